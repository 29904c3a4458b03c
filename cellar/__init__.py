"""Review analytics and recommendation operators on Spark."""
