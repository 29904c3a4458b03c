"""Table sources, role views, file sources and sinks."""
