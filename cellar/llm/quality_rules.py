"""Quality rules with risk-controlled thresholds.

Base rules have fixed limits. Further rules (``RULES``) each compare one ratio
with a cutoff from a fixed grid, ordered from the loosest to the strictest. Per
stratum, labelled good documents that pass the base rules are the holdout: a
cutoff is certified when the exact binomial test rejects "its false rejection
rate is above ``alpha / rules``" at level ``delta / (rules * strata)``
(Bonferroni over rules and strata). Within a rule, cutoffs are tested in fixed
order and testing stops at the first failure, which needs no further
correction. So with probability 1 - delta, in every stratum, all rules together
falsely reject at most ``alpha`` of the good documents. Of the certified
cutoffs the one with the best balance of rejected bad and good documents is
taken; a stratum with too few labels has none, and the rule is idle there.

Null text: no words. Null stratum: a stratum of its own. A document without
words fails the base rules. Repeated rows are judged each by itself. Labels
that disagree for one document count as bad. Texts are processed whole.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import fresh, materialize, with_struct
from cellar.llm.words import Words, mix, run_hashes, slices, span_hashes, within

#: rule: (expression over the measures m, higher is worse, cutoffs from loose to strict)
RULES = {
    "symbols": ("try_divide(m.n_symbols, m.n_words)", True, (2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05)),
    "dup_lines": ("try_divide(m.n_dup_lines, m.n_lines)", True, (0.9, 0.7, 0.5, 0.4, 0.3, 0.2)),
    "repeats": ("try_divide(m.n_repeat_words, m.n_words)", True, (0.5, 0.3, 0.2, 0.15, 0.1)),
    "upper": ("try_divide(m.n_upper, m.word_chars)", True, (0.9, 0.7, 0.5, 0.3, 0.2)),
    "exclaims": ("try_divide(m.n_exclaims, m.n_words)", True, (2.0, 1.0, 0.5, 0.3, 0.2)),
    "long_words": ("try_divide(m.word_chars, m.n_words)", True, (30.0, 20.0, 15.0, 12.0, 10.0)),
}

MEASURES = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_lines:bigint,n_dup_lines:bigint,n_repeat_words:bigint,n_upper:bigint,n_exclaims:bigint>"
_NAMES = [x.split(":")[0] for x in MEASURES[7:-1].split(",")]
WINDOW = 5
MAX_BROADCAST_STRATA = 20_000


def _marks(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


_SYMBOL, _EXCLAIM, _UPPER = _marks("#*$%&|<>"), _marks("!"), _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _repeated(keys: np.ndarray, first_too: bool) -> np.ndarray:
    """Mark the keys that occurred before; with ``first_too`` their first occurrence as well."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    if first_too:
        out[order[:-1][same]] = True
    return out


def _measure_slice(offsets: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    w = Words(offsets, data)
    n = w.n_docs

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[offsets[1:]] - total[offsets[:-1]]

    space = ((data >= 9) & (data <= 13)) | (data == 32)
    out = {
        "n_words": w.n,
        "word_chars": per_text(~space & ((data & 0xC0) != 0x80)),
        "n_symbols": per_text(_SYMBOL[data]),
        "n_upper": per_text(_UPPER[data]),
        "n_exclaims": per_text(_EXCLAIM[data]),
    }
    # lines that have a word: found by their first word
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, w.starts)
    lead = np.flatnonzero(np.diff(line, prepend=-1).astype(bool) | np.diff(w.doc, prepend=-1).astype(bool))
    doc, line = w.doc[lead], line[lead]
    edges = np.concatenate(([-1], breaks, [len(data)]))
    begins = np.maximum(edges[line] + 1, offsets[doc])
    ends = np.minimum(edges[line + 1], offsets[doc + 1])
    again = _repeated(within(doc, span_hashes(data, begins, ends)), False)
    # equal hashes point at equal lines; the bytes decide
    if again.any():
        raw, seen = data.tobytes(), set()
        in_question = np.isin(doc, np.unique(doc[again]))
        again[:] = False
        for i in np.flatnonzero(in_question).tolist():
            line_ = doc[i], raw[begins[i] : ends[i]]
            again[i] = line_ in seen
            seen.add(line_)
    out["n_lines"] = np.bincount(doc, minlength=n)
    out["n_dup_lines"] = np.bincount(doc[again], minlength=n)
    # words inside windows found twice or more
    h = w.hashes()
    at, g = w.ngrams(h, WINDOW)
    hit = at[_repeated(within(w.doc[at], g ^ mix(run_hashes(h, at, at + WINDOW, other=True))), True)]
    cover = np.zeros(len(w.starts) + 1, np.int64)
    cover[hit] += 1
    np.subtract.at(cover, hit + WINDOW, 1)
    out["n_repeat_words"] = np.bincount(w.doc[np.cumsum(cover[:-1]) > 0], minlength=n)
    return out


def measure_texts(texts: pa.Array) -> pa.StructArray:
    """The measures of each text of a batch."""
    parts = [_measure_slice(off, data) for _, _, off, data in slices(texts)]
    return pa.StructArray.from_arrays([pa.array(np.concatenate([p[k] for p in parts]).astype(np.int64)) for k in _NAMES], _NAMES)


def measure(docs: DataFrame, into: str = "m", text: str = "text", keep: bool = True) -> DataFrame:
    """``docs`` (without the texts, unless ``keep``) and the measures of every whole text in struct ``into``."""
    return with_struct(docs, into, MEASURES, measure_texts, text, keep)


def base_failed(m: str = "m"):
    return F.expr(f"{m}.n_words < 10 OR 100 * {m}.n_repeat_words > 20 * {m}.n_words")


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), 1 where k >= n * p (never small there)."""
    if k >= n * p:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    total = 0.0
    for i in range(k, -1, -1):  # terms fall geometrically
        total += term
        if term < total * 1e-17:
            break
        term *= i * (1 - p) / ((n - i + 1) * p)
    return min(total, 1.0)


def _p_values(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    return pd.Series([binomial_cdf(int(a), int(b), float(c)) for a, b, c in zip(k, n, p)], dtype="float64")


def _levels(m: str = "m"):
    """Per rule: the number of its cutoffs that the document violates."""
    out = []
    for name, (value, high, cutoffs) in RULES.items():
        value = value.replace("m.", f"{m}.")
        # cutoffs are nested, so the violated ones are the loosest up to a level counted from the strict end
        hit = " + ".join(f"IF({value} {'>' if high else '<'} {c}D, 1, 0)" for c in cutoffs)
        out.append(F.struct(F.lit(name).alias("rule"), F.coalesce(F.expr(hit), F.lit(0)).alias("violated"), F.lit(len(cutoffs)).alias("size")))
    return F.array(*out)


def thresholds(measured: DataFrame, labels: DataFrame, id: str = "doc_id", stratum: str = "stratum", alpha: float = 0.03, delta: float = 0.1, weight: float = 5.0) -> DataFrame:
    """One row per stratum and rule: ``limit``, the number of cutoffs a kept document may violate.

    ``measured`` has ``id``, ``stratum`` and the measures ``m``. A document that
    violates v of a rule's s cutoffs breaks cutoff number j (0 is the loosest)
    when s - j <= v; taking cutoff j rejects documents with v >= s - j.
    """
    good = labels.where(F.col("quality").isNotNull()).groupBy(id).agg(F.min("quality").alias("good"))
    held = measured.where(~base_failed()).join(good, id).select(stratum, "good", F.explode(_levels()).alias("r"))
    counts = held.groupBy(stratum, F.col("r.rule").alias("rule"), F.col("r.size").alias("size"), F.col("r.violated").alias("violated")).agg(
        F.sum((F.col("good") == 1).cast("long")).alias("g"), F.sum((F.col("good") != 1).cast("long")).alias("b")
    )
    by_rule = counts.groupBy(stratum, "rule", "size").agg(F.collect_list(F.struct("violated", "g", "b")).alias("c"), F.sum("g").alias("n"), F.sum("b").alias("n_bad"))
    by_rule = materialize(by_rule, "quality-holdout")  # at most a row per stratum and rule
    grid = by_rule.select(
        stratum, "rule", "n", "n_bad", "c", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("j"), "size"
    ).select(
        stratum, "rule", "n", "n_bad", "j", (F.col("size") - F.col("j")).alias("at"),
        F.expr("aggregate(c, 0L, (s, x) -> s + IF(x.violated >= size - j, x.g, 0L))").alias("k"),
        F.expr("aggregate(c, 0L, (s, x) -> s + IF(x.violated >= size - j, x.b, 0L))").alias("hit"),
    )
    rules, tests = len(RULES), max(1, by_rule.count())  # strata times rules
    p = F.pandas_udf(_p_values, "double")("k", "n", F.lit(alpha / rules))
    tested = grid.withColumn("ok", (p <= delta / tests).cast("int"))
    seq = Window.partitionBy(stratum, "rule").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    gain = F.col("hit") / F.greatest(F.col("n_bad"), F.lit(1)) - F.lit(weight) * F.col("k") / F.greatest(F.col("n"), F.lit(1))
    certified = tested.withColumn("ok", F.min("ok").over(seq)).where("ok = 1").withColumn("gain", gain)
    best = certified.groupBy(stratum, "rule").agg(F.max(F.struct("gain", "at")).alias("best"))  # a tie takes the loosest
    return best.where("best.gain > 0").select(stratum, "rule", F.col("best.at").alias("at"))


def apply_rules(measured: DataFrame, limits: DataFrame, stratum: str = "stratum") -> DataFrame:
    """Adds ``base_failed``, ``broken`` (the certified rules it breaks) and ``kept``."""
    per = limits.groupBy(stratum).agg(F.map_from_entries(F.collect_list(F.struct("rule", "at"))).alias("_limits"))
    if limits.count() <= MAX_BROADCAST_STRATA * len(RULES):
        per = F.broadcast(per)
    per = per.withColumnRenamed(stratum, "_stratum")
    out = measured.join(per, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    broken = F.transform(
        F.filter(_levels(), lambda r: r["violated"] >= F.coalesce(F.try_element_at(F.col("_limits"), r["rule"]), F.lit(1 << 30))), lambda r: r["rule"]
    )
    out = out.withColumn("base_failed", base_failed()).withColumn("broken", broken)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)).drop("_limits", "_stratum")


def _with_stratum(docs: DataFrame, by: str) -> DataFrame:
    return docs.withColumn("stratum", F.col(by).cast("string") if by in docs.columns else F.lit(""))


def judge(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", by: str = "lang") -> DataFrame:
    """One row per document: id, measures ``m``, ``base_failed``, ``broken`` and ``kept``.

    The texts are read once; the measures (a few numbers per document) are
    written to the shared folder because the cutoffs and the verdicts need them.
    """
    slim = _with_stratum(docs, by).select(F.col(id), F.col("stratum"), F.col(text).cast("string").alias("text"))
    measured = materialize(measure(slim, "m", keep=False), "quality-measures")
    limits = materialize(thresholds(measured, labels, id), "quality-limits")
    return apply_rules(measured, limits)


def keep(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", by: str = "lang") -> DataFrame:
    """The documents that pass, with their columns.

    Texts are measured twice (once for the cutoffs, once for the verdict), which
    costs a scan but moves no text: only the cutoffs are joined, by stratum.
    For the verdict a text passes through the worker once, as the column it is.
    """
    slim = _with_stratum(docs, by).select(F.col(id), F.col("stratum"), F.col(text).cast("string").alias("text"))
    measured = measure(slim, "m", keep=False)
    limits = materialize(thresholds(measured, labels, id), "quality-limits")
    own = fresh(docs, "doc")
    once = text in docs.columns and docs.schema[text].dataType == T.StringType()
    rest = [c for c in docs.columns if not (once and c == text)] or docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias(own), F.col(text).cast("string").alias("text"), F.col(by).cast("string").alias("stratum") if by in docs.columns else F.lit("").alias("stratum"))
    judged = apply_rules(measure(whole, "m", keep=once), limits)
    return judged.where("kept").select(*[F.col("text").alias(c) if once and c == text else F.col(own).getField(c).alias(c) for c in docs.columns])
