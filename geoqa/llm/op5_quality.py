"""Operator 5 - quality rules whose cutoffs carry a risk guarantee.

Each rule rejects a document whose measure is above a cutoff.  Labelled documents
are split in two.  For every stratum (length class) the fit half proposes a path:
(rule, cutoff) pairs in order of growing cost in good documents, so that each
step rejects all that the steps before it do.  The holdout half tests the steps
in this order; a step holds while the exact (Clopper-Pearson) upper bound on the
share of good documents rejected so far is at most ``ALPHA``, and testing ends
at the first failure.  In a fixed order that ends at a failure the steps need no
further correction; over strata the error level is divided (Bonferroni).  So with
probability ``1 - DELTA`` no stratum loses more than ``ALPHA`` of its good
documents to the learned rules.  Without enough labels nothing is certified and
nothing rejected.  Only counts - strata x rules x cutoffs - reach the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoqa.llm import textscan as T
from geoqa.llm.common import arrow_map, crc32_of_id, only, stored, table

ALPHA, DELTA = 0.02, 0.05
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Strata: documents of up to so many words (the last has no end).
LENGTHS = (40, 200, 1000)
#: Cutoffs that can be proposed: steps of every measure's range from 0 to 1.
STEPS = 100
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "long_words": "least(word_chars / greatest(n_words, 1) / 40, 1)",
    "single_marks": "n_marks / greatest(n_words, 1)",
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_WORD_CHAR = T.SPACED.copy()
_WORD_CHAR[0x80:0xC0] = False  # a code point counts at its first byte
_IN_LINE = np.ones(256, bool)
_IN_LINE[0x0A] = False


def _marked(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (row, key): is it found twice or more, and is it a later one."""
    _, first, place, n = np.unique(T.mix(key + T.mix(row.astype(np.uint64) + np.uint64(1))),
                                   return_index=True, return_inverse=True, return_counts=True)
    return n[place] > 1, first[place] != np.arange(len(key))


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Counts of every row's whole text: ``n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, n_marks`` (words without a letter or digit).  Null text counts as empty: all 0."""
    docs = only(df, id=id_col, text=text_col)
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_marks"]

    def run(batches):
        for b in batches:
            at = 0
            for lo, hi, data, offs in T.chunks(b.column(1)):
                m = hi - lo
                w = T.scan(data, offs)
                chars, symbols = _WORD_CHAR[data], _SYMBOL[data]
                ends = list(zip(offs[:-1].tolist(), offs[1:].tolist()))
                word_chars = [np.count_nonzero(chars[a:z]) for a, z in ends]
                n_symbols = [np.count_nonzero(symbols[a:z]) for a, z in ends]
                line = T.scan(data, offs, _IN_LINE)
                real = np.searchsorted(w.start, line.end) > np.searchsorted(w.start, line.start)
                row, key = line.doc[real], line.key[real]
                _, again = _marked(key, row)
                roll = T.rolling(w.key, window)
                inside = np.flatnonzero(w.doc[:len(roll)] == w.doc[window - 1:]) if len(roll) else np.zeros(0, np.int64)
                twice, _ = _marked(roll[inside], w.doc[inside])
                # words under any repeated window: +1 where one begins, -1 where it ends
                cover = np.zeros(len(w) + 1, np.int32)
                np.add.at(cover, inside[twice], 1)
                np.add.at(cover, inside[twice] + window, -1)
                under = np.cumsum(cover[:-1]) > 0
                alnum = T.scan(data, offs, T.ALNUM)
                marks = np.searchsorted(alnum.start, w.end) == np.searchsorted(alnum.start, w.start)
                cols = [w.counts(), word_chars, n_symbols, np.bincount(row, minlength=m), np.bincount(row[again], minlength=m),
                        np.bincount(w.doc[under], minlength=m), np.bincount(w.doc[marks], minlength=m)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, m), *(pa.array(np.asarray(c), pa.int64()) for c in cols)], ["id", *names])
                at += m

    return arrow_map(docs, run, f"id {docs.schema['id'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names))


def upper_bound(k: int, n: int, level: float) -> float:
    """Clopper-Pearson: the rate p at which k or fewer of n have probability ``level``."""
    if n == 0 or k >= n:
        return 1.0
    lo, hi = k / n, 1.0
    for _ in range(60):
        p = (lo + hi) / 2
        if p >= 1:
            break
        lo, hi = (p, hi) if beta_share(n - k, k + 1, 1 - p) > level else (lo, p)
    return hi


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b): the chance of at least ``a`` hits in a + b - 1 trials at
    rate ``x``, by its continued fraction (some steps for each root of a + b, not one a trial)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_share(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 1_000_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + term * d, 1 + term / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return front * out


def _stratum() -> F.Column:
    return F.expr("case " + " ".join(f"when n_words <= {m} then {i}" for i, m in enumerate(LENGTHS)) + f" else {len(LENGTHS)} end")


def _steps() -> list[F.Column]:
    """Each rule's measure in steps: a cutoff c rejects steps above c."""
    return [F.expr(f"cast(ceil({STEPS} * ({e})) as int)").alias(r) for r, e in RULES.items()]


def paths(hist: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each stratum (rule, cutoff) steps from the cheapest on; ``hist[stratum, y, rule, step]`` counts the fit half."""
    above = hist.sum(-1, keepdims=True) - hist.cumsum(-1)  # [..., c]: rows with a step above c
    out = []
    for s in range(len(hist)):
        steps = []
        for i in range(hist.shape[2]):
            bad, good = above[s, 0, i], above[s, 1, i]
            n_bad, n_good = max(1, hist[s, 0, i].sum()), max(1, hist[s, 1, i].sum())
            for c in range(STEPS, -1, -1):
                # only cutoffs that reject bad documents clearly more often than good ones
                if bad[c] >= 3 and bad[c] > bad[c + 1] and bad[c] / n_bad > 10 * good[c] / n_good:
                    steps.append((good[c] / n_good, i, -c))
        out.append([(i, -c) for _, i, c in sorted(steps)])
    return out


def certified(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
              alpha: float = ALPHA, delta: float = DELTA) -> list[dict]:
    """Accepted steps: ``stratum, rule, cutoff``, and ``rejected, good, bound`` of the path up to there.
    Labels other than 0 and 1 are left out; of repeated labels of a document the smallest counts."""
    label = only(labels, id=id_col, y=label_col).where("y in (0, 1) and id is not null").groupBy("id").agg(F.min("y").cast("int").alias("y"))
    names = list(RULES)
    rows = (measured.where(f"n_words >= {MIN_WORDS}").join(label, "id").select(
        _stratum().alias("stratum"), (crc32_of_id(F.col("id")) % 2).cast("int").alias("half"), "y", *_steps()))
    long = rows.where("half = 0").select("stratum", "y", F.explode(F.array(*[
        F.struct(F.lit(i).alias("rule"), F.col(r).alias("step")) for i, r in enumerate(names)])).alias("m"))
    hist = np.zeros((len(LENGTHS) + 1, 2, len(names), STEPS + 2), np.int64)
    for r in long.groupBy("stratum", "y", "m.rule", "m.step").count().collect():  # <= strata * 2 * rules * STEPS rows
        hist[r.stratum, r.y, r.rule, min(max(r.step, 0), STEPS + 1)] += r["count"]
    path = paths(hist)
    # the first step of its stratum's path that rejects a row
    firsts = []
    for s, steps in enumerate(path):
        for i, r in enumerate(names):
            first = [next((j for j, (k, c) in enumerate(steps) if k == i and step > c), len(steps)) for step in range(STEPS + 2)]
            firsts.append(F.when(F.col("stratum") == s, F.element_at(F.array(*map(F.lit, first)), F.greatest(F.least(F.col(r), F.lit(STEPS + 1)), F.lit(0)) + 1)))
    held = rows.where("half = 1 and y = 1").select("stratum", F.least(*firsts).alias("first")).groupBy("stratum", "first").count().collect()
    out = []
    for s, steps in enumerate(path):
        n = sum(r["count"] for r in held if r.stratum == s)
        for j, (i, c) in enumerate(steps):
            k = sum(r["count"] for r in held if r.stratum == s and r.first <= j)
            bound = upper_bound(k, n, delta / len(path))
            if bound > alpha:
                break
            out.append({"stratum": s, "rule": names[i], "cutoff": c, "rejected": k, "good": n, "bound": bound})
    return out


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
            alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Measures of every row, ``base_failed``, ``rules`` (names of the certified rules that reject it) and ``kept``.

    Rows keep their number; null or empty text has no words and fails the base
    rules; without usable labels only the base rules reject; an empty table gives
    no rows.  Extra columns are ignored.
    """
    m = stored(measures(df, id_col, text_col), "measures")
    rules = certified(m, labels, id_col, label_col, alpha, delta)
    steps = dict(zip(RULES, _steps()))
    lowest = {}  # a path only lowers a rule's cutoff
    for c in rules:
        lowest[c["stratum"], c["rule"]] = min(c["cutoff"], lowest.get((c["stratum"], c["rule"]), STEPS + 1))
    hits = [F.when((_stratum() == s) & (steps[r] > c), F.lit(r)) for (s, r), c in lowest.items()]
    names = F.filter(F.array(*hits), lambda x: x.isNotNull()) if hits else F.array().cast("array<string>")
    failed = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words")
    return m.withColumn("base_failed", failed).withColumn("rules", names).withColumn("kept", ~F.col("base_failed") & (F.size("rules") == 0))


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", F.array_join("rules", ",").alias("rules"))
