"""Operator 8 - license scans by ordered signature rules.

A rule is tried on a text only if all strings that its matches contain occur in it,
so of hundreds of patterns a few run, on the few texts that name a license.
Detections are taken in order of priority, longest first; one that lies inside a
kept detection of its own or an earlier priority is suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoqa.llm import textscan as T
from geoqa.llm.common import arrow_map, only, table
from geoqa.llm.license_rules import rules

#: Base phrases (consecutive words) and their labels: fixed values.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BASE_WEIGHT = 0.7

_ready: list = []


def _compiled():
    """[(label, keyword numbers, pattern, priority, weight)], rules by gate, keywords, other keywords by gate.
    A rule's gate is the keyword that it shares with the most rules."""
    if not _ready:
        table_ = rules()
        uses = Counter(w for r in table_ for w in r[1])
        words = sorted(uses, key=lambda w: (uses[w], w))
        number = {w: i for i, w in enumerate(words)}
        compiled = [(label, frozenset(number[w] for w in need), re.compile(rf"(?<![\w-])(?:{p})(?![\w-])"), priority, weight)
                    for label, need, p, priority, weight in table_]
        first: dict[int, list[int]] = {}
        for i, r in enumerate(compiled):
            first.setdefault(max(r[1]), []).append(i)
        others = {gate: sorted(set().union(*(compiled[i][1] for i in of)) - {gate}) for gate, of in first.items()}
        _ready.append((compiled, first, words, others))
    return _ready[0]


def keywords_in(text: str) -> set[int]:
    """Keywords of a lower-cased text, as far as a rule may need them."""
    _, _, words, others = _compiled()
    present: set[int] = set()
    for gate, more in others.items():
        if gate in present or words[gate] in text:
            present.add(gate)
            present.update(k for k in more if k not in present and words[k] in text)
    return present


def detect(text: str, present: set[int]) -> list[tuple[int, int, str, int, float]]:
    """Kept detections (start, end, label, priority, weight) of a lower-cased text that has the keywords ``present``."""
    compiled, first, _, _ = _compiled()
    found: dict[int, list] = {}
    for word in present:
        for i in first.get(word, ()):
            label, need, pattern, priority, weight = compiled[i]
            if need <= present:
                found.setdefault(priority, []).extend((m.start(), -m.end(), i) for m in pattern.finditer(text))
    kept: list = []
    starts, reach = [], []  # kept so far by start, and how far any of them up to there reaches
    for priority in sorted(found):
        far, new = -1, []
        for start, end, i in sorted(found[priority]):
            at = bisect_right(starts, start) - 1
            if -end > max(far, reach[at] if at >= 0 else -1):
                far = -end
                new.append((start, -end, compiled[i][0], priority, compiled[i][4]))
        kept = sorted(kept + new)
        starts = [k[0] for k in kept]
        reach = list(accumulate((k[1] for k in kept), max))
    return kept


def base_places(w: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """(word index, phrase number) of every place where a base phrase stands within one row."""
    places, which = [], []
    for p, keys in enumerate(T.keys_of(list(PHRASES), T.ALNUM)):
        at = np.flatnonzero(w.key == keys[0])
        at = at[at + len(keys) <= len(w)]
        for j, k in enumerate(keys[1:], 1):
            at = at[w.key[at + j] == k]
        at = at[w.doc[at] == w.doc[at + len(keys) - 1]]
        places.append(at)
        which.append(np.full(len(at), p))
    return np.concatenate(places), np.concatenate(which)


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections`` of every row.

    ``detections`` are the kept (start, end, label) in code points of the text.  Null text is
    empty: no words, no labels (empty strings), null first and last word, score 0.
    """
    docs = only(df, id=id_col, text=text_col)

    def run(batches):
        names = list(PHRASES.values())
        for b in batches:
            at0 = 0
            for lo, hi, data, offs in T.chunks(b.column(1)):
                m = hi - lo
                w = T.scan(data, offs, T.ALNUM, lower=True)
                place, phrase = base_places(w)
                row = w.doc[place]
                n_base = np.bincount(row, minlength=m)
                first = np.full(m, np.iinfo(np.int64).max)
                last = np.full(m, -1)
                word = place - w.first()[row]
                np.minimum.at(first, row, word)
                np.maximum.at(last, row, word)
                base = [set() for _ in range(m)]
                for r, p in zip(row.tolist(), phrase.tolist()):
                    base[r].add(names[p])
                labels, score, spans = [set(x) for x in base], np.where(n_base > 0, BASE_WEIGHT, 0.0), [[] for _ in range(m)]
                for r in range(m):
                    text = data[offs[r]:offs[r + 1]].tobytes().lower().decode()  # lowers A-Z only
                    kept = detect(text, keywords_in(text))
                    if kept:
                        spans[r] = [{"start": s, "end": e, "label": x} for s, e, x, _, _ in kept]
                        labels[r] |= {x for _, _, x, _, _ in kept}
                        score[r] = max(score[r], max(k[4] for k in kept))
                some = n_base > 0
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(at0, m), pa.array(w.counts(), pa.int64()), pa.array(n_base, pa.int64()),
                    pa.array(first, pa.int64(), mask=~some), pa.array(last, pa.int64(), mask=~some),
                    pa.array([",".join(sorted(x)) for x in base], pa.string()), pa.array([",".join(sorted(x)) for x in labels], pa.string()), pa.array(score),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string())])))],
                    ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])
                at0 += m

    return arrow_map(docs, run, f"id {docs.schema['id'].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, "
                     "base_labels string, labels string, score double, detections array<struct<start: int, end: int, label: string>>")


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    out = scan_licenses(table(spark, sf_dir, "documents"))
    return out.withColumnRenamed("id", "doc_id").withColumn("n_detections", F.size("detections").cast("long")).drop("detections")
