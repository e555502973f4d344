import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoqa.llm import license_rules, op3_lm, op5_quality, op6_toxicity, op7_decontaminate, op8_licenses
from tests.llm.cases import EDGE, LOWER, alnum, documents, prose, spaced


def key(rows):
    return sorted(rows, key=str)


# operator 3

def test_base_scores_are_exact_for_any_tier(spark):
    rows = EDGE + [(100 + i, prose(i % 7, 40 + i)) for i in range(30)]
    df = documents(spark, rows)
    train = [(i, t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    words = lambda t: [x.encode() for x in spaced((t or "").translate(LOWER))] + [None]
    c = collections.Counter(x for _, t in train for x in words(t))
    n, v = sum(c.values()), len(c)
    want = []
    for i, t in rows:
        w = words(t)
        want.append((i, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)))
    train_df = df.where(op3_lm.crc32_of_id(F.col("doc_id")) % 7 != 2)
    for entries in (1 << 20, 10, 1):
        got = op3_lm.score_texts(df, train_df, entries=entries, bits=1 << 20).collect()
        assert key((r.id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == key(want)
        assert all(r.score < 0 for r in got)
    assert op3_lm.score_texts(df.limit(0), train_df, bits=1 << 20).count() == 0
    alone = op3_lm.score_texts(df, df.limit(0), bits=1 << 20).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and abs(r.base_score) < 1e-9 for r in alone)


def test_filter_reads_back_levels():
    r = np.random.default_rng(0)
    k = r.integers(0, 2 ** 63, 20000).astype(np.uint64)
    level = r.integers(1, 8, len(k))
    blocks = (1 << 21) // 64 // op3_lm.SEGMENTS // 8
    words = np.zeros((1 << 21) // 64, np.uint64)
    for a, n in zip(np.split(k, 10), np.split(level, 10)):
        kk = np.repeat(a, n)
        block, bits = op3_lm.Filter.places(kk, op3_lm.T.spans(n) + 1, blocks)
        base = op3_lm.Filter.segment(kk) * blocks * 8
        for b in bits:
            np.bitwise_or.at(words, base + block + (b >> np.uint64(6)).astype(np.int64), np.uint64(1) << (b & np.uint64(63)))
    f = op3_lm.Filter(words)
    got = f.levels(k)
    assert (got >= level).all() and (got == level).mean() > 0.97
    assert (f.levels(r.integers(0, 2 ** 63, 20000).astype(np.uint64)) == 0).mean() > 0.97


def test_a_look_into_the_filter_takes_few_keys_at_once():
    """Levels of many keys: right for each, without arrays of all keys for every probe."""
    import tracemalloc
    r = np.random.default_rng(1)
    k, n = r.integers(0, 2 ** 63, 10 * op3_lm.SHORT).astype(np.uint64), 8
    f = op3_lm.Filter(np.full(op3_lm.SEGMENTS * 8 * n, (1 << 64) - 1, np.uint64))
    f.words.reshape(op3_lm.SEGMENTS, n, 8)[1::2] = 0  # odd segments are empty; even ones have all up to any level
    odd = op3_lm.Filter.segment(k) % 2 == 1
    has = f.has
    f.has = lambda key, base, level: has(key, base, level) if level < 6 else np.zeros(0, np.int64)
    tracemalloc.start()
    got = f.levels(k)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got[odd] == 0).all() and (got[~odd] == 5).all()
    assert peak < 100 * len(k), peak / len(k)


def test_fill_gets_large_batches(spark, monkeypatch):
    """Rows of two numbers are handed over in batches far larger than those of texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    seen, before = [], spark.conf.get(key)
    first = type(spark.range(1)).first
    monkeypatch.setattr(type(spark.range(1)), "first", lambda df: (seen.append(int(spark.conf.get(key))), first(df))[1])
    entries = spark.range(5000).selectExpr("id * 7919 key", "1L + id % 3 level")
    parts = op3_lm.build_filter(entries, 10000, 1 << 16)
    assert max(seen) >= op3_lm.SHORT and spark.conf.get(key) in (before, "1000")
    assert (parts.levels(np.arange(5000, dtype=np.uint64) * np.uint64(7919)) >= 1 + np.arange(5000) % 3).all()


def test_model_beats_unigrams_on_held_out_text(spark):
    rows = [(i, " ".join(f"w{(i * 7 + 3 * j) % 50}" for j in range(80))) for i in range(200)]
    df = documents(spark, rows)
    got = op3_lm.score_texts(df.where("doc_id >= 150"), df.where("doc_id < 150"), bits=1 << 20).collect()
    assert all(r.score > r.base_score for r in got)


def test_filter_grows_with_the_counts(spark):
    rows = [(i, " ".join(f"w{(i * i + j * (i % 11 + 1)) % 4000}" for j in range(60))) for i in range(400)]
    df = documents(spark, rows)
    c, pairs = collections.Counter(), collections.Counter()
    for _, t in rows:
        w = [None, *t.split(), None]
        c.update(w[1:])
        pairs.update(zip(w, w[1:]))
    n, v, heads, kinds = sum(c.values()), len(c), collections.Counter(), collections.Counter()
    for (h, _), k in pairs.items():
        heads[h] += k
        kinds[h] += 1
    want = []
    for _, t in rows:
        w = [None, *t.split(), None]
        want.append(sum(math.log10((pairs[a, b] - 0.75) / c[a] + max(0.75 * kinds[a] / heads[a], op3_lm.FLOOR) * (c[b] + 1) / (n + v + 1)) for a, b in zip(w, w[1:])))
    for bits in (1 << 28, 1 << 16):  # one part, many parts
        got = [r.score for r in sorted(op3_lm.score_texts(df, df, bits=bits).collect(), key=lambda r: r.id)]
        assert all(abs(a - b) < 0.1 * abs(b) for a, b in zip(got, want))  # levels are counts within a step of 1.5
    assert op3_lm.model_of(df.select("text"), 1 << 16)[1].parts > 4


def test_filter_in_files_false_positives_and_total(spark):
    """Against exact counts: what the filter reads back, how often it is wrong, and what probabilities add up to."""
    r = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{min(int(x), 900)}" for x in r.zipf(1.4, 120))) for i in range(150)]
    docs = documents(spark, rows).select("text")
    for held in (op3_lm.HELD, 50):  # counts that a task hands on early add up to the same
        got = {(x.order, x.key): x.n for x in op3_lm.ngram_counts(docs, held).collect()}
        assert sum(n for (o, _), n in got.items() if o == 1) == 150 * 121 and len(got) > 1000
        counts = got if held == op3_lm.HELD else counts
        assert got == counts
    model, parts, _, _ = op3_lm.model_of(docs, 1 << 14)
    assert parts.parts > 4
    known = {o: np.array([k for (x, k) in counts if x == o], np.int64).view(np.uint64) for o in (1, 2)}
    true = {o: np.array([counts[o, int(k)] for k in known[o].view(np.int64)]) for o in (1, 2)}
    for o in (1, 2):
        level = parts.levels(known[o])
        want = 1 + np.floor(np.log(true[o]) / np.log(op3_lm.BASE) + 1e-9).astype(int)
        assert (level >= want).all() and (level > want).mean() < 0.03
        unseen = parts.levels(r.integers(0, 2 ** 63, 20000).astype(np.uint64))
        assert (unseen > 0).mean() < 0.02
    text = " ".join(sorted({w for _, t in rows for w in t.split()}))
    vocabulary = np.unique(op3_lm.tokens(op3_lm.T.scan(*op3_lm.T.buffer_of(op3_lm.pa.array([text]))))[1])
    ones, twos = model.means
    p1 = (ones[np.minimum(parts.levels(vocabulary), len(ones) - 1)] + 1) / (model.n + model.v + 1)
    for h in vocabulary[::40]:
        pair = twos[np.minimum(parts.levels(op3_lm.pair_key(np.full(len(vocabulary), h), vocabulary)), len(twos) - 1)]
        count = ones[np.minimum(parts.levels(np.array([h])), len(ones) - 1)][0]
        beta = 1 - min(int(parts.levels(op3_lm.share_key(np.array([h])))[0]), op3_lm.SHARES) / op3_lm.SHARES
        total = (np.maximum(pair - op3_lm.DISCOUNT, 0) / np.maximum(count, np.maximum(pair, 1)) + max(beta, op3_lm.FLOOR) * p1).sum()
        assert 0.75 < total < 1.3, total


# operator 5

def measures(t):
    w, seen, dup, lines = spaced(t), set(), 0, 0
    for line in (t or "").split("\n"):
        if spaced(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    c = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if c[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum((t or "").count(x) for x in "#*$%&|<>"), lines, dup, len(cover)


def test_quality_measures(spark):
    rows = EDGE + [(50, "a b c d e a b c d e f\nx | y\nx | y\n x | y\n\n"), (51, "#*$ %&|<> ## é…"), (52, "go go go go go go")]
    got = op5_quality.measures(documents(spark, rows)).collect()
    assert key(tuple(r)[:7] for r in got) == key((i, *measures(t)) for i, t in rows)
    labels = spark.createDataFrame([(1, None), (5, 1), (5, 0), (None, 1), (999, 0)], "doc_id long, quality int")
    out = op5_quality.quality(documents(spark, rows), labels).collect()
    assert len(out) == len(rows)
    for r in out:  # too few labels: nothing is certified
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept == (not r.base_failed) and list(r.rules) == []
    assert op5_quality.quality(documents(spark, []), labels).count() == 0


def test_binomial_bound():
    for k, n in ((0, 50), (3, 80), (10, 40)):
        u = op5_quality.upper_bound(k, n, 0.05)
        cdf = sum(math.comb(n, i) * u ** i * (1 - u) ** (n - i) for i in range(k + 1))
        assert abs(cdf - 0.05) < 1e-6
    import time
    begun = time.perf_counter()
    u = op5_quality.upper_bound(2_000_000, 100_000_000, 0.05)
    assert time.perf_counter() - begun < 2 and 0.02 < u < 0.0201
    assert op5_quality.upper_bound(0, 0, 0.05) == 1.0 and op5_quality.upper_bound(4, 4, 0.05) == 1.0


def test_certified_rules_keep_their_promise(spark):
    rows, labels = [], []
    for i in range(3000):
        bad = i % 6 == 0
        text = prose(i, 60)
        rows.append((i, text.replace(" ", "### ") if bad else text))
        labels.append((i, int(not bad)))
    out = op5_quality.quality(documents(spark, rows, extra=False), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    good = [r for r in out if r.id % 6 and not r.base_failed]
    bad = [r for r in out if r.id % 6 == 0]
    assert sum(not r.kept for r in good) <= op5_quality.ALPHA * len(good)
    assert sum(not r.kept for r in bad) > 0.9 * len(bad)


# operator 6

def test_training_sample_has_long_rows_and_its_full_size(spark):
    long = " ".join(f"w{i % 3000}" for i in range(25000)) + " grobnak"
    rows = [(i, long if i == 0 else f"text {i}") for i in range(9000)]
    labels = spark.createDataFrame([(i, int(i < 3000)) for i in range(9000)], "doc_id long, toxic int")
    bags, _ = op6_toxicity.training_sample(documents(spark, rows, extra=False), labels, "doc_id", "text", "toxic")
    assert collections.Counter(bags.column("y").to_pylist()) == {1: 2000, 0: 4000}
    bags, _ = op6_toxicity.training_sample(documents(spark, rows[:1], extra=False), labels.where("doc_id = 0"), "doc_id", "text", "toxic")
    assert [("grobnak" in w, sum(n)) for w, n in zip(bags.column("words").to_pylist(), bags.column("counts").to_pylist())] == [(True, 25001)]


def test_toxicity_learns_words_and_misspellings(spark):
    insults = ["grobnak", "vilzuck", "snurfel", "dratvog"]
    rows = []
    for i in range(900):
        w = prose(i, 60).split()
        if i % 5 == 0:
            for j in range(3):
                w[(i * 13 + j * 17) % 60] = insults[(i + j) % 4]
        rows.append((i, " ".join(w)))
    df = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(900)], "doc_id long, toxic int")
    out = op6_toxicity.toxicity(df, df, labels).collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in out)
    assert sum(r.predicted == (r.id % 5 == 0) for r in held) >= 0.98 * len(held)
    bags, share = op6_toxicity.training_sample(df, labels, "doc_id", "text", "toxic")
    model = op6_toxicity.train(bags, share)
    new = [(1, prose(5001, 50)), (2, prose(5002, 50) + " Grobnakk vilzucks, snurfels!"), (3, None), (4, ""), (None, "?"), (6, prose(3, 50) + " grobnaks")]
    got = {r.id: r.score for r in op6_toxicity.score_texts(documents(spark, new), model).collect()}
    assert got[2] > 0.3 > got[1] and got[3] == got[4] == got[None] < 0.3
    assert [r.doc_id for r in op6_toxicity.without_toxic(documents(spark, new), model).select("doc_id").orderBy("doc_id").collect()][:2] == [None, 1]


def test_toxicity_without_labels(spark):
    df = documents(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(abs(r.score - 0.01) < 1e-9 and r.predicted == 0 for r in op6_toxicity.toxicity(df, df, none).collect())
    odd = spark.createDataFrame([(1, None), (None, 1), (5, 7), (12345, 1)], "doc_id long, toxic int")
    assert op6_toxicity.toxicity(df, df, odd).count() == df.count()
    assert op6_toxicity.toxicity(documents(spark, []), df, none).count() == 0


# operator 7

def contaminated(rows, items):
    out = []
    for i, t in rows:
        w, hit, found = alnum(t), set(), set()
        for k, s in items:
            b = alnum(s)
            m = min(10, len(b))
            for j in range(len(b) - m + 1 if b else 0):
                for p in range(len(w) - m + 1):
                    if w[p:p + m] == b[j:j + m]:
                        hit.update(range(p, p + m))
                        found |= set() if k is None else {str(k)}
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return out


@pytest.mark.parametrize("block_words", [1 << 18, 8])
def test_decontamination(spark, block_words):
    test = prose(77, 30)
    rows = EDGE + [(30, prose(8, 50) + " " + test + " " + prose(9, 40)), (31, " ".join(test.split()[5:15]).upper() + " tail"), (32, " ".join(test.split()[:9])),
                   (33, "two words"), (34, "two"), (35, "words"), (36, test + " " + test)]
    items = [(1, test), (2, None), (3, ""), (4, "two words"), (10, "Two, WORDS!"), (4, "two words"), (None, "one two three four five"), (6, prose(78, 12))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit(1))
    got = op7_decontaminate.decontaminate(documents(spark, rows), bench, block_words=block_words).collect()
    assert key((r.id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == key(contaminated(rows, items))
    assert all(set(r["items"]) <= set(r.near_items) for r in got)
    assert op7_decontaminate.decontaminate(documents(spark, []), bench).count() == 0
    none = op7_decontaminate.decontaminate(documents(spark, rows), bench.limit(0)).collect()
    assert len(none) == len(rows) and all(r.n_hit == 0 for r in none)


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "red green blue white black")], "item_id long, text string")
    rows = [(1, "blue red x green y black white"), (2, "red green blue white"), (3, "red " + "z " * 30 + "green blue white black")]
    got = {r.id: r for r in op7_decontaminate.decontaminate(documents(spark, rows), bench).collect()}
    assert list(got[1].near_items) == ["1"] and got[1].n_hit == 0 and not got[2].near_items and not got[3].near_items


# operator 8

def test_license_base(spark):
    rows = EDGE + [(20, "This work is licensed under the GNU General Public License, version 3."), (21, "cc-by CC BY, cc  by mit-license"),
                   (22, "Apache\nLicense, Version 2.0; mit. license"), (23, "SPDX-License-Identifier: BSD-3-Clause"), (24, "© All rights reserved."), (25, "mit " * 9 + "license")]
    got = {str(r.id): r for r in op8_licenses.scan_licenses(documents(spark, rows)).collect()}
    assert len(op8_licenses.scan_licenses(documents(spark, rows)).collect()) == len(rows)
    for i, t in rows:
        w, places, labels = alnum(t), [], set()
        for p, label in op8_licenses.PHRASES.items():
            q = p.split()
            at = [j for j in range(len(w) - len(q) + 1) if w[j:j + len(q)] == q]
            places += at
            labels |= {label} if at else set()
        r = got[str(i)]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert got["20"].labels == "gpl,gpl-3.0" and got["23"].labels == "bsd-3-clause" and got["24"].labels == "proprietary"
    assert op8_licenses.scan_licenses(documents(spark, [])).count() == 0


def spellings(parsed):
    """One text for each choice of branches, options and plain characters of a parsed pattern."""
    out = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            new = [chr(arg)]
        elif name == "IN":
            new = [chr(c if str(k) == "LITERAL" else c[0]) for k, c in arg if str(k) in ("LITERAL", "RANGE") and (str(k) == "RANGE" or chr(c) not in ",;\"'()")]
            new = new or [{"CATEGORY_SPACE": " ", "CATEGORY_DIGIT": "1"}.get(str(arg[0][1]), "x")]
        elif name == "SUBPATTERN":
            new = spellings(arg[-1])
        elif name == "BRANCH":
            new = [x for branch in arg[1] for x in spellings(branch)]
        else:
            assert name in ("MAX_REPEAT", "POSSESSIVE_REPEAT")
            new = [""] * (arg[0] == 0) + spellings(arg[2])
        out = [x + y for x in out for y in new]
    return out


def test_every_spelling_of_every_license_rule_is_found(spark):
    rows, of = [], []
    for label, _, pattern, _, _ in license_rules.rules():
        for text in dict.fromkeys(spellings(license_rules.parser.parse(pattern))):
            rows.append((len(rows), f"\u201c{text.upper()}\u201d" if len(rows) % 2 else f"see {text}, too"))
            of.append((label, text))
    got = {r.id: r for r in op8_licenses.scan_licenses(documents(spark, rows)).collect()}
    lost = [x for i, x in enumerate(of) if not any(d.start <= rows[i][1].lower().index(x[1]) and d.end >= rows[i][1].lower().index(x[1]) + len(x[1]) for d in got[i].detections)]
    assert not lost, (len(lost), len(of), lost[:20])
    found = {x for r in got.values() for x in r.labels.split(",")}
    assert {x for x, _ in of} <= found


def test_license_names_in_their_usual_spellings(spark):
    named = {"GPL v3": "gpl-3.0", "LGPL v2.1": "lgpl-2.1", "AGPL v3": "agpl-3.0", "MPL v2.0": "mpl-2.0", "Apache License v2.0": "apache-2.0", "Mozilla Public License v2.0": "mpl-2.0",
             "GNU GPL v2": "gpl-2.0", "Creative Commons Attribution Share-Alike": "cc-by-sa", "Creative Commons Attribution Non-Commercial": "cc-by-nc", "Open-RAIL": "openrail",
             "beer-ware license": "beerware", "open source licence": "open-source", "https://www.boost.org/LICENSE_1_0.txt": "bsl-1.0", "https://zlib.net/zlib_license.html": "zlib"}
    for r in op8_licenses.scan_licenses(documents(spark, list(enumerate(named)))).collect():
        assert list(named.values())[r.id] in r.labels.split(",") and r.score > 0, r


def test_license_rules_and_suppression():
    table = license_rules.rules()
    assert len(table) > 200
    seen = op8_licenses.detect("licensed under the apache license, version 2.0. see the apache license. apache license", set(range(400)))
    assert [(x[2], x[3]) for x in seen] == [("apache-2.0", 1), ("apache", 3), ("apache", 3)]
    long = "the mit license " * 5000
    assert len(op8_licenses.detect(long, set(range(400)))) == 5000
