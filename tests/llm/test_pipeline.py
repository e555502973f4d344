import zlib

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from geoqa.llm import op4_substrings, op7_decontaminate, op9_minhash
from geoqa.llm.queries import ORACLES, QUERIES
from tests.llm.cases import documents, prose
from tests.llm.test_near_duplicates import brute
from tests.llm.test_text_operators import contaminated


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    insults = ["grobnak", "vilzuck", "snurfel", "dratvog"]
    p, bench, rows = prose(9990, 70), prose(9991, 30), []
    for i in range(300):
        w = prose(i, 80).split()
        if i % 5 == 0:
            for j in range(4):
                w[(i * 13 + j * 17) % 80] = insults[(i + j) % 4]
        rows.append((i, " ".join(w)))
    rows += [(400 + i, rows[3 * i + 1][1]) for i in range(10)]  # exact copies, some of toxic documents
    rows += [(500 + i, prose(700 + i, 25) + " " + p + " " + prose(800 + i, 60)) for i in range(6)]
    rows += [(600, prose(900, 40) + " " + bench), (601, bench.upper()), (610, None), (611, ""), (None, "no id"), (620, prose(901, 4000))]
    d = tmp_path_factory.mktemp("sf")
    documents(spark, rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), dict(rows)


def test_stages(spark, folder):
    d, texts = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()} if "text" in docs.columns else {}
        docs = corpus_pipeline.stored(stage(spark, docs, d), name)
        rows = docs.collect()
        seen[name] = rows
        if name == "packing":
            break
        assert docs.columns == columns and len(rows) == len({r.doc_id for r in rows})
        after = {r.doc_id: r.text for r in rows}
        if name == "toxicity":
            assert {i for i in before if i not in after} == {i for i, t in texts.items() if t and "grobnak" in t or t and "vilzuck" in t}
        elif name == "near_dedup":
            comp = brute([(i, t) for i, t in before.items()])
            assert set(after) == {i for i in before if comp.get(i) == i}
        elif name == "substring_dedup":
            assert all(after[i] == before[i] for i in after if not 501 <= (i or 0) <= 505)
            assert all(len(after[i].split()) <= 90 for i in range(501, 506)) and len(after[500].split()) == 155
        elif name == "decontamination":
            assert {i for i in before if i not in after} == {r[0] for r in contaminated(list(before.items()), [(1, prose(9991, 30))]) if r[2]} == {600, 601}
    ids = {r.doc_id for r in seen["packing"]}
    assert ids == {r.doc_id for r in seen["decontamination"]}
    by = {}
    for r in seen["packing"]:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in by.values():
        s.sort()
        assert [o for o, _ in s] == list(np.cumsum([0] + [n for _, n in s])[:-1]) and sum(n for _, n in s) <= 2048


def test_run_gives_the_last_stage(spark, folder):
    d, _ = folder
    got = corpus_pipeline.run(spark, d)
    assert {"doc_id", "sequence_id", "offset", "ids_crc32"} <= set(got.columns) and got.count() > 0


def test_registration():
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES}
    q = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(q) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_crc_of_ids(spark):
    from geoqa.llm.common import crc32_of_id
    rows = spark.range(50).select("id", crc32_of_id(corpus_pipeline.op9_minhash.F.col("id")).alias("c")).collect()
    assert all(r.c == zlib.crc32(str(r.id).encode()) for r in rows)
    assert op4_substrings.MIN_WORDS <= 50 and op7_decontaminate.WINDOW == 10 and op9_minhash.PERCENT == 75
