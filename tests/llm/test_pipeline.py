"""Stages on their own input, and the whole against the stages' brute force on small tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tessera.llm import queries
from tests_words import WORDS


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    prose = lambda k: " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(k))
    items = [(i, prose(25)) for i in range(5)]
    clean = [prose(60) + "\n" + prose(30) for _ in range(40)]
    rows = [(i, t, "en", f"s{i % 3}", len(t), "x") for i, t in enumerate(clean)]
    rows += [(100 + i, clean[i], "en", "s0", 0, "x") for i in range(5)]  # exact copies
    near = clean[6].split(" ")
    near[3] = "different"
    rows += [(110, " ".join(near), "en", "s1", 0, "x")]
    rows += [(120 + i, prose(40) + " " + items[i][1] + " " + prose(40), "en", "s2", 0, "x") for i in range(3)]
    rows += [(200 + i, " ".join(w + "###" for w in prose(60).split()), "en", "s2", 0, "x") for i in range(30)]
    rows += [(300, None, None, None, None, None), (301, "", "en", None, 0, None)]
    root = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words string").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i in [*range(40), *range(200, 230)]], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, folder).cache()
        if k < 4:
            assert out.columns == docs.columns
        kept.append({r["doc_id"] for r in out.select("doc_id").collect()})
        docs = out
    clean = set(range(40))
    assert kept[0] == clean | set(range(100, 105)) | {110, 120, 121, 122}  # symbols, null and empty texts go
    assert kept[1] == kept[0]  # lines go, rows stay
    assert kept[2] == kept[0]  # whole copies have lost their lines, so nothing similar is left but empty texts
    assert kept[3] == kept[2] - {120, 121, 122}
    final = {r["doc_id"]: r for r in docs.collect()}
    assert all(final[i]["taken"] <= 3 * final[i]["size"] for i in final) and final[100]["size"] == 0
    assert sum(r["taken"] for r in final.values()) > 0


def test_copies_go_without_line_dedup(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r["doc_id"] for r in C.near_duplicates(spark, docs, folder).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - set(range(100, 105)) - {110}


def test_run(spark, folder):
    got = C.run(spark, folder)
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    again = C.run(spark, folder)
    assert not got.exceptAll(again).count() and got.filter(F.col("taken") > 3 * F.col("size")).count() == 0
    assert C.ORACLE_SQL is None and set(queries.oracle_sql()) <= set(queries.queries())


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in queries.queries().items():
        assert query(spark, str(tmp_path)).count() == 0, name
