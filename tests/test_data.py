import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import profile as R
from tessera.operators import sampling as S
from tessera.operators import submission as W
from tessera.operators import synth
from tessera.plans.pipeline import Job, test_side as run_test_side, train_side
from tessera.operators.model import ModelConfig
from tessera.sources import tables as A


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_tsv(spark, tmp_path):
    p = put(tmp_path / "a.tsv", 'entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-70\tThe "Old Mill\tN/A\t\nS1-71 \tMill 12" Pipes\\\tnone \tFR\n')
    rows = A.read_tsv(spark, p).orderBy("entity_id").collect()
    assert [tuple(r) for r in rows] == [("S1-70", 'The "Old Mill', "N/A", ""), ("S1-71 ", 'Mill 12" Pipes\\', "none ", "FR")]
    A.write_tsv(A.read_tsv(spark, p), f"{tmp_path}/again.tsv")
    assert sorted(map(tuple, A.read_tsv(spark, f"{tmp_path}/again.tsv").collect())) == [tuple(r) for r in rows]
    assert A.line_stats(spark, p).first().asDict() == {"lines": 2, "quotes": 2}
    assert A.read_tsv(spark, p, ("country",)).columns == ["country"] and A.classify(A.header(spark, p)) == "source"
    with pytest.raises(ValueError):
        A.read_tsv(spark, p, ("nothing",))


def test_line_stats(spark, tmp_path):
    for text, want in (('h\n"a\nb"\nc', (3, 2)), ("h\na\nb\n", (2, 0)), ("h\n", (0, 0))):
        r = A.line_stats(spark, put(tmp_path / f"{len(text)}.txt", text)).first()
        assert (r["lines"], r["quotes"]) == want


def test_truth(spark):
    t = spark.createDataFrame([(f"S1-{i}", "" if i % 3 == 0 else f"S2-{i},S3-{i}") for i in range(10)], "source1_entity_id string, matched_entity_ids string")
    ids = spark.createDataFrame([(f"S1-{i}",) for i in (1, 3, 9, 404)], "s1_id string")
    assert {r["s1_id"] for r in A.truth_of(t, ids).collect()} == {"S1-1", "S1-3", "S1-9"}
    assert A.checked_truth(t).count() == 10
    with pytest.raises(ValueError):
        A.checked_truth(t.union(t.limit(1)))


def test_integrity(spark):
    t = spark.createDataFrame([("S1-30", "S2-41,S3-52,S2-42"), ("S1-31", "S3-52"), ("S1-31", "S2-77, S2-77"), ("S1-32", "")], "source1_entity_id string, matched_entity_ids string")
    records = spark.createDataFrame([(x,) for x in ("S1-30", "S1-31", "S1-39", "S2-41", "S2-42", "S3-52", "S3-53")], "entity_id string")
    got = {r["what"]: r["n"] for r in R.truth_integrity(t, records).collect()}
    assert got == {"missing mentions": 1, "missing ids": 1, "truth without record": 1, "record without truth": 1, "repeated truth rows": 1}
    s = R.truth_stats(t).first()
    assert s["n_rows"] == 4 and s["repeated_rows"] == 1 and s["both_sources"] == 1 and s["shared_ids"] == 1 and s["most_shared"] == 2 and s["singletons"] == 1 and s["n_pairs"] == 5
    scan = R.scan_stats(spark.createDataFrame([("S2-1", "a", ""), ("S2-2 ", "", "x"), ("S2-1", "b", "y"), ("X", "c", "z")], "entity_id string, business_name string, business_address string"), "S2-").first().asDict()
    assert scan == {"n_rows": 4, "n_ids": 3, "n_repeated": 1, "empty_names": 1, "empty_addresses": 1, "bad_prefix": 1, "outer_space": 1}
    assert len(R.warnings(scan, {"lines": 5})) == 4
    assert "| 7 |" in R.markdown("Ids", records.agg(F.count("*").alias("n")))


def entities(spark):
    rows = [(f"S1-{i:04d}", "US" if i < 400 else "India", i % 10 != 0) for i in range(600)]
    return spark.createDataFrame(rows, "s1_id string, country string, has_match boolean")


def test_split_and_fraction(spark):
    e = entities(spark)
    n = Counter((r["country"], r["has_match"], r["split"]) for r in S.split(e).collect())
    sizes = Counter((r["country"], r["has_match"]) for r in e.collect())
    assert all(n[(*k, "train")] == math.floor(v * 0.8 + 0.5) for k, v in sizes.items()) and sum(n.values()) == 600
    assert {tuple(r) for r in S.split(e.repartition(5)).collect()} == {tuple(r) for r in S.split(e).collect()}
    f = Counter((r["country"], r["has_match"]) for r in S.fraction_of(e, 0.25).collect())
    assert all(abs(f[k] - v / 4) <= 1 for k, v in sizes.items())
    assert S.fraction_of(e, 1e-4).count() == 4


def test_allocation_caps_and_groups(spark):
    sizes = spark.createDataFrame([("a", 5), ("b", 3), ("c", 2)], "stratum string, size long")
    assert {r["stratum"]: r["take"] for r in S.allocate(sizes, 4).collect()} == {"a": 2, "b": 1, "c": 1}
    assert sum(r["take"] for r in S.allocate(sizes, 99).collect()) == 10
    rows = spark.createDataFrame([(f"g{i}", j) for i in range(20) for j in range(i)], "g string, j int")
    kept = S.capped_groups(rows, "g", 60)
    whole = Counter(r["g"] for r in rows.collect())
    got = Counter(r["g"] for r in kept.collect())
    assert 0 < sum(got.values()) <= 60 and all(whole[g] == n for g, n in got.items())


def test_sample(spark):
    raw, truth = synth.frames(spark, 120)
    records = raw.withColumn("source", F.substring("entity_id", 1, 2))
    pairs = A.truth_pairs(truth)
    e = A.has_match(truth).join(raw.select(F.col("entity_id").alias("s1_id"), "country"), "s1_id")
    ids = [r["entity_id"] for r in S.make_sample(records, pairs, e, 25).collect()]
    s1 = {i for i in ids if i.startswith("S1")}
    true = [(r["s1_id"], r["cand_id"]) for r in pairs.collect()]
    wanted = {c for s, c in true if s in s1}
    assert len(s1) == 25 and len(ids) == len(set(ids)) and wanted <= set(ids)
    for source in ("S2", "S3"):
        others = [i for i in ids if i.startswith(source) and i not in wanted]
        assert len(others) == 3 * sum(w.startswith(source) for w in wanted)
    d = S.share_deviation(records, records.filter(F.col("entity_id").isin(ids)), False).first()
    assert 0 <= d["deviation"] <= 1 and d["tolerance"] > 0.05


def test_submission(spark, tmp_path):
    def of(found):
        return spark.createDataFrame([(s, c) for s, v in found.items() for c in v], "s1_id string, cand_id string")

    s1 = spark.createDataFrame([(f"S1-{i}",) for i in (10, 20, 30, 40, 50)], "s1_id string")
    pool = spark.createDataFrame([(i,) for i in ("S2-81", "S2-82", "S3-83", "S3-84", "S2-85")], "entity_id string")
    cands, matches = of({"S1-10": ["S3-84", "S2-82", "S3-84", "S2-81"], "S1-30": ["S2-85", "S3-83"], "S1-50": ["S2-81"]}), of({"S1-10": ["S3-84", "S2-81"], "S1-30": ["S3-83"]})
    W.write(matches, cands, s1, pool, str(tmp_path))
    rows = {r[0]: r[1] for r in A.read_tsv(spark, f"{tmp_path}/matching_results.tsv").collect()}
    assert rows == {"S1-10": "S2-81,S3-84", "S1-20": "", "S1-30": "S3-83", "S1-40": "", "S1-50": ""}
    assert W.validate(spark, f"{tmp_path}/candidate_pairs.tsv", "candidate_entity_ids", s1, pool) == (True, [])
    assert W.validate_both(spark, str(tmp_path), s1, pool) == (True, [])
    for bad_matches, bad_cands in (({"S1-10": ["S2-82"]}, {"S1-20": ["S2-82"]}), ({}, {"S1-10": ["S1-20"]}), ({}, {"S1-10": ["S2-99"]}), ({}, {"S1-11": ["S2-81"]}), ({}, {"S1-10": ["Q-81"]})):
        with pytest.raises(ValueError):
            W.write(of(bad_matches), of(bad_cands), s1, pool, str(tmp_path / "bad"))
    with pytest.raises(ValueError):
        W.write(matches, cands, s1.union(s1.limit(1)), pool, str(tmp_path / "bad"))
    wrong = put(tmp_path / "w.tsv", "source1_entity_id\tmatched_entity_ids\nS1-10\tS2-81,S2-81\nS1-10\tS1-20\nS1-99\tZ\nno tab\n")
    ok, errors = W.validate(spark, wrong, "matched_entity_ids", s1, pool)
    assert not ok and len(errors) == 7
    lost = tmp_path / "lost"
    put(lost / "matching_results.tsv", "source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\t{'S2-85' if i == 10 else ''}\n" for i in (10, 20, 30, 40, 50)))
    assert W.validate_both(spark, str(lost), s1, pool) == (False, [f"candidate_pairs: {lost}/candidate_pairs.tsv is missing"])
    (lost / "candidate_pairs.tsv").write_bytes((tmp_path / "lost/matching_results.tsv").read_bytes().replace(b"matched", b"candidate").replace(b"S2-85", b"S2-81"))
    assert W.validate_both(spark, str(lost), s1, pool)[1] == ["1 matches aren't candidates, such as ('S1-10', 'S2-85')"]
    (tmp_path / "latin.tsv").write_bytes(b"source1_entity_id\tmatched_entity_ids\nS1-10\t\xe9\n")
    assert "UTF-8" in W.validate(spark, f"{tmp_path}/latin.tsv", "matched_entity_ids", s1)[1][0]
    assert not W.validate(spark, put(tmp_path / "c.csv", "source1_entity_id,matched_entity_ids\n"), "matched_entity_ids", s1)[0]


def test_whole_run(spark, tmp_path):
    synth.write(spark, str(tmp_path / "data"), 60, 20)
    job = Job(spark, str(tmp_path / "data"), str(tmp_path / "work"), model=ModelConfig(rounds=3, depth=3, folds=2))
    result = train_side(job)
    scores = next(r for r in result["scores"] if r["country"] is None and r["singleton"] is None)
    assert scores["macro_f05"] > 0.6 and result["blocking"]["recall"] > 0.8
    run_test_side(job, str(tmp_path / "out"))
    s1 = job.entities("test")
    pool = job.records("test").filter("source <> 'S1'").select("entity_id")
    for name, column in (("matching_results", "matched_entity_ids"), ("candidate_pairs", "candidate_entity_ids")):
        assert W.validate(spark, f"{tmp_path}/out/{name}.tsv", column, s1, pool) == (True, [])
    stages = A.latest_metrics(spark, f"{tmp_path}/work/stages.jsonl")
    assert stages.count() == 16 and stages.filter("stage = 'block' AND split = 'train+val'").count() == 1
    text = job.summary()
    assert "## Stages" in text and "| predict | val |" in text and "## Metrics" in text
    meta = A.load_json(f"{tmp_path}/work/model_meta.json")
    A.save_json(meta | {"features": meta["features"][::-1]}, f"{tmp_path}/work/model_meta.json")
    with pytest.raises(ValueError, match="another order"):
        job.predict("val")
    with pytest.raises(FileNotFoundError):
        A.load_json(str(tmp_path / "nothing.json"))


def test_stream(spark, tmp_path):
    from tessera.operators import blocking as B
    from tessera.operators.normalize import channel_texts, normalize
    from tessera.streaming import matching

    raw, _ = synth.frames(spark, 30)
    pool = raw.filter(~F.col("entity_id").startswith("S1-"))
    pool.repartition(3).write.parquet(str(tmp_path / "in"))
    stored = normalize(raw).cache()
    texts = channel_texts(stored)
    idfs = B.idf(B.document_frequency(B.gram_table(texts)), B.document_counts(texts)).cache()
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 10).parquet(str(tmp_path / "in"))
    q = matching.start(stream, stored, idfs, str(tmp_path / "out"), str(tmp_path / "ck"), once=True)
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).select("s1_id", "cand_id", "block_score")
    want = B.block(stored).select("s1_id", "cand_id", "block_score")
    assert got.count() == want.count() and not want.exceptAll(got).count()


def test_reports(spark, tmp_path, capsys):
    from tessera.operators import blocking as B
    from tessera.operators.normalize import normalize
    from tessera.plans import report

    root, out = str(tmp_path / "data"), str(tmp_path / "small")
    synth.write(spark, root, 80, 60)
    kinds = {p.rsplit("/", 1)[-1]: k for p, k in report.discover(spark, root)}
    assert len(kinds) == 7 and kinds["train_ground_truth.tsv"] == "truth" and kinds["test_source2.tsv"] == "source"
    text = report.profile_folder(spark, root)
    assert "## train: truth" in text and "| US |" in text
    with pytest.raises(ValueError):
        report.write_sample(spark, root, f"{root}/inside", 10)
    report.write_sample(spark, root, out, 40, test_share=0.5)
    assert report.verify_sample(spark, root, out) == []
    A.write_tsv(A.read_tsv(spark, f"{root}/test/test_source1.tsv").withColumn("country", F.lit("US")), f"{out}/test/test_source1.tsv", True)
    wrong = report.verify_sample(spark, root, out)
    assert len(wrong) == 2 and all(w.startswith("test") for w in wrong)
    rows, truth = A.read_split(spark, root, "train", True)
    records = normalize(rows).cache()
    pairs = A.truth_pairs(truth)
    cands = B.block(records, B.BlockConfig(k={"name": 1}, retrieve=1))
    assert "## Missed pairs" in report.blocking_report(pairs, cands, records, A.truth_lists(truth))
    put(tmp_path / "m.tsv", "source1_entity_id\tmatched_entity_ids\nS1-00001\tS2-00001\n")
    assert report.main(["validate", f"{tmp_path}/m.tsv", "--data", root]) == 1 and "FAIL" in capsys.readouterr().out
