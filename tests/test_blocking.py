import itertools
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import blocking as B
from tessera.operators import features as P
from tessera.operators.normalize import channel_texts, normalize

WORDS = "alpha bravo cedar delta ember fable grove haven inlet jolly karma lunar".split()
SCHEMA = "entity_id string, business_name string, business_address string, country string"


def corpus():
    rng = random.Random(5)
    rows = []
    for source, n in (("S1", 15), ("S2", 60), ("S3", 60)):
        for i in range(n):
            rows.append((f"{source}-{i:03d}", " ".join(rng.choices(WORDS, k=rng.randint(1, 3))), f"{rng.randint(1, 99)} {rng.choice(WORDS)} street {rng.choice(WORDS)}", "US"))
    return [*rows, ("S1-900", "lone star", "1 far road", "Atlantis"), ("S2-900", "lone star", "1 far road", "Atlantis"), ("S2-901", "", "", "US")]


@pytest.fixture(scope="module")
def records(spark):
    return normalize(spark.createDataFrame(corpus(), SCHEMA)).cache()


@pytest.fixture(scope="module")
def blocked(records):
    return B.block(records, B.BlockConfig(k={"name": 3, "ctx": 2, "addr": 2})).cache()


def grams(text):
    return Counter(p[i : i + 3] for w in text.split() for p in [f" {w} "] for i in range(len(p) - 2))


def test_retrieval_is_brute_force(records):
    texts = [r.asDict() for r in channel_texts(records, ("name",)).collect() if r["country"] == "US"]
    df = Counter(g for t in texts for g in grams(t["text"]))
    vec = {}
    for t in texts:
        w = {g: (1 + math.log(n)) * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g, n in grams(t["text"]).items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        vec[t["entity_id"]] = {g: math.floor(x / norm * 1e6 + 0.5) for g, x in w.items()}
    config = B.BlockConfig(k={"name": 3}, retrieve=2)
    got = defaultdict(list)
    for r in B.retrieve(B.weighted_grams(records, config), config).filter("country = 'US'").orderBy("rank").collect():
        got[r["s1_id"], r["source"]].append((r["cand_id"], r["score"]))
    for s1, source in itertools.product([i for i in vec if i.startswith("S1")], ("S2", "S3")):
        scores = [(c, sum(q * vec[c].get(g, 0) for g, q in vec[s1].items())) for c in vec if c.startswith(source)]
        best = sorted((x for x in scores if x[1]), key=lambda x: (-x[1], x[0]))[:6]
        assert got[s1, source] == best


def test_partitions_dont_matter(spark, records, blocked):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = B.block(records.repartition(7), B.BlockConfig(k={"name": 3, "ctx": 2, "addr": 2}))
        assert not again.exceptAll(blocked).count() and again.count() == blocked.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_invariants(blocked, records):
    rows = blocked.collect()
    assert len({(r["s1_id"], r["cand_id"]) for r in rows}) == len(rows)
    country = {r["entity_id"]: r["country"] for r in records.collect()}
    for r in rows:
        assert country[r["s1_id"]] == country[r["cand_id"]] == r["country"]
        assert all(r[f"ch_{c}"] == (r[f"rank_{c}"] is not None) and 0 <= r[f"cos_{c}"] <= 1 for c in ("name", "ctx", "addr"))
        assert r["block_score"] == max(r["cos_name"], r["cos_ctx"], r["cos_addr"])
    per = Counter((r["s1_id"], c, r["cand_id"][:2]) for r in rows for c in ("name", "ctx", "addr") if r[f"ch_{c}"])
    assert all(n <= {"name": 3, "ctx": 2, "addr": 2}[c] for (_, c, _), n in per.items())
    assert ("S1-900", "S2-900") in {(r["s1_id"], r["cand_id"]) for r in rows} and "S2-901" not in {r["cand_id"] for r in rows}


@pytest.mark.parametrize("channels", [c for n in (1, 2, 3) for c in itertools.combinations(("name", "ctx", "addr"), n)])
def test_any_channels(spark, records, channels):
    rows = B.block(records, B.BlockConfig(k=dict.fromkeys(channels, 2))).cache()
    assert rows.columns == ["s1_id", "cand_id", "country", *[f"{p}_{c}" for p in ("ch", "rank", "cos") for c in ("name", "ctx", "addr")], "block_score"]
    for c in {"name", "ctx", "addr"} - set(channels):
        assert not rows.filter(f"ch_{c} OR rank_{c} IS NOT NULL OR cos_{c} <> 0").count()
    assert rows.count() and P.features(rows, records).count() == rows.count()
    with pytest.raises(ValueError):
        B.block(records, B.BlockConfig(k={"nothing": 1}))


def test_whole_pool_keeps_the_country(spark):
    rows = normalize(spark.createDataFrame([("S1-1", "stone bridge", "1 oak road", "US"), ("S2-1", "stone bridge", "1 oak road", "France")], SCHEMA))
    assert B.block(rows).count() == 0
    got = B.block(rows, B.BlockConfig(by_country=False)).collect()
    assert [(r["s1_id"], r["cand_id"], r["country"]) for r in got] == [("S1-1", "S2-1", "US")]


def test_fallback(spark):
    rows = spark.createDataFrame(
        [("q1", g, d) for g, d in (("10", 900), ("11", 700), ("12", 800), ("13", 600))] + [("q2", "12", 800), ("q2", "13", 600), ("q3", "10", 900), ("q3", "20", 5)],
        "entity_id string, gram string, df long",
    ).withColumns({"country": F.lit(""), "channel": F.lit("name"), "n_docs": F.lit(1000), "q": F.lit(1)})
    got = defaultdict(set)
    for r in B.search_grams(rows, B.BlockConfig(fallback=2)).collect():
        got[r["entity_id"]].add(r["gram"])
    assert got == {"q1": {"13", "11"}, "q2": {"12", "13"}, "q3": {"20"}}


@pytest.mark.parametrize(("tiebreak", "first"), [(0.5, True), (0.0, False)])
def test_address_breaks_ties(spark, tiebreak, first):
    rows = [("S1-1", "ridgeline", "10 oak street, waxahachie", "US")] + [(f"S2-{i:02d}", "ridgeline", f"{i} elm street, dallas", "US") for i in range(40)] + [("S2-99", "ridgeline", "10 oak street, waxahachie", "US")]
    config = B.BlockConfig(k={"name": 15, "addr": 1}, tiebreak=tiebreak)
    weighted = B.weighted_grams(normalize(spark.createDataFrame(rows, SCHEMA)), config)
    found = B.retrieve(weighted, config)
    top = B.rerank(found, B.exact_cosine(found, weighted), config).filter("channel = 'name' AND final = 1").first()
    assert (top["cand_id"] == "S2-99") is first


def test_empty(spark):
    assert B.block(normalize(spark.createDataFrame([], SCHEMA))).count() == 0


def test_equal_countries(spark, records):
    pairs = spark.createDataFrame([("S1-001", "S2-001"), ("S1-900", "S2-001"), ("S1-001", "S2-nowhere")], "s1_id string, cand_id string")
    assert B.country_equal_share(pairs, records).first().asDict() == {"n_true_pairs": 2, "n_equal": 1, "country_equal_share": 0.5}
    assert not B.by_country(pairs, records)


def test_features(spark):
    rows = [("S1-1", "Acme Foods LLC", "12 Main Street, Springfield, IL", "US"), ("S2-1", "ACME FOODS", "12 MAIN ST, SPRINGFIELD, IL", "US"), ("S3-1", "Acme Foods Inc", "", "US")]
    records = normalize(spark.createDataFrame(rows, SCHEMA))
    truth = spark.createDataFrame([("S1-1", "S2-1")], "s1_id string, cand_id string")
    f = {r["cand_id"]: r for r in P.features(B.block(records), records, truth).collect()}
    assert set(P.FEATURES) <= set(f["S2-1"].asDict()) and len(P.FEATURES) == 35
    a, b = f["S2-1"], f["S3-1"]
    assert a["core_exact"] == 1 and a["num_shared"] >= 1 and a["num_conflict"] == 0 and a["ad_tset"] > 0.7 and a["cand_is_s3"] == 0 and a["label"] == 1
    assert b["addr_empty_cand"] == 1 and b["ad_ratio"] == 0 and b["cand_is_s3"] == 1 and b["num_conflict"] == 0 and b["label"] == 0
    assert P.unknown_ids(truth, records).count() == 0
    with pytest.raises(Exception, match="no record has the id S2-404"):
        P.features(B.block(records).withColumn("cand_id", F.lit("S2-404")), records).collect()
