"""Profiles of a data folder, smaller data sets, and blocking reports, as Markdown or files."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import evaluate, profile, sampling, submission
from tessera.operators.features import sides
from tessera.sources import tables as A


def discover(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(path, kind) of the .tsv files and folders below root; kind is source, truth or other."""
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, todo = [], [top]
    while todo:
        for s in fs.listStatus(todo.pop()):
            path = s.getPath()
            if path.getName().endswith(".tsv"):
                found.append(path.toString())
            elif s.isDirectory():
                todo.append(path)
    return [(p, A.classify(A.header(spark, p))) for p in sorted(found)]


def prefix(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    return next((f"S{k}-" for k in (1, 2, 3) if f"source{k}" in name), "S")


def profile_folder(spark: SparkSession, root: str) -> str:
    """A report on every source and truth below root."""
    parts, sources, truths = [f"# Profile of {root}", ""], {}, {}
    for path, kind in discover(spark, root):
        name = path.rsplit("/", 1)[-1].removesuffix(".tsv")
        split = name.split("_")[0]
        if kind == "source":
            rows = A.read_tsv(spark, path, A.RECORD)
            sources[split] = rows if split not in sources else sources[split].unionByName(rows)
            stats = profile.scan_stats(rows, prefix(path))
            parts += [profile.markdown(name, stats), profile.markdown(f"{name}: countries", profile.country_counts(rows))]
            parts += [f"* {w}" for w in profile.warnings(stats.first().asDict(), A.line_stats(spark, path).first().asDict())] + [""]
        elif kind == "truth":
            truths[split] = A.read_tsv(spark, path, A.TRUTH)
    for split, truth in truths.items():
        parts += [profile.markdown(f"{split}: truth", profile.truth_stats(truth)), profile.markdown(f"{split}: matches per entity", profile.match_histogram(A.truth_lists(truth)))]
        if split in sources:
            parts += [profile.markdown(f"{split}: truth against sources", profile.truth_integrity(truth, sources[split]))]
    return "\n".join(parts)


def write_sample(spark: SparkSession, root: str, out: str, n_s1: int, ratio: int = 3, test_share: float = 0.1, seed: int = 42) -> None:
    """A smaller train set by sampling.make_sample and a hashed share of the test files, in the input's form; never below root."""
    if f"{out.rstrip('/')}/".startswith(f"{root.rstrip('/')}/"):
        raise ValueError("the sample would lie inside its source")
    rows, truth = A.read_split(spark, root, "train", True)
    rows = rows.withColumn("entity_id", F.trim("entity_id"))
    entities = A.has_match(truth).join(rows.select(F.col("entity_id").alias("s1_id"), F.trim("country").alias("country")), "s1_id")
    small = sampling.make_sample(rows, A.truth_pairs(truth), entities, n_s1, ratio, seed)
    for k, name in enumerate(A.SOURCES, 1):
        A.write_tsv(small.filter(F.col("source") == f"S{k}").select(*A.RECORD), f"{out}/train/train_{name}.tsv", True)
        test = A.read_tsv(spark, f"{root}/test/test_{name}.tsv", A.RECORD)
        A.write_tsv(sampling.hash_share(test, test_share, seed, "test", "entity_id"), f"{out}/test/test_{name}.tsv", True)
    kept = truth.withColumn("s1_id", F.trim(A.TRUTH[0])).join(small.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi").select(*A.TRUTH)
    A.write_tsv(kept, f"{out}/train/train_ground_truth.tsv", True)


def verify_sample(spark: SparkSession, root: str, out: str) -> list[str]:
    """What is wrong with a sample: rows that the source lacks, lost matches, repeated ids, countries' shares out of tolerance; of the test files rows and shares."""
    wrong = []
    big, truth = A.read_split(spark, root, "train", True)
    small, kept = A.read_split(spark, out, "train", True)
    big, small = (d.withColumn("entity_id", F.trim("entity_id")) for d in (big, small))
    if n := small.join(big, [*A.RECORD], "left_anti").count():
        wrong.append(f"{n} rows differ from the source")
    if n := profile.truth_integrity(kept, small).filter("what = 'missing ids'").first()["n"]:
        wrong.append(f"{n} matched ids are missing")
    if n := small.groupBy("entity_id").count().filter("count > 1").count():
        wrong.append(f"{n} repeated ids")
    s1 = lambda d: d.filter("source = 'S1'")
    d = sampling.share_deviation(s1(big), s1(small), False).first()
    if d["deviation"] > d["tolerance"]:
        wrong.append(f"countries' shares differ by {d['deviation']:.3f}")
    big, small = A.read_sources(spark, root, "test"), A.read_sources(spark, out, "test")
    if n := small.join(big, [*A.RECORD], "left_anti").count():
        wrong.append(f"test: {n} rows differ from the source")
    for source in ("S1", "S2", "S3"):
        # a hashed share is a random one: its tolerance is statistical
        d = sampling.share_deviation(*(x.filter(F.col("source") == source) for x in (big, small)), True).first()
        if d["deviation"] > d["tolerance"]:
            wrong.append(f"test {source}: countries' shares differ by {d['deviation']:.3f}")
    return wrong


def examples(lost: DataFrame, records: DataFrame, per_cause: int = 5) -> DataFrame:
    """The first few missed pairs of each cause by id, with both names and addresses."""
    from pyspark.sql import Window

    own = Window.partitionBy("cause").orderBy("s1_id", "cand_id")
    few = lost.withColumn("k", F.row_number().over(own)).filter(F.col("k") <= per_cause)
    return sides(few, records, ("name_raw", "addr_raw")).select("cause", "s1_id", "cand_id", F.round("similarity", 3).alias("similarity"), F.col("a.name_raw").alias("name"), F.col("a.addr_raw").alias("address"), F.col("b.name_raw").alias("other_name"), F.col("b.addr_raw").alias("other_address"))


def blocking_report(truth_pairs: DataFrame, cands: DataFrame, records: DataFrame, entities: DataFrame) -> str:
    """Recall overall, by country and channel, candidates per entity, and why pairs were missed."""
    countries = records.select(F.col("entity_id").alias("s1_id"), "country")
    lost = evaluate.misses(truth_pairs, cands, records)
    return "\n".join([
        profile.markdown("Blocking", evaluate.blocking_recall(truth_pairs, cands, entities)),
        profile.markdown("By country", evaluate.recall_by(truth_pairs, cands, countries)),
        profile.markdown("Missed pairs", evaluate.miss_causes(lost)),
        profile.markdown("Examples", examples(lost, records)),
    ])


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Reports on data folders and checks of result files.")
    do = p.add_subparsers(dest="do", required=True)
    a = do.add_parser("profile")
    a.add_argument("root")
    a = do.add_parser("sample")
    a.add_argument("root")
    a.add_argument("out")
    a.add_argument("--entities", type=int, default=1000)
    a = do.add_parser("validate")
    a.add_argument("path", help="a result file, or the folder of both")
    a.add_argument("--column", default="matched_entity_ids")
    a.add_argument("--data", required=True)
    a.add_argument("--check-ids", action="store_true")
    x = p.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if x.do == "profile":
        print(profile_folder(spark, x.root))
        return 0
    if x.do == "sample":
        write_sample(spark, x.root, x.out, x.entities)
        wrong = verify_sample(spark, x.root, x.out)
    else:
        rows = A.read_sources(spark, x.data, "test")
        ids = rows.select(F.trim("entity_id").alias("entity_id"), "source")
        s1 = ids.filter("source = 'S1'").select(F.col("entity_id").alias("s1_id"))
        pool = ids.filter("source <> 'S1'") if x.check_ids else None
        both = A.exists(f"{x.path}/matching_results.tsv") or A.exists(f"{x.path}/candidate_pairs.tsv")
        wrong = (submission.validate_both(spark, x.path, s1, pool) if both else submission.validate(spark, x.path, x.column, s1, pool))[1]
    print("\n".join(["FAIL", *wrong] if wrong else ["PASS"]))
    return int(bool(wrong))


if __name__ == "__main__":
    raise SystemExit(main())
