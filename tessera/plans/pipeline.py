"""Whole runs: train side, test side, and the command line.

Each stage reads its inputs from and writes its table to `work`, a folder that all
executors share, so that a stage can be run again by itself.
"""

from __future__ import annotations

import argparse
import os
import resource
import time
from dataclasses import dataclass, field, fields, replace

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tessera.operators import blocking, evaluate, features, model, profile, sampling, submission, synth
from tessera.operators.normalize import normalize
from tessera.sources.shared import cut, ready
from tessera.sources.tables import Files, append_metric, checked_truth, exists, has_match, latest_metrics, load_json, read_split, save_json, truth_pairs, write_parquet

STAGES = ("split", "normalize", "block", "features", "train", "predict", "decide", "evaluate", "write")


@dataclass(frozen=True)
class Job:
    """Inputs, work folder and the stages' options."""

    spark: SparkSession
    data: str
    work: str
    fraction: float = 1.0
    block: blocking.BlockConfig = field(default_factory=blocking.BlockConfig)
    model: model.ModelConfig = field(default_factory=model.ModelConfig)
    most_pairs: int = 10_000_000
    seed: int = 42

    @property
    def files(self) -> Files:
        return Files(self.work)

    def read(self, stage: str, split: str | None = None) -> DataFrame:
        return self.spark.read.parquet(self.files.at(stage, split))

    def raw(self, split: str, truth: bool = False) -> tuple[DataFrame, DataFrame | None]:
        return read_split(self.spark, self.data, split, truth)

    def entities(self, split: str) -> DataFrame:
        """s1_id of a split: those of split.json's table, or every S1 record of the test files."""
        if split == "test":
            return self.raw("test")[0].filter("source = 'S1'").select(F.trim("entity_id").alias("s1_id"))
        return self.read("split").filter(F.col("split") == split).select("s1_id")

    def truth_lists(self, split: str) -> DataFrame:
        return checked_truth(self.raw(split, True)[1]).join(self.entities(split), "s1_id", "left_semi")

    def split(self) -> None:
        rows, truth = self.raw("train", True)
        s1 = rows.filter("source = 'S1'").select(F.trim("entity_id").alias("s1_id"), F.trim("country").alias("country"))
        e = sampling.fraction_of(s1.join(has_match(truth), "s1_id"), self.fraction, self.seed)
        write_parquet(sampling.split(e, 0.8, self.seed), self.files.at("split"))

    def normalize(self, split: str) -> None:
        files = "train" if split == "val" else split
        write_parquet(normalize(self.raw(files)[0]), self.files.at("records", files))

    def records(self, split: str) -> DataFrame:
        return self.read("records", "train" if split == "val" else split)

    def block_splits(self, *splits: str) -> None:
        """Candidates of some splits of the same files: one index and one pass over the pool for all of them."""
        if "train" in splits:
            share = blocking.country_equal_share(truth_pairs(self.raw("train", True)[1]), self.records("train")).first().asDict()
            save_json(share | {"by_country": share["country_equal_share"] >= 0.995}, f"{self.work}/block_meta.json")
        config = replace(self.block, by_country=load_json(f"{self.work}/block_meta.json")["by_country"])
        own = None
        for split in splits:
            one = self.entities(split).withColumn("split", F.lit(split))
            own = one if own is None else own.unionByName(one)
        # every query searches the whole pool of its files, whatever the split
        found = blocking.block(self.records(splits[0]), config, own)
        if len(splits) > 1:
            found = cut(found)
        for split in splits:
            write_parquet(found.join(own.filter(F.col("split") == split).select("s1_id"), "s1_id", "left_semi") if len(splits) > 1 else found, self.files.at("candidates", split))

    def features(self, split: str) -> None:
        truth = None if split == "test" else truth_pairs(self.raw(split, True)[1])
        write_parquet(features.features(self.read("candidates", split), self.records(split), truth), self.files.at("features", split))

    def train(self) -> None:
        rows = self.read("features", "train")
        if rows.count() > self.most_pairs:
            rows = sampling.capped_groups(rows, "s1_id", self.most_pairs, self.seed)
        oof, rounds = model.out_of_fold(rows, self.model)
        write_parquet(oof, self.files.at("preds", "train"))
        final = model.fit(model.vectors(rows, self.model).withColumn("label", F.col("label").cast("double")), self.model, model.final_rounds(rounds))
        final.write().overwrite().save(self.files.at("model"))
        save_json({"features": list(features.FEATURES), "rounds": rounds}, f"{self.work}/model_meta.json")
        quality = evaluate.average_precision(self.read("preds", "train")).first().asDict()
        append_metric(f"{self.work}/metrics.jsonl", {"stage": "train", "split": "train", "rounds": rounds, "importance": model.importance(final)} | quality)

    def predict(self, split: str) -> None:
        model.checked_names(load_json(f"{self.work}/model_meta.json")["features"])
        fitted = GBTClassificationModel.load(self.files.at("model"))
        preds = model.score(fitted, model.vectors(self.read("features", split), self.model)).select("s1_id", "cand_id", "prob")
        write_parquet(preds, self.files.at("preds", split))

    def decide(self, split: str) -> None:
        if split == "train":
            # the sampled groups are those with predictions; entities without candidates stay in the average
            swept = evaluate.sweep(self.read("preds", "train"), self.truth_lists("train"))
            rows = [r.asDict() for r in swept.orderBy("t").collect()]
            best = max(rows, key=lambda r: (round(r["macro_f05"], 12), r["t"]))
            save_json({"threshold": best["t"], "oof_macro_f05": best["macro_f05"], "sweep": rows}, f"{self.work}/threshold.json")
        matches = evaluate.apply_threshold(self.read("preds", split), load_json(f"{self.work}/threshold.json")["threshold"])
        write_parquet(matches, self.files.at("matches", split))

    def evaluate(self, split: str) -> dict:
        lists = self.truth_lists(split)
        countries = self.records(split).select(F.col("entity_id").alias("s1_id"), "country")
        rows = [r.asDict() for r in evaluate.summary(evaluate.entity_counts(lists, self.read("matches", split)), countries).collect()]
        pairs = lists.select("s1_id", F.explode("ids").alias("cand_id"))
        recall = evaluate.blocking_recall(pairs, self.read("candidates", split), lists).first().asDict()
        out = {"stage": "evaluate", "split": split, "scores": rows, "blocking": recall}
        append_metric(f"{self.work}/metrics.jsonl", out)
        return out

    def write(self, out_dir: str) -> None:
        s1 = self.entities("test")
        counts = {self.read(t, "test").count() for t in ("candidates", "features", "preds")}
        if len(counts) > 1:
            raise ValueError(f"candidates, features and predictions differ in number: {sorted(counts)}")
        pool = self.records("test").filter("source <> 'S1'").select("entity_id")
        submission.write(self.read("matches", "test"), self.read("candidates", "test"), s1, pool, out_dir)

    def run(self, stage: str, split: str, out_dir: str | None = None) -> object:
        ready(self.spark)
        began = time.time()
        step = {"split": self.split, "train": self.train, "write": lambda: self.write(out_dir or f"{self.work}/output")}
        by_split = {"normalize": self.normalize, "block": lambda x: self.block_splits(*(("train", "val") if x == "train+val" else (x,))), "features": self.features, "predict": self.predict, "decide": self.decide, "evaluate": self.evaluate}
        out = step[stage]() if stage in step else by_split[stage](split)
        peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
        append_metric(f"{self.work}/stages.jsonl", {"stage": stage, "split": split, "seconds": round(time.time() - began, 3), "driver_python_mb": peak, "driver_jvm_mb": heap_mb(self.spark)})
        return out

    def summary(self) -> str:
        """The last time, memory and metrics of each stage, as Markdown."""
        parts = [profile.markdown("Stages", latest_metrics(self.spark, f"{self.work}/stages.jsonl"))]
        if exists(f"{self.work}/metrics.jsonl"):
            last = latest_metrics(self.spark, f"{self.work}/metrics.jsonl")
            flat = [c if not isinstance(last.schema[c].dataType, (ArrayType, StructType)) else F.to_json(c).alias(c) for c in last.columns]
            parts.append(profile.markdown("Metrics", last.select(*flat)))
        return "\n".join(parts)


def heap_mb(spark: SparkSession) -> int:
    """What the driver's JVM holds."""
    r = spark._jvm.java.lang.Runtime.getRuntime()
    return (r.totalMemory() - r.freeMemory()) >> 20


def block_config(channels: str | None = None, env: dict[str, str] | None = None) -> blocking.BlockConfig:
    """The block stage's options from the environment (TESSERA_MAX_DF_SHARE, TESSERA_MAX_DF_FLOOR, TESSERA_RETRIEVE, TESSERA_FALLBACK, TESSERA_TIEBREAK) and channels as name:15,addr:10."""
    env = os.environ if env is None else env
    base = blocking.BlockConfig()
    given = {f.name: type(getattr(base, f.name))(env[key]) for f in fields(base) if (key := f"TESSERA_{f.name.upper()}") in env and isinstance(getattr(base, f.name), (int, float)) and f.name != "by_country"}
    if channels:
        pairs = [x.split(":") for x in channels.split(",")]
        given["k"] = {c: int(k[0]) if k else base.k[c] for c, *k in pairs}
    return replace(base, **given)


def train_side(job: Job) -> dict:
    job.run("split", "train")
    job.run("normalize", "train")
    job.run("block", "train+val")
    for split in ("train", "val"):
        job.run("features", split)
    job.run("train", "train")
    job.run("predict", "val")
    for split in ("train", "val"):
        job.run("decide", split)
    return job.run("evaluate", "val")


def test_side(job: Job, out_dir: str) -> None:
    for stage in ("normalize", "block", "features", "predict", "decide"):
        job.run(stage, "test")
    job.run("write", "test", out_dir)


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Runs one stage, prints a summary, or writes made-up data.")
    p.add_argument("stage", choices=(*STAGES, "summary", "fake-data"))
    p.add_argument("--split", choices=("train", "val", "train+val", "test"), default="train")
    p.add_argument("--data", required=True)
    p.add_argument("--work")
    p.add_argument("--out")
    p.add_argument("--fraction", type=float, default=1.0)
    p.add_argument("--channels", help="such as name:15,ctx:10,addr:10; those left out are disabled")
    p.add_argument("--entities", type=int, default=1000, help="of made-up training data; the test files have a third as many")
    a = p.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if a.stage == "fake-data":
        synth.write(spark, a.data, a.entities, max(1, a.entities // 3))
        return
    if not a.work:
        p.error("--work is needed")
    job = Job(spark, a.data, a.work, a.fraction, block_config(a.channels))
    if a.stage == "summary":
        print(job.summary())
        return
    job.run(a.stage, a.split, a.out)


if __name__ == "__main__":
    main()

__all__ = ["STAGES", "Job", "block_config", "main", "test_side", "train_side"]
