"""Tab-separated sources and sinks without quoting, truth tables, Parquet and JSON."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as X

RECORD = ("entity_id", "business_name", "business_address", "country")
TRUTH = ("source1_entity_id", "matched_entity_ids")
SOURCES = ("source1", "source2", "source3")


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names alone."""
    line = spark.read.text(path).limit(1).collect()
    return line[0][0].rstrip("\r").split("\t") if line else []


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """All columns as strings, empty for missing; quotes and backslashes are ordinary characters. `columns`: those wanted."""
    names = header(spark, path)
    if missing := [c for c in columns or () if c not in names]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = ", ".join(f"`{n}` string" for n in names)
    rows = spark.read.csv(path, schema=schema, sep="\t", header=True, quote="", escape="", nullValue="\u0000", emptyValue="", enforceSchema=True)
    return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in (columns or names)])


def write_tsv(rows: DataFrame, path: str, one_file: bool = False) -> None:
    (rows.coalesce(1) if one_file else rows).write.csv(path, sep="\t", header=True, quote="", escape="", emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, mode="overwrite")


def read_sources(spark: SparkSession, root: str, split: str) -> DataFrame:
    """The three sources of a split, with a column source (S1, S2 or S3)."""
    out = None
    for k, name in enumerate(SOURCES, 1):
        one = read_tsv(spark, f"{root}/{split}/{split}_{name}.tsv", RECORD).withColumn("source", F.lit(f"S{k}"))
        out = one if out is None else out.unionByName(one)
    return out


def read_split(spark: SparkSession, root: str, split: str, truth: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Records and, if wanted, truth rows; val reads the train files."""
    files = "train" if split == "val" else split
    return read_sources(spark, root, files), (read_tsv(spark, f"{root}/{files}/{files}_ground_truth.tsv", TRUTH) if truth else None)


def truth_lists(rows: DataFrame) -> DataFrame:
    """s1_id, ids of each truth row, ids trimmed."""
    return rows.select(F.trim(TRUTH[0]).alias("s1_id"), X.id_list(F.col(TRUTH[1])).alias("ids"))


def truth_pairs(rows: DataFrame) -> DataFrame:
    return truth_lists(rows).select("s1_id", F.explode("ids").alias("cand_id"))


def checked_truth(rows: DataFrame) -> DataFrame:
    """truth_lists; an id that has two rows is an error."""
    lists = truth_lists(rows)
    twice = lists.groupBy("s1_id").count().filter("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"repeated truth rows: {', '.join(r['s1_id'] for r in twice)}")
    return lists


def truth_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """truth_lists of the s1_id in ids."""
    return truth_lists(rows).join(ids.select("s1_id").distinct(), "s1_id", "left_semi")


def has_match(rows: DataFrame) -> DataFrame:
    return rows.select(F.trim(TRUTH[0]).alias("s1_id"), (F.trim(TRUTH[1]) != "").alias("has_match"))


def read_records(spark: SparkSession, path: str, country: str | None = None, sources: tuple[str, ...] | None = None, columns: tuple[str, ...] | None = None, ids: DataFrame | None = None) -> DataFrame:
    """Normalised records; the predicates reach the Parquet scan."""
    rows = spark.read.parquet(path)
    if country is not None:
        rows = rows.filter(F.col("country") == country)
    if sources:
        rows = rows.filter(F.col("source").isin(*sources))
    if ids is not None:
        rows = rows.join(ids.select("entity_id").distinct(), "entity_id", "left_semi")
    return rows.select(*columns) if columns else rows


def write_parquet(rows: DataFrame, path: str, by: str | None = None) -> None:
    writer = rows.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)


def line_stats(spark: SparkSession, path: str) -> DataFrame:
    """Lines below the header and quote characters of a file, whatever a reader makes of them."""
    lines = spark.read.text(path, lineSep="\n")
    quotes: Column = F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    return lines.agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias("lines"), F.coalesce(quotes, F.lit(0)).alias("quotes"))


@dataclass(frozen=True)
class Files:
    """Where a run keeps its stages' tables."""

    root: str

    def at(self, stage: str, split: str | None = None) -> str:
        return f"{self.root}/{stage}" + (f"_{split}" if split else "")


def _file(path: str):
    """The file system that a path lies in (any that Spark knows), and the path there."""
    spark = SparkSession.active()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(path: str) -> bool:
    fs, at = _file(path)
    return bool(fs.exists(at))


def write_text(path: str, text: str) -> None:
    fs, at = _file(path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(path: str) -> str:
    fs, at = _file(path)
    if not fs.exists(at):
        raise FileNotFoundError(f"{path} isn't there: run the stage that writes it first")
    return SparkSession.active()._jvm.org.apache.commons.io.IOUtils.toString(fs.open(at), "UTF-8")


def save_json(value: dict, path: str) -> None:
    write_text(path, json.dumps(value, indent=1, sort_keys=True))


def load_json(path: str) -> dict:
    return json.loads(read_text(path))


def append_metric(path: str, record: dict) -> None:
    """One more line of a small file, which is written anew: object stores can't append."""
    fs, at = _file(path)
    write_text(path, (read_text(path) if fs.exists(at) else "") + json.dumps(record, sort_keys=True) + "\n")


def latest_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The last record of each (stage, split) of a metrics file."""
    rows = spark.read.json(path)
    last = rows.select("*", F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line")).alias("line_no"))
    return last.groupBy("stage", "split").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("stage", "split")]), "line_no").alias("last")).select("stage", "split", "last.*")


def classify(names: list[str]) -> str:
    """What a file with these columns is."""
    return "source" if set(RECORD) <= set(names) else "truth" if set(TRUTH) <= set(names) else "other"
