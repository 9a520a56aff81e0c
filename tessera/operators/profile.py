"""Profiles and integrity checks of sources and truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.tables import TRUTH, truth_lists


def scan_stats(rows: DataFrame, prefix: str, id_col: str = "entity_id", name: str = "business_name", address: str = "business_address") -> DataFrame:
    """Rows, distinct ids, repeated ids, empty names and addresses, ids with a wrong prefix or outer white space."""
    empty = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    n, d = F.count(F.lit(1)), F.count_distinct(F.trim(id_col))
    return rows.agg(n.alias("n_rows"), d.alias("n_ids"), (n - d).alias("n_repeated"), F.count_if(empty(name)).alias("empty_names"), F.count_if(empty(address)).alias("empty_addresses"), F.count_if(~F.trim(id_col).startswith(prefix)).alias("bad_prefix"), F.count_if(F.col(id_col) != F.trim(id_col)).alias("outer_space"))


def country_counts(rows: DataFrame, country: str = "country") -> DataFrame:
    return rows.groupBy(F.trim(country).alias("country")).agg(F.count(F.lit(1)).alias("n"))


def match_histogram(lists: DataFrame, most: int = 10) -> DataFrame:
    """How many entities have 0, 1, ... and `most` or more matches."""
    return lists.groupBy(F.least(F.size("ids"), F.lit(most)).cast("long").alias("matches")).agg(F.count(F.lit(1)).alias("n"))


def truth_stats(truth: DataFrame) -> DataFrame:
    """One row on the truth alone."""
    lists = truth_lists(truth)
    has = lambda p: F.exists("ids", lambda x: x.startswith(p))
    other: Column = F.size(F.filter("ids", lambda x: ~x.rlike("^S[23]-")))
    n = F.count(F.lit(1))
    rows = lists.agg(n.alias("n_rows"), (n - F.count_distinct("s1_id")).alias("repeated_rows"), F.count_if(F.size("ids") == 0).alias("singletons"), F.count_if(has("S2-") & has("S3-")).alias("both_sources"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n_pairs"), F.coalesce(F.sum(other), F.lit(0)).alias("other_prefix"), F.lit(1).alias("one"))
    shared = lists.select("s1_id", F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("k")).agg(F.count_if(F.col("k") > 1).alias("shared_ids"), F.coalesce(F.max("k"), F.lit(0)).alias("most_shared"), F.lit(1).alias("one"))
    space = truth.agg(F.count_if(F.col(TRUTH[0]) != F.trim(TRUTH[0])).alias("outer_space"), F.lit(1).alias("one"))
    return rows.join(shared, "one").join(space, "one").drop("one")


def truth_integrity(truth: DataFrame, records: DataFrame) -> DataFrame:
    """What truth and sources say differently, as (what, n): rows of either without the other."""
    lists = truth_lists(truth)
    ids = records.select(F.trim("entity_id").alias("id"), F.substring(F.trim("entity_id"), 1, 2).alias("source")).distinct()
    mentioned = lists.select(F.explode("ids").alias("id"))
    lost = mentioned.join(ids, "id", "left_anti")
    s1 = ids.filter("source = 'S1'").select(F.col("id").alias("s1_id"))
    parts = {
        "missing mentions": lost.agg(F.count(F.lit(1)).alias("n")),
        "missing ids": lost.agg(F.count_distinct("id").alias("n")),
        "truth without record": lists.select("s1_id").distinct().join(s1, "s1_id", "left_anti").agg(F.count(F.lit(1)).alias("n")),
        "record without truth": s1.join(lists, "s1_id", "left_anti").agg(F.count(F.lit(1)).alias("n")),
        "repeated truth rows": lists.groupBy("s1_id").count().filter("count > 1").agg(F.count(F.lit(1)).alias("n")),
    }
    out = None
    for what, one in parts.items():
        one = one.select(F.lit(what).alias("what"), F.col("n").cast("long").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def warnings(stats: dict, lines: dict | None = None) -> list[str]:
    """Sentences on what is wrong in a scan."""
    out = []
    if lines and lines["lines"] != stats["n_rows"]:
        out.append(f"{stats['n_rows']} rows were read from {lines['lines']} lines")
    for key, what in (("outer_space", "ids with outer white space"), ("bad_prefix", "ids with a wrong prefix"), ("n_repeated", "repeated ids")):
        if stats[key]:
            out.append(f"{stats[key]} {what}")
    return out


def markdown(title: str, table: DataFrame) -> str:
    """A report's table (aggregates: a row for each country, cause or the like) as Markdown, in order of its columns."""
    rows = table.orderBy(*table.columns).collect()
    line = lambda xs: "| " + " | ".join("" if x is None else f"{x:,}" if isinstance(x, int) else str(x) for x in xs) + " |"
    return "\n".join([f"## {title}", "", line(table.columns), line(["---"] * len(table.columns)), *(line(r) for r in rows), ""])
