"""Thirty-five features of a candidate pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.functions.similarity import SCORERS, similarities

# The features' names, and the columns of a candidate pair that they are made from.
FUZZY = tuple(f"{p}_{k}" for p in ("nn", "nc", "ad") for k in SCORERS)
PAIR = ("name_jaccard", "core_exact", "name_len_diff", "addr_empty_s1", "addr_empty_cand", "num_shared", "num_conflict", "pc_state")
BLOCK = ("cand_is_s3", "ch_name", "ch_ctx", "ch_addr", "n_channels", "rank_name", "rank_ctx", "rank_addr", "cos_name", "cos_ctx", "cos_addr", "block_score")
FEATURES = FUZZY + PAIR + BLOCK
NEEDED = ("name_norm", "name_core", "addr_norm", "numbers", "postcode")


def sides(pairs: DataFrame, records: DataFrame, columns: tuple[str, ...] = NEEDED) -> DataFrame:
    """pairs with the records of both sides as structs a and b; an id without a record is an error, in the task that meets it."""
    r = records.select("entity_id", F.struct(*columns).alias("r"))
    for i, side in (("s1_id", "a"), ("cand_id", "b")):
        pairs = pairs.join(r.select(F.col("entity_id").alias(i), F.col("r").alias(side)), i, "left")
        lost = F.raise_error(F.concat(F.lit("no record has the id "), F.coalesce(i, F.lit("null"))))
        pairs = pairs.withColumn(side, F.when(F.col(side).isNull(), lost.cast(pairs.schema[side].dataType)).otherwise(F.col(side)))
    return pairs


def unknown_ids(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Ids of pairs that have no record; features of such pairs can't be made."""
    ids = pairs.select(F.explode(F.array("s1_id", "cand_id")).alias("entity_id")).distinct()
    return ids.join(records.select("entity_id"), "entity_id", "left_anti")


def jaccard(a: Column, b: Column) -> Column:
    return F.when(F.size(F.array_union(a, b)) > 0, F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(0.0)


def shared_numbers(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(X.number_set(a), X.number_set(b)))


def postcode_state(a: Column, b: Column) -> Column:
    return F.when((a == "") | (b == ""), 0).when(a == b, 1).otherwise(-1)


def pair_features() -> dict[str, Column]:
    a, b = F.col("a"), F.col("b")
    core = F.length(a["name_core"]) - F.length(b["name_core"])
    shared = shared_numbers(a["numbers"], b["numbers"])
    return {
        "name_jaccard": jaccard(X.words(a["name_core"]), X.words(b["name_core"])),
        "core_exact": ((a["name_core"] == b["name_core"]) & (a["name_core"] != "")).cast("int"),
        "name_len_diff": F.abs(core),
        "addr_empty_s1": (a["addr_norm"] == "").cast("int"),
        "addr_empty_cand": (b["addr_norm"] == "").cast("int"),
        "num_shared": shared,
        "num_conflict": ((F.size(a["numbers"]) > 0) & (F.size(b["numbers"]) > 0) & (shared == 0)).cast("int"),
        "pc_state": postcode_state(a["postcode"], b["postcode"]),
    }


def features(cands: DataFrame, records: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """s1_id, cand_id, the features as floats, and label if truth pairs are given."""
    rows = sides(cands, records)
    score = similarities()
    for prefix, column in (("nn", "name_norm"), ("nc", "name_core"), ("ad", "addr_norm")):
        rows = rows.withColumn(prefix, score(F.col(f"a.{column}"), F.col(f"b.{column}")))
    fuzzy = [F.col(f"{p}.{k}").cast("float").alias(f"{p}_{k}") for p in ("nn", "nc", "ad") for k in SCORERS]
    pair = [c.cast("float").alias(n) for n, c in pair_features().items()]
    flags = [F.col(c).cast("int") for c in ("ch_name", "ch_ctx", "ch_addr")]
    blocked = [F.col("cand_id").startswith("S3-").cast("float").alias("cand_is_s3"), *[F.col(c).cast("float").alias(c) for c in ("ch_name", "ch_ctx", "ch_addr")], (flags[0] + flags[1] + flags[2]).cast("float").alias("n_channels"), *[F.col(c).cast("float").alias(c) for c in BLOCK[5:]]]
    if truth is None:
        return rows.select("s1_id", "cand_id", *fuzzy, *pair, *blocked)
    return labelled(rows, truth).select("s1_id", "cand_id", *fuzzy, *pair, *blocked, "label")


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    t = truth.select("s1_id", "cand_id", F.lit(1).alias("__t")).distinct()
    return pairs.join(t, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("__t", F.lit(0)).cast("byte")).drop("__t")
