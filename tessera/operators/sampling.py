"""Splits and samples by hashed order: the same rows however the table is partitioned.

Strata are spread by their key; where one stratum may hold most rows its ranking is
made in two steps, by the first hex digits of the order and within them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as X


def ranked(rows: DataFrame, strata: list[str], key: Column, tie: str) -> DataFrame:
    """rows with place (from 1) and stratum_size, by key within each stratum."""
    r = rows.withColumn("__key", key).withColumn("__digit", F.substring("__key", 1, 4))
    sizes = r.groupBy(*strata, "__digit").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy(*strata)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(own.orderBy("__digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("stratum_size", F.sum("n").over(own)).drop("n")
    within = F.row_number().over(Window.partitionBy(*strata, "__digit").orderBy("__key", tie))
    return r.withColumn("__w", within).join(sizes, [*strata, "__digit"]).withColumn("place", F.col("__w") + F.col("before")).drop("__w", "before", "__key", "__digit")


def half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def split(entities: DataFrame, fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """s1_id, country, has_match -> split: `fraction` of each (country, has_match) stratum trains."""
    r = ranked(entities, ["country", "has_match"], X.order_key(seed, "split", F.col("s1_id")), "s1_id")
    return r.withColumn("split", F.when(F.col("place") <= half_up(F.col("stratum_size") * fraction), "train").otherwise("val")).select("s1_id", "country", "has_match", "split")


def fraction_of(entities: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """That share of each (country, has_match) stratum, one row at least."""
    if fraction >= 1:
        return entities
    r = ranked(entities, ["country", "has_match"], X.order_key(seed, "frac", F.col("s1_id")), "s1_id")
    return r.filter(F.col("place") <= F.greatest(F.lit(1), half_up(F.col("stratum_size") * fraction))).select(*entities.columns)


def allocate(sizes: DataFrame, n: int) -> DataFrame:
    """(stratum, size) -> take: n in all, in proportion, by largest remainders, ties by name, never above size."""
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sizes.withColumn("total", F.sum("size").over(whole)).withColumn("quota", F.col("size") * F.least(F.lit(n), F.col("total")) / F.col("total")).withColumn("take", F.floor("quota"))
    s = s.withColumn("left", F.least(F.lit(n), F.col("total")) - F.sum("take").over(whole))
    turn = F.row_number().over(Window.orderBy(F.desc(F.col("quota") - F.col("take")), "stratum"))
    return s.withColumn("turn", turn).select("stratum", "size", (F.col("take") + F.when((F.col("turn") <= F.col("left")) & (F.col("take") < F.col("size")), 1).otherwise(0)).cast("long").alias("take"))


def per_stratum(rows: DataFrame, stratum: str, takes: DataFrame, key: Column, tie: str) -> DataFrame:
    """The first `take` rows of each stratum by key."""
    r = ranked(rows, [stratum], key, tie).join(takes.select(F.col("stratum").alias(stratum), "take"), stratum)
    return r.filter(F.col("place") <= F.col("take")).select(*rows.columns)


def bottom_k(rows: DataFrame, k: int, key: Column, tie: str) -> DataFrame:
    """The k rows least by key: partial limits before one merge."""
    return rows.withColumn("__key", key).orderBy("__key", tie).limit(k).drop("__key")


def hash_share(rows: DataFrame, share: float, seed: int, salt: str, key: str) -> DataFrame:
    """About that share of the rows, by the hash of their key alone."""
    bound = f"{int(share * 16**8):08x}" if share < 1 else "g"
    return rows.filter(F.substring(X.order_key(seed, salt, F.col(key)), 1, 8) < bound)


def capped_groups(rows: DataFrame, group: str, cap: int, seed: int = 42) -> DataFrame:
    """Whole groups, in hashed order, while their rows together stay within cap.

    Running sums are made per leading hex digits of the order, then within them, so no task ranks all groups.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).withColumn("key", X.order_key(seed, "cap", F.col(group))).withColumn("digit", F.substring("key", 1, 3))
    before = sizes.groupBy("digit").agg(F.sum("n").alias("m")).withColumn("before", F.coalesce(F.sum("m").over(Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("m")
    run = F.sum("n").over(Window.partitionBy("digit").orderBy("key", group).rowsBetween(Window.unboundedPreceding, 0))
    chosen = sizes.withColumn("run", run).join(before, "digit").filter(F.col("run") + F.col("before") <= cap).select(group)
    return rows.join(chosen, group, "left_semi")


def make_sample(records: DataFrame, truth_pairs: DataFrame, entities: DataFrame, n_s1: int, ratio: int = 3, seed: int = 42) -> DataFrame:
    """A smaller data set: n_s1 stratified S1, all their matches, and for each pool source `ratio` times as many distractors as matches."""
    e = entities.withColumn("stratum", F.concat_ws("|", "country", F.col("has_match").cast("string")))
    takes = allocate(e.groupBy("stratum").agg(F.count(F.lit(1)).alias("size")), n_s1)
    s1 = per_stratum(e, "stratum", takes, X.order_key(seed, "s1", F.col("s1_id")), "s1_id").select(F.col("s1_id").alias("entity_id"))
    matched = truth_pairs.join(s1.withColumnRenamed("entity_id", "s1_id"), "s1_id", "left_semi").select(F.col("cand_id").alias("entity_id")).distinct()
    kept = s1.union(matched)
    others = records.filter(F.col("source") != "S1").join(truth_pairs.select(F.col("cand_id").alias("entity_id")), "entity_id", "left_anti")
    out = records.join(kept, "entity_id", "left_semi")
    wanted = {r["source"]: r["n"] for r in records.join(matched, "entity_id", "left_semi").groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    for source, n in sorted(wanted.items()):
        out = out.unionByName(bottom_k(others.filter(F.col("source") == source), ratio * n, X.order_key(seed, "distractor", F.col("entity_id")), "entity_id"))
    return out


def share_deviation(original: DataFrame, sample: DataFrame, statistical: bool) -> DataFrame:
    """Largest difference between the countries' shares in two tables, and the tolerance: 5 points, or 4 standard errors, plus 1/n."""
    count = lambda d, name: d.groupBy("country").agg(F.count(F.lit(1)).alias(name))
    j = count(original, "a").join(count(sample, "b"), "country", "full").na.fill(0, ["a", "b"])
    t = j.agg(F.sum("a").alias("na"), F.sum("b").alias("nb"), F.collect_list(F.struct("a", "b")).alias("c"))
    pa, nb = lambda x: x["a"] / F.col("na"), F.col("nb")
    error = (lambda x: 4 * F.sqrt(pa(x) * (1 - pa(x)) / nb)) if statistical else (lambda x: F.lit(0.05))
    ok = (F.col("na") > 0) & (nb > 0)
    return t.select(F.when(ok, F.array_max(F.transform("c", lambda x: F.abs(pa(x) - x["b"] / nb)))).otherwise(0.0).alias("deviation"), F.when(ok, F.array_max(F.transform("c", error)) + 1 / nb).otherwise(0.0).alias("tolerance"))
