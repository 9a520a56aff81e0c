"""Entity-resolution views of the driver's tables: pages as business records.

The address of a page is its entity's name, its parts the address, its language the
country; the page number deals the whole table out to the three sources. Pages of
one site and language, whatever the protocol or the kind of host, are one entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.shared import spread_out

LANGUAGE = "/(en|fr|de|es)(/|$|\\?|#)"


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread_out(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return p.select(
        F.concat(F.lit("S"), (F.col("page_id") % 3 + 1).cast("string"), F.lit("-"), F.col("page_id").cast("string")).alias("entity_id"),
        F.col("url").alias("business_name"),
        F.regexp_replace("url", "[/?#&=:]+", ", ").alias("business_address"),
        F.regexp_extract("url", LANGUAGE, 1).alias("country"),
        F.regexp_extract(F.lower("url"), "^https?://(?:www\\.|m\\.|blog\\.)?([^/]+)", 1).alias("address"),
    )


def truth(raw: DataFrame) -> DataFrame:
    """source1_entity_id and matched_entity_ids of every S1 record."""
    s1 = raw.filter(F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias("source1_entity_id"), "address", "country")
    pool = raw.filter(~F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias("cand_id"), "address", "country")
    return s1.join(pool, ["address", "country"], "left").groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_set("cand_id")), ",").alias("matched_entity_ids"))


def spoilt(rows: DataFrame, column: str) -> DataFrame:
    """A table of source1_entity_id and id lists with every kind of fault, by the number in the id, for the checks to find."""
    own = F.col("source1_entity_id")
    n = F.split_part(own, F.lit("-"), F.lit(2)).cast("long")
    ids = F.when(F.col(column) == "", F.array().cast("array<string>")).otherwise(F.split(column, ","))
    more = lambda k, x: F.when(n % k == 0, F.array(x)).otherwise(F.array().cast("array<string>"))
    first = F.when((n % 7 == 0) & (F.size(ids) > 0), F.slice(ids, 1, 1)).otherwise(F.array().cast("array<string>"))
    longer = F.concat(ids, first, more(11, own), more(13, F.concat(F.lit("X-"), n.cast("string"))), more(17, F.concat(F.lit("S2-0"), n.cast("string"))))
    r = rows.select(F.when(n % 31 == 0, F.concat(own, F.lit(" "))).otherwise(own).alias("source1_entity_id"), F.array_join(longer, ",").alias(column), n.alias("n")).filter("n % 19 <> 0")
    twice = r.filter("n % 23 = 0")
    strange = r.filter("n % 29 = 0").select(F.concat(F.lit("S1-0"), F.col("n").cast("string")).alias("source1_entity_id"), F.lit("").alias(column), "n")
    return r.unionByName(twice).unionByName(strange).drop("n")


def loose_groups(raw: DataFrame) -> DataFrame:
    """entity_id and group: records of a country whose numbers end alike, as if they were true pairs; most of them are unlike, so that blocking misses some."""
    digit = F.split_part("entity_id", F.lit("-"), F.lit(2)).cast("long") % 10
    return raw.select("entity_id", F.concat("country", F.lit("/"), digit.cast("string")).alias("group")).filter("group is not null")


def fewer(raw: DataFrame) -> DataFrame:
    """Records without some, so that truth mentions ids that aren't there."""
    return raw.filter(F.split_part("entity_id", F.lit("-"), F.lit(2)).cast("long") % 37 != 0)
