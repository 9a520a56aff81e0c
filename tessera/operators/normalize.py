"""Records in one normal form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as X

CHANNELS = ("name", "ctx", "addr")


def normalize(rows: DataFrame, folded: bool = False) -> DataFrame:
    """Twelve columns of each raw record; folded: name and address have only ASCII characters."""
    fold = (lambda c: F.coalesce(c, F.lit(""))) if folded else X.fold
    r = rows.select(
        F.trim("entity_id").alias("entity_id"),
        F.substring(F.trim("entity_id"), 1, 2).alias("source"),
        F.trim(F.coalesce("country", F.lit(""))).alias("country"),
        F.coalesce("business_name", F.lit("")).alias("name_raw"),
        F.coalesce("business_address", F.lit("")).alias("addr_raw"),
    ).withColumns({"n": fold(F.col("name_raw")), "a": fold(F.col("addr_raw"))})
    r = r.withColumns({"name_norm": X.clean(F.col("n")), "numbers": X.digit_runs(F.col("a")), "addr_clean": X.clean(F.col("a"))})
    r = r.withColumns({"name_core": X.name_core(F.col("name_norm")), "addr_norm": X.address(F.col("addr_clean")), "postcode": X.postcode(F.col("numbers")), "city_token": X.city_token(F.col("a"))})
    return r.select("entity_id", "source", "country", "name_raw", "addr_raw", "name_norm", "name_core", "addr_norm", "numbers", "postcode", "city_token", X.words(F.col("name_core")).alias("name_tokens"))


def channel_texts(records: DataFrame, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """(entity_id, source, country, channel, text): what each channel compares."""
    text = {
        "name": F.col("name_core"),
        "ctx": F.trim(F.concat_ws(" ", "name_core", *[F.when(F.col(c) != "", F.col(c)) for c in ("postcode", "city_token")])),
        "addr": F.col("addr_norm"),
    }
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), text[c].alias("text")) for c in channels])).alias("c")
    return records.select("entity_id", "source", "country", each).select("entity_id", "source", "country", "c.channel", "c.text")
