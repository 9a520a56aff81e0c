"""Candidates by TF-IDF similarity of character trigrams, per country and channel.

The inverted index is a table of (country, channel, gram, entity). Queries keep only
grams that few documents have, so that a key of the join fans out to `max_df` rows at most;
only a query that keeps none gets its `fallback` rarest grams back, however common these are. What the join finds is cut to
K' per query, channel and pool source by a ranking window (partial limits run before
the shuffle), scored again on all grams (as one vector for each record), and cut to K. Weights are integers of
millionths, so sums don't depend on the order of rows or on the number of
partitions; ties go to the smaller id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators.normalize import channel_texts
from tessera.sources.shared import cut

KEY = ("country", "channel")
SCALE = 1_000_000
CHANNELS = ("name", "ctx", "addr")
#: A table of grams with at most so many rows may be broadcast (they grow with the alphabet and the countries, not with the records).
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class BlockConfig:
    """K per channel; K' = retrieve * K; caps, fallback and the address tiebreak."""

    k: dict[str, int] = field(default_factory=lambda: {"name": 15, "ctx": 10, "addr": 10})
    retrieve: int = 4
    max_df_share: float = 0.002
    max_df_floor: int = 500
    fallback: int = 5
    tiebreak: float = 0.5
    tiebreak_channels: tuple[str, ...] = ("name", "ctx")
    by_country: bool = True


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """X.grams of each text, counted within its row: nothing is shuffled, and no expression is interpreted for every two grams."""
    for b in batches:
        grams, tf, many = [], [], []
        for text in b.column("text").to_pylist():
            n: Counter[str] = Counter()
            for w in (text or "").split(" "):
                padded = f" {w} "
                n.update([padded[i : i + 3] for i in range(len(w))])
            grams += n.keys()
            tf += n.values()
            many.append(len(n))
        row = pa.array(np.repeat(np.arange(b.num_rows), np.array(many, np.int64)))
        yield pa.record_batch([*(b.column(c).take(row) for c in (*KEY, "entity_id", "source")), pa.array(grams, pa.string()), pa.array(tf, pa.int64())], names=[*KEY, "entity_id", "source", "gram", "tf"])


def gram_table(texts: DataFrame) -> DataFrame:
    """(country, channel, entity_id, source, gram, tf)."""
    return texts.mapInArrow(_counted, "country string, channel string, entity_id string, source string, gram string, tf long")


def document_frequency(grams: DataFrame) -> DataFrame:
    return grams.groupBy(*KEY, "gram").agg(F.count(F.lit(1)).alias("df"))


def document_counts(texts: DataFrame) -> DataFrame:
    return texts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"))


def idf(df: DataFrame, counts: DataFrame) -> DataFrame:
    """df with n_docs and the smoothed inverse document frequency."""
    return df.join(counts, list(KEY)).withColumn("idf", F.log((F.lit(1) + F.col("n_docs")) / (F.lit(1) + F.col("df"))) + 1)


def weights(grams: DataFrame, idfs: DataFrame) -> DataFrame:
    """(country, channel, entity_id, source, gram, df, n_docs, q): unit vectors in integers."""
    w = grams.join(idfs, [*KEY, "gram"]).withColumn("w", (F.lit(1) + F.log("tf")) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*KEY, "entity_id")))
    return w.select(*KEY, "entity_id", "source", "gram", "df", "n_docs", F.round(F.col("w") / norm * SCALE).cast("long").alias("q"))


def max_df(config: BlockConfig):
    return F.greatest(F.lit(config.max_df_floor), F.floor(F.col("n_docs") * config.max_df_share))


def search_grams(queries: DataFrame, config: BlockConfig) -> DataFrame:
    """The grams with which queries search: those under the cap, or the rarest of a query that has none such."""
    own = Window.partitionBy(*KEY, "entity_id")
    q = queries.withColumn("common", F.col("df") > max_df(config))
    q = q.withColumn("lost", F.min("common").over(own)).withColumn("rare", F.row_number().over(own.orderBy("df", "gram")))
    return q.filter(~F.col("common") | (F.col("lost") & (F.col("rare") <= config.fallback))).drop("common", "lost", "rare")


def retrieve(weighted: DataFrame, config: BlockConfig, queries: DataFrame | None = None) -> DataFrame:
    """(country, channel, s1_id, cand_id, source, score, rank): the best K' of each pool source, score in integers."""
    q = weighted.filter(F.col("source") == "S1")
    if queries is not None:
        q = q.join(queries.select(F.col("s1_id").alias("entity_id")).distinct(), "entity_id", "left_semi")
    q = search_grams(q, config).select(*KEY, "gram", F.col("entity_id").alias("s1_id"), F.col("q").alias("qa"))
    pool = weighted.filter(F.col("source") != "S1").select(*KEY, "gram", F.col("entity_id").alias("cand_id"), "source", F.col("q").alias("qb"))
    hits = q.join(pool, [*KEY, "gram"]).groupBy(*KEY, "s1_id", "cand_id", "source").agg(F.sum(F.col("qa") * F.col("qb")).alias("score"))
    top = F.row_number().over(Window.partitionBy(*KEY, "s1_id", "source").orderBy(F.desc("score"), "cand_id"))
    most = F.element_at(F.create_map(*[F.lit(x) for c, k in config.k.items() for x in (c, k * config.retrieve)]), F.col("channel"))
    # the constant bound lets partial limits run before the shuffle
    return hits.withColumn("rank", top).filter(F.col("rank") <= max(config.k.values()) * config.retrieve).filter(F.col("rank") <= most)


def _dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Integer dot products of each row's two sparse vectors; rows without a common gram go."""

    def flat(b: pa.RecordBatch, keys: str, values: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = b.column(keys)
        row = np.repeat(np.arange(b.num_rows), np.diff(np.asarray(lists.offsets)))
        return row, np.asarray(lists.flatten()), np.asarray(b.column(values).flatten())

    for b in batches:
        (ra, ka, qa), (rb, kb, qb) = flat(b, "ka", "va"), flat(b, "kb", "vb")
        _, key = np.unique(np.concatenate([ka, kb]), return_inverse=True)
        both = np.concatenate([ra, rb]) * (int(key.max(initial=0)) + 1) + key
        order = np.argsort(both, kind="stable")
        same = np.flatnonzero(both[order][1:] == both[order][:-1])
        left, right = order[same], order[same + 1] - len(ka)
        product = qa[left] * qb[right]
        total, many = np.zeros(b.num_rows, np.int64), np.bincount(ra[left], minlength=b.num_rows)
        np.add.at(total, ra[left], product)
        at = pa.array(np.flatnonzero(many))
        yield pa.record_batch([*(b.column(c).take(at) for c in ("country", "s1_id", "cand_id", "channel")), pa.array(total).take(at)], names=["country", "s1_id", "cand_id", "channel", "cos"])


def exact_cosine(pairs: DataFrame, weighted: DataFrame) -> DataFrame:
    """Of each (country, s1_id, cand_id): cos of every channel on all grams, as integers over SCALE squared.

    Each record's grams become one vector; a pair meets two vectors a channel instead of a row for each gram.
    """
    p = pairs.select("country", "s1_id", "cand_id").distinct()
    # a gram has three characters; known by a hash of 64 bits, which numpy can compare
    v = weighted.groupBy(*KEY, "entity_id").agg(F.collect_list(F.struct(F.xxhash64("gram").alias("k"), "q")).alias("v")).select(*KEY, "entity_id", F.col("v.k").alias("k"), F.col("v.q").alias("v"))
    a = v.filter(F.col("entity_id").startswith("S1-")).select(*KEY, F.col("entity_id").alias("s1_id"), F.col("k").alias("ka"), F.col("v").alias("va"))
    b = v.select(*KEY, F.col("entity_id").alias("cand_id"), F.col("k").alias("kb"), F.col("v").alias("vb"))
    return p.join(a, ["country", "s1_id"]).join(b, ["country", "channel", "cand_id"]).mapInArrow(_dots, "country string, s1_id string, cand_id string, channel string, cos long")


def rerank(retrieved: DataFrame, cosines: DataFrame, config: BlockConfig) -> DataFrame:
    """retrieved cut to K by exact cosine, with the address as tiebreak where it applies; adds key, cos and final."""
    keys = ["country", "s1_id", "cand_id"]
    addr = cosines.filter(F.col("channel") == "addr").select(*keys, F.col("cos").alias("cos_addr"))
    r = retrieved.join(cosines, [*keys, "channel"], "left").join(addr, keys, "left")
    bonus = F.when(F.col("channel").isin(*config.tiebreak_channels), F.coalesce("cos_addr", F.lit(0)) * config.tiebreak).otherwise(0)
    r = r.withColumn("key", F.coalesce("cos", F.lit(0)) + bonus.cast("long"))
    final = F.row_number().over(Window.partitionBy(*KEY, "s1_id", "source").orderBy(F.desc("key"), F.desc("score"), "cand_id"))
    k = F.element_at(F.create_map(*[F.lit(x) for c, n in config.k.items() for x in (c, n)]), F.col("channel"))
    return r.withColumn("final", final).filter(F.col("final") <= max(config.k.values())).filter(F.col("final") <= k).select(*KEY, "s1_id", "cand_id", "source", "score", "cos", "key", "final")


def candidates(ranked: DataFrame, cosines: DataFrame) -> DataFrame:
    """One row per pair: channel flags, ranks (null where not found), cosines, block_score.

    All channels have their columns; one that is disabled found nothing and has the cosine 0.
    """
    keys = ["country", "s1_id", "cand_id"]
    per = ranked.groupBy(*keys).agg(*[F.min(F.when(F.col("channel") == c, F.col("final"))).cast("float").alias(f"rank_{c}") for c in CHANNELS])
    cos = cosines.groupBy(*keys).agg(*[F.max(F.when(F.col("channel") == c, F.col("cos"))).alias(f"c_{c}") for c in CHANNELS])
    unit = {c: F.least(F.coalesce(F.col(f"c_{c}"), F.lit(0)) / float(SCALE) ** 2, F.lit(1.0)) for c in CHANNELS}
    r = per.join(cos, keys, "left")
    return r.select("s1_id", "cand_id", "country", *[F.col(f"rank_{c}").isNotNull().alias(f"ch_{c}") for c in CHANNELS], *[f"rank_{c}" for c in CHANNELS], *[unit[c].cast("float").alias(f"cos_{c}") for c in CHANNELS], F.greatest(*unit.values()).cast("float").alias("block_score"))


def near(table: DataFrame) -> DataFrame:
    """A counted table of grams, to be broadcast if it is small; a larger one is joined by a shuffle, whose skewed keys Spark splits."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table.hint("merge")


def weighted_grams(records: DataFrame, config: BlockConfig = BlockConfig()) -> DataFrame:
    rows = records if config.by_country else records.withColumn("country", F.lit(""))
    texts = cut(channel_texts(rows, tuple(c for c in CHANNELS if c in config.k)))
    grams = gram_table(texts)
    return weights(grams, near(cut(idf(document_frequency(grams), document_counts(texts)))))


def block(records: DataFrame, config: BlockConfig = BlockConfig(), queries: DataFrame | None = None) -> DataFrame:
    """Candidates of each S1 record (of those in queries); the pool is every S2 and S3 record.

    The index, what was retrieved and its cosines are each read several times, so they are written to the shared folder.
    A pair has its S1 record's country, whether the search went by country or not.
    """
    if not config.k or set(config.k) - set(CHANNELS):
        raise ValueError(f"channels must be some of {', '.join(CHANNELS)}")
    weighted = cut(weighted_grams(records, config))
    found = cut(retrieve(weighted, config, queries))
    cosines = cut(exact_cosine(found, weighted))
    out = candidates(rerank(found, cosines, config), cosines)
    if config.by_country:
        return out
    own = records.filter(F.col("source") == "S1").select(F.col("entity_id").alias("s1_id"), "country")
    return out.drop("country").join(own, "s1_id").select(*out.columns)


def country_equal_share(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """pairs, equal and share of the true pairs whose records lie in one country; pairs without records don't count."""
    c = records.select("entity_id", "country")
    j = pairs.join(c.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("c1")), "s1_id").join(c.select(F.col("entity_id").alias("cand_id"), F.col("country").alias("c2")), "cand_id")
    n, same = F.count(F.lit(1)), F.count_if(F.col("c1") == F.col("c2"))
    return j.agg(n.alias("n_true_pairs"), same.alias("n_equal"), F.when(n > 0, same / n).otherwise(1.0).alias("country_equal_share"))


def by_country(pairs: DataFrame, records: DataFrame, least: float = 0.995) -> bool:
    return country_equal_share(pairs, records).first()["country_equal_share"] >= least
