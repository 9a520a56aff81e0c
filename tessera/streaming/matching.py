"""Candidates for pool records that arrive as a stream, against stored first-source records.

Statistics (document frequencies) come from the stored index, so a record's
candidates don't depend on the batch that it came in. Delivery is exactly once:
each batch overwrites the folder of its own number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tessera.operators import blocking as B
from tessera.operators.normalize import channel_texts, normalize


def match_batch(batch: DataFrame, stored: DataFrame, idfs: DataFrame, config: B.BlockConfig) -> DataFrame:
    """Candidates between stored S1 records and a batch of raw pool records; grams unknown to the index count as seen once."""
    records = normalize(batch).select(*stored.columns)
    grams = B.gram_table(channel_texts(stored.filter("source = 'S1'").unionByName(records.filter("source <> 'S1'"))))
    counts = idfs.select(*B.KEY, "n_docs").distinct()
    known = grams.select(*B.KEY, "gram").distinct().join(counts, list(B.KEY)).join(idfs.select(*B.KEY, "gram", "df"), [*B.KEY, "gram"], "left").na.fill(1, ["df"])
    weighted = B.weights(grams, known.withColumn("idf", F.log((F.lit(1) + F.col("n_docs")) / (F.lit(1) + F.col("df"))) + 1))
    found = B.retrieve(weighted, config)
    cosines = B.exact_cosine(found, weighted)
    return B.candidates(B.rerank(found, cosines, config), cosines)


def start(stream: DataFrame, stored: DataFrame, idfs: DataFrame, out: str, checkpoint: str, config: B.BlockConfig = B.BlockConfig(), once: bool = False) -> StreamingQuery:
    """stream: raw pool records. Each batch's candidates go to out/batch=<number>."""

    def each(batch: DataFrame, number: int) -> None:
        match_batch(batch, stored, idfs, config).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
