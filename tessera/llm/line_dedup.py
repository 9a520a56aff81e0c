"""Line deduplication as an exact set-similarity join.

A line's tokens are its word shingles (see jaccard: rarest first, with prefix, length
and positional filters, verified once per pair). Of two lines whose sets have a
Jaccard similarity of `percent` hundredths or more, the later is removed; later is by
document id, then by line. So a line goes if any earlier line of the corpus matches
it, itself removed or not. Equal lines are merged before they are joined.

Lines are split at "\\n". Lines without a word match nothing and stay. A null text
stays null, with 0 lines; a text that loses all its lines becomes what is left of it,
perhaps empty, and its row stays. Rows with equal id and text count as one document;
rows with a null id come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import blocks as B
from tessera.llm import jaccard
from tessera.llm.shared import cut

WORD = "[^\\x20\\x09-\\x0D]"
LAST = 2**63 - 1


def kept(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, percent: int = 75) -> DataFrame:
    """(rep, tag, lines): of each document (id, hash of text) the lines with words that stay, from 0."""
    lines = docs.select(F.col(doc_id).alias("rep"), F.xxhash64(text).alias("tag"), F.posexplode(F.split(text, "\n")).alias("sub", "text")).filter(F.col("text").rlike(WORD))
    to, _ = B.sizes(docs, text)
    found = cut(jaccard.rarest_first(B.blocks(lines, to.blocks), to, k, percent).select("k1", "k2", "rep", "sub", "tag", "n", "rare", "body"))
    late = jaccard.join(found, percent, False)
    stay = found.select("k1", "k2", "rep", "sub", "tag").join(late, ["k1", "k2"], "left_anti")
    return stay.groupBy("rep", "tag").agg(F.collect_list(F.col("sub").cast("int")).alias("lines"))


def with_kept(docs: DataFrame, text: str, doc_id: str, k: int, percent: int) -> DataFrame:
    """(row, lines): the rows as a struct, as their names may be any."""
    stay = kept(docs, text, doc_id, k, percent)
    return docs.select(F.struct("*").alias("row"), F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("rep"), F.xxhash64(text).alias("tag")).join(stay, ["rep", "tag"], "left").select("row", "lines")


def worded(text: str) -> Column:
    return F.coalesce(F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))), F.lit(0)).cast("long")


def report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_lines (with a word), n_removed and kept_lines (their numbers, ascending)."""
    rows = docs.select(F.col(doc_id), F.xxhash64(text).alias("__tag"), worded(text).alias("n_lines"))
    stay = kept(docs, text, doc_id, k, percent)
    out = rows.withColumn("__rep", F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))).join(stay.select(F.col("rep").alias("__rep"), F.col("tag").alias("__tag"), "lines"), ["__rep", "__tag"], "left")
    lines = F.when(F.col("n_lines") > 0, F.sort_array(F.coalesce("lines", F.array().cast("array<int>")))).otherwise(F.array().cast("array<int>"))
    return out.select(doc_id, "n_lines", (F.col("n_lines") - F.size(lines)).cast("long").alias("n_removed"), lines.alias("kept_lines"))


def remove(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, percent: int = 75) -> DataFrame:
    """docs with later lines removed from text."""
    t = F.col("row")[text]
    stays = F.filter(F.split(t, "\n"), lambda x, i: ~x.rlike(WORD) | F.coalesce(F.array_contains("lines", i), F.lit(False)))
    rows = with_kept(docs, text, doc_id, k, percent).select("row", F.when(t.isNotNull(), F.array_join(stays, "\n")).alias("left"))
    return rows.select(*[(F.col("left") if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
