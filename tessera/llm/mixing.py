"""Mixing sources to target weights.

Each source's documents, in a hashed order, form one stream of words that is cut
into blocks of `block` words. The mix has as many slots as the sources' targets
need, dealt to output shards of `shard_slots`. Every slot draws its source by itself,
with the targets' shares, so the counts of a shard are multinomial. The draws are then
corrected to the totals: what a source drew beyond its exact number of slots goes to
the sources that drew too little; which of its slots go is a pseudorandom choice among all shards. A
source's slots are numbered across the shards; slot j takes block perm(j mod n) of the
source's n blocks, where perm is a pseudorandom permutation of its own for each source
and each pass over it (a keyed Feistel network with cycle walking). Joining blocks by
their index says how often each is taken, and each document gives the words that it
has in them.

Targets: weights 5, 2, 1, repeating, by the sources' code point order, null last;
they share all words; a target stops at `most` times its source's words, and the
excess is shared again by weight until none is above.

Sums along a source's stream are made in two steps, per bucket of a hash of the id
and then within a bucket of about `bucket_rows` rows, so that a source with a third of all
rows is spread over the cluster; slots are numbered likewise, by bunches of shards. The only
windows over everything are those over the table of sources. Null text or text without words: size 0, nothing taken. Repeated ids
are told apart by their text; repeated rows share the words evenly as far as whole
words allow. An empty table gives no row. Of docs only the three columns named are read, so others may clash with nothing. No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import cut

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
#: Half rounds of the Feistel network, and how often a value beyond the range may be sent through it again.
ROUNDS, WALK = 6, 64
#: Shards whose draws are numbered in one task.
BUNCH = 4096
#: A table of at most so many sources may be broadcast.
FEW_SOURCES = 10_000


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """source, source_size -> with target (double), by filling in order of size for each weight.

    Sources that stop are those with the least size for their weight: after the first k have
    stopped, the rest share what they leave by weight. The table has a row for each source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.hex(F.encode("source", "utf-8")))
    up = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("double")).withColumn("ratio", F.lit(most) * F.col("source_size") / F.col("weight"))
    s = s.withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum(F.lit(most) * F.col("source_size")).over(up), F.lit(0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(up), F.lit(0))))
    # the level that holds for those that don't stop is that before the first of them
    s = s.withColumn("stops", F.col("ratio") <= F.col("level"))
    s = s.withColumn("level", F.min(F.when(~F.col("stops"), F.struct("ratio", "place", "level"))).over(whole)["level"])
    return s.select("source", "source_size", "place", F.when(F.col("stops"), F.lit(most) * F.col("source_size")).otherwise(F.col("level") * F.col("weight")).cast("double").alias("target"))


def permuted(j: Column, n: Column, key: Column) -> Column:
    """A pseudorandom bijection of 0..n-1 for each key.

    j is two digits of a number system with ceil(sqrt(n)) and ceil(n / that) values, to each of which a hash of
    the other is added in turn. A result of n or more, of which there are fewer than sqrt(n), is sent through again
    until it is below: at most as often as there are such values, so WALK times are always enough up to n = 4096,
    and beyond it a chain of WALK of them has a probability below 64 ** -WALK; it would raise an error.
    """
    wide = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    high = F.ceil(n / wide).cast("long")

    def half(s: Column, i: Column) -> Column:
        turned = F.pmod(s["a"] + F.pmod(F.xxhash64(key, i, s["b"]), s["p"]), s["p"])
        return F.struct(s["b"].alias("a"), turned.alias("b"), s["q"].alias("p"), s["p"].alias("q"))

    def through(x: Column) -> Column:
        """The digits swap places in each half round, so after an even number the high one comes first again."""
        digits = F.struct(F.floor(x / wide).cast("long").alias("a"), F.pmod(x, wide).alias("b"), high.alias("p"), wide.alias("q"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), digits, half, lambda s: s["a"] * s["q"] + s["b"])

    # loops as expressions: written out, the network's tree would double with each round
    walk = lambda once: F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once, lambda x, _: F.when(x < n, x).otherwise(through(x)), lambda x: F.when(x < n, x).otherwise(F.raise_error(F.lit("a permutation didn't settle")).cast("long")))
    return F.get(F.transform(F.array(through(j)), lambda once: F.when(once < n, once).otherwise(walk(once))), F.lit(0))


def intervals(table: DataFrame, first: str, last: str, width: Column) -> DataFrame:
    """table with a row for each stretch of `width` numbers that first (inclusive) to last (exclusive) meets: a key to look numbers up by.

    With as many stretches as rows of the table a number finds two rows on average, however many and however small the intervals are.
    """
    rows = table.filter(F.col(first) < F.col(last))
    return rows.withColumn("stretch", F.explode(F.sequence(F.floor(F.col(first) / width), F.floor((F.col(last) - 1) / width))))


def slots(aims: DataFrame, shard_slots: int = 4096, seed: int = 1) -> DataFrame:
    """(place, shard, block) of every slot of the mix. aims: place, blocks and slots of each source, cut."""
    order = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources, total = aims.agg(F.count(F.lit(1)), F.coalesce(F.sum("slots"), F.lit(0))).first()
    width = max(1, -(-total // max(1, sources)))
    deck = aims.withColumn("last", F.sum("slots").over(order)).withColumn("first", F.col("last") - F.col("slots"))
    looked = intervals(deck.select("place", "first", "last"), "first", "last", F.lit(width))
    tasks = max(1, min(int(aims.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // 16384)), -(-total // 1_000_000))
    draws = aims.sparkSession.range(0, total, 1, tasks)
    draws = draws.select(F.floor(F.col("id") / shard_slots).alias("shard"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, total))).alias("r")).withColumn("stretch", F.floor(F.col("r") / width))
    counts = cut(draws.join(looked, "stretch").filter((F.col("first") <= F.col("r")) & (F.col("r") < F.col("last"))).groupBy("place", "shard").agg(F.count(F.lit(1)).alias("drawn")))

    # the draws of a source, numbered across its shards
    counts = counts.withColumn("bunch", F.floor(F.col("shard") / BUNCH))
    sums = counts.groupBy("place", "bunch").agg(F.sum("drawn").alias("many"))
    by_place = Window.partitionBy("place").orderBy("bunch")
    sums = sums.select("place", "bunch", F.coalesce(F.sum("many").over(by_place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("place", "bunch").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counts.withColumn("within", F.coalesce(F.sum("drawn").over(inside), F.lit(0))).join(sums, ["place", "bunch"]).withColumn("begin", F.col("base") + F.col("within"))

    # surplus draws of some sources, and what others lack, both in order of the sources
    drawn = aims.join(counts.groupBy("place").agg(F.sum("drawn").alias("drawn")), "place", "left").na.fill(0, ["drawn"])
    drawn = drawn.withColumns({"over": F.greatest(F.col("drawn") - F.col("slots"), F.lit(0)), "under": F.greatest(F.col("slots") - F.col("drawn"), F.lit(0))})
    drawn = drawn.withColumns({"over_first": F.sum("over").over(order) - F.col("over"), "under_last": F.sum("under").over(order), "width": F.greatest(F.lit(1), F.ceil(F.sum("over").over(whole) / max(1, sources)))})
    drawn = cut(drawn.select("place", "blocks", "slots", F.col("drawn").alias("all"), "over_first", (F.col("under_last") - F.col("under")).alias("under_first"), "under_last", "width"))

    # few rows become many slots: they are dealt out first
    every = numbered.repartition(tasks, "place", "shard").select("place", "shard", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("drawn") - 1)).alias("j")).join(drawn.select("place", "blocks", "slots", "all", "over_first", "width"), "place")
    every = every.withColumn("j", permuted(F.col("j"), F.col("all"), F.concat_ws(":", F.lit("surplus"), F.lit(seed), "place")))
    # one row for each slot; what a surplus draw is to become is looked up for it alone
    every = every.withColumn("r", F.when(F.col("j") >= F.col("slots"), F.col("over_first") + F.col("j") - F.col("slots"))).withColumn("stretch", F.floor(F.col("r") / F.col("width")))
    found = intervals(drawn.select(F.col("place").alias("p"), F.col("blocks").alias("b"), F.col("all").alias("a"), "under_first", "under_last", "width"), "under_first", "under_last", F.col("width")).drop("width")
    lacking = (every["stretch"] == found["stretch"]) & (F.col("under_first") <= F.col("r")) & (F.col("r") < F.col("under_last"))
    every = every.join(F.broadcast(found) if sources <= FEW_SOURCES else found, lacking, "left")
    moved = F.col("r").isNotNull()
    every = every.select("shard", *[F.when(moved, F.col(x)).otherwise(F.col(y)).alias(y) for x, y in (("p", "place"), ("b", "blocks"))], F.when(moved, F.col("a") + F.col("r") - F.col("under_first")).otherwise(F.col("j")).alias("j"))
    key = F.concat_ws(":", F.lit("block"), F.lit(seed), "place", F.floor(F.col("j") / F.col("blocks")))
    return every.select("place", "shard", permuted(F.pmod("j", F.col("blocks")), F.col("blocks"), key).alias("block"))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", block: int = 128, shard_slots: int = 4096, weights: tuple[int, ...] = WEIGHTS, most: int = 3, bucket_rows: int = 4096, seed: int = 1) -> DataFrame:
    """doc_id, source, k1, size, source_size, target, taken of each document; k1 hashes its text."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("k1"), words(text).alias("size"))
    d = cut(d.groupBy("source", "doc_id", "k1", "size").agg(F.count(F.lit(1)).alias("rows")))
    salt = max(1, -(-d.count() // bucket_rows))
    d = d.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "k1"), F.lit(salt)).cast("int"))

    # where each document's words stand in its source's stream
    sums = d.groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("rows")).alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut(sums.select("source", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"), "words"))
    aims = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    # slots and blocks of each source
    aims = aims.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    aims = cut(aims.withColumn("slots", F.when(F.col("source_size") > 0, F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")), most * F.col("blocks"))).otherwise(0).cast("long")))
    taken = slots(aims, shard_slots, seed).groupBy("place", "block").agg(F.count(F.lit(1)).alias("times"))

    # documents to the blocks in which they have words; those without words to numbers of their own below 0, which no block has
    places = sums.join(aims.select(F.col("source").alias("s"), "place", "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))).select(F.col("source").alias("s"), F.col("bucket").alias("b"), "base", "place", "source_size", "target")
    inside = Window.partitionBy("source", "bucket").orderBy(F.xxhash64("k1", "doc_id"), "doc_id", "k1").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("within", F.coalesce(F.sum(F.col("size") * F.col("rows")).over(inside), F.lit(0)))
    d = d.join(places, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).withColumn("start", F.col("base") + F.col("within"))
    end = F.col("start") + F.col("size") * F.col("rows")
    at = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))).otherwise(F.array(-1 - F.pmod(F.xxhash64("doc_id", "k1"), F.lit(2**31))))
    columns = ["doc_id", "source", "k1", "size", "rows", "source_size", "target"]
    spread = d.select(*columns, "place", "start", F.explode(at).alias("block"))
    part = F.least((F.col("block") + 1) * block, end) - F.greatest(F.col("block") * block, F.col("start"))
    got = spread.join(taken.hint("merge"), ["place", "block"], "left").groupBy(*columns).agg(F.sum(F.coalesce(part * F.col("times"), F.lit(0))).alias("got"))
    # repeated rows share what their words got
    out = got.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return out.select("doc_id", "source", "k1", "size", "source_size", "target", (F.floor(F.col("got") / F.col("rows")) + (F.col("row") <= F.col("got") % F.col("rows")).cast("long")).cast("long").alias("taken"))
