"""Blocks of texts that ask shards of keys: the exchange below the corpus-wide operators.

A *block* is a bounded bunch of distinct texts; a *shard* is a bounded range of
64-bit keys. A block asks about its sorted distinct keys in a few packed rows, one
for each part of the key space; shards merge what all blocks sent and answer, and the
block reads its answers beside its texts. So a key crosses the network once for each
block that has it, in a few bytes, whatever its number of occurrences; a hot key
costs a shard one entry for each sender. Nothing reaches the driver, nothing is
broadcast, and every step is an ordinary shuffle that Spark can run again when an
executor is lost.

A block never sends more than FAN rows, whatever the number of shards. With more
shards than that, the key space is parted in levels: a *relay* merges the rows that as
many senders as there are parts sent for one part, parts what it got further and passes the
answers back. A relay holds as much as a block, each level has as many relays as there are blocks, and so
the number of rows grows in proportion to the input (times the levels, a logarithm).
Blocks, relays and shards are dealt to at most PARTITIONS tasks, which take them one by one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U = np.uint64
#: Bytes of text in a block, and keys in a shard: what one task holds at a time.
BLOCK_BYTES, SHARD_KEYS = 12 << 20, 2_500_000
#: Rows that a block or a relay sends at most, and partitions of a shuffle.
FAN, PARTITIONS = 512, 1 << 15


@dataclass(frozen=True)
class Route:
    """blocks, and into how many parts the key space is parted on each level."""

    blocks: int
    fans: tuple[int, ...]

    def shards(self, depth: int = -1) -> int:
        return math.prod(self.fans[: depth + 1] if depth >= 0 else self.fans)


def route(blocks: int, shards: int) -> Route:
    levels = 1
    while FAN**levels < shards:
        levels += 1
    each = math.ceil(round(shards ** (1 / levels), 9))
    return Route(blocks, (each,) * levels)


def dealt(rows: DataFrame, number: str, n: int) -> DataFrame:
    """rows with those of each number (of n) in one partition (part), the numbers dealt evenly."""
    parts = max(1, min(n, PARTITIONS))
    return rows.withColumn("part", F.pmod(F.col(number), F.lit(parts)).cast("int")).repartitionById(parts, "part")


def identity(text: str | Column) -> list[Column]:
    """128 bits that stand for a text, null as empty."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(7), t).alias("k2")]


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of a text, that with the least (rep, sub); copies and trained summed."""
    for b in batches:
        if not b.num_rows:
            continue
        keys = [np.asarray(b.column(c)) for c in ("tag", "sub", "rep", "k2", "k1")]
        order = np.lexsort(keys)
        k1, k2 = keys[4][order], keys[3][order]
        at = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))
        first = pa.array(order[at])
        yield pa.record_batch([pa.array(np.add.reduceat(np.asarray(b.column(c))[order], at)) if c in ("copies", "trained") else b.column(c).take(first) for c in b.schema.names], names=b.schema.names)


def sizes(texts: DataFrame, text: str = "text", block_bytes: int | None = None, keys: int = 1) -> tuple[Route, int]:
    """How many blocks and shards hold these texts, with so many keys a word, and the texts' bytes."""
    total = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    least = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = min(least, math.ceil(total / (1 << 20)))  # small inputs use all cores too
    return route(max(1, math.ceil(total / (block_bytes or BLOCK_BYTES)), few), max(1, math.ceil(total * keys / 6 / SHARD_KEYS), few)), total


def blocks(texts: DataFrame, n: int) -> DataFrame:
    """(part, blk, k1, k2, text, rep, sub, copies, trained, tag) of the distinct texts, dealt into n blocks by content.

    texts: text, rep and perhaps sub (by which copies are ordered), perhaps trained (0 or 1)
    and tag (of the first copy). Copies are merged
    before the shuffle, so that a text that a third of all rows share isn't a hot block.
    """
    last = F.lit(2**63 - 1)
    t = texts.select(*identity("text"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("rep").cast("long"), last).alias("rep"), (F.col("sub") if "sub" in texts.columns else F.lit(0)).cast("long").alias("sub"), F.lit(1).cast("long").alias("copies"), (F.col("trained") if "trained" in texts.columns else F.lit(0)).cast("long").alias("trained"), (F.col("tag") if "tag" in texts.columns else F.lit(0)).cast("long").alias("tag"))
    return dealt(t.mapInArrow(_collapse, t.schema).withColumn("blk", F.pmod(F.xxhash64("k2"), F.lit(n))), "blk", n)


def merged(block: pa.Table) -> pa.Table:
    """A block with each text once."""
    if not block.num_rows:
        return block
    block = block.combine_chunks()
    parts = list(_collapse(iter(block.to_batches())))
    out = pa.Table.from_batches(parts)
    return out if len(parts) == 1 else pa.Table.from_batches(list(_collapse(iter(out.combine_chunks().to_batches()))))


def shard_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Rises with the key, so that sorted keys are dealt in runs."""
    return ((keys >> U(32)) * U(n)) >> U(32)


def pack(x: np.ndarray) -> bytes:
    """Integers as byte planes without the empty high ones; the shuffle's compression does the rest."""
    x = np.ascontiguousarray(x, np.uint64)
    planes = x.view(np.uint8).reshape(-1, 8).T
    used = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    return bytes([used]) + len(x).to_bytes(8, "little") + np.ascontiguousarray(planes[:used]).tobytes()


def unpack(b: bytes | memoryview, at: int = 0) -> tuple[np.ndarray, int]:
    """The integers, and where what follows them begins."""
    used, n = b[at], int.from_bytes(b[at + 1 : at + 9], "little")
    out = np.zeros((n, 8), np.uint8)
    if used:
        out[:, :used] = np.frombuffer(b, np.uint8, used * n, at + 9).reshape(used, n).T
    return out.view(np.uint64).reshape(-1), at + 9 + used * n


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending integers, as differences."""
    d = x.astype(np.uint64, copy=True)
    d[1:] -= x[:-1]
    return pack(d)


def unpack_sorted(b: bytes | memoryview, at: int = 0) -> tuple[np.ndarray, int]:
    d, at = unpack(b, at)
    return np.cumsum(d, dtype=np.uint64), at


def parted(of: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each shard of ascending shard numbers, and where its entries begin and end."""
    shard, at = np.unique(of, return_index=True)
    yield from zip(shard.tolist(), at.tolist(), [*at[1:].tolist(), len(of)], strict=True)


MESSAGE = "blk long, shard long, body binary"
_SCHEMA = pa.schema([("blk", pa.int64()), ("shard", pa.int64()), ("body", pa.binary())])


def message(blk: list[int], shard: list[int], body: list[bytes]) -> pa.Table:
    return pa.table([pa.array(blk, pa.int64()), pa.array(shard, pa.int64()), pa.array(body, pa.binary())], schema=_SCHEMA)


Entries = tuple[np.ndarray, ...]


def distinct(keys: np.ndarray, low: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the place of each key among them.

    Keys whose `low` last bits are empty carry their places there if these fit, so that values are sorted and no order of indices.
    """
    if not len(keys) or len(keys) > 1 << int(low):
        return np.unique(keys, return_inverse=True)
    both = keys | np.arange(len(keys), dtype=np.uint64)
    both.sort()
    every = both & (~U(0) << low)
    fresh = np.append(True, every[1:] != every[:-1])
    where = np.empty(len(keys), np.int64)
    where[(both ^ every).view(np.int64)] = np.cumsum(fresh) - 1
    return every[fresh], where


class Count:
    """Entries are distinct keys and how often each occurs; the answer is a value of each key's total.

    bits: so many of a key's first bits travel.
    """

    def __init__(self, value: Callable[[np.ndarray], np.ndarray], dtype: type, bits: int = 64):
        self.value, self.dtype, self.low = value, dtype, U(64 - bits)

    def entries(self, keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[Entries, np.ndarray]:
        """Of keys in any order, each with a weight (else 1): the entries, and the entry of each key."""
        every, where = distinct(keys & (~U(0) << self.low), self.low)
        return (every, np.bincount(where, weights, len(every)).astype(np.uint64)), where

    def counted(self, keys: np.ndarray) -> Entries:
        """The entries alone of keys in any order."""
        keys = np.sort(keys >> self.low)
        at = np.flatnonzero(np.append(np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]))
        return keys[at] << self.low, np.diff(np.append(at, len(keys))).astype(np.uint64)

    def write(self, e: Entries, a: int, z: int) -> bytes:
        return pack_sorted(e[0][a:z] >> self.low) + pack(e[1][a:z])

    def read(self, body: memoryview) -> Entries:
        keys, at = unpack_sorted(body)
        return keys << self.low, unpack(body, at)[0]

    def merge(self, parts: list[Entries]) -> tuple[Entries, np.ndarray]:
        every, where = distinct(np.concatenate([k for k, _ in parts]), self.low)
        return (every, np.bincount(where, np.concatenate([n for _, n in parts]).astype(float), len(every)).astype(np.uint64)), where

    def lengths(self, e: Entries) -> np.ndarray:
        return np.ones(len(e[0]), np.int64)

    def judge(self, e: Entries) -> np.ndarray:
        return self.value(e[1].astype(np.int64))


def write_values(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes() if x.dtype == bool else x.tobytes() if x.dtype == np.uint8 else pack(x)


def read_values(body: memoryview, n: int, dtype: type) -> np.ndarray:
    if dtype is bool:
        return np.unpackbits(np.frombuffer(body, np.uint8), count=n).astype(bool)
    return np.frombuffer(body, np.uint8, n) if dtype is np.uint8 else unpack(body)[0]


def outgoing(kind: Count, e: Entries, shards: int) -> list[tuple[int, bytes]]:
    return [(s, kind.write(e, a, z)) for s, a, z in parted(shard_of(e[0], shards))]


def values(kind: Count, e: Entries, got: pa.Table, shards: int) -> np.ndarray:
    """The answers in the order of the entries."""
    at = np.append(0, np.cumsum(kind.lengths(e)))
    out = np.zeros(at[-1], kind.dtype)
    answers = by_shard(got)
    for s, a, z in parted(shard_of(e[0], shards)):
        out[at[a] : at[z]] = read_values(answers[s], at[z] - at[a], kind.dtype)
    return out


def replies(kind: Count, parts: list[Entries], merged: Entries, where: np.ndarray, found: np.ndarray) -> list[bytes]:
    """What was found for the merged entries, to each of those that sent some of them."""
    size = kind.lengths(merged)
    begin = (np.cumsum(size) - size)[where]
    size = size[where]
    upto = np.append(0, np.cumsum(size))
    pick = found[np.repeat(begin - upto[:-1], size) + np.arange(upto[-1])]
    ends = upto[np.cumsum([len(p[0]) for p in parts])]
    return [write_values(pick[a:z]) for a, z in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def bodies(got: pa.Table) -> list[memoryview]:
    return [memoryview(x.as_buffer()) for c in got.column("body").chunks for x in c]


def by_shard(got: pa.Table) -> dict[int, memoryview]:
    return dict(zip(got.column("shard").to_pylist(), bodies(got), strict=True))


def asked(blocked: DataFrame, to: Route, kind: Count, question: Callable[[pa.Table], Entries]) -> DataFrame:
    """Messages of the blocks. question: of a merged block, its entries, keys ascending."""

    def up(block: pa.Table) -> pa.Table:
        blk = int(block.column("blk")[0].as_py())
        out = outgoing(kind, question(merged(block)), to.shards(0))
        return message([blk] * len(out), [s for s, _ in out], [b for _, b in out])

    return dealt(blocked.groupBy("part", "blk").applyInArrow(up, MESSAGE), "shard", to.shards(0))


def answered(messages: DataFrame, to: Route, kind: Count, depth: int = 0, senders: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Messages back to the blocks; and those that the shards got. What blocks keep for themselves (shards below 0) passes through.

    messages: dealt by shard. senders: how many may send to one shard.
    """
    if depth == len(to.fans) - 1:

        def over(got: pa.Table) -> pa.Table:
            shard = int(got.column("shard")[0].as_py())
            if shard < 0:
                return got.select(_SCHEMA.names)
            parts = [kind.read(b) for b in bodies(got)]
            every, where = kind.merge(parts)
            return message(got.column("blk").to_pylist(), [shard] * len(parts), replies(kind, parts, every, where, kind.judge(every)))

        return messages.groupBy("part", "shard").applyInArrow(over, MESSAGE), messages

    bunches = -(-(senders or to.blocks) // to.fans[depth])
    relays, below = to.shards(depth) * bunches, to.shards(depth + 1)
    relay = F.when(F.col("shard") < 0, F.col("shard")).otherwise(F.col("shard") * bunches + F.pmod(F.xxhash64("blk"), F.lit(bunches)))
    keyed = dealt(messages.withColumn("relay", relay), "relay", relays)

    def up(got: pa.Table) -> pa.Table:
        number = int(got.column("relay")[0].as_py())
        if number < 0:
            return message([], [], [])
        out = outgoing(kind, kind.merge([kind.read(b) for b in bodies(got)])[0], below)
        return message([number] * len(out), [s for s, _ in out], [b for _, b in out])

    further = dealt(keyed.groupBy("part", "relay").applyInArrow(up, MESSAGE), "shard", below)
    answers, last = answered(further, to, kind, depth + 1, bunches)

    def back(sent: pa.Table, got: pa.Table) -> pa.Table:
        if not sent.num_rows or sent.column("relay")[0].as_py() < 0:
            return sent.select(_SCHEMA.names)
        parts = [kind.read(b) for b in bodies(sent)]
        every, where = kind.merge(parts)
        return message(sent.column("blk").to_pylist(), sent.column("shard").to_pylist(), replies(kind, parts, every, where, values(kind, every, got, below)))

    return keyed.groupBy("part", "relay").cogroup(dealt(answers, "blk", relays).groupBy("part", "blk")).applyInArrow(back, MESSAGE), last


def tell(blocked: DataFrame, answers: DataFrame, to: Route, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """work(merged block, its answers) for each block."""

    def down(block: pa.Table, got: pa.Table) -> pa.Table:
        return work(merged(block), got)

    return blocked.groupBy("part", "blk").cogroup(dealt(answers, "blk", to.blocks).groupBy("part", "blk")).applyInArrow(down, schema)


def spread(results: DataFrame, docs: DataFrame, text: str, *columns: Column) -> DataFrame:
    """Results of distinct texts (k1, k2, ...) to every row of docs that has the text; columns of docs are kept."""
    rows = docs.select(*columns, *identity(text))
    return rows.join(results, ["k1", "k2"]).drop("k1", "k2")


#: Document frequencies of keys, by their first 40 bits, which order texts alike wherever they are read. The answer is
#: a class: 0 for one text, then eight steps for each doubling.
FREQUENCY = Count(lambda n: np.minimum(np.floor(8 * np.log2(np.maximum(n, 1))), 255).astype(np.uint8), np.uint8, 40)
#: Whether a key occurs twice or more.
SHARED = Count(lambda n: n > 1, bool)
