"""Benchmark decontamination by latent semantic retrieval.

Benchmark items become TF-IDF vectors over hashed words, weighted by document
frequencies counted over every document. A randomised SVD, whose products with the
item matrix are sums that Spark makes over the items, gives their latent space. (Passages of documents in
that matrix would change nothing: in any space that holds an item whole, its cosine with a window is the same; and a space that
doesn't would lose copies.)
Every document is then read in windows whose lengths double from the shortest item's
to the longest's, so that an item has one of at least half its length within it and one
of less than twice its length around it; a window's cosine with
an item is taken in that space against the window's full length, so that words
outside the items' vocabulary count against it. A bound is tested first: a window's
product with any item can't be larger than the sum, over its words, of the largest product that each
has with an item, which a running sum tells for all windows at once.

The windows of a document near an item are checked in full, the highest cosine first,
until one matches: the longest common subsequence of the item's words
and of the words around the window must cover `strong` of the item; between `weak`
and `strong` (a paraphrase) the item's answer must be there too, which is the
column `answer` if given and otherwise the item's last quarter.

Items are the stated query set. They are taken in blocks of about `block_items` items and `block_words` words, so
what workers return, at most SLICES matrices of words by items, and what is broadcast are bounded by these and by the number of buckets. The latent space of
a block has as many directions as the block has different items: it keeps each of them
whole, which is checked when it is made (`least_kept`). Null or empty texts match
nothing. An item of fewer than `least_words` words is too short for a cosine to tell: all
its words in sequence are a match, found exactly. One of fewer than `fewest_words` would
match common phrases and is left out. Repeated rows each give their matches; repeated items each match.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import text as T
from tessera.llm.toxicity import APART


#: Partial products with the item matrix that reach the driver at once.
SLICES = 4


def answered(answer: list[int], upto: list[int], around: list[int]) -> bool:
    """Whether the answer is there: without one, the last quarter of the item, of which `upto` are its prefixes' lengths."""
    if answer:
        return common(answer, around)[0] >= 0.75 * len(answer)
    tail = len(upto) // 4
    return upto[-1] - upto[len(upto) - tail - 1] >= 0.75 * tail


def falling(near: list[tuple[np.ndarray, ...]]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each document and item, its windows near the item in falling order: cosines, starts, ends."""
    if not near:
        return
    doc, item, cosine, start, end = (np.concatenate(c) for c in zip(*near, strict=True))
    order = np.lexsort((-cosine, item, doc))
    doc, item, cosine, start, end = (c[order] for c in (doc, item, cosine, start, end))
    cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(item) != 0)) + 1
    for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(doc)], strict=True):
        if z > a:
            yield int(doc[a]), int(item[a]), cosine[a:z], start[a:z], end[a:z]


def first_match(words: list[int], answer: list[int], h: np.ndarray, first: int, last: int, starts: np.ndarray, ends: np.ndarray, strong: float, weak: float) -> tuple[int, float, bool] | None:
    """The first window that matches the item, its overlap, and whether the answer is there.

    A window is passed over only if it can't match: each word that it has beyond one that failed adds no
    more than one to the common subsequence.
    """
    failed: list[tuple[int, int, int]] = []
    for k, (a, z) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        a, z = max(first, a - len(words)), min(last, z + len(words))
        if any(n + max(0, min(z, b) - a) + max(0, z - max(a, y)) < weak * len(words) for b, y, n in failed):
            continue
        around = h[a:z].tolist()
        size, upto = common(words, around)
        share = size / len(words)
        if share < weak:
            failed.append((a, z, size))
            continue
        got = answered(answer, upto, around)
        if share >= strong or got:
            return k, share, bool(got)
    return None


@dataclass
class Items:
    ids: list[int]
    words: list[list[int]]
    answers: list[list[int]]


def window_sizes(lengths: list[int]) -> list[tuple[int, int]]:
    """Lengths of windows for items of these lengths, and their strides."""
    out, size = [], min(lengths, default=0)
    while size and (not out or out[-1][0] < max(lengths)):
        out.append((size, max(1, size // 4)))
        size *= 2
    return out


def runs(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n words in a row."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        out = T.mix(out + h[k : k + len(out)])
    return out


def short_matches(short: Items, h: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(document, item, start) of the first place of each item's words in sequence in each document."""
    for n in sorted({len(w) for w in short.words}):
        some = [k for k, w in enumerate(short.words) if len(w) == n]
        own = np.array([runs(np.array(short.words[k], np.uint64), n)[0] for k in some])
        of: dict[int, list[int]] = {}
        for k, x in zip(some, own.tolist(), strict=True):
            of.setdefault(x, []).append(k)
        got = runs(h, n)
        at = np.flatnonzero(np.isin(got, own))
        doc = np.searchsorted(bounds, at, "right") - 1
        inside = at + n <= bounds[doc + 1]
        seen = set()
        for start, d in zip(at[inside].tolist(), doc[inside].tolist(), strict=True):
            for k in of[int(got[start])]:
                if (d, k) not in seen:
                    seen.add((d, k))
                    yield d, k, start


def terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Of each slice of rows: first, last, hashes of lower-case words without punctuation, bounds."""
    data, offsets = T.buffers(column)
    for i, j in T.slices(offsets):
        part = T.lower(data[offsets[i] : offsets[j]])
        starts, ends, bounds = T.words(part, offsets[i : j + 1] - offsets[i], APART)
        yield i, j, T.hash_words(part, starts, ends), bounds


def bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def frequencies(docs: DataFrame, bits: int, text: str = "text") -> tuple[int, np.ndarray]:
    """Documents, and those that have a word of each bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << bits, np.int64), 0
        for b in batches:
            n += b.num_rows
            for _, _, h, bounds in terms(b.column(0)):
                kind = np.uint32 if len(bounds) <= 1 << (32 - bits) else np.int64  # half as wide is sorted twice as fast
                key = (T.owners(bounds).astype(kind) << kind(bits)) | bucket(h, bits).astype(kind)
                key.sort()
                key = key[np.append(np.ones(min(1, len(key)), bool), key[1:] != key[:-1])] & kind((1 << bits) - 1)
                total += np.bincount(key, minlength=1 << bits)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], names=["bucket", "n"])

    rows = docs.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    at, n = np.asarray(rows.column("bucket").combine_chunks()), np.asarray(rows.column("n").combine_chunks())
    out = np.zeros(1 << bits, np.int64)
    out[at[at >= 0]] = n[at >= 0]
    return int(n[at < 0].sum()), out


def singular(items: DataFrame, text: str, idf: np.ndarray, bits: int, rank: int, passes: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that items have, and a basis of at most `rank` directions over them, by randomised SVD.

    Each product with the item matrix A is AᵀAQ, a sum over items of outer products; workers
    return it for the buckets of their items.
    """
    def vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _, _, h, bounds in terms(column):
            key = bucket(h, bits)
            for a, b in zip(bounds, bounds[1:], strict=False):
                at, n = np.unique(key[a:b], return_counts=True)
                if len(at):
                    x = n * idf[at]
                    yield at, x / np.sqrt(x @ x)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([pa.array(np.unique(np.concatenate([np.zeros(0, np.int64), *(at for at, _ in vectors(b.column(0)))])), pa.int64())], names=["bucket"])

    texts = items.select(text)
    used = np.array(sorted(r[0] for r in texts.mapInArrow(named, "bucket long").distinct().collect()), np.int64)
    if not len(used):
        return used, np.zeros((0, 0), np.float32)
    rank = min(rank, len(used))
    q = np.linalg.qr(np.random.default_rng(11).standard_normal((len(used), min(len(used), rank + 8))))[0]
    for _ in range(passes):
        now = q

        def product(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            total = np.zeros(now.shape, np.float32)
            for b in batches:
                for at, x in vectors(b.column(0)):
                    i = np.searchsorted(used, at)
                    total[i] += np.outer(x, x @ now[i])
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["part"])

        parts = texts.coalesce(SLICES).mapInArrow(product, "part binary").collect()
        q = np.linalg.qr(sum(np.frombuffer(r[0], np.float32).reshape(now.shape).astype(float) for r in parts))[0]

    def small(batches: Iterator[pa.RecordBatch], now: np.ndarray = q) -> Iterator[pa.RecordBatch]:
        total = np.zeros((now.shape[1],) * 2)
        for b in batches:
            for at, x in vectors(b.column(0)):
                y = x @ now[np.searchsorted(used, at)]
                total += np.outer(y, y)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["part"])

    gram = sum(np.frombuffer(r[0]).reshape((q.shape[1],) * 2) for r in texts.coalesce(SLICES).mapInArrow(small, "part binary").collect())
    value, turn = np.linalg.eigh(gram)
    keep = np.argsort(-value)[:rank]
    keep = keep[value[keep] > 1e-9 * max(value.max(), 1e-300)]
    return used, (q @ turn[:, keep]).astype(np.float32)


def common(a: list[int], b: list[int]) -> tuple[int, list[int]]:
    """Length of the longest common subsequence, and that of b with each prefix of a."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        if hit := where.get(x):
            u = row & hit
            row = ((row + u) | (row - u)) & full
    zeros = ~row & full
    out, n = [], 0
    for i in range(len(a)):
        n += zeros >> i & 1
        out.append(n)
    return n, out


def squares(key: np.ndarray, weight: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int, most: int = 1 << 20) -> np.ndarray:
    """The squared length of each window's vector, in which a repeated word's weights are added; of windows of about `most` words at a time."""
    upto = np.append(0, np.cumsum(ends - starts))
    out = np.zeros(len(starts))
    k = 0
    while k < len(starts):
        z = max(k + 1, int(np.searchsorted(upto, upto[k] + most, "right")) - 1)
        n = np.diff(upto[k : z + 1])
        both = (np.repeat(np.arange(z - k), n) << bits) | key[np.arange(upto[k], upto[z]) + np.repeat(starts[k:z] - upto[k:z], n)]
        both.sort()
        at = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        x = np.diff(np.append(at, len(both))) * weight[both[at] & ((1 << bits) - 1)]
        out[k:z] = np.bincount(both[at] >> bits, x**2, z - k)
        k = z
    return out


def possible(known: np.ndarray, largest: np.ndarray, key: np.ndarray, weight: np.ndarray, bounds: np.ndarray, sizes: list[tuple[int, int]], bits: int, least_cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each size, the windows that may be near an item: starts, ends, documents, squared lengths.

    largest: of each word of the items, its largest product with one, 0 at least. No item's sum over a window's words is larger than
    that of these; a thousandth is left for rounding. Repeated words make a window longer, which is counted for those left only.
    """
    sums, mass = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    np.cumsum(np.append(largest, 0)[known], out=sums[1:])  # words of no item are -1
    np.cumsum(weight[key] ** 2, out=mass[1:])
    for size, stride in sizes:
        s, e, doc = window_starts(bounds, size, stride)
        reach = ((sums[e] - sums[s]) / (0.999 * least_cosine)) ** 2
        pick = np.flatnonzero(reach >= mass[e] - mass[s])
        length = squares(key, weight, s[pick], e[pick], bits)
        left = reach[pick] >= length
        pick = pick[left]
        yield s[pick], e[pick], doc[pick], length[left]


def latent(known: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: np.ndarray, most: int = 1 << 12) -> Iterator[tuple[int, np.ndarray]]:
    """Of windows in ascending order, bunch by bunch: the first window's number, and their cosines with all items. length: squared.

    rows: for each item, the products of its latent vector with every word's. As products are linear, running sums over words give those
    of all windows over them.
    """
    change = np.zeros(len(known) + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    at = np.flatnonzero((np.cumsum(change)[:-1] > 0) & (known >= 0))
    first, last = np.searchsorted(at, starts), np.searchsorted(at, ends)
    k = 0
    while k < len(starts):
        z = max(k + 1, min(k + 4096, int(np.searchsorted(last, first[k] + most, "right"))))
        a, b = int(first[k]), int(last[z - 1])
        sums = np.zeros((rows.shape[0], b - a + 1), np.float32)
        np.cumsum(np.take(rows, known[at[a:b]], axis=1), axis=1, out=sums[:, 1:])  # along memory: several times as fast as across it
        v = np.take(sums, last[k:z] - a, axis=1)
        v -= np.take(sums, first[k:z] - a, axis=1)
        v /= np.sqrt(np.maximum(length[k:z], 1e-9)).astype(np.float32)
        yield k, v.T
        k = z


def window_starts(bounds: np.ndarray, size: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all windows of the documents, and their documents."""
    n = np.diff(bounds)
    some = np.flatnonzero(n > 0)
    more = -(-np.maximum(n[some] - size, 0) // stride) + 1
    doc = np.repeat(some, more)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(more) - more, more)
    start = bounds[doc] + np.minimum(k * stride, np.maximum(n[doc] - size, 0))
    return start, np.minimum(start + size, bounds[doc + 1]), doc


def matchers(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", answer: str | None = None, least_cosine: float = 0.55, strong: float = 0.75, weak: float = 0.5, least_words: int = 8, fewest_words: int = 3, bits: int = 17, block_items: int = 256, block_words: int = 1 << 14, least_kept: float = 0.99):
    """For each block of items, a function from texts to (row, item_id, cosine, overlap, answered) of each match."""
    n, df = frequencies(docs, bits, text)
    idf = np.log((1 + n) / (1 + df)) + 1
    columns = [F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("t"), (F.col(answer) if answer else F.lit(None)).cast("string").alias("a")]
    items = benchmark.select(*columns).filter(F.length("t") > 0)
    many, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(F.split("t", "\\s+"))), F.lit(0))).first()
    items = items.withColumn("part", F.pmod(F.xxhash64("t", "item_id"), F.lit(max(1, -(-many // block_items), -(-size // block_words)))))
    for part in sorted(r[0] for r in items.select("part").distinct().collect()):
        yield _matcher(docs, items.filter(F.col("part") == part), idf, bits, least_kept, least_cosine, strong, weak, least_words, fewest_words)


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", ids: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """ids, item_id, cosine, overlap (share of the item's words in sequence) and answered, for each match. options: of matchers()."""
    source = docs.select(*ids, F.col(text).alias("__text"))
    schema = source.drop("__text").schema.add("item_id", "long").add("cosine", "double").add("overlap", "double").add("answered", "boolean")
    out = docs.sparkSession.createDataFrame([], schema)
    for k, matcher in enumerate(matchers(docs, benchmark, text, **options)):

        def work(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = matcher(b.column("__text"))
                at = pa.array([f[0] for f in found], pa.int64())
                yield pa.record_batch([*(b.column(c).take(at) for c in ids), pa.array([f[1] for f in found], pa.int64()), pa.array([round(f[2], 6) for f in found], pa.float64()), pa.array([f[3] for f in found], pa.float64()), pa.array([f[4] for f in found], pa.bool_())], names=[*ids, "item_id", "cosine", "overlap", "answered"])

        one = source.mapInArrow(work, schema)
        out = out.unionByName(one) if k else one
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """docs without the rows that match an item."""
    for matcher in list(matchers(docs, benchmark, text, **options)):

        def work(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for b in batches:
                stays = np.ones(b.num_rows, bool)
                stays[[f[0] for f in matcher(b.column(text))]] = False
                yield b.filter(pa.array(stays))

        docs = docs.mapInArrow(work, docs.schema)
    return docs


def _matcher(docs: DataFrame, items: DataFrame, idf: np.ndarray, bits: int, least_kept: float, least_cosine: float, strong: float, weak: float, least_words: int, fewest_words: int):
    rows = items.orderBy("item_id", "t").collect()
    used, basis = singular(items, "t", idf, bits, len({r["t"] for r in rows}))
    stated, short = Items([], [], []), Items([], [], [])
    vectors = []
    for r in rows:
        (_, _, h, _), *_ = terms(pa.array([r["t"]]))
        if len(h) < fewest_words:
            continue
        to = short if len(h) < least_words else stated
        to.ids.append(r["item_id"])
        to.words.append(h.tolist())
        to.answers.append(next(terms(pa.array([r["a"]])))[2].tolist() if r["a"] else [])
        if to is short:
            continue
        at, k = np.unique(bucket(h, bits), return_counts=True)
        x = k * idf[at] @ basis[np.searchsorted(used, at)]
        if np.sqrt(x @ x) < least_kept * np.linalg.norm(k * idf[at]):
            raise RuntimeError(f"the latent space loses item {r['item_id']}")
        vectors.append(x / max(np.sqrt(x @ x), 1e-12))
    matrix = np.array(vectors, np.float32).reshape(len(vectors), basis.shape[1])
    at_row = np.full(1 << bits, -1, np.int32)
    at_row[used] = np.arange(len(used))
    table = spark_broadcast(docs, (idf, at_row, np.ascontiguousarray(matrix @ (basis * idf[used, None].astype(np.float32)).T), stated, short, window_sizes([len(w) for w in stated.words])))

    def matches(texts: pa.Array) -> list[tuple[int, int, float, float, bool]]:
        weight, row_of, rows_, stated, short, sizes = table.value
        largest = rows_.max(axis=0, initial=0)
        found: list[tuple[int, int, float, float, bool]] = []
        for i, _, h, bounds in terms(texts):
            key = bucket(h, bits)
            known = row_of[key]
            near_: list[tuple[np.ndarray, ...]] = []
            for s, e, doc, length in possible(known, largest, key, weight, bounds, sizes, bits, least_cosine):
                for p, cosine in latent(known, rows_, s, e, length):
                    m, item = np.nonzero(cosine >= least_cosine)
                    near_.append((doc[p + m], item, cosine[m, item], s[p + m], e[p + m]))
            for d, item, cosine_, a, z in falling(near_):
                words = stated.words[item]
                if hit := first_match(words, stated.answers[item], h, int(bounds[d]), int(bounds[d + 1]), a, z, strong, weak):
                    found.append((i + d, stated.ids[item], float(cosine_[hit[0]]), hit[1], hit[2]))
            for d, item, a in short_matches(short, h, bounds):
                n = len(short.words[item])
                got = not short.answers[item] or answered(short.answers[item], [], h[max(bounds[d], a - n) : min(bounds[d + 1], a + 2 * n)].tolist())
                found.append((i + d, short.ids[item], 1.0, 1.0, bool(got)))
        found.sort()
        return found

    return matches


def spark_broadcast(docs: DataFrame, value: tuple):
    """Bounded by the number of buckets and the items of a block."""
    return docs.sparkSession.sparkContext.broadcast(value)
