"""Language-model scores from a weighted backoff automaton.

A state is a context, the last words read, up to `order` - 1 of them, the begin of a text
counted as one; the root is the empty context. A state h that training has met C(h) times has an arc for each word
w that followed it there, weighted with

    p(w | h) = (c(h w) + a p(w | h')) / (C(h) + a),

where h' is the context without its first word, and a failure arc to h', weighted with
a / (C(h) + a): a word without an arc is read there. So a context that was seen once trusts its
only follower little, one that was seen often trusts its counts. The number a of a length of contexts is the mean number of
words that followed a state exactly once. The root has an arc for every known word, (c + 1) / (N + V + 1), and one for unknown words.

A text is read once from left to right. The state is carried along: the longest context
that training has met. Each word takes its arc, or failure arcs until there is one;
weights multiply, so log probabilities add up. As a state is a function of the last words, those of all
places of a block are known at once, and the walk goes over arrays instead of words.

The automaton of a large corpus fits no single machine, so nobody holds it. Its arcs (whose counts are also the states', as a
state is what an arc of a shorter context read) are dealt into shards by their hashes, each arc by itself, so
that the arcs of a frequent word don't meet in one task; a block of texts asks for
the part of the automaton that its own texts can reach, once for each arc
however often it occurs, and walks its texts through it.
All counts are over all training texts, merged copies counted as often as they
occur; no n-gram is dropped. Arcs are known by as many bits of a hash as tell them apart but for a
share of one in some millions (20 more than the corpus' bytes need, at least 50; 62 at most).

Tokens are lower-case (A-Z) words and one end for each text. A null or empty text
is its end alone. An unknown word has the probability 1 / (N + V + 1) at the root.
Without training texts every token is unknown. Rows with a null id are training
rows if `held_out` is null for them. Repeated rows each get their score; an empty table gives no row. Of docs only the columns named are read,
so that others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import blocks as B
from tessera.llm import text as T

U = np.uint64
BEGIN, END = U(0x1B873593CC9E2D51), U(0x85EBCA6B2C1B3C6D)
#: The last bits of a key are the number of words of its context.
LENGTH_BITS = U(2)


def keyed(grams: np.ndarray, length: int, bits: int) -> np.ndarray:
    """Keys of arcs from contexts of `length` words: so many bits, the first of 64."""
    low = U(64 - bits)
    return ((grams >> (low + LENGTH_BITS)) << LENGTH_BITS | U(length)) << low


def counts_of(bits: int) -> B.Count:
    return B.Count(lambda n: n.astype(np.uint64), np.uint64, bits)


@dataclass
class Walks:
    """A block's tokens and its distinct arcs; the begin of a text is a token that is only a context."""

    doc: np.ndarray  # document of each token
    first: np.ndarray  # whether it is the begin
    arc: list[np.ndarray]  # by length of context, the arc over each token: its number among the entries, -1 where the text is too short
    entries: B.Entries  # keys of the arcs, and their training occurrences here


def walks(block: pa.Table, order: int, bits: int) -> Walks:
    data, offsets = T.buffers(block.column("text"))
    hashes, counts = [], []
    for i, j in T.slices(offsets):
        part = T.LOWER[data[offsets[i] : offsets[j]]]
        starts, ends, bounds = T.words(part, offsets[i : j + 1] - offsets[i])
        hashes.append(T.hash_words(part, starts, ends))
        counts.append(np.diff(bounds))
    h, n = np.concatenate(hashes), np.concatenate(counts)
    kind = counts_of(bits)
    doc = np.repeat(np.arange(len(n), dtype=np.int32), n + 2)
    last = np.cumsum(n + 2) - 1
    token = np.empty(len(doc), np.uint64)
    inner = np.ones(len(doc), bool)
    inner[last] = inner[last - n - 1] = False
    token[inner] = h
    token[last], token[last - n - 1] = END, BEGIN
    place = (np.arange(len(doc)) - np.repeat(last - n - 1, n + 2)).astype(np.int32)
    del h, hashes, inner
    trained = np.asarray(block.column("trained").combine_chunks()).astype(np.float32)[doc]
    gram, keys, at, many = T.mix(token), [], [], []
    for length in range(order):
        if length:
            gram[1:] = T.mix(gram[:-1] * U(0x9FB21C651E98DF25) + token[1:])
        some = place >= length
        (key, n_), where = kind.entries(keyed(gram[some], length, bits), trained[some])
        number = np.full(len(doc), -1, np.int32)
        number[some] = where
        del where
        keys.append(key)
        many.append(n_)
        at.append(number)
    every = np.concatenate(keys)
    by = np.argsort(every, kind="stable")
    rank = np.empty(len(by), np.int32)
    rank[by] = np.arange(len(by), dtype=np.int32)
    begin = 0
    for length in range(order):
        at[length] = np.where(at[length] >= 0, rank[begin + at[length]], np.int32(-1))
        begin += len(keys[length])
    return Walks(doc, place == 0, at, (every[by], np.concatenate(many)[by]))


def sizes_of(got: pa.Table, bits: int) -> pa.Table:
    """Of a shard's arcs of each length of context: occurrences, arcs, arcs that occur once. The begin is no word."""
    kind = counts_of(bits)
    keys, n = kind.merge([kind.read(b) for b in B.bodies(got)])[0]
    size = 1 << int(LENGTH_BITS)
    length = (keys >> kind.low & U(size - 1)).astype(int)
    n = np.where(keys == keyed(T.mix(np.array([BEGIN])), 0, bits)[0], 0, n).astype(np.int64)
    return pa.table({"length": pa.array(range(size), pa.int32()), "total": pa.array(np.bincount(length, n, size).astype(np.int64)), "arcs": pa.array(np.bincount(length, n > 0, size).astype(np.int64)), "single": pa.array(np.bincount(length, n == 1, size).astype(np.int64))})


def walk(block: pa.Table, got: pa.Table, to: B.Route, order: int, bits: int) -> pa.Table:
    w = walks(block, order, bits)
    sizes = {r["length"]: r for r in got.column("sizes")[0].as_py()} if got.num_rows else {}
    total, arcs, single = ([sizes.get(k, {}).get(c) or 0 for k in range(order)] for c in ("total", "arcs", "single"))
    count = B.values(counts_of(bits), w.entries, got, to.shards(0)).astype(np.float64)
    of = lambda length: np.where(w.arc[length] >= 0, count[w.arc[length]], 0.0)
    root = (of(0) + 1) / (total[0] + arcs[0] + 1)
    p = root
    for length in range(1, order):
        a = max(single[length], 1) / max(arcs[length - 1], 1)
        # the state in which a token is read: what the arc over the token before it read
        met = np.append(0.0, of(length - 1)[:-1])
        p = np.where((w.arc[length] >= 0) & (met > 0), (of(length) + a * p) / (met + a), p)
    real = ~w.first
    n, doc = block.num_rows, w.doc[real]
    return pa.table(
        {
            "k1": block.column("k1"),
            "k2": block.column("k2"),
            "n_tokens": pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
            "n_known": pa.array(np.bincount(doc, of(0)[real] > 0, n).astype(np.int64)),
            "train_tokens": pa.array(np.full(n, total[0], np.int64)),
            "base_score": pa.array(np.bincount(doc, np.log10(root[real]), n)),
            "score": pa.array(np.bincount(doc, np.log10(p[real]), n)),
        }
    )


def score(docs: DataFrame, held_out: Column, text: str = "text", doc_id: str = "doc_id", order: int = 3) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of docs. order: 1 to 4."""
    if not 1 <= order <= 1 << int(LENGTH_BITS):
        raise ValueError("order must be from 1 to 4")
    out = F.coalesce(held_out, F.lit(False))
    to, total = B.sizes(docs, text, B.BLOCK_BYTES // 2, order)  # a word has an arc of each order
    bits = min(64, max(52, total.bit_length() + 22))
    kind = counts_of(bits)
    blocked = B.blocks(docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("rep"), (~out).cast("long").alias("trained")), to.blocks)
    messages = B.asked(blocked, to, kind, lambda block: walks(block, order, bits).entries)
    answers, last = B.answered(messages, to, kind)
    sums = last.groupBy("part", "shard").applyInArrow(lambda got: sizes_of(got, bits), "length int, total long, arcs long, single long").groupBy("length").agg(*[F.sum(c).alias(c) for c in ("total", "arcs", "single")])
    # a row for each length of context, as one value
    size = sums.agg(F.collect_list(F.struct("*")).alias("sizes")).withColumn("one", F.lit(1))
    answers = answers.withColumn("one", F.lit(1)).join(F.broadcast(size), "one").drop("one")
    scored = B.tell(blocked, answers, to, lambda block, got: walk(block, got, to, order, bits), "k1 long, k2 long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return B.spread(scored, docs, text, F.col(doc_id), out.alias("held_out"))
