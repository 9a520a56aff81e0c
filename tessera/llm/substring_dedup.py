"""Removal of repeated substrings by matching statistics on suffix automata.

A word is removed if a run of `length` words that covers it starts anywhere else in
the corpus too. Runs are judged on the input.

Streaming every document through automata of the whole corpus would cost documents
times shards, and automata of the whole corpus can't be broadcast within a bound. So
the reference is sharded by content, and only that part of a document that can match
in a shard is sent there. Every run of `length` words has a seed: the least hash of
the runs of `SEED` words in it. Equal runs have equal seeds, at the same place. Seeds
are counted over the corpus; where a seed occurs once, no run over it is repeated.
Runs over shared seeds are counted again by their first and last words, so that of a
passage in many surroundings only the passage is left. Stretches of runs that may be
repeated go to their seed's shard, equal stretches of a block once. There the stretches of a seed are the reference: suffix automata over
bounded parts of them, whose states know how often they occur, are streamed over all
of them; the matching statistics tell which runs occur twice or more.

Words are unchanged; they are known by 48 bits of a hash, seeds by 64. Equal texts are
one text that occurs several times. Null or empty texts have no word; texts of fewer
than `length` words lose none.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import blocks as B
from tessera.llm import text as T

U = np.uint64
SEED = 8
#: Words in one automaton.
REFERENCE_WORDS = 40_000


def sliding(x: np.ndarray, size: int, least: bool) -> np.ndarray:
    """Minimum or maximum of each run of `size`."""
    f = np.minimum if least else np.maximum
    out, width = x, 1
    while width * 2 <= size:
        out = f(out[: len(out) - width], out[width:])
        width *= 2
    return f(out[: len(x) - size + 1], out[size - width : size - width + len(x) - size + 1]) if width < size else out


@dataclass
class Runs:
    words: np.ndarray  # hashes of all words of a block
    bounds: np.ndarray  # of its documents
    seed: np.ndarray  # of the run of words from each place
    ends: np.ndarray  # hash of its first and last words
    whole: np.ndarray  # whether that run lies in one document
    seeds: np.ndarray  # distinct seeds
    counts: np.ndarray  # occurrences of each, 2 for more


def look(block: pa.Table, length: int) -> Runs:
    """Slice by slice, so that what is made on the way stays small."""
    data, offsets = T.buffers(block.column("text"))
    copies = np.minimum(copies_of(block), 2)
    span = length - SEED + 1
    parts: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool))]
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for i, j in T.slices(offsets):
        part = data[offsets[i] : offsets[j]]
        starts, ends, bounds = T.words(part, offsets[i : j + 1] - offsets[i])
        words = T.hash_words(part, starts, ends)
        seed, both, whole = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64), np.zeros(len(words), bool)
        parts.append((words, np.diff(bounds), seed, both, whole))
        n = len(words) - length + 1
        if n <= 0:
            continue
        doc = T.owners(bounds)
        g = np.maximum(T.grams(words, SEED), U(1))
        seed[:n] = sliding(g, span, True)
        whole[:n] = doc[:n] == doc[length - 1 :]
        both[:n] = T.mix(seed[:n] + g[:n] * U(0x9FB21C651E98DF25) + g[span - 1 :] * U(0xD6E8FEB86659FD93))
        edge = np.zeros(span - 1, np.uint64)
        at = np.flatnonzero(sliding(np.concatenate([edge, np.where(whole[:n], seed[:n], U(0)), edge]), span, False) == g)
        keys, where = np.unique(T.mix(g[at]), return_inverse=True)
        found.append((keys, np.bincount(where, copies[i + doc[at]], len(keys)).astype(np.int64)))
        seed[:n] = T.mix(seed[:n])  # least hashes are small; mixed, they are spread over all shards
    words, n, seed, both, whole = (np.concatenate(x) for x in zip(*parts, strict=True))
    seeds, where = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    counts = np.minimum(np.bincount(where, np.concatenate([c for _, c in found]), len(seeds)), 2).astype(np.uint64)
    return Runs(words, np.cumsum(n), seed, both, whole, seeds, counts)


def copies_of(block: pa.Table) -> np.ndarray:
    return np.asarray(block.column("copies").combine_chunks())


def candidates(r: Runs, shared: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the runs over shared seeds: their places, their distinct ends, the number of each, and how often each occurs, 2 for more."""
    none = np.zeros(0, np.int64)
    if not len(r.seeds):
        return none, none.astype(np.uint64), none, none
    place = np.flatnonzero(r.whole & shared[np.minimum(np.searchsorted(r.seeds, r.seed), len(r.seeds) - 1)])
    keys, where = np.unique(r.ends[place], return_inverse=True)
    doc = np.searchsorted(r.bounds, place, "right") - 1
    return place, keys, where, np.minimum(np.bincount(where, np.minimum(copies[doc], 2), len(keys)), 2).astype(np.int64)


@dataclass
class Stretches:
    first: np.ndarray  # first run of each stretch
    last: np.ndarray
    kind: np.ndarray  # its number among the distinct ones
    of: np.ndarray  # a stretch of each kind; kinds are ordered by seed
    weight: np.ndarray  # how often each kind occurs, 2 for more


def stretches(r: Runs, on: np.ndarray, copies: np.ndarray, length: int) -> Stretches:
    """Maximal stretches of the chosen runs with the same seed within a document."""
    new, stop = on.copy(), on.copy()
    new[1:] &= ~on[:-1] | (r.seed[1:] != r.seed[:-1])
    stop[:-1] &= ~on[1:] | (r.seed[1:] != r.seed[:-1])
    first, last = np.flatnonzero(new), np.flatnonzero(stop)
    if not len(first):
        none = np.zeros(0, np.int64)
        return Stretches(none, none, none, none, none)
    # contents are told apart by a hash of their words
    sums = T.mix(r.words)
    sums *= T._powers(T._BASE, len(sums))
    np.cumsum(sums, out=sums)
    content = sums[last + length - 1] - np.where(first > 0, sums[first - 1], U(0))
    del sums
    content *= T._powers(pow(T._BASE, -1, 2**64), len(r.words))[first]
    content = T.mix(content) + (last - first).astype(np.uint64)
    order = np.lexsort((content, r.seed[first]))
    s, c = r.seed[first][order], content[order]
    fresh = np.append(True, (s[1:] != s[:-1]) | (c[1:] != c[:-1]))
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(fresh) - 1
    doc = np.searchsorted(r.bounds, first, "right") - 1
    weight = np.minimum(np.bincount(kind, np.minimum(copies[doc], 2)), 2).astype(np.int64)
    return Stretches(first, last, kind, order[fresh], weight)


def own(got: pa.Table) -> tuple[np.ndarray, pa.Table]:
    """What the block kept for itself, and the shards' answers."""
    mine = np.asarray(got.column("shard").combine_chunks()) < 0 if got.num_rows else np.zeros(0, bool)
    return np.frombuffer(B.bodies(got.filter(pa.array(mine)))[0], np.uint8), got.filter(pa.array(~mine))


class Automaton:
    """A suffix automaton of several sequences; each state knows how often its substrings occur, weighted."""

    def __init__(self, sequences: list[tuple[list[int], int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.count = [-1], [0], [0]
        for words, weight in sequences:
            last = 0
            for w in words:
                last = self.extend(last, w)
                self.count[last] += weight
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            self.count[self.link[s]] += self.count[s]

    def extend(self, last: int, w: int) -> int:
        nxt, link, size = self.next, self.link, self.size
        if (q := nxt[last].get(w)) is not None and size[q] == size[last] + 1:
            return q
        if q is None:
            new = self.state(size[last] + 1, {})
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = new
                p = link[p]
            if p < 0:
                link[new] = 0
                return new
            q = nxt[p][w]
            link[new] = q if size[q] == size[p] + 1 else self.clone(p, q, w)
            return new
        return self.clone(last, q, w)

    def state(self, size: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.link.append(0)
        self.size.append(size)
        self.count.append(0)
        return len(self.size) - 1

    def clone(self, p: int, q: int, w: int) -> int:
        c = self.state(self.size[p] + 1, dict(self.next[q]))
        self.link[c] = self.link[q]
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def occurrences(self, words: list[int], length: int) -> list[int]:
        """Of each run of `length` words, how often it occurs here."""
        nxt, link, size, out = self.next, self.link, self.size, []
        s = n = 0
        for i, w in enumerate(words):
            while s and w not in nxt[s]:
                s = link[s]
                n = size[s]
            if (q := nxt[s].get(w)) is not None:
                s, n = q, n + 1
            while size[link[s]] >= length if s else False:
                s = link[s]
            n = min(n, length)
            if i >= length - 1:
                out.append(self.count[s] if n == length else 0)
        return out


def repeated(contents: list[tuple[list[int], int]], length: int) -> list[np.ndarray]:
    """Of the distinct stretches over a seed, with their weights, which runs occur twice or more."""
    if len(contents) == 1 and contents[0][1] > 1:
        return [np.ones(len(contents[0][0]) - length + 1, bool)]
    counts = [np.zeros(len(words) - length + 1, np.int64) for words, _ in contents]
    i = 0
    while i < len(contents):
        j, total = i, 0
        while j < len(contents) and (j == i or total + len(contents[j][0]) <= REFERENCE_WORDS):
            total += len(contents[j][0])
            j += 1
        automaton = Automaton(contents[i:j])
        for k, (words, _) in enumerate(contents):
            counts[k] += automaton.occurrences(words, length)
        i = j
    return [c > 1 for c in counts]


class Repeated:
    """Entries are stretches: seeds, lengths, weights and all words; the answer is for each run of a stretch whether it occurs twice or more."""

    dtype = bool

    def __init__(self, length: int):
        self.length = length

    def write(self, e: B.Entries, a: int, z: int) -> bytes:
        seed, size, weight, words = e
        upto = np.append(0, np.cumsum(size))
        return B.pack_sorted(seed[a:z]) + B.pack(size[a:z]) + B.pack(weight[a:z]) + B.pack(words[upto[a] : upto[z]])

    def read(self, body: memoryview) -> B.Entries:
        seed, at = B.unpack_sorted(body)
        size, at = B.unpack(body, at)
        weight, at = B.unpack(body, at)
        return seed, size.astype(np.int64), weight.astype(np.int64), B.unpack(body, at)[0]

    def merge(self, parts: list[B.Entries]) -> tuple[B.Entries, np.ndarray]:
        """Side by side, in order of seeds."""
        seed, size, weight, words = map(np.concatenate, zip(*parts, strict=True))
        order = np.argsort(seed, kind="stable")
        where = np.empty(len(order), np.int64)
        where[order] = np.arange(len(order))
        begin = np.cumsum(size) - size
        size = size[order]
        pick = np.repeat(begin[order] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return (seed[order], size, weight[order], words[pick]), where

    def lengths(self, e: B.Entries) -> np.ndarray:
        return e[1] - self.length + 1

    def judge(self, e: B.Entries) -> np.ndarray:
        seed, size, weight, words = e
        upto, runs = np.append(0, np.cumsum(size)), np.append(0, np.cumsum(self.lengths(e)))
        flags = np.zeros(runs[-1], bool)
        for _, a, z in B.parted(seed):
            kinds: dict[bytes, list[int]] = {}
            for i in range(a, z):
                kinds.setdefault(words[upto[i] : upto[i + 1]].tobytes(), []).append(i)
            contents = [(np.frombuffer(c, np.uint64).tolist(), int(weight[m].sum())) for c, m in kinds.items()]
            for found, members in zip(repeated(contents, self.length), kinds.values(), strict=True):
                for i in members:
                    flags[runs[i] : runs[i + 1]] = found
        return flags


def covered(r: Runs, st: Stretches, flags: np.ndarray, length: int) -> np.ndarray:
    """Which words of a block lie in a repeated run. flags: of the runs of the distinct stretches."""
    change = np.zeros(len(r.words) + 1, np.int64)
    if len(st.of):
        at = np.append(0, np.cumsum((st.last - st.first + 1)[st.of]))
        n = st.last - st.first + 1
        place = np.repeat(st.first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        hit = place[flags[np.repeat(at[st.kind] - (np.cumsum(n) - n), n) + np.arange(n.sum())]]
        np.add.at(change, hit, 1)
        np.add.at(change, hit + length, -1)
    return np.cumsum(change)[:-1] > 0


def sent(r: Runs, st: Stretches, length: int) -> B.Entries:
    """The distinct stretches, with 48 bits of each word."""
    a, z = st.first[st.of], st.last[st.of] + length
    size = z - a
    pick = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return r.seed[a], size, st.weight, r.words[pick] >> U(16)


def deduplicate(docs: DataFrame, text: str = "text", length: int = 35, whole_texts: bool = False) -> DataFrame:
    """(k1, k2, n_words, n_removed, kept_sha256) of each distinct text; kept_text too if whole_texts."""
    if length <= SEED:
        raise ValueError(f"length must be above {SEED}")
    to, _ = B.sizes(docs, text, 2 * B.BLOCK_BYTES // 3)  # a block's runs take more room than other operators' keys
    blocked = B.blocks(docs.select(F.col(text).alias("text"), F.lit(0).alias("rep")), to.blocks)
    first, kind = to.shards(0), Repeated(length)

    def seeds_of(block: pa.Table) -> B.Entries:
        r = look(block, length)
        return r.seeds, r.counts

    seeds, _ = B.answered(B.asked(blocked, to, B.SHARED, seeds_of), to, B.SHARED)

    def packed(block: pa.Table, kept: np.ndarray, out: list[tuple[int, bytes]]) -> pa.Table:
        """Messages, and what the block keeps for itself."""
        blk = int(block.column("blk")[0].as_py())
        out = [(-1 - blk, np.packbits(kept).tobytes()), *out]
        return B.message([blk] * len(out), [s for s, _ in out], [b for _, b in out])

    def send_ends(block: pa.Table, got: pa.Table) -> pa.Table:
        r = look(block, length)
        shared = B.values(B.SHARED, (r.seeds, r.counts), got, first)
        _, keys, _, counts = candidates(r, shared, copies_of(block))
        return packed(block, shared, B.outgoing(B.SHARED, (keys, counts), first))

    ends, _ = B.answered(B.dealt(B.tell(blocked, seeds, to, send_ends, B.MESSAGE), "shard", first), to, B.SHARED)

    def send(block: pa.Table, got: pa.Table) -> pa.Table:
        r, copies = look(block, length), copies_of(block)
        bits, got = own(got)
        place, keys, where, counts = candidates(r, np.unpackbits(bits, count=len(r.seeds)).astype(bool), copies)
        on = np.zeros(len(r.seed), bool)
        on[place[B.values(B.SHARED, (keys, counts), got, first)[where]]] = True
        st = stretches(r, on, copies, length)
        return packed(block, on, B.outgoing(kind, sent(r, st, length), first) if len(st.of) else [])

    answers, _ = B.answered(B.dealt(B.tell(blocked, ends, to, send, B.MESSAGE), "shard", first), to, kind)

    def finish(block: pa.Table, got: pa.Table) -> pa.Table:
        r = look(block, length)
        bits, got = own(got)
        st = stretches(r, np.unpackbits(bits, count=len(r.seed)).astype(bool), copies_of(block), length)
        flags = B.values(kind, sent(r, st, length), got, first) if len(st.of) else np.zeros(0, bool)
        gone = covered(r, st, flags, length)
        digest, whole = [], []
        removed = np.add.reduceat(np.append(gone, False).astype(np.int64), r.bounds[:-1]) * (np.diff(r.bounds) > 0)
        for i, t in enumerate(x for c in block.column("text").chunks for x in c):
            words = t.as_buffer().to_pybytes().split()
            if removed[i]:
                words = compress(words, ~gone[r.bounds[i] : r.bounds[i + 1]])
            kept = b" ".join(words)
            digest.append(hashlib.sha256(kept).hexdigest())
            if whole_texts:
                whole.append(kept.decode())
        out = {"k1": block.column("k1"), "k2": block.column("k2"), "n_words": pa.array(np.diff(r.bounds)), "n_removed": pa.array(removed), "kept_sha256": pa.array(digest, pa.string())}
        return pa.table(out | ({"kept_text": pa.array(whole, pa.string())} if whole_texts else {}))

    return B.tell(blocked, answers, to, finish, "k1 long, k2 long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * whole_texts)


def remove(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row of docs."""
    return B.spread(deduplicate(docs, text, length), docs, text, F.col(doc_id))
