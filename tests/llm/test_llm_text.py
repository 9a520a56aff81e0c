import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import blocks as B
from tessera.llm import text as T


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x0c\r 中", max_size=30)), max_size=6))
def test_words(texts):
    data, offsets = T.buffers(pa.array(texts, pa.string()))
    starts, ends, bounds = T.words(data, offsets)
    got = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
    want = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    assert got == [w for ws in want for w in ws]
    assert np.diff(bounds).tolist() == [len(w) for w in want]
    hashes = T.hash_words(data, starts, ends)
    by = defaultdict(set)
    for w, h in zip(got, hashes.tolist(), strict=True):
        by[w].add(h)
    assert all(len(h) == 1 for h in by.values()) and len({h for s in by.values() for h in s}) == len(by)


def test_long_words_and_slices():
    texts = ["x" * (T._PIECE + 5), "a", "x" * (T._PIECE + 5) + "y b"]
    data, offsets = T.buffers(pa.array(texts))
    h = T.hash_words(data, *T.words(data, offsets)[:2])
    assert len(h) == 4 and len(set(h.tolist())) == 4
    assert list(T.slices(offsets, 10)) == [(0, 1), (1, 2), (2, 3)] and list(T.slices(np.zeros(1, np.int64))) == []


def test_shingles():
    texts = ["a b c d e f", "a b c d e f", "a b", "a b", "b a", "", None, "a b c d e a b c d e"]
    data, offsets = T.buffers(pa.array(texts))
    s, e, bounds = T.words(data, offsets)
    g, at = T.shingle_sets(T.hash_words(data, s, e), bounds, 5)
    sets = [frozenset(g[a:b].tolist()) for a, b in zip(at, at[1:], strict=False)]
    assert [len(x) for x in sets] == [2, 2, 1, 1, 1, 0, 0, 5]
    assert sets[0] == sets[1] and sets[2] == sets[3] != sets[4] and len(sets[7] & sets[0]) == 1


def test_pack():
    rng = random.Random(1)
    for top in (1, 200, 2**40, 2**64):
        x = np.array(sorted(rng.randrange(top) for _ in range(50)), np.uint64)
        b = B.pack_sorted(x) + B.pack(x[::-1])
        y, at = B.unpack_sorted(memoryview(b))
        z, end = B.unpack(memoryview(b), at)
        assert (y == x).all() and (z == x[::-1]).all() and end == len(b)
    assert not len(B.unpack(B.pack(np.zeros(0, np.uint64)))[0])


def test_messages_grow_with_the_input(spark, monkeypatch):
    """However many shards there are, a sender sends at most FAN rows; each level has about as many relays as there are blocks."""
    from tessera.llm.shared import ready

    ready(spark)
    monkeypatch.setattr(B, "FAN", 6)
    texts = [(" ".join(f"w{(7 * i + j) % 900}" for j in range(60)) if i % 3 else "hot " * 60, i) for i in range(240)]
    docs = spark.createDataFrame(texts, "text string, rep long").repartition(4)

    def words(block):
        data, offsets = T.buffers(block.column("text"))
        s, e, bounds = T.words(data, offsets)
        h = T.hash_words(data, s, e)
        return B.SHARED.entries(h)[0]

    for blocks, shards, levels in ((10, 5, 1), (24, 30, 2), (40, 200, 3)):
        to = B.route(blocks, shards)
        assert len(to.fans) == levels and shards <= to.shards() and max(to.fans) <= 6
        blocked = B.blocks(docs, blocks)
        assert blocked.groupBy("part").agg({"blk": "max"}).count() <= blocks
        messages = B.asked(blocked, to, B.SHARED, words)
        answers, last = B.answered(messages, to, B.SHARED)
        sent, got, back = messages.count(), last.count(), answers.count()
        assert sent <= blocks * 6 and back == sent and got <= 2 * blocks * 6
        # the hot word, which a third of the rows have 60 times each, is one entry of one message
        assert max(len(r["body"]) for r in messages.collect()) < 12 * 900

        def work(block, answers, first=to.shards(0)):
            e = words(block)
            return pa.table({"key": pa.array(e[0].view(np.int64)), "shared": pa.array(B.values(B.SHARED, e, answers, first))})

        found = {r["key"]: r["shared"] for r in B.tell(blocked, answers, to, work, "key long, shared boolean").collect()}
        assert len(found) == 901 and all(found.values())


def test_sets_and_keys_are_sorted_as_values(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 2, 4, 5, 9, 9, 60]))) for _ in range(300)]
    data, offsets = T.buffers(pa.array(texts))
    starts, ends, bounds = T.words(data, offsets)
    h = T.hash_words(data, starts, ends)
    keys = np.array([rng.randrange(200) for _ in range(5000)], np.uint64) << np.uint64(24)
    want, places, n = np.unique(keys, return_inverse=True, return_counts=True)
    unique = np.unique

    def plain(x, **options):
        assert not options.get("return_inverse"), "an order of indices costs several sorts of values"
        return unique(x, **options)

    with monkeypatch.context() as m:
        m.setattr(np, "unique", plain)
        m.setattr(np, "lexsort", None)
        g, at = T.shingle_sets(h, bounds, 5)
        (every, count), where = B.FREQUENCY.entries(keys)
        alone = B.FREQUENCY.counted(keys)
        (merged, total), _ = B.FREQUENCY.merge([(every, count), (every[:3], count[:3])])
    for i, text in enumerate(texts):
        w = text.split()
        runs = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
        own = g[at[i] : at[i + 1]].tolist()
        assert len(own) == len(runs) and own == sorted(set(own))
    assert len(at) == len(texts) + 1
    assert every.tolist() == want.tolist() == alone[0].tolist() and where.tolist() == places.tolist() and count.tolist() == n.tolist() == alone[1].tolist()
    assert merged.tolist() == want.tolist() and total[:4].tolist() == [2 * n[0], 2 * n[1], 2 * n[2], n[3]]
    # places that don't fit below the keys
    assert [x.tolist() for x in B.distinct(np.array([9, 7, 9], np.uint64), np.uint64(1))] == [[7, 9], [1, 0, 1]]
    assert [len(x) for x in T.shingle_sets(np.zeros(0, np.uint64), np.zeros(1, np.int64))] == [0, 1]
    x = np.array([3, 1, 2, 9, 8], np.uint64)
    T.sort_runs(x, np.array([0, 0, 3, 3, 5]))
    assert x.tolist() == [1, 2, 3, 8, 9]
    T.sort_runs(x[:0], np.zeros(1, np.int64))
