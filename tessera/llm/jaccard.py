"""Exact Jaccard joins of texts' word shingles, rarest first.

A text's set is its distinct k-word shingles (a shorter text's whole sequence is its
only one). Shingles are ordered by how many texts have them, rarest first, ties by
hash; the frequencies are counted over all texts. Two texts with a Jaccard
similarity of t must share one of the first n - ceil(t n) + 1 shingles of each
(prefix filter). Most texts have enough shingles of their own to be done here.

Texts left whose prefixes share a shingle, directly or in steps, form a cluster; the
pairs of a cluster are the only ones that can be similar. A cluster is joined in one
task, or, if it is large, in tasks of two of its blocks each. Within a task texts
are met in order of size (or age), candidates come from an index of prefixes, and length,
positional and suffix filters let few through to be verified, each pair once.
Where classes are wanted, candidates already known to be in one class are skipped:
that loses no class and spares the pairs within a large group.

Words are lower-case (A-Z). Null or empty texts have an empty set and match nothing.
Equal texts are one text with several rows. Shingles are known by 56 bits of a hash
and their frequency.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import blocks as B
from tessera.llm import text as T
from tessera.llm.graph import Union, components
from tessera.llm.shared import cut

U = np.uint64
#: Texts of a cluster that one task joins, and shingle bytes in a task.
CLUSTER_TEXTS, TASK_BYTES = 4096, 12 << 20
#: Rows of cluster numbers that may be broadcast.
BROADCAST_ROWS = 200_000


def sets(block: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = T.buffers(block.column("text"))
    found, counts = [], [np.zeros(1, np.int64)]
    for i, j in T.slices(offsets):
        part = T.lower(data[offsets[i] : offsets[j]])
        starts, ends, bounds = T.words(part, offsets[i : j + 1] - offsets[i])
        g, at = T.shingle_sets(T.hash_words(part, starts, ends), bounds, k)
        found.append(g)
        counts.append(np.diff(at))
    return np.concatenate([np.zeros(0, np.uint64), *found]), np.cumsum(np.concatenate(counts))


def need(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Least overlap of a set of n with any that is similar."""
    return -(-percent * n // 100)


def pair_need(a: int, b: int, percent: int) -> int:
    return -(-percent * (a + b) // (100 + percent))


def rarest_first(docs_blocks: DataFrame, to: B.Route, k: int, percent: int) -> DataFrame:
    """(k1, k2, rep, sub, tag, copies, n, rare, body) of each distinct text: its set's size, its number of shingles that no other
    text has, and, if a similar text is possible, its other shingles in order (else null)."""

    def ask(block: pa.Table) -> B.Entries:
        return B.FREQUENCY.counted(sets(block, k)[0])

    def work(block: pa.Table, got: pa.Table) -> pa.Table:
        g, at = sets(block, k)
        asked, where = B.FREQUENCY.entries(g)
        rank = B.values(B.FREQUENCY, asked, got, to.shards(0))[where]
        n = np.diff(at)
        rare = np.diff(np.append(0, np.cumsum(rank == 0))[at])
        some = (n > 0) & (n - need(n, percent) + 1 > rare)
        left = np.repeat(some, n) & (rank > 0)
        token = (rank[left].astype(np.uint64) << U(56)) | (g[left] >> U(8))
        ends = np.append(0, np.cumsum(np.where(some, n - rare, 0)))
        T.sort_runs(token, ends)
        body = [B.pack_sorted(token[ends[i] : ends[i + 1]]) if some[i] else None for i in range(len(n))]
        return pa.table({**{c: block.column(c) for c in ("k1", "k2", "rep", "sub", "tag", "copies")}, "n": pa.array(n), "rare": pa.array(rare), "body": pa.array(body, pa.binary())})

    answers, _ = B.answered(B.asked(docs_blocks, to, B.FREQUENCY, ask), to, B.FREQUENCY)
    return B.tell(docs_blocks, answers, to, work, "k1 long, k2 long, rep long, sub long, tag long, copies long, n long, rare long, body binary")


def prefix(n: int, rare: int, percent: int) -> int:
    """Length of the prefix among the shingles that others have too."""
    return n - need(n, percent) + 1 - rare


def star(token: np.ndarray, node: np.ndarray) -> tuple[Union, np.ndarray, np.ndarray]:
    """Classes of the nodes that share tokens, and the distinct (token, root) left."""
    order = np.lexsort((node, token))
    token, node = token[order], node[order]
    first = np.append(True, token[1:] != token[:-1])
    lead = node[np.maximum.accumulate(np.where(first, np.arange(len(node)), 0))]
    union = Union()
    if len(node):
        for a, b in np.unique(np.stack([lead[~first], node[~first]]), axis=1).T.tolist():
            union.join(a, b)
    every, at = np.unique(node, return_inverse=True)
    root = np.array([union.find(x) for x in every.tolist()], np.int64)[at] if len(every) else node
    pair = np.append(True, (token[1:] != token[:-1]) | (root[1:] != root[:-1])) if len(token) else np.zeros(0, bool)
    return union, token[pair], root[pair]


def clusters(left: DataFrame, percent: int) -> DataFrame:
    """(node, comp) of the texts left whose prefixes share shingles."""
    total = left.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // (4 * B.SHARD_KEYS)))

    def gather(batches):
        for b in batches:
            tokens, nodes = [], []
            for k1, n, rare, body in zip(*(b.column(c).to_pylist() for c in ("k1", "n", "rare", "body")), strict=True):
                t = B.unpack_sorted(body)[0][: prefix(n, rare, percent)]
                tokens.append(t)
                nodes.append(np.full(len(t), k1, np.int64))
            if not tokens:
                continue
            union, token, root = star(np.concatenate(tokens), np.concatenate(nodes))
            a = list(union)
            out = [(-1, np.array([a, [union.find(x) for x in a]], np.int64).tobytes())] if a else []
            token_shard = B.shard_of(T.mix(token), shards)
            order = np.argsort(token_shard, kind="stable")
            # never more rows than tokens, however many shards there are
            for s, x, z in B.parted(token_shard[order]):
                out.append((s, token[order[x:z]].tobytes() + root[order[x:z]].tobytes()))
            yield pa.record_batch([pa.array([x for x, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["shard", "body"])

    def meet(got: pa.Table) -> pa.Table:
        parts = B.bodies(got)
        if got.column("shard")[0].as_py() < 0:
            pairs = np.concatenate([np.frombuffer(p, np.int64).reshape(2, -1) for p in parts], axis=1)
        else:
            token = np.concatenate([np.frombuffer(p, np.uint64, len(p) // 16) for p in parts])
            node = np.concatenate([np.frombuffer(p, np.int64, len(p) // 16, len(p) // 2) for p in parts])
            union, _, _ = star(token, node)
            a = list(union)
            pairs = np.array([a, [union.find(x) for x in a]], np.int64).reshape(2, -1)
        return pa.table({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})

    # the pairs found within a batch need no meeting: any task may pass them on
    messages = left.select("k1", "n", "rare", "body").mapInArrow(gather, "shard int, body binary").withColumn("deal", F.when(F.col("shard") < 0, F.pmod(F.xxhash64("body"), F.lit(max(64, shards)))).otherwise(0))
    edges = messages.groupBy("shard", "deal").applyInArrow(meet, "a long, b long")
    return components(edges)


def verify(a: np.ndarray, b: np.ndarray) -> int:
    c = np.concatenate((a, b))
    c.sort()
    return int((c[1:] == c[:-1]).sum())


def suffix_bound(a: list[int], b: list[int], a0: int, b0: int, depth: int = 2) -> int:
    """At most so many of a[a0:] and b[b0:] are common, by where the middle of one falls in the other."""

    def bound(al: int, ar: int, bl: int, br: int, depth: int) -> int:
        if not depth or ar - al < 8 or br - bl < 8:
            return min(ar - al, br - bl)
        am = (al + ar) // 2
        bm = bisect_left(b, a[am], bl, br)
        same = bm < br and b[bm] == a[am]
        return bound(al, am, bl, bm, depth - 1) + same + bound(am + 1, ar, bm + same, br, depth - 1)

    return bound(a0, len(a), b0, len(b), depth)


def join_cluster(rows: list[tuple], percent: int, classes: bool) -> tuple[Union, set[int]]:
    """rows: (n, rare, tokens, order, side, known class). Similar rows' classes, or the rows that match one of lower order.

    side: rows of one side that isn't negative were joined elsewhere.
    """
    union, late = Union(), set()
    known: dict[int, int] = {}
    for i, r in enumerate(rows):
        if r[5] is not None:
            union.join(known.setdefault(r[5], i), i)
    index: dict[int, dict[int, list[tuple[int, int]]]] = {}
    lists = [r[2].tolist() for r in rows]
    for x in sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][3]) if classes else rows[i][3]):
        n, rare, tokens, _, side, _ = rows[x]
        own, seen = lists[x], set()
        least = need(n, percent)
        upto = min(prefix(n, rare, percent), len(own))
        for p in range(upto):
            groups = index.get(own[p])
            if not groups or x in late:
                continue
            if classes and len(groups) > 1 and any(union.find(r) != r for r in groups):
                fresh: dict[int, list[tuple[int, int]]] = {}
                for r, members in groups.items():
                    fresh.setdefault(union.find(r), []).extend(members)
                groups = index[own[p]] = fresh
            for root, members in list(groups.items()):
                for y, q in members:
                    if x in late or classes and union.find(root) == union.find(x):
                        break
                    m, _, tokens_y, _, side_y, _ = rows[y]
                    if m < least or n < need(m, percent) or y in seen or side >= 0 and side == side_y:
                        continue
                    seen.add(y)
                    must = pair_need(n, m, percent)
                    if min(len(own) - p, len(lists[y]) - q) < must or suffix_bound(own, lists[y], p, q) < must or verify(tokens, tokens_y) < must:
                        continue
                    if classes:
                        union.join(x, y)
                    else:
                        late.add(x)
        for p in range(upto):
            index.setdefault(own[p], {}).setdefault(union.find(x) if classes else 0, []).append((x, p))
    return union, late


def join(sets_: DataFrame, percent: int, classes: bool) -> DataFrame:
    """Of texts that may have a similar one: the first of its class; without classes, those texts that match an earlier one.

    sets_: rarest_first's rows, cut. Columns: k1, k2, lead_rep, lead_sub, lead, lead2 (its k1 and k2); or k1 and k2 alone.
    Clusters are found by k1 (another text with the same k1 would only be one more candidate); texts are told apart by both.
    """
    left = sets_.filter(F.col("body").isNotNull()).select("k1", "k2", "rep", "sub", "n", "rare", "body")
    labels = cut(clusters(left, percent)).withColumnRenamed("node", "k1")
    # two numbers a row: a counted, bounded table spares the shingles a shuffle, a larger one is joined by a shuffle
    near = F.broadcast if labels.count() <= BROADCAST_ROWS else (lambda table: table)
    # sizes need no shingles, so only their lengths are joined
    sizes = cut(left.select("k1", F.octet_length("body").alias("bytes")).join(near(labels), "k1").groupBy("comp").agg(F.count(F.lit(1)).alias("m"), F.sum("bytes").alias("bytes")))
    total = sizes.agg(F.sum("bytes"), F.max("m")).first()
    tasks = max(1, -(-(total[0] or 0) // TASK_BYTES), min(int(sets_.sparkSession.conf.get("spark.sql.shuffle.partitions")), (total[0] or 0) >> 16))
    places = labels.join(near(sizes.select("comp", F.ceil(F.col("m") / CLUSTER_TEXTS).cast("int").alias("parts"))), "comp")
    wide = left.join(near(places), "k1").withColumn("known", F.lit(None).cast("long"))
    small = wide.filter("parts = 1").withColumn("task", F.pmod(F.xxhash64("comp"), F.lit(tasks))).withColumn("side", F.lit(-1))
    columns = ["task", "side", "k1", "k2", "rep", "sub", "n", "rare", "body", "known"]
    out = "k1 long, k2 long, lead_rep long, lead_sub long, lead long, lead2 long" if classes else "k1 long, k2 long"

    def work(got: pa.Table) -> pa.Table:
        c = {name: got.column(name).to_pylist() for name in columns[1:]}
        order = list(zip(c["rep"], c["sub"], c["k1"], c["k2"], strict=True))
        rows = [(n, rare, B.unpack_sorted(body)[0], o, side, known) for n, rare, body, o, side, known in zip(c["n"], c["rare"], c["body"], order, c["side"], c["known"], strict=True)]
        union, late = join_cluster(rows, percent, classes)
        if not classes:
            return pa.table({k: pa.array([c[k][i] for i in sorted(late)], pa.int64()) for k in ("k1", "k2")})
        first: dict[int, tuple] = {}
        for i, o in enumerate(order):
            r = union.find(i)
            first[r] = min(first.get(r, o), o)
        lead = [first[union.find(i)] for i in range(len(rows))]
        return pa.table({**{k: pa.array(c[k], pa.int64()) for k in ("k1", "k2")}, **{f"lead{name}": pa.array([o[j] for o in lead], pa.int64()) for j, name in enumerate(("_rep", "_sub", "", "2"))}})

    done = small.select(columns).groupBy("task").applyInArrow(work, out)
    if (total[1] or 0) <= CLUSTER_TEXTS:
        return done
    large = wide.filter("parts > 1").withColumn("block", F.pmod(F.xxhash64("k1"), F.col("parts")))

    def paired(rows: DataFrame, others, alone: bool) -> DataFrame:
        """Tasks of two blocks i <= j; side tells them apart; a block by itself is a task too."""
        pairs = rows.withColumn("other", F.explode(others))
        i, j = F.least("block", "other"), F.greatest("block", "other")
        t = pairs.withColumn("task", F.xxhash64("comp", i, j)).withColumn("side", F.when(i == j, F.lit(-1)).otherwise(F.col("block")))
        return (t if alone else t.filter(i != j)).select(columns).groupBy("task").applyInArrow(work, out)

    every = F.sequence(F.lit(0), F.col("parts") - 1)
    if not classes:
        return done.unionByName(paired(large, every, True)).distinct()
    node, to = F.xxhash64("k1", "k2"), F.xxhash64("lead", "lead2")
    # each block by itself and with the first, which settles most of a large group; then what is still apart
    first = cut(paired(large, F.when(F.col("block") == 0, every).otherwise(F.array_distinct(F.array(F.lit(0), F.col("block")))), True))
    known = components(first.select(node.alias("a"), to.alias("b")))
    large = large.drop("known").withColumn("node", node).join(known.select("node", F.col("comp").alias("known")), "node")
    apart = large.groupBy("comp").agg(F.count_distinct("known").alias("classes")).filter("classes > 1").select("comp")
    rest = paired(large.join(apart, "comp"), every, False)
    linked = first.select(node.alias("a"), to.alias("b")).unionByName(rest.select(node.alias("a"), to.alias("b")))
    final = cut(components(linked)).join(large.select("node", "k1", "k2", "rep", "sub"), "node")
    lead = final.groupBy("comp").agg(F.min(F.struct("rep", "sub", "k1", "k2")).alias("lead"))
    return done.unionByName(final.join(lead, "comp").select("k1", "k2", F.col("lead.rep").alias("lead_rep"), F.col("lead.sub").alias("lead_sub"), F.col("lead.k1").alias("lead"), F.col("lead.k2").alias("lead2")))


def found_classes(docs: DataFrame, text: str, doc_id: str, k: int, percent: int) -> DataFrame:
    """(k1, k2, rep, n, lead_rep, lead, lead2) of each distinct text; lead is null where it has no similar text."""
    to, _ = B.sizes(docs, text)
    blocked = B.blocks(docs.select(F.col(text).alias("text"), F.col(doc_id).alias("rep")), to.blocks)
    found = cut(rarest_first(blocked, to, k, percent).select("k1", "k2", "rep", "sub", "n", "rare", "body"))
    lead = join(found, percent, True)
    return found.select("k1", "k2", "rep", "n").join(lead.select("k1", "k2", "lead_rep", "lead", "lead2"), ["k1", "k2"], "left")


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles and component_id (least id of the texts reachable by links) of each row of docs.

    Rows without a set stand alone. Rows with a null id take the least id of their class, null if it has none.
    """
    result = found_classes(docs, text, doc_id, k, percent).select("k1", "k2", F.col("n").alias("n_shingles"), F.coalesce("lead_rep", "rep").alias("component_id"))
    rows = B.spread(result, docs, text, F.col(doc_id))
    return rows.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col(doc_id)).otherwise(F.when(F.col("component_id") < 2**63 - 1, F.col("component_id"))))


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, percent: int = 75) -> DataFrame:
    """Of each class of similar rows of docs that with the least id; rows without a set stay. Of repeated rows one stays."""
    result = found_classes(docs, text, doc_id, k, percent).filter((F.col("n") > 0) & (F.col("lead").isNull() | (F.col("lead") == F.col("k1")) & (F.col("lead2") == F.col("k2"))))
    result = result.select(F.col("k1").alias("k1"), F.col("k2").alias("k2"), F.col("rep").alias("id"), F.lit(True).alias("first"))
    k1, k2 = B.identity(text)
    keys = ["k1", "k2", "id"]
    # the rows as a struct: their names may be any. The id is among the keys: the copies of a text are spread, and only the first of them finds its row
    rows = docs.select(F.struct("*").alias("row"), k1, k2, F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1)).alias("id"), (~F.coalesce(F.col(text), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")).alias("none"))
    rows = rows.join(result, keys, "left").withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("none")))
    return rows.filter(F.col("none") | (F.col("first") & (F.col("place") == 1))).select("row.*")
