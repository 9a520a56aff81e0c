"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is logistic in the words and
word stems (first few bytes) it has; a document is toxic unless every sentence is clean, so its score is the
noisy-or 1 - prod(1 - sentence score). Only documents are labelled: the gradient
of the document's likelihood shares the label out among its sentences. The scored
sentences then say where the offence is.

Fitting takes at most `sample_rows` labelled ids, chosen by a hash of the id, whose texts
have together at most `sample_bytes` (an id whose rows have more than `id_bytes` by themselves is
not learnt from). The words that tell the labels apart are counted by Spark over that
sample; all whose shares among toxic and other documents differ by `least_worth` standard errors become features. Scoring covers every document.
Null or empty text has no sentence and scores 0. A document labelled more than
once counts as toxic if any of its labels says so; null labels are left out. With
no labelled document of either kind every score is 0. Repeated rows each get their score, an empty table gives no row; of docs only
the columns named are read, so that others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import text as T
from tessera.llm.shared import cut

#: Words end at white space and at ASCII punctuation; a sentence ends at one of ".!?" or a line's end.
APART = T.SPACE.copy()
APART[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
#: Beside the word, its first so many bytes: an offensive stem under endings never met before.
STEMS = (4, 5, 6, 7, 8)
STOP = np.zeros(256, bool)
STOP[[*b".!?\n"]] = True


def sentence_words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each slice of documents: first, last, hashes of words and stems, the document of each and its sentence in the slice."""
    data, offsets = T.buffers(column)
    for i, j in T.slices(offsets):
        part = T.LOWER[data[offsets[i] : offsets[j]]]
        bounds = offsets[i : j + 1] - offsets[i]
        starts, ends, of = T.words(part, bounds, APART)
        doc = T.owners(of)
        stops = np.cumsum(STOP[part])[starts] if len(starts) else np.zeros(0, np.int64)
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (stops[1:] != stops[:-1]) | (doc[1:] != doc[:-1])
        sentence = np.cumsum(fresh) - 1
        hashes, of, within = [T.hash_words(part, starts, ends)], [doc], [sentence]
        for k in STEMS:
            longer = ends - starts > k
            hashes.append(T.mix(T.hash_words(part, starts[longer], starts[longer] + k) + np.uint64(k)))
            of.append(doc[longer])
            within.append(sentence[longer])
        yield i, j, np.concatenate(hashes), np.concatenate(of), np.concatenate(within)


@dataclass(frozen=True)
class Model:
    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def sentences(self, hashes: np.ndarray, sentence: np.ndarray) -> np.ndarray:
        """-log(1 - score) of each sentence."""
        n = int(sentence.max()) + 1 if len(sentence) else 0
        at, found = lookup(self.keys, hashes)
        pair = np.unique(np.stack([sentence[found], at[found]]), axis=1) if found.any() else np.zeros((2, 0), int)
        z = self.bias + np.bincount(pair[0], self.weights[pair[1]], n)
        return np.logaddexp(0, z)


def lookup(keys: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return at, keys[at] == hashes


def fit(docs: DataFrame, labels: DataFrame, trained: Column, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", sample_rows: int = 20_000, sample_bytes: int = 64 << 20, id_bytes: int = 1 << 20, least_worth: float = 3.5, rounds: int = 400) -> Model:
    """trained: which ids of labels may be learnt from."""
    order = ["__order", "__id"]
    chosen = labels.filter(trained & F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("__y")).withColumn("__order", F.xxhash64("__id")).orderBy(*order).limit(sample_rows)
    # read once, then small: the passes below are over the sample alone
    sample = cut(docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id"))
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)  # a row for each of at most sample_rows ids
    sizes = sample.groupBy(*order).agg(F.sum(F.coalesce(F.octet_length("__text"), F.lit(0))).alias("__bytes")).filter(F.col("__bytes") <= id_bytes).withColumn("__upto", F.sum("__bytes").over(upto))
    sample = sample.join(F.broadcast(sizes.filter(F.col("__upto") <= sample_bytes).select("__id")), "__id", "left_semi").select("__text", "__y")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = np.asarray(b.column("__y"))
            for i, j, h, doc, _ in sentence_words(b.column("__text")):
                pair = np.unique(np.stack([doc.astype(np.uint64), h]), axis=1)
                keys, at = np.unique(pair[1], return_inverse=True)
                toxic = y[i:j][pair[0].astype(int)]
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(np.bincount(at, toxic, len(keys)).astype(np.int64)), pa.array(np.bincount(at, 1 - toxic, len(keys)).astype(np.int64))], names=["key", "bad", "good"])

    totals = sample.groupBy("__y").count().collect()
    n = {r["__y"]: r["count"] for r in totals}
    if not (n.get(0) and n.get(1)):
        return Model(np.zeros(0, np.uint64), np.zeros(0), -50.0)
    p, q = (F.col("bad") + 0.5) / (n[1] + 1), (F.col("good") + 0.5) / (n[0] + 1)
    best = sample.mapInArrow(tell, "key long, bad long, good long").groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).withColumn("worth", (p - q) / F.sqrt(p + q)).filter(F.abs("worth") >= least_worth * (1 / n[0] + 1 / n[1]) ** 0.5).select("key").collect()
    keys = np.sort(np.array([r[0] for r in best], np.int64).view(np.uint64))

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = np.asarray(b.column("__y"))
            rows = []
            for i, j, h, doc, sentence in sentence_words(b.column("__text")):
                order = np.argsort(doc, kind="stable")
                h, doc, sentence = h[order], doc[order], sentence[order]
                at, found = lookup(keys, h)
                ends = np.searchsorted(doc, np.arange(j - i + 1))
                for d in range(j - i):
                    s, e = ends[d], ends[d + 1]
                    own = sentence[s:e]
                    begin = own.min() if len(own) else 0
                    pair = np.unique(np.stack([own[found[s:e]] - begin, at[s:e][found[s:e]]]), axis=1).astype(np.int32)
                    rows.append((int(y[i + d]), int(own.max() - begin + 1) if len(own) else 0, pair[0].tobytes(), pair[1].tobytes()))
            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["y", "n", "sentence", "feature"])

    bags = sample.mapInArrow(bag, "y int, n long, sentence binary, feature binary").collect()
    y = np.array([r["y"] for r in bags], float)
    first = np.concatenate([[0], np.cumsum([r["n"] for r in bags])]).astype(int)
    sentence = np.concatenate([np.frombuffer(r["sentence"], np.int32) + first[k] for k, r in enumerate(bags)])
    feature = np.concatenate([np.frombuffer(r["feature"], np.int32) for r in bags])
    return Model(keys, *ascend(y, first, sentence, feature, len(keys), rounds))


def ascend(y: np.ndarray, first: np.ndarray, sentence: np.ndarray, feature: np.ndarray, n_features: int, rounds: int, l2: float = 5e-5) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the documents' noisy-or likelihood; the rarer label weighs more, by the root of its rarity."""
    doc = np.repeat(np.arange(len(y)), np.diff(first))
    n, total = len(doc), len(y)
    share = np.where(y == 1, max(1, y.sum()), max(1, (1 - y).sum())) ** -0.5
    share /= share.sum()
    w = np.zeros(n_features + 1)
    w[-1] = -3.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        z = w[-1] + np.bincount(sentence, w[:-1][feature], n)
        p = 1 / (1 + np.exp(-z))
        clean = np.minimum(np.bincount(doc, np.logaddexp(0, z), total), 500)
        pull = share * np.where(y == 1, -np.exp(-clean) / np.maximum(-np.expm1(-clean), 1e-9), 1.0)
        g = pull[doc] * p
        grad = np.append(np.bincount(feature, g[sentence], n_features), g.sum()) + l2 * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.05 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model, text: str = "text", ids: tuple[str, ...] = ("doc_id",), threshold: float = 0.7) -> DataFrame:
    """ids, score, predicted, n_sentences, and the number and the score of the worst sentence (from 0; null without any)."""
    rows = docs.select(*ids, F.col(text).alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, count, worst, top = (np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows))
            for i, j, h, doc, sentence in sentence_words(b.column("__text")):
                dirt = model.sentences(h, sentence)
                of = np.zeros(len(dirt), np.int64)
                of[sentence] = doc
                clean = np.bincount(of, dirt, j - i)
                out[i:j] = -np.expm1(-clean)
                count[i:j] = np.bincount(of, minlength=j - i)
                if len(dirt):
                    order = np.lexsort((-np.arange(len(dirt)), dirt, of))
                    last = np.flatnonzero(np.append(of[order][1:] != of[order][:-1], True))
                    at = order[last]
                    begin = np.searchsorted(of, np.arange(j - i))
                    worst[i + of[at]] = at - begin[of[at]]
                    top[i + of[at]] = -np.expm1(-dirt[at])
            yield pa.record_batch([*(b.column(c) for c in ids), pa.array(out), pa.array((out >= threshold).astype(np.int32)), pa.array(count), pa.array(worst, mask=np.asarray(count == 0)), pa.array(top, mask=np.asarray(count == 0))], names=[*ids, "score", "predicted", "n_sentences", "worst_sentence", "worst_score"])

    schema = rows.drop("__text").schema.add("score", "double").add("predicted", "integer").add("n_sentences", "long").add("worst_sentence", "long").add("worst_score", "double")
    return rows.mapInArrow(work, schema)
