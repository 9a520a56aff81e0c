"""Quality rules as learned decision lists.

Statistics of a text are Spark expressions of its row alone. A decision list is
learnt by sequential covering: a rule, a conjunction of thresholds on statistics,
is grown by information gain on two thirds of the labelled statistics, pruned on
the other third, and kept if it is right often enough there; what it covers is
set aside and the next rule is grown. The rules become one ordered conditional
expression; what no rule rejects is kept.

Learning takes at most `sample_rows` labelled rows, chosen by a hash of their id;
their statistics are binned and counted per cell by Spark, and only the counts
reach the driver. Everything else covers every row. Null text counts as empty:
all counts 0, base_failed true. Conflicting labels of an id: the worse holds; null
labels are left out. Without labels of both kinds the list is empty.
Windows of three words are compared by a 64-bit hash within their text.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import cut

SPACE = "[\\x20\\x09-\\x0D]"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = ("n_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "mark_rate", "digit_rate", "stop_rate")


def bind(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x computed once, where f names it more than once within a lambda."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def repeated(words: Column) -> Column:
    """Words in three-word windows that the text has twice or more."""

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b)

    def found(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
        return bind(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def windows(k: Column) -> Column:
        return F.when(F.size(F.array_distinct(k)) == F.size(k), F.lit(0)).otherwise(bind(F.sort_array(F.transform(k, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), found))

    def keys(w: Column) -> Column:
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(bind(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))), windows))

    return bind(words, keys)


def describe(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the base counts, base_failed and a struct `stats`."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(t, SPACE + "+"), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counts = bind(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.when(F.size(w) < 4, F.lit(0)).otherwise(repeated(w)).cast("long").alias("n_repeat_words")))
    by_line = bind(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    more = F.struct(
        counts.alias("w"),
        by_line.alias("l"),
        (F.length(t) - F.regexp_count(t, F.lit(SPACE))).cast("long").alias("chars"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("symbols"),
        F.regexp_count(t, F.lit("\\p{Lu}")).alias("upper"),
        F.regexp_count(t, F.lit("[!?]")).alias("marks"),
        F.regexp_count(t, F.lit("[0-9]")).alias("digits"),
        F.regexp_count(t, F.lit("[.,;:]")).alias("stops"),
    )
    d = docs.withColumn("__m", more)
    m, n = F.col("__m"), F.greatest(F.col("__m.w.n_words"), F.lit(1)).cast("double")
    d = d.withColumns({"n_words": m["w"]["n_words"], "word_chars": m["chars"], "n_symbols": m["symbols"], "n_dup_lines": m["l"]["dup"], "n_repeat_words": m["w"]["n_repeat_words"]})
    chars = F.greatest(m["chars"], F.lit(1)).cast("double")
    stats = F.struct(
        m["w"]["n_words"].cast("double").alias("n_words"),
        (m["chars"] / n).alias("word_length"),
        (m["symbols"] / n).alias("symbol_rate"),
        (m["l"]["dup"] / F.greatest(m["l"]["n"], F.lit(1))).alias("dup_line_rate"),
        (m["w"]["n_repeat_words"] / n).alias("repeat_rate"),
        (m["upper"] / chars).alias("upper_rate"),
        (m["marks"] / n).alias("mark_rate"),
        (m["digits"] / chars).alias("digit_rate"),
        (m["stops"] / n).alias("stop_rate"),
    )
    d = d.withColumn("stats", stats).drop("__m")
    return d.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


@dataclass(frozen=True)
class Rule:
    """Rejects where all conditions (statistic, ">" or "<=", threshold) hold; precision on the pruning third."""

    conditions: tuple[tuple[str, str, float], ...]
    precision: float

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for name, op, x in self.conditions:
            out = out & ((stats[name] > x) if op == ">" else (stats[name] <= x))
        return out


def verdict(rules: list[Rule], stats: Column) -> Column:
    """The number of the first rule that rejects, from 0; null if none does."""
    out = None
    for i, r in enumerate(rules):
        out = F.when(r.column(stats), F.lit(i)) if out is None else out.when(r.column(stats), F.lit(i))
    return F.lit(None).cast("int") if out is None else out


Cell = tuple[tuple[int, ...], int, int, int]


def cover(cells: list[Cell], cuts: dict[str, list[float]], most_rules: int = 12, most_conditions: int = 4, least: float = 0.9, least_rows: int = 8) -> list[Rule]:
    """Rules from cells (bins of each statistic, part 0 or 1 to grow and 2 to prune, good, bad)."""
    names, rules = list(cuts), []
    tests = [(k, op, b) for k, name in enumerate(names) for b in range(len(cuts[name])) for op in (">", "<=")]

    def hits(cell: Cell, test: tuple[int, str, int]) -> bool:
        return (cell[0][test[0]] > test[2]) == (test[1] == ">")

    def tally(rows: list[Cell]) -> tuple[int, int]:
        return sum(c[3] for c in rows), sum(c[2] for c in rows)

    def gain(rows: list[Cell], part: list[Cell]) -> float:
        (p0, n0), (p, n) = tally(rows), tally(part)
        return p * (math.log2((p + 1e-9) / (p + n + 1e-9)) - math.log2((p0 + 1e-9) / (p0 + n0 + 1e-9))) if p else -1.0

    rest = cells
    while len(rules) < most_rules:
        grow, prune = [c for c in rest if c[1] != 2], [c for c in rest if c[1] == 2]
        chosen: list[tuple[int, str, int]] = []
        part = grow
        while len(chosen) < most_conditions and tally(part)[1]:
            best = max(tests, key=lambda t: (gain(part, [c for c in part if hits(c, t)]), t[1] == ">", -t[0], -t[2]))
            inside = [c for c in part if hits(c, best)]
            if gain(part, inside) <= 1e-6:
                break
            chosen.append(best)
            part = inside

        def worth(tests_: list[tuple[int, str, int]], prune: list[Cell] = prune) -> float:
            p, n = tally([c for c in prune if all(hits(c, t) for t in tests_)])
            return (p - n) / (p + n) if p + n else -1.0

        while len(chosen) > 1 and worth(chosen[:-1]) >= worth(chosen):
            chosen.pop()
        p, n = tally([c for c in prune if all(hits(c, t) for t in chosen)])
        inside = [c for c in grow if all(hits(c, t) for t in chosen)]
        gp, gn = tally(inside)
        if not chosen or p + gp < least_rows or (p + gp) < least * (p + gp + n + gn) or p < least * (p + n):
            break
        rules.append(Rule(tuple((names[k], op, cuts[names[k]][b]) for k, op, b in chosen), p / (p + n) if p + n else gp / (gp + gn)))
        rest = [c for c in rest if not all(hits(c, t) for t in chosen)]
    return rules


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", sample_rows: int = 20_000, bins: int = 16, least: float = 0.9) -> list[Rule]:
    """Rules that reject documents labelled 0."""
    chosen = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.min(label).cast("int").alias("__y")).orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
    # cut before it is described: the filter below would go below the join otherwise, and every document would be described for it
    sample = describe(cut(docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")), "__text")
    sample = sample.filter(~F.col("base_failed")).select("__id", "__y", "stats.*")
    sample = cut(sample)
    # cuts halfway between neighbouring quantiles of either label: a rare kind of bad text has cuts of its own, and none lies at the edge of the good texts
    at = [i / bins for i in range(bins + 1)]
    marks = sample.groupBy("__y").agg(*[F.percentile_approx(s, at, 2000).alias(s) for s in STATISTICS]).collect()
    if {r["__y"] for r in marks} < {0, 1}:
        return []
    seen = {s: sorted({x for r in marks for x in r[s] or []}) for s in STATISTICS}
    cuts = {s: [(a + b) / 2 for a, b in zip(x, x[1:], strict=False)] for s, x in seen.items()}
    binned = [sum((F.when(F.col(s) > x, F.lit(1)).otherwise(F.lit(0)) for x in cuts[s]), F.lit(0)).alias(f"b_{s}") if cuts[s] else F.lit(0).alias(f"b_{s}") for s in STATISTICS]
    cells = sample.select(F.pmod(F.xxhash64("__id", F.lit(1)), F.lit(3)).cast("int").alias("part"), "__y", F.array(*binned).alias("bins")).groupBy("bins", "part").agg(F.sum(F.when(F.col("__y") == 1, 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("__y") == 0, 1).otherwise(0)).alias("bad")).collect()
    return cover(sorted((tuple(r["bins"]), r["part"], r["good"], r["bad"]) for r in cells), cuts, least=least)


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """docs with the base counts, base_failed, rule (the first that rejects, or null) and kept."""
    d = describe(docs, text)
    return d.withColumn("rule", verdict(rules, F.col("stats"))).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).drop("stats")
