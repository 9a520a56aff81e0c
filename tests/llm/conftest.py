from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from tests_words import WORDS  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k1 string, rep string, n_words string, score string, blk string"


def make(seed: int = 4, n: int = 60) -> list[tuple]:
    """Documents with copies, near copies, shared passages and lines, odd white space, nulls, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    prose = lambda k: " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", ","]) for _ in range(k))
    shared, line = prose(60), prose(14)
    texts: list[str | None] = []
    for i in range(n):
        kind = i % 10
        if kind == 0 and texts and texts[-1]:
            w = texts[-1].split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
        elif kind == 1 and i > 10:
            texts.append(texts[i - 9])
        elif kind == 2:
            texts.append(prose(30) + "\n" + shared + "\n" + line + "\n" + prose(20))
        elif kind == 3:
            texts.append(line + "\n" + prose(80) + "\n\n" + line.upper() + "\n" + prose(5))
        elif kind == 4:
            texts.append(rng.choice(["", " \t\n", "one", "Two  words", "a b c d", "a b c d e"]))
        elif kind == 5:
            texts.append(None if i % 20 == 5 else "x y " * 50)
        else:
            texts.append(prose(rng.randint(40, 160)).capitalize() + rng.choice(["", "\n", " é ñ ß z\x0b\x0c"]))
    texts.append(" ".join(rng.choice(WORDS) for _ in range(30_000)))
    # hot groups: a third of the rows are copies of one text or near copies of another, all with one more passage and line
    hot, near = prose(70) + "\n" + shared, prose(90).split(" ")
    for i in range(30):
        texts += [hot, " ".join([*near[: i + 30], f"own{i}", *near[i + 31 :]]) + "\n" + line] if i % 2 else [hot]
    rows = [(i, t, "en", rng.choice(["s0", "s0", "s1", "é", None]), len(t or ""), "k", "r", "7", "s", "b") for i, t in enumerate(texts)]
    return rows + rows[:3] + [(None, "null id here with several words in it", None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def rows():
    return make()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from tessera.llm.shared import ready

    ready(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    from tessera.llm.shared import ready

    ready(spark)
    return spark.createDataFrame([], SCHEMA)
