"""Token counts by a compiled finite-state tokenizer.

A byte-pair tokenizer that merges the best-ranked pair first has this property:
the last token of a prefix's encoding fixes how the prefix was cut, and whether a
token may follow another can be told from the two alone. So the encoding of a
growing prefix is a walk through a deterministic transducer: its state is the last
few characters and, for places among them, the token that ended there; a transition
reads one character and is annotated with the change of the number of tokens
emitted so far. States and transitions are made when first met and then kept.

No piece holds a space mark behind another character, so after a character that
isn't a space the next space always leads to the same state. A text is cut into
chunks; a chunk's map from the state it is entered in to the state it leaves is
kept as (text up to its first such reset, tokens up to the last reset, text behind
it). Maps compose associatively, so that a document's maps are combined pairwise,
level by level.

A document's chunks are mapped and composed by the worker that has its text. Null or empty text: 0 tokens. Repeated rows each get
their counts, an empty table gives no row; of docs only the columns named are read, so that others may have any name. Memory is bounded by `_KEPT` words and pairs and
`_STATES` states; beyond it they are forgotten and made anew, which changes no count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
CHUNK = 1 << 15
_KEPT, _STATES = 400_000, 250_000
_SEGMENT = re.compile(" +[^ ]*")
_RESET = re.compile("(?<=[^ ]) ")


class Transducer:
    """Of pieces, best rank first; a character outside them counts its UTF-8 bytes.

    A state holds the characters behind which a piece may still be growing and, for each place
    among them where one may have begun, the token that ended there and how many tokens fewer
    had been emitted by then. Places at which no growing piece can have begun are forgotten, so
    that words of different beginnings soon come to the same states.
    """

    def __init__(self, ranks: dict[str, int]):
        self.ranks, self.longest = ranks, max(map(len, ranks), default=1)
        self.growing = {x[:i] for x in ranks for i in range(1, len(x))}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.reset()

    def reset(self) -> None:
        start = ("", (("", 0),))
        self.states: dict[tuple, int] = {start: 0}
        self.contents: list[tuple[str, tuple[tuple[str, int] | None, ...]]] = [start]
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]

    def merge(self, text: str) -> list[str]:
        parts = list(text)
        while True:
            best = min(((r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None:
                return parts
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    def stands(self, piece: str) -> bool:
        """Whether the piece, read alone, becomes itself."""
        if (known := self.whole.get(piece)) is None:
            known = self.whole[piece] = self.merge(piece) == [piece]
        return known

    def follows(self, left: str, right: str) -> bool:
        if (known := self.pairs.get((left, right))) is None:
            if len(self.pairs) > _KEPT:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def cost(self, token: str) -> int:
        return 1 if token in self.ranks else len(token.encode())

    def step(self, state: int, char: str) -> tuple[int, int]:
        """The next state and the change of the count."""
        if known := self.arcs[state].get(char):
            return known
        text, places = self.contents[state]
        text += char
        for size in range(len(text), 0, -1):
            piece, place = text[-size:], places[len(text) - size]
            if place and (size == 1 or piece in self.ranks and self.stands(piece)) and (not place[0] or self.follows(place[0], piece)):
                break
        else:
            raise AssertionError("no token ends here")
        change = self.cost(piece) + place[1]
        places = (*(p and (p[0], p[1] - change) for p in places), (piece, 0))
        growing, begin, kept = self.growing, len(text), []
        for i in range(len(text)):
            if places[i] and text[i:] in growing:
                begin = min(begin, i)
                kept.append(places[i])
            elif begin < i:
                kept.append(None)
        content = (text[begin:], (*kept, places[-1]))
        target = self.states.get(content)
        if target is None:
            target = self.states[content] = len(self.contents)
            self.contents.append(content)
            self.arcs.append({})
        self.arcs[state][char] = (target, change)
        return target, change

    def count(self, segment: str) -> int:
        """Tokens of a segment: marks, then other characters."""
        if len(self.contents) > _STATES:
            self.reset()
        state = total = 0
        arcs = self.arcs
        for char in segment.replace(" ", MARK):
            if len(self.contents) > 2 * _STATES:  # only within one very long word
                content = self.contents[state]
                self.reset()
                arcs = self.arcs
                self.states[content], state = len(self.contents), len(self.contents)
                self.contents.append(content)
                arcs.append({})
            state, change = arcs[state].get(char) or self.step(state, char)
            total += change
        return total


class Counter(dict):
    """Counts by segment; those met before need no walk."""

    def __init__(self, ranks: dict[str, int]):
        self.transducer = Transducer(ranks)

    def __missing__(self, segment: str) -> int:
        n = self.transducer.count(segment)
        if len(segment) <= 64:
            if len(self) > _KEPT:
                self.clear()
            self[segment] = n
        return n

    def tokens(self, text: str) -> int:
        return sum(map(self.__getitem__, _SEGMENT.findall(text)))

    def chunk_map(self, chunk: str) -> tuple[str, int, str] | str:
        """Head, tokens and open tail of a chunk, or the chunk itself if no reset is in it."""
        if not (first := _RESET.search(chunk)):
            return chunk
        at = first.start()
        *closed, tail = _SEGMENT.findall(chunk, at)
        return chunk[:at], sum(map(self.__getitem__, closed)), tail

    def compose(self, a: tuple[str, int, str] | str, b: tuple[str, int, str] | str) -> tuple[str, int, str] | str:
        if isinstance(a, str):
            if isinstance(b, str):
                return self.chunk_map(a + b)
            met = self.chunk_map(a + b[0])
            return (met, b[1], b[2]) if isinstance(met, str) else (met[0], met[1] + self[met[2]] + b[1], b[2])
        if isinstance(b, str):
            *closed, tail = _SEGMENT.findall(a[2] + b)
            return a[0], a[1] + sum(map(self.__getitem__, closed)), tail
        return a[0], a[1] + self.tokens(a[2] + b[0]) + b[1], b[2]

    def document(self, text: str, chunk: int = CHUNK) -> int:
        if not text:
            return 0
        text = " " + text.replace(MARK, " ")
        if len(text) <= chunk:
            return self.tokens(text)
        maps = [self.chunk_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:
            maps = [self.compose(maps[i], maps[i + 1]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return self.tokens(maps[0]) if isinstance(maps[0], str) else self.tokens(maps[0][0]) + maps[0][1] + self[maps[0][2]]


def piece_ranks(model: str) -> dict[str, int]:
    """Ranks of a sentencepiece model's ordinary pieces, 0 the best."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    # the counts hold for a byte-pair model that changes nothing but spaces; a normaliser, pieces that users defined or missing bytes would change them
    same = "".join(map(chr, range(0x21, 0x7F))) + "ÀéßøçŁ①ｆﬁ½Ⅷ™ªµ·…“”　\u200b\ufeffe\u0301中文हिन्दी🙂\t\n\x0b"
    if sp.decode(sp.encode(same)) != same:
        raise ValueError("the model normalises texts")
    if sp.encode("a  b ", out_type=str) != sp.encode(f"a{MARK}{MARK}b{MARK}", out_type=str) or not sp.encode("a", out_type=str)[0].startswith(MARK):
        raise ValueError("the model treats spaces in another way")
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if len({f"<0x{i:02X}>" for i in range(256)} & set(pieces)) < 256:
        raise ValueError("the model has no byte fallback")
    usual = [i for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    if any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in usual):
        raise ValueError("a piece has a space mark behind another character")
    return {sp.id_to_piece(i): r for r, i in enumerate(sorted(usual, key=lambda i: -sp.get_score(i)))}


_COMPILED: dict[str, Counter] = {}


def compiled(name: str, ranks: dict[str, int]) -> Counter:
    """What this Python worker has compiled of a tokenizer, kept from task to task."""
    if name not in _COMPILED:
        _COMPILED[name] = Counter(ranks)
    return _COMPILED[name]


def count_tokens(docs: DataFrame, model: str, text: str = "text", limit: int = 4096, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """ids, n_bytes, n_tokens and over_limit of each row of docs."""
    ranks = piece_ranks(model)
    rows = docs.select(*ids, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.coalesce(text, F.lit("")).alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = compiled(model, ranks)
        for b in batches:
            n = []
            texts = b.column("__text")
            for i in range(0, b.num_rows, 128):
                n += [counter.document(x) for x in texts.slice(i, 128).to_pylist()]
            yield pa.record_batch([*(b.column(c) for c in (*ids, "n_bytes")), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=[*ids, "n_bytes", "n_tokens", "over_limit"])

    schema = rows.drop("__text").schema.add("n_tokens", "long").add("over_limit", "boolean")
    return rows.mapInArrow(work, schema)
