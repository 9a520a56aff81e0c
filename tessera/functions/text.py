"""Cleaning of names and addresses, as column expressions.

Everything but `fold` runs inside the JVM; `fold` is an Arrow function that only
texts with characters beyond ASCII reach.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words of legal forms and generic words that a name's core leaves out.
LEGAL = "pvt private ltd limited llc inc incorporated corp corporation co company llp plc sarl sas sa eurl gmbh lp pllc ag spa srl bv nv pte opc public sci snc sasu scop sca selarl".split()
GENERIC = "the and of de du des la le les et".split()
# Address abbreviations and their full words.
ABBREVIATIONS = {"rd": "road", "st": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "bd": "boulevard", "nr": "near", "opp": "opposite", "hwy": "highway", "bldg": "building", "apt": "apartment", "ste": "suite", "pkwy": "parkway", "ln": "lane"}
# Words that mark a part of an address as something else than a city.
NOT_CITY = "road rd street st avenue ave av boulevard blvd bd lane ln drive dr court ct place pl way highway hwy parkway pkwy circle cir trail terrace square plaza loop marg floor plot block phase flat unit suite apartment building bldg tower near opposite opp nr behind beside ward gali colony society complex layout cross main chowk market industrial area estate rue chemin chm impasse allee cours cour cite quai route residence appartement batiment bat zone lieu passage villa hameau".split()
POSTCODE_LENGTHS = (5, 6)
# Letters without a decomposition.
LETTERS = {"ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ı": "i", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "…": "...", "№": "No", "€": "EUR"}
# Devanagari consonants (with an inherent a), vowels and vowel signs.
CONSONANTS = dict(zip("कखगघङचछजझञटठडढणतथदधनपफबभमयरलवशषसहळ", "k kh g gh ng c ch j jh ny tt tth dd ddh nn t th d dh n p ph b bh m y r l v sh ss s h ll".split(), strict=True))
VOWELS = dict(zip("अआइईउऊऋएऐओऔ", "a aa i ii u uu r e ai o au".split(), strict=True))
SIGNS = dict(zip("ािीुूृेैोौंःँ", "aa i ii u uu r e ai o au n h n".split(), strict=True))
VIRAMA, NUKTA = "्", "़"


# Letters whose Unicode names begin otherwise than their usual transcription.
GREEK = {"ETA": "e", "THETA": "th", "XI": "x", "PHI": "ph", "CHI": "ch", "PSI": "ps", "OMEGA": "o"}
CYRILLIC = {"BE": "b", "VE": "v", "GHE": "g", "DE": "d", "IE": "e", "IO": "io", "ZHE": "zh", "ZE": "z", "SHORT I": "i", "KA": "k", "EL": "l", "EM": "m", "EN": "n", "PE": "p", "ER": "r", "ES": "s", "TE": "t", "EF": "f", "HA": "kh", "TSE": "ts", "CHE": "ch", "SHA": "sh", "SHCHA": "shch", "HARD SIGN": "", "YERU": "y", "SOFT SIGN": "", "YU": "iu", "YA": "ia", "UKRAINIAN IE": "ie", "BYELORUSSIAN-UKRAINIAN I": "i", "YI": "yi", "GHE WITH UPTURN": "g"}
ARABIC = {"ALEF": "a", "BEH": "b", "TEH": "t", "TEH MARBUTA": "h", "THEH": "th", "JEEM": "j", "HAH": "h", "KHAH": "kh", "DAL": "d", "THAL": "dh", "REH": "r", "ZAIN": "z", "SEEN": "s", "SHEEN": "sh", "SAD": "s", "DAD": "d", "TAH": "t", "ZAH": "z", "AIN": "", "GHAIN": "gh", "FEH": "f", "QAF": "q", "KAF": "k", "LAM": "l", "MEEM": "m", "NOON": "n", "HEH": "h", "WAW": "w", "YEH": "y", "ALEF MAKSURA": "a", "HAMZA": ""}
HEBREW = {"ALEF": "", "BET": "b", "GIMEL": "g", "DALET": "d", "HE": "h", "VAV": "v", "ZAYIN": "z", "HET": "kh", "TET": "t", "YOD": "y", "KAF": "k", "FINAL KAF": "k", "LAMED": "l", "MEM": "m", "FINAL MEM": "m", "NUN": "n", "FINAL NUN": "n", "SAMEKH": "s", "AYIN": "", "PE": "p", "FINAL PE": "p", "TSADI": "ts", "FINAL TSADI": "ts", "QOF": "q", "RESH": "r", "SHIN": "sh", "TAV": "t"}


def transcribed(c: str) -> str:
    """ASCII for a character: by its decomposition, else by its Unicode name (scripts whose letters' names say how they sound)."""
    if c in LETTERS:
        return LETTERS[c]
    if (digit := unicodedata.digit(c, None)) is not None:
        return str(digit)
    if plain := "".join(x for x in unicodedata.normalize("NFKD", c) if x.isascii()):
        return plain
    if (name := unicodedata.name(c, "")).startswith("HANGUL SYLLABLE "):
        return name.removeprefix("HANGUL SYLLABLE ").lower()
    parts = unicodedata.normalize("NFD", c)
    script, _, rest = unicodedata.name(parts[0], "").partition(" ")
    kind, _, letter = rest.rpartition("LETTER ")
    letter = letter if letter == "GHE WITH UPTURN" else letter.partition(" WITH ")[0]
    if script in ("GREEK", "CYRILLIC") and kind in ("SMALL ", "CAPITAL "):
        table = GREEK if script == "GREEK" else CYRILLIC
        out = table.get(letter, letter.removeprefix("FINAL ")[:1].lower())
        return out.capitalize() if kind == "CAPITAL " else out
    if script in ("ARABIC", "HEBREW") and not kind:
        return (ARABIC if script == "ARABIC" else HEBREW).get(letter, "")
    if script in ("HIRAGANA", "KATAKANA") and not kind:
        return name.rpartition("LETTER ")[2].removeprefix("SMALL ").lower()
    return ""


class _Ascii(dict):
    """A table for str.translate that fills itself."""

    def __missing__(self, code: int) -> str:
        out = self[code] = chr(code) if code < 128 else transcribed(chr(code))
        return out


_TABLE = _Ascii()
DEVANAGARI = re.compile("[\u0900-\u0963]+")


def _devanagari(found: re.Match) -> str:
    """Consonants have an inherent a, which a vowel sign or a virama takes away."""
    out: list[str] = []
    for c in found[0]:
        if c in CONSONANTS:
            out.append(CONSONANTS[c] + "a")
        elif c in VOWELS:
            out.append(VOWELS[c])
        elif c in SIGNS or c == VIRAMA:
            if c not in "ंःँ" and out and out[-1].endswith("a"):
                out[-1] = out[-1][:-1]
            out.append(SIGNS.get(c, ""))
    return "".join(out)


def ascii_fold(text: str | None) -> str:
    """ASCII for what has any: Latin, Greek, Cyrillic, Arabic, Hebrew, Devanagari, Hangul, kana and digits; null becomes empty, ASCII stays as it is.

    Characters without a transcription (Han, for one, whose readings no rule gives) vanish.
    """
    if text is None or text.isascii():
        return text or ""
    return DEVANAGARI.sub(_devanagari, unicodedata.normalize("NFC", text)).translate(_TABLE)


@F.pandas_udf(StringType())
def _fold(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(ascii_fold)


def fold(text: Column) -> Column:
    """ascii_fold; only texts beyond ASCII travel to Python."""
    t = F.coalesce(text, F.lit(""))
    plain = ~t.rlike("[^\\x00-\\x7F]")
    return F.when(plain, t).otherwise(_fold(F.when(~plain, t)))


def clean(folded: Column) -> Column:
    """Lower case; & as "and"; dots, apostrophes and backticks vanish; anything else but letters and digits is one space."""
    x = F.replace(F.lower(folded), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(F.regexp_replace(x, "[.'`]", ""), "[^a-z0-9]+", " "))


def words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def name_core(name: Column) -> Column:
    """The name without legal and generic words; the whole name if nothing else is left."""
    stop = F.array(*map(F.lit, LEGAL + GENERIC))
    core = F.array_join(F.filter(words(name), lambda w: ~F.array_contains(stop, w)), " ")
    return F.when(core == "", name).otherwise(core)


def address(cleaned: Column) -> Column:
    """Without the word null, abbreviations written out."""
    full = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    return F.array_join(F.transform(F.filter(words(cleaned), lambda w: w != "null"), lambda w: F.coalesce(F.try_element_at(full, w), w)), " ")


def digit_runs(folded: Column) -> Column:
    return F.regexp_extract_all(folded, F.lit("([0-9]+)"), F.lit(1))


def postcode(runs: Column) -> Column:
    """The last run of five or six digits, or empty."""
    return F.coalesce(F.try_element_at(F.filter(runs, lambda r: F.length(r).isin(*POSTCODE_LENGTHS)), F.lit(-1)), F.lit(""))


def city_token(folded: Column) -> Column:
    """Of the comma-separated parts that can be a place, the last but one, or the only one, or empty."""
    marks = F.array(*map(F.lit, NOT_CITY))
    parts = F.transform(F.filter(F.split(folded, ","), lambda p: ~p.rlike("[0-9]")), clean)
    keep = F.filter(parts, lambda p: (p != "null") & (F.length(F.replace(p, F.lit(" "), F.lit(""))) > 2) & ~F.arrays_overlap(words(p), marks))
    return F.coalesce(F.try_element_at(keep, F.lit(-2)), F.try_element_at(keep, F.lit(1)), F.lit(""))


def id_list(text: Column) -> Column:
    """Distinct trimmed ids of a comma-separated list, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""))


def join_ids(ids: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(ids)), ",")


def grams(text: Column, n: int = 3) -> Column:
    """Character n-grams of each word between two spaces."""

    def of(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(word) + 3 - n, F.lit(1))), lambda i: F.substring(padded, i, F.lit(n)))

    return F.flatten(F.transform(words(text), of))


def number_set(runs: Column) -> Column:
    """Distinct numbers without leading zeros."""
    return F.array_distinct(F.transform(runs, lambda x: F.when(F.ltrim(x, F.lit("0")) == "", F.lit("0")).otherwise(F.ltrim(x, F.lit("0")))))


def order_key(seed: int | str, salt: str, key: Column) -> Column:
    """A pseudorandom order that any engine with md5 can make again."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(salt), F.trim(key)))
