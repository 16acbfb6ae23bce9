"""Tokens of any script, and phrases of a lexicon, with their places.

Scripts that part words by blanks give runs of letters, digits and marks. Those that don't (``UNSPACED``) give one token
for each grapheme cluster, so a text of theirs can be searched and aligned like any other; in mixed text every run goes by
its own script. Places are code points, ends exclusive. Running sums over a text's tokens are what array functions lack,
so places are found in Arrow batches; ``tokens`` gives the words alone and stays in generated code.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

#: Scripts that write words without blanks between them, and the sound marks that belong to kana.
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan")
SOUND_MARKS = "ーｰ"

_JAVA = "[" + "".join(f"\\p{{Is{s}}}" for s in UNSPACED) + SOUND_MARKS + "]"
_PYTHON = "[" + "".join(f"\\p{{{s}}}" for s in UNSPACED) + SOUND_MARKS + "]"
_PATTERN = "(?={0})\\X|(?:(?!{0})[\\p{{L}}\\p{{N}}_]\\p{{M}}*)+"
#: The same tokens, as this module's expressions say them best: one for texts without unspaced letters, which most are.
_UNSPACED = regex.compile(_PYTHON)
_SPACED_TOKEN = regex.compile("((?:[\\p{L}\\p{N}_]\\p{M}*)+)")
_ANY_TOKEN = regex.compile(f"(?V1)((?:[[\\p{{L}}\\p{{N}}_]--{_PYTHON}]\\p{{M}}*)+|(?={_PYTHON})\\X)")
#: Texts of plain letters alone (no marks, nothing that a cluster goes on with) have the same tokens by quicker expressions.
_SINGLE = "\u3041-\u3096\u30a1-\u30fa\u30fc\u3400-\u4dbf\u4e00-\u9fff"
_BEYOND_LATIN = re.compile("[^\0-\u02ff\u2010-\u2027]")
_BEYOND_PLAIN = re.compile(f"[^\0-\u02ff\u2010-\u2027\u3000-\u3002{_SINGLE}]")
_LATIN_TOKEN = re.compile("(\\w+)")
_PLAIN_TOKEN = re.compile(f"([{_SINGLE}]|[^\\W{_SINGLE}]+)")
#: Characters of text that are cut at a time: what a worker holds as Python objects does not grow with a batch's texts.
_AT_ONCE = 1 << 20
_PLACED = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())])
_PLACES = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("text", StringType())]))


def tokens(text: Column) -> Column:
    """array<string>: the tokens of a text, in order."""
    return F.regexp_extract_all(text, F.lit(_PATTERN.format(_JAVA)), 0)


_COUNTED = pa.struct([("text", pa.string()), ("n", pa.int32()), ("start", pa.int32())])
_COUNTS = ArrayType(StructType([StructField("text", StringType()), StructField("n", IntegerType()), StructField("start", IntegerType())]))


def _lists(columns: list[list], ends: list[int], kind: pa.StructType, missing: pa.Array) -> pa.Array:
    """Flat columns as an array of lists of structs, cut at ``ends``."""
    flat = [pa.array(x, f.type) for x, f in zip(columns, kind)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(flat, fields=list(kind)), mask=missing)


def _listed(rows: list[list[tuple] | None], kind: pa.StructType) -> pa.Array:
    """Rows of tuples as an array of lists of structs."""
    flat = [x for row in rows for x in row or ()]
    ends = [0, *accumulate(len(row or ()) for row in rows)]
    return _lists([[x[k] for x in flat] for k in range(kind.num_fields)], ends, kind, pa.array([row is None for row in rows]))


def _portions(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The texts of all batches in order, about ``_AT_ONCE`` bytes at a time (one text at least)."""
    for batch in batches:
        till = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch), 0).cast(pa.int64())).to_pylist()
        begin = 0
        for k in range(1, len(batch) + 1):
            if k == len(batch) or till[k] - (till[begin - 1] if begin else 0) > _AT_ONCE:
                yield batch.slice(begin, k - begin)
                begin = k


def _pattern(text: str) -> re.Pattern | regex.Pattern:
    if not _BEYOND_LATIN.search(text):
        return _LATIN_TOKEN
    if not _BEYOND_PLAIN.search(text):
        return _PLAIN_TOKEN
    return _ANY_TOKEN if _UNSPACED.search(text) else _SPACED_TOKEN


def _cut(text: str) -> tuple[list[int], list[int], list[str]]:
    """(starts, ends, tokens) of one text."""
    parts = _pattern(text).split(text)  # what is between tokens, and tokens, in turn
    at = list(accumulate(map(len, parts)))
    return at[:-1:2], at[1::2], parts[1::2]


def split(text: str) -> list[tuple[int, int, str]]:
    """(start, end, token) of each token of one text."""
    return list(zip(*_cut(text)))


@F.arrow_udf(_PLACES)
def tokens_at(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The tokens of each text with their places; null for null."""
    for batch in _portions(batches):
        # flat lists of numbers and words: millions of small tuples would keep the collector busy
        starts, stops, words, ends = [], [], [], [0]
        for text in batch.to_pylist():
            for held, found in zip((starts, stops, words), _cut(text or "")):
                held.extend(found)
            ends.append(len(words))
        yield _lists([starts, stops, words], ends, _PLACED, batch.is_null())


@F.arrow_udf(_COUNTS)
def token_counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The distinct lower-cased tokens of each text, with their number and first place; null for null."""
    for batch in _portions(batches):
        words, counts, firsts, ends = [], [], [], [0]
        for text in batch.to_pylist():
            starts, _, cased = _cut(text or "")
            found = list(map(str.lower, cased))
            n, first = Counter(found), dict(zip(reversed(found), reversed(starts)))
            words.extend(n)
            counts.extend(n.values())
            firsts.extend(map(first.__getitem__, n))
            ends.append(len(words))
        yield _lists([words, counts, firsts], ends, _COUNTED, batch.is_null())


#: Phrases that one automaton may hold: what is sent to every executor.
MOST_PHRASES = 1 << 20


class Phrases:
    """Phrases of a lexicon, found all at once by one automaton that reads a text a single time.

    ``whole`` asks for word boundaries at both ends, ``fold`` compares lower-cased forms. Of the phrases, blank ones are
    left out. The automaton is built once in each Python worker, from the phrases in the closure, so their number is
    bounded (``MOST_PHRASES``); longer lists belong into a join on tokens.
    """

    def __init__(self, phrases: list[str], whole: bool = True, fold: bool = True):
        self.phrases, self.whole, self.fold = [p for p in dict.fromkeys(phrases) if p.strip()], whole, fold
        if len(self.phrases) > MOST_PHRASES:
            raise ValueError(f"more than {MOST_PHRASES} phrases")

    def _automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for p in self.phrases:
            key = _folded(p) if self.fold else p
            out.add_word(key, (len(key), [*(out.get(key, (0, []))[1]), p]))
        out.make_automaton()
        return out

    def at(self, text: Column) -> Column:
        """array<struct(start, end, text)>: every occurrence by its end, then the longest first; ``text`` is the phrase."""
        made = []

        @F.arrow_udf(_PLACES)
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            if not made:
                made.append(self._automaton() if self.phrases else None)
            for batch in batches:
                yield _listed([None if t is None else self._found(made[0], t) for t in batch.to_pylist()], _PLACED)

        return run(text)

    def _found(self, automaton: ahocorasick.Automaton | None, text: str) -> list[tuple[int, int, str]]:
        if automaton is None:
            return []
        read, out = _folded(text) if self.fold else text, []
        for last, (size, names) in automaton.iter(read):
            begin, end = last + 1 - size, last + 1
            if not self.whole or not (begin and _in_word(read, begin - 1) and _in_word(read, begin) or end < len(read) and _in_word(read, end - 1) and _in_word(read, end)):
                out.extend((begin, end, name) for name in names)
        return sorted(out, key=lambda x: (x[1], x[0], x[2]))


def _folded(text: str) -> str:
    """Lower case, letter by letter: places stay what they are."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _in_word(text: str, at: int) -> bool:
    return text[at].isalnum() or text[at] == "_"


def phrase_counts(rows: DataFrame, text: str, phrases: Phrases, *keys: str) -> DataFrame:
    """(keys, phrase, hits): occurrences of each phrase; those without any are left out."""
    found = rows.select(*keys, F.explode(phrases.at(F.col(text))).alias("p"))
    return found.groupBy(*keys, F.col("p.text").alias("phrase")).agg(F.count("*").alias("hits"))
