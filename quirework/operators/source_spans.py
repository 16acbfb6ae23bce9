"""Spans of a passage that a proposal may point at, and proposals brought into shape by them.

Spans are found by rules in a fixed order and numbered as found; a proposal names them by number, so its segments hold the
passage's own words whatever a model returned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.annotations import SCRIPTURE
from quirework.operators.spans import sentence_window, spans_of, stripped

#: Patterns and openers of spans, in the order in which they are looked for.
BRACED = r"[}]\s*[^{}]{8,700}?\s*[{]"
SPAN_OPENERS = ["قال تعالى", "قوله تعالى", "فقال تعالى", "قال اللّٰه", "قال الله"]
REPORT_BEGINS = ["قال رسول اللّٰه", "قال رسول الله", "وقال صلى اللّٰه عليه وسلم", "وقال صلى الله عليه وسلم", "وكان صلى اللّٰه عليه وسلم يقول", "وكان صلى الله عليه وسلم يقول"]
REPORT_REST = r"[^.؟؛\n]{12,900}(?:[.؟؛]|$)"
PRAYER_BEGINS = ["اللهم", "اللَّهُمَّ"]
PRAYER_REST = r"[^.؟؛*\n]{10,900}(?:[.؟؛*]|$)"
QUOTE_PHRASES = ["قال القسطلاني", "قال السخاوي", "قال الشيخ", "قال ابن حجر", "قال النووي", "نقل الشيخ", "نقل العلامة", "نقل القسطلاني", "ونقل"]
SHORT_OPENERS = ["بسم", "اللهم", "اللَّهُمَّ"]
POEM_SECTION = "قصيدة"

_FOUND = "array<struct<start:int,end:int,kind:string,reason:string>>"


def _any(words: list[str]) -> str:
    return f"(?:{'|'.join(words)})"


def _found(start: Column, end: Column, kind: Column | str, reason: Column | str) -> Column:
    word = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), word(kind).alias("kind"), word(reason).alias("reason"))


def _when(test: Column, span: Column) -> Column:
    none = F.array().cast(_FOUND)
    return F.when(F.coalesce(test, F.lit(False)), F.array(span)).otherwise(none)


def source_spans(text: Column, section: Column | None = None, most: int = 18) -> Column:
    """array<struct(span_id, start, end, kind, reason, text)>: short whole passage, braced quotations, openers (not within 80
    characters of a braced one), reports, prayers, sentences with a quoting phrase, poem. Equal ranges count once."""
    marks = F.transform(spans_of(text, T.SPACE.join(BRACED.split(r"\s")), "ayah"), lambda s: stripped(text, s["start"] + 1, s["end"] - 1))
    found = T.bind(marks, lambda braced: _candidates(text, braced, section))
    bounded = F.transform(found, lambda s: F.struct(stripped(text, s["start"], s["end"]).alias("b"), s["kind"].alias("kind"), s["reason"].alias("reason")))
    real = F.filter(bounded, lambda s: s["b"]["text"] != "")
    before = lambda held, s, i: F.exists(F.slice(held, F.lit(1), i), lambda o: (o["b"]["start"] == s["b"]["start"]) & (o["b"]["end"] == s["b"]["end"]))
    fresh = T.bind(real, lambda held: F.filter(held, lambda s, i: ~before(held, s, i)))
    return F.transform(
        F.slice(fresh, 1, most),
        lambda s, i: F.struct(
            F.concat(F.lit("S"), (i + 1).cast("string")).alias("span_id"),
            s["b"]["start"].alias("start"),
            s["b"]["end"].alias("end"),
            s["kind"].alias("kind"),
            s["reason"].alias("reason"),
            s["b"]["text"].alias("text"),
        ),
    )


def _candidates(text: Column, braced: Column, section: Column | None) -> Column:
    """All spans in the order of the rules, with blanks at their ends and equal ones among them."""
    opened = []
    for opener in SPAN_OPENERS:
        at = F.instr(text, F.lit(opener)) - 1
        rest = F.substring(text, at + len(opener) + 1, F.length(text))
        reach = F.length(F.regexp_extract(rest, "^[^.؟؛\n*]*[.؟؛]?", 0))
        opened.append(_when(F.contains(text, F.lit(opener)) & ~F.exists(braced, _near(at)), _found(at, F.least(at + len(opener) + reach, at + 700), "ayah", f"quran_signal:{opener}")))
    # a quick search for what a pattern begins with, before the pattern itself is tried everywhere
    any_of = lambda words: reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))
    by_pattern = lambda p, begins, kind, reason: F.when(any_of(begins), F.transform(spans_of(text, p, kind), lambda s: _found(s["start"], s["end"], kind, reason))).otherwise(F.array().cast(_FOUND))
    quoted = []
    for phrase in QUOTE_PHRASES:
        at = F.instr(text, F.lit(phrase)) - 1
        window = sentence_window(text, at, at + len(phrase))
        quoted.append(_when(F.contains(text, F.lit(phrase)), _found(window["start"], window["end"], "quote", f"quote_source:{phrase}")))
    bare = T.strip(text)
    short = F.when(F.coalesce(*(F.when(bare.startswith(o), True) for o in SHORT_OPENERS), F.lit(False)), "matn").otherwise("body")
    poem = F.lit(False) if section is None else F.contains(section, F.lit(POEM_SECTION)) & F.contains(text, F.lit("\n"))
    return F.concat(
        _when(F.length(bare) <= 260, _found(F.lit(0), F.length(text), short, "short_whole_passage")),
        F.transform(braced, lambda s: _found(s["start"], s["end"], "ayah", "brace_quran_candidate")),
        *opened,
        by_pattern(f"{_any(REPORT_BEGINS)}{REPORT_REST}", REPORT_BEGINS, "hadith", "hadith_opener"),
        by_pattern(f"{_any(PRAYER_BEGINS)}{PRAYER_REST}", PRAYER_BEGINS, "dua", "dua_opener"),
        *quoted,
        _when(poem, _found(F.lit(0), F.least(F.length(text), F.lit(1200)), "poem", "poetry_section")),
    )


def _near(at: Column, reach: int = 80):
    return lambda s: F.abs(at - s["start"]) < reach


def display_bounds(text: Column, kind: Column, start: Column, end: Column) -> Column:
    """struct(start, end) of what is shown for a span: of scripture, the braces of an old print around it too."""
    left = F.length(F.regexp_extract(F.substring(text, F.lit(1), start), f"[}}]{T.SPACE}*$", 0))
    right = F.length(F.regexp_extract(F.substring(text, end + 1, F.length(text)), f"^{T.SPACE}*[{{]", 0))
    scripture = kind.isin("ayah", "ayat")
    return F.struct(F.when(scripture, start - left).otherwise(start).alias("start"), F.when(scripture, end + right).otherwise(end).alias("end"))


def normalized_segments(text: Column, segments: Column, spans: Column) -> Column:
    """Segments (kind, span_id, ref, review_required, text) with the words of the span they name.

    Scripture is always for review; a span that does not exist, and words that the passage does not hold, are errors.
    """

    def shape(s: Column, spans: Column) -> Column:
        named = F.coalesce(s["span_id"], F.lit("")) != ""
        span = F.get(F.filter(spans, lambda x: x["span_id"] == s["span_id"]), F.lit(0))
        words = F.when(named, F.coalesce(span["text"], F.lit(""))).otherwise(F.coalesce(s["text"], F.lit("")))
        foreign = (words != "") & (F.instr(text, words) == 0)
        lost = named & span.isNull()
        given = F.coalesce(s["text"], F.lit(""))
        error = F.when(foreign, "segment_text_not_exact_source_substring").when(lost, "invalid_source_span_id")
        return F.struct(
            s["kind"].alias("kind"),
            s["span_id"].alias("span_id"),
            s["ref"].alias("ref"),
            (F.coalesce(s["review_required"], F.lit(False)) | lost | foreign | F.coalesce(s["kind"].isin(*SCRIPTURE), F.lit(False))).alias("review_required"),
            words.alias("text"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            error.alias("validation_error"),
            F.when(error.isNotNull(), error).when(named & (given != "") & (given != words), "segment_text_ignored_for_span_id").alias("warning"),
        )

    return T.bind(spans, lambda held: F.transform(segments, lambda s: shape(s, held)))
