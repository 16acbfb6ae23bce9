"""Scalar text functions as Column expressions: no Python on the executors, so they stay inside generated code.

Character classes are spelt out: Java's ``\\s`` and ``\\w`` cover ASCII only, and texts hold Arabic and no-break spaces.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bidirectional controls, a glyph that stands for nothing, the stretching mark, blanks, letters, marks.
BIDI = "[\\x{200E}\\x{200F}\\x{202A}-\\x{202E}\\x{2066}-\\x{2069}\\x{FEFF}]"
BAD_GLYPH = "᧦"
TATWEEL = "ـ"
SPACE = "[\\t\\n\\x0B\\f\\r \\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
#: The same blanks, as text.
BLANKS = "".join(map(chr, [*range(9, 14), 32, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
ARABIC_LETTER = "\\x{0621}-\\x{064A}\\x{066E}-\\x{06D3}"
ARABIC_MARK = "\\x{0610}-\\x{061A}\\x{064B}-\\x{065F}\\x{0670}\\x{06D6}-\\x{06ED}"
JOINED_MARK = "\\x{064B}-\\x{065F}\\x{0670}"
ARABIC_DIGITS, DIGITS = "٠١٢٣٤٥٦٧٨٩", "0123456789"
STOPS = "،؛:؟.!"
RUNTIME_ERROR = "(?i)runtime\\s+(?:VBScript|Script)|Microsoft.*error|Subscript.*out\\s+of\\s+range|/Tafseer/"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used: inside lambdas an expression is computed anew for
    every element, and no optimiser takes it out."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def replace_all(text: Column, steps: list[tuple[str, str]]) -> Column:
    """Regular expression replacements, one after the other; their order matters."""
    return reduce(lambda col, step: F.regexp_replace(col, step[0], step[1]), steps, text)


def strip(text: Column) -> Column:
    """Remove blanks of any kind at both ends (SQL ``trim`` knows the space only); only the ends are read."""
    return F.btrim(text, F.lit(BLANKS))


def normalize_space(text: Column) -> Column:
    """Runs of blanks become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def to_ascii_digits(text: Column) -> Column:
    return F.translate(text, ARABIC_DIGITS, DIGITS)


def to_arabic_digits(text: Column) -> Column:
    return F.translate(text, DIGITS, ARABIC_DIGITS)


def clean_extracted(text: Column) -> Column:
    """Undo traces of page extraction: controls, no-break spaces, detached marks, blanks before punctuation."""
    bare = F.translate(F.regexp_replace(text, BIDI, ""), " " + BAD_GLYPH, " ")
    return F.trim(
        replace_all(
            bare,
            [
                (f"{SPACE}+", " "),
                (f"([{ARABIC_LETTER}]) +([{JOINED_MARK}])", "$1$2"),
                (f"([{JOINED_MARK}]) +([{JOINED_MARK}])", "$1$2"),
                (f" +([{STOPS}])", "$1"),
            ],
        )
    )


def match_key(text: Column) -> Column:
    """Key for comparing titles: no marks, ASCII digits, letters and digits only."""
    folded = to_ascii_digits(F.regexp_replace(clean_extracted(text), f"[{ARABIC_MARK}]", ""))
    return F.regexp_replace(folded, "[^\\p{L}\\p{N}_]", "")


def truncate(text: Column, limit: int, suffix: str = "…") -> Column:
    """Normalized text of ``limit`` characters at most before the suffix takes the last one's place.

    Mostly the beginning of a text is enough to tell; the whole is normalized only where it is not.
    """
    flat, head = normalize_space(text), normalize_space(F.substring(text, 1, 8 * limit))
    cut = lambda x: F.concat(F.rtrim(F.substring(x, 1, limit - 1)), F.lit(suffix))
    return F.when(F.length(head) > limit, cut(head)).when(F.length(flat) <= limit, flat).otherwise(cut(flat))


def replace_stars(text: Column) -> tuple[Column, Column]:
    """(text, runs): runs of stars become an Arabic comma; a text that is one run becomes empty."""
    runs = F.regexp_count(text, F.lit("\\*+"))
    tidy = replace_all(text, [(f"{SPACE}*\\*+{SPACE}*", "، "), (f"(?:،{SPACE}*){{2,}}", "، "), (f"{SPACE}+،", "،")])
    return F.when(runs == 0, text).when(text.rlike(f"^{SPACE}*\\*+{SPACE}*$"), "").otherwise(strip(tidy)), runs


def count_pattern(text: Column, pattern: str, literal: bool = False) -> Column:
    """Occurrences of a pattern; a literal is quoted."""
    return F.regexp_count(text, F.lit(f"\\Q{pattern}\\E" if literal else pattern)).cast("long")


def is_noise(text: Column) -> Column:
    """Digits and punctuation only, once spaces are left out; a text without anything else is none."""
    return to_ascii_digits(F.replace(text, F.lit(" "), F.lit(""))).rlike("^[0-9.()،؛:؟!\\-ـ]+$")


def is_punctuation(text: Column) -> Column:
    """Marks and blanks only, once stripped, and at least one."""
    return strip(text).rlike("^[،,؛;:.}{\\[\\]()ـ*\\- ]+$")


def has_page_noise(text: Column, y0: Column, y1: Column, page_height: Column, head: float = 38, foot: float = 36) -> Column:
    """Header or footer block: empty, near an edge of the page, or digits only."""
    return (strip(text) == "") | (y0 < head) | (y1 > page_height - foot) | is_noise(text)


def arabic_letters(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[\\x{0621}-\\x{064A}]")).cast("long")


def block_id(work: Column, page: Column, number: Column) -> Column:
    return F.format_string("%s.p%04d.b%03d", work, page, number)


def passage_id(prefix: Column | str, number: Column) -> Column:
    return F.format_string("%s-%05d", F.lit(prefix) if isinstance(prefix, str) else prefix, number)


def stable_id(work: Column, kind: Column, key: Column) -> Column:
    """The same id for the same (work, kind, key) in every run."""
    return F.concat_ws("__", work, kind, F.substring(F.sha1(F.concat_ws(":", work, kind, key)), 1, 16))


def slug(text: Column) -> Column:
    return F.translate(F.replace(text, F.lit("/"), F.lit("__")), ": .", "---")


def length_ratio(target: Column, source: Column) -> Column:
    return F.round(F.length(target) / F.greatest(F.length(source), F.lit(1)), 2)


def length_outlier(target: Column, source: Column) -> Column:
    """Too short or too long for its source: below 0.25 or above 4 times, or above 400 characters for a source under 80."""
    n, m = F.length(source), F.length(target)
    ratio = m / F.greatest(n, F.lit(1))
    return F.when(n >= 80, (ratio < 0.25) | (ratio > 4.0)).otherwise(m > 400)


def salvage_json(text: Column) -> Column:
    """A JSON object as a variant: the whole text, else from the first ``{`` to the last ``}``; null if neither parses."""
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(F.regexp_extract(text, "(?s)\\{.*\\}", 0)))


def title_prefix(first_id: Column, work: Column) -> Column:
    """Capital letters that begin the first passage id, else the initials of the work id's first four parts."""
    parts = F.slice(F.split(work, "[-_]"), 1, 4)
    initials = F.upper(F.array_join(F.transform(parts, lambda p: F.substring(p, 1, 1)), ""))
    found = F.regexp_extract(first_id, "^([A-Z]+)", 1)
    return F.when(found != "", found).when(initials != "", initials).otherwise("IMG")


def strip_title(text: Column) -> Column:
    """Punctuation and blanks off both ends of a title."""
    return F.regexp_replace(text, "^[ .:\\-؛،]+|[ .:\\-؛،]+$", "")


def word_tokens(text: Column) -> Column:
    """Runs of letters and digits of any script."""
    return F.regexp_extract_all(text, F.lit("[\\p{L}\\p{N}_]+"), 0)
