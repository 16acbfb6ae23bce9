"""Line cleaning with a count for every kind of change, and the patterns that a cleaned line should no longer show.

Each step is a projection of its own: it counts on, and replaces in, the text that the steps before it left, so a line is
read by each pattern twice, however many steps there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.sequence import first_k

#: Headings; steps in order, as (counter, pattern, replacement); ``\s`` stands for every Unicode blank.
HEADING = r"^(#{1,6})\s+(.+?)\s*$"
FIRST_STEPS = [
    ("nbsp_replaced", "\\x{A0}", " "),
    ("bad_glyph_removed", "᧦", ""),
    ("tatweel_removed", "ـ", ""),
]
STEPS = [
    ("common_particle_joined", r"إِ\s+نَّ", "إِنَّ"),
    ("common_particle_joined", r"إِ\s+لا", "إِلا"),
    ("common_particle_joined", r"إِ\s+لى", "إِلى"),
    ("common_particle_joined", r"إِ\s+ذا", "إِذا"),
    ("common_particle_joined", r"إِ\s+ذْ", "إِذْ"),
    ("diacritic_joined", rf"([{T.ARABIC_LETTER}])\s+([{T.ARABIC_MARK}])", "$1$2"),
    ("diacritic_joined", rf"([{T.ARABIC_MARK}])\s+([{T.ARABIC_MARK}])", "$1$2"),
    ("punctuation_spacing_fixed", r"\s+([،؛:؟.!])", "$1"),
    ("paren_spacing_fixed", r"([\(（])\s+", "$1"),
    ("paren_spacing_fixed", r"\s+([\)）])", "$1"),
    ("spaces_collapsed", r"\s{2,}", " "),
]
#: Traces of an older print's markers, and the tidying after them.
PRINT_MARKER_STEPS = [
    (r"ط\([،.]-", "، "),
    (r"ط\([،.]\)", "، "),
    (r"ط\([،.]", "، "),
    (r"-ط\([،.]\)", "، "),
    (r"-ط\([،.]", "، "),
    (r"-\)", "، "),
    (r":\)", ": "),
    (r"\s*-\s*،\s*", "، "),
    (r"\s*،\s*", "، "),
    (r"^(?:،\s*)+", ""),
    (r"(?:\s*،)+$", ""),
    (r"(،\s*){2,}", "، "),
    (r"\s{2,}", " "),
]
#: What is suspicious in a cleaned line.
SUSPICIOUS = [
    ("star_leftover", r"\*"),
    ("legacy_print_marker", r"(?:^|[\s،.؛:])-?ط\([،.]?\)?-?"),
    ("runtime_error", T.RUNTIME_ERROR),
    ("latin_word", r"[A-Za-z]{3,}"),
    ("brace_marker", r"[{}]"),
    ("bidi_control", T.BIDI),
    ("broken_initial_alef", r"ا[أإآ]ل"),
]
#: What a line must show for any step to change it: most lines are read by this pattern only.
_TOUCHED = "|".join(
    [
        T.BIDI,
        "[\\x{A0}᧦ـ*،؛؟\\x{0610}-\\x{06ED}]",
        r"\s{2,}|\s[:.!)）]|[\(（]\s|^\s|\s$|-\)|:\)",
        "(?i:runtime|microsoft|subscript|/tafseer/)",
    ]
)
#: Rules that a profile may add.
PRINT_MARKERS, DROP_ERRORS = "fix_legacy_print_markers", "drop_runtime_error_lines"
#: Counters that a report shows at 0 too; the others only where they are above.
ALWAYS = ["stars_replaced", *dict.fromkeys(name for name, _, _ in STEPS)]


def _blanks(pattern: str) -> str:
    """``\\s`` as the class of Unicode blanks, within a class and outside of one."""
    return pattern.replace(r"[\s", f"[{T.SPACE}").replace(r"\s", T.SPACE)


def fix_print_markers(text: Column) -> Column:
    return T.strip(T.replace_all(text, [(_blanks(p), new) for p, new in PRINT_MARKER_STEPS]))


def profile_rules(profiles: dict[str, list[str]], name: str) -> list[str]:
    """The default profile's rules and the named one's after them, each once; an unknown name gives the default."""
    return list(dict.fromkeys([*profiles.get("default", []), *profiles.get(name, [])]))


def clean_lines(rows: DataFrame, line: str = "line", rules: tuple[str, ...] = (DROP_ERRORS,)) -> DataFrame:
    """``rows`` with ``cleaned`` and ``changes`` (a struct of counters).

    The marker of a heading stays and its title is cleaned. A line that a rule drops becomes empty and keeps its counts.
    """
    mark = F.regexp_extract(F.col(line), _blanks(HEADING), 1)
    out = rows.withColumn("_mark", mark)
    out = out.withColumn("_text", F.when(F.col("_mark") != "", F.regexp_extract(F.col(line), _blanks(HEADING), 2)).otherwise(F.col(line)))
    out = out.withColumn("_touched", F.col("_text").rlike(_blanks(_TOUCHED)))
    text, touched, names = F.col("_text"), F.col("_touched"), []

    def step(counter: str, count: Column, new: Column) -> None:
        nonlocal out
        names.append((counter, f"_n{len(names)}"))
        out = out.withColumns({names[-1][1]: F.when(touched, count.cast("long")).otherwise(0), "_text": F.when(touched, new).otherwise(text)})

    step("bidi_controls_removed", text.rlike(T.BIDI), F.regexp_replace(text, T.BIDI, ""))
    for counter, pattern, new in FIRST_STEPS:
        step(counter, F.regexp_count(text, F.lit(pattern)), F.regexp_replace(text, pattern, new))
    tidy, runs = T.replace_stars(text)
    step("stars_replaced", runs, tidy)
    for counter, pattern, new in STEPS:
        step(counter, F.regexp_count(text, F.lit(_blanks(pattern))), F.regexp_replace(text, _blanks(pattern), new))
    for rule in rules:
        if rule == PRINT_MARKERS:
            out = out.withColumn("_fixed", F.when(touched, fix_print_markers(text)).otherwise(text))
            step(rule, text != F.col("_fixed"), F.col("_fixed"))
            out = out.drop("_fixed")
        elif rule == DROP_ERRORS:
            step(rule, text.rlike(T.RUNTIME_ERROR), F.when(text.rlike(T.RUNTIME_ERROR), "").otherwise(text))
    sums: dict[str, Column] = {}
    for counter, c in names:
        sums[counter] = sums[counter] + F.col(c) if counter in sums else F.col(c)
    whole = F.when(F.col("_mark") != "", F.rtrim(F.concat_ws(" ", "_mark", T.strip(text)))).otherwise(T.strip(text))
    changes = F.struct(*(n.alias(counter) for counter, n in sums.items()))
    return out.select(*rows.columns, whole.alias("cleaned"), changes.alias("changes"))


def change_report(cleaned: DataFrame, *keys: str) -> DataFrame:
    """(keys, counter, n): the counters of ``clean_lines`` summed, and the number of lines."""
    counters = cleaned.schema["changes"].dataType.names
    sums = [F.coalesce(F.sum(f"changes.{c}"), F.lit(0)).alias(c) for c in counters]
    flat = cleaned.select(*keys, "changes").groupBy(*keys).agg(F.count("*").alias("lines"), *sums)
    return flat.unpivot(list(keys), ["lines", *counters], "counter", "n").where((F.col("n") > 0) | F.col("counter").isin("lines", *ALWAYS))


def suspicious(rows: DataFrame, work: str, line_no: str, line: str, limit: int | None = 250) -> DataFrame:
    """(work, line_no, pattern, text): one row for each suspicious pattern of a line, the text cut at 220 characters.

    With ``limit``, a line adds its rows only while those of the lines before it are fewer.
    """
    hits = F.array_compact(F.array(*(F.when(F.col(line).rlike(_blanks(p)), F.lit(name)) for name, p in SUSPICIOUS)))
    found = rows.select(work, line_no, F.substring(line, 1, 220).alias("text"), hits.alias("hits")).where(F.size("hits") > 0)
    if limit is not None:
        found = first_k(found, [work], [line_no], max(limit, 1))  # each line has a hit, so no other line counts
        before = Window.partitionBy(work).orderBy(line_no).rowsBetween(Window.unboundedPreceding, -1)
        found = found.withColumn("_before", F.coalesce(F.sum(F.size("hits")).over(before), F.lit(0))).where(F.col("_before") < limit)
    return found.select(work, line_no, F.explode("hits").alias("pattern"), "text")
