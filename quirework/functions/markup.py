"""Text made safe for what it is written into: typesetter source, quoted strings, HTML, fenced blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.functions.text import strip

#: Characters with a meaning in typesetter text, and in HTML with what stands for them.
TYPESET = "\\#[]$*_`@<>"
HTML = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]
FENCE, BROKEN_FENCE = "```", "` ` `"
WATERMARK = "Shamela.org"


def typeset_text(text: Column) -> Column:
    """Every character that has a meaning there behind a backslash."""
    return F.regexp_replace(text, "([\\\\#\\[\\]$*_`@<>])", "\\\\$1")


def typeset_string(text: Column) -> Column:
    """For between double quotes."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def html(text: Column) -> Column:
    """For HTML text and attributes."""
    for char, name in HTML:
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def fenced(text: Column) -> Column:
    """For a fenced block: no fence within; null is empty."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit(FENCE), F.lit(BROKEN_FENCE))


def is_margin(text: Column, y0: Column, y1: Column, page_height: Column, head: float = 38, foot: float = 36) -> Column:
    """Header or footer block: empty, near an edge of the page, with the print's watermark, or digits only."""
    compact = F.replace(text, F.lit(" "), F.lit(""))
    return (strip(text) == "") | (y0 < head) | (y1 > page_height - foot) | F.contains(compact, F.lit(WATERMARK)) | compact.rlike("^[0-9٠-٩]+$")
