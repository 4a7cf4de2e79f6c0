"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def route_code(col: str) -> Column:
    """Zero-padded to two characters; longer codes stay whole (``lpad`` would cut them)."""
    c = F.col(col).cast("string")
    return F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)


def direction_name(direction: str) -> Column:
    return F.when(F.col(direction) == 1, "outbound").otherwise("inbound")


def variant_key(direction: str, variant: str) -> Column:
    return F.concat_ws("_", direction_name(direction), F.col(variant).cast("string"))


def format_pct(col: str | Column) -> Column:
    """One decimal; exact ties go to the even digit, as in Python's ``.1%``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNotNull(), F.format_string("%.1f%%", F.bround(c.cast("double") * 100, 1)))


def parse_pct(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.rtrim(c, F.lit("%")).try_cast("double") / 100


def unescape_html(c: Column) -> Column:
    """Numbered entities and the common named ones; the ampersand comes last so nothing is unescaped twice."""
    # A numbered ampersand becomes the named one, which waits for the last step.
    c = F.regexp_replace(c, r"&#0*38;|&#[xX]0*26;", "&amp;")
    pieces = F.split(F.regexp_replace(c, r"(&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});)", "\u0000$1\u0000"), "\u0000")

    def piece(p: Column) -> Column:
        digits = F.regexp_extract(p, r"^&#([0-9]{1,7});$", 1)
        hexed = F.regexp_extract(p, r"^&#[xX]([0-9a-fA-F]{1,6});$", 1)
        code = F.when(digits != "", digits.try_cast("int")).when(hexed != "", F.conv(hexed, 16, 10).try_cast("int"))
        raw = F.unhex(F.lpad(F.hex(code), 8, "0"))
        sound = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(sound, F.decode(raw, "UTF-32")).otherwise(p)

    c = F.when(F.contains(c, F.lit("&#")), F.array_join(F.transform(pieces, piece), "")).otherwise(c)
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def trimmed(c: Column) -> Column:
    """Blanks of any kind at both ends removed."""
    return F.regexp_replace(c, r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def plain_text(c: Column) -> Column:
    """Markup removed (a bracket may stand in a quoted value), blanks at both ends removed."""
    return F.regexp_replace(F.regexp_replace(c, r"""<(?:"[^"]*"|'[^']*'|[^'">])*>|<[^>]*>""", ""), r"^\s+|\s+$", "")
