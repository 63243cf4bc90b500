"""Text, number, date and JSON column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date patterns.
ISO_DATE = "yyyy-MM-dd"
CLOCK = "HH:mm:ss"
DAY_MONTH_YEAR = "dd-MMM-yyyy"
COMPACT_DATE = "yyMMdd"
COMPACT_TIME = "HHmm"
ISSUE_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS'Z'"
REPLY_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSS'+05:30'"


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def nz(c: Column) -> Column:
    """NULL as empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def oracle_concat(*parts: Column | str) -> Column:
    """Concatenation in which NULL counts as empty text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else nz(p) for p in parts])


def in_parentheses(c: Column) -> Column:
    """Text inside the first pair of parentheses, NULL when there is none."""
    return F.nullif(F.regexp_extract(c, r"\(([^)]+)\)", 1), F.lit(""))


def squeeze(c: Column) -> Column:
    """Each run of white space becomes one blank."""
    return F.regexp_replace(c, r"\s+", " ")


def split_number(c: Column) -> Column:
    """Three-character prefix, dash, remainder."""
    return F.concat(F.substring(c, 1, 3), F.lit("-"), c.substr(F.lit(4), F.length(c)))


def without_last(c: Column) -> Column:
    return c.substr(F.lit(1), F.length(c) - 1)


def short_upper_date(c: Column) -> Column:
    return F.upper(F.date_format(c, "dd-MMM-yy"))


def whole_days(later: Column, earlier: Column) -> Column:
    """``n Days`` between two timestamps, truncated toward zero."""
    days = F.extract(F.lit("DAY"), later.cast("timestamp_ntz") - earlier.cast("timestamp_ntz"))
    return F.concat(days.cast("int").cast("string"), F.lit(" Days"))


def fixed_three(c: Column) -> Column:
    """Three decimals, no leading zero and no padding: ``.454``, ``2072.920``.

    More than six integer digits do not fit the mask and give a row of ``#``.
    """
    exact = c.cast("decimal(38,3)")
    text = F.regexp_replace(exact.cast("string"), r"^(-?)0\.", "$1.")
    return F.when(F.abs(exact) >= 1_000_000, F.lit("#" * 11)).otherwise(text)


def tonnes(kg: Column) -> Column:
    return (kg / 1000).cast("decimal(18,3)")


def to_boolean(c: Column) -> Column:
    """Accepts the usual words for true and false; other text gives NULL."""
    word = F.lower(F.trim(c))
    return (
        F.when(word.isin("true", "t", "yes", "y", "on", "1"), True)
        .when(word.isin("false", "f", "no", "n", "off", "0"), False)
    )


def address_line(building: Column, street: Column, city: Column, po_box: Column) -> Column:
    """Four parts with one blank between, missing parts as empty text."""
    blank = F.lit(" ")
    return F.concat(nz(building), blank, nz(street), blank, nz(city), blank, nz(po_box))


def full_address(*parts: Column) -> Column:
    """Parts joined by commas, missing parts as empty text."""
    out = []
    for p in parts:
        out += [nz(p), F.lit(",")]
    return F.concat(*out[:-1])


def json_text(c: Column, stamp: str = "yyyy-MM-dd'T'HH:mm:ss") -> Column:
    """JSON text that keeps NULL fields."""
    return F.to_json(
        c, {"ignoreNullFields": "false", "timestampFormat": stamp, "timestampNTZFormat": stamp}
    )


def json_list(c: Column) -> Column:
    return F.from_json(c, "array<string>")


def xml_escape(c: Column) -> Column:
    text = F.replace(nz(c), F.lit("&"), F.lit("&amp;"))
    text = F.replace(text, F.lit("<"), F.lit("&lt;"))
    return F.replace(text, F.lit(">"), F.lit("&gt;"))
