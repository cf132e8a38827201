"""Canonical form of nested JSON values, and of what they are made of."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexigrid.functions.arrays import bind
from lexigrid.functions.text import BLANKS
from lexigrid.functions.udfs import sorted_json


def strip(text: Column) -> Column:
    """Trim every kind of blank."""
    return F.btrim(text, F.lit(BLANKS))


def json_string(text: Column) -> Column:
    """Quoted JSON string; characters beyond ASCII stay as they are."""
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    short = {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
    escaped = out
    for code in range(32):
        char = chr(code)
        escaped = F.replace(escaped, F.lit(char), F.lit(short.get(char, f"\\u{code:04x}")))
    guarded = F.when(text.rlike(r"[\x00-\x1f]"), escaped).otherwise(out)
    return F.concat(F.lit('"'), guarded, F.lit('"'))


def number_text(token: Column) -> Column:
    """Whole numbers as written; others with the fewest digits, and an exponent from 1e16 up and below 1e-4."""

    def written(shown: Column) -> Column:
        """From ``d.dddE±x`` or ``ddd.ddd``."""
        sign = F.when(shown.startswith("-"), "-").otherwise("")
        mantissa = F.regexp_replace(F.regexp_extract(shown, r"^-?([0-9.]+)", 1), r"\.0$", "")
        power = F.regexp_extract(shown, r"E(-?[0-9]+)$", 1).try_cast("int")
        digits = F.replace(mantissa, F.lit("."), F.lit(""))
        whole = F.concat(F.rpad(digits, power + 1, F.lit("0")), F.lit("."))
        rest = F.substr(digits, power + 2)
        large = F.concat(whole, F.when(rest == "", "0").otherwise(rest))
        two = F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0"))
        scientific = F.concat(mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"), two)
        return (
            F.when(power.isNull(), shown)
            .when((power >= 0) & (power < 16), F.concat(sign, large))
            .when(power == -4, F.concat(sign, F.lit("0.000"), digits))
            .otherwise(F.concat(sign, scientific))
        )

    return (
        F.when(token == "-0", "0")
        .when(token.rlike(r"^-?[0-9]+$") | token.rlike(r"^-?(0|[1-9][0-9]{0,6})\.(0|[0-9]{0,6}[1-9])$"), token)
        .otherwise(bind(token.try_cast("double").cast("string"), written))
    )


def nested_json(text: Column, sort: bool = True) -> Column:
    """A JSON value with names and strings stripped, objects in order of name and lists in order of
    value, ``", "`` and ``": "`` between.

    Numbers (true is 1, false 0) are ordered by size, strings by code point, lists item by item,
    and values of different kinds as null, numbers, strings, lists, objects; equal values keep their
    order. Of names that become equal the last one counts. With ``sort=False`` lists keep their
    order. The text must be valid JSON.
    """
    return F.get(nested_texts(F.array(text), sort), F.lit(0))


def nested_texts(texts: Column, sort: bool = True) -> Column:
    """:func:`nested_json` of each text of an array; nulls pass through."""
    return sorted_json(sort, BLANKS)(texts)
