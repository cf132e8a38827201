"""The Arrow UDFs for which Spark has no built-in.

Each is made inside a function, so that it is shipped to the workers by value and
they need not have this package installed.
"""

from __future__ import annotations

import hashlib
import re
import struct
import unicodedata
from collections.abc import Callable
from json.decoder import scanstring
from json.encoder import encode_basestring

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StringType


def unicode_normalize(form: str) -> Callable[[Column], Column]:
    """NFC, NFD, NFKC or NFKD; nulls pass through."""

    @F.pandas_udf(StringType())
    def normalized(text: pd.Series) -> pd.Series:
        return text.map(lambda t: unicodedata.normalize(form, t), na_action="ignore")

    return normalized


def blake2b_32(text: Column) -> Column:
    """First 32 hex digits of BLAKE2b."""

    @F.pandas_udf(StringType())
    def hashed(values: pd.Series) -> pd.Series:
        return values.map(lambda t: hashlib.blake2b(t.encode()).hexdigest()[:32], na_action="ignore")

    return hashed(text)


def sorted_json(sort: bool, blanks: str) -> Callable[[Column], Column]:
    """Canonical texts of arrays of nested JSON values (see :func:`lexigrid.functions.nested.nested_json`).

    One pass over the tokens with a stack of open containers, so of any depth. An item of a list that
    is sorted has a rank, whose order as a string is the order of the values.
    """
    token = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[{}\[\]]|[^\s{}\[\],:"]+', re.DOTALL)
    whole = re.compile(r"-?[0-9]+")
    infinite = {"inf": "Infinity", "-inf": "-Infinity"}

    def decoded(t: str) -> str:
        out = scanstring(t, 1, False)[0].strip(blanks)
        # half of a surrogate pair is no character
        return out if out.isascii() else out.encode("utf-8", "replace").decode()

    def number(t: str) -> str:
        if whole.fullmatch(t):
            return "0" if t == "-0" else t
        out = repr(float(t))
        return infinite.get(out, out)

    def number_rank(value: float) -> str:
        (bits,) = struct.unpack(">Q", struct.pack(">d", value + 0.0))
        return f"1{bits ^ (0xFFFFFFFFFFFFFFFF if bits >> 63 else 1 << 63):016x}"

    def scalar(t: str, ranked: bool) -> tuple[str, str]:
        if t[0] == '"':
            s = decoded(t)
            return ("2" + s.replace("\0", "\0\1") + "\0\0" if ranked else ""), encode_basestring(s)
        if t == "null":
            return "0", t
        if t == "true" or t == "false":
            return (number_rank(float(t == "true")) if ranked else ""), t
        return (number_rank(float(t)) if ranked else ""), number(t)

    def closed(items: list, is_object: bool) -> tuple[str, str]:
        if is_object:
            # of equal names the last one counts
            fields = sorted(dict(items).items())
            text = "{" + ", ".join([f"{encode_basestring(n)}: {v}" for n, v in fields]) + "}"
            return "4" + text, text
        if sort:
            items.sort(key=lambda item: item[0])
        return "3" + "".join([r for r, _ in items]) + "\0", "[" + ", ".join([v for _, v in items]) + "]"

    def canonical(text: str) -> str:
        stack, items, is_object, name = [], [], False, None
        for t in token.findall(text):
            if t in "{[":
                stack.append((items, is_object, name))
                items, is_object, name = [], t == "{", None
                continue
            if t in "}]":
                rank, shown = closed(items, is_object)
                items, is_object, name = stack.pop()
            elif is_object and name is None:
                name = decoded(t)
                continue
            else:
                rank, shown = scalar(t, sort and not is_object)
            items.append((name, shown) if is_object else (rank, shown))
            name = None
        return items[0][1]

    @F.pandas_udf(ArrayType(StringType()))
    def nested(values: pd.Series) -> pd.Series:
        return values.map(lambda texts: [None if t is None else canonical(t) for t in texts], na_action="ignore")

    return nested
