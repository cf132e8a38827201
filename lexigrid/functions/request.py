"""Column functions over request parameters, URLs and JSON bodies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexigrid.functions.arrays import bind
from lexigrid.functions.nested import json_string, nested_texts, strip
from lexigrid.functions.udfs import blake2b_32

PARAMS = "map<string,array<string>>"
# Must equal the reference's.
CREDENTIALS = ["api_key", "username"]


def normalized_entries(params: Column, kinds: Column | None = None, sort_lists: bool = False) -> Column:
    """``key, value, kind`` of each parameter, keys and values stripped, nested values (kind
    ``json``) all through; of keys that become equal the last one counts, with its kind.

    Lists keep their order, which is the order of execution; only the key sorts them.
    """

    def entry(e: Column, nested: Column | None = None) -> Column:
        kind = F.lit("") if kinds is None else F.coalesce(F.try_element_at(kinds, e["key"]), F.lit(""))
        items = F.transform(e["value"], strip)
        plain = F.sort_array(items) if sort_lists else items
        value = plain if nested is None else F.when(nested.isNotNull(), F.array(nested)).otherwise(plain)
        return F.struct(strip(e["key"]).alias("key"), value.alias("value"), kind.alias("kind"))

    def last_ones(es: Column) -> Column:
        def is_last(e: Column, i: Column) -> Column:
            later = F.transform(F.slice(es, i + 2, F.size(es)), lambda x: x["key"])
            return ~F.array_contains(later, e["key"])

        return F.filter(es, is_last)

    entries = F.map_entries(params)
    if kinds is None:
        return bind(F.transform(entries, lambda e: entry(e)), last_ones)
    return bind(F.zip_with(entries, _nested(entries, kinds, sort_lists), entry), last_ones)


def _nested(entries: Column, kinds: Column, sort: bool) -> Column:
    """Per entry its nested value, null for other kinds; calls without any do not go through Python."""
    texts = F.transform(entries, lambda e: F.when(F.try_element_at(kinds, e["key"]) == "json", F.get(e["value"], F.lit(0))))
    given = F.when(F.array_contains(F.map_values(kinds), F.lit("json")), texts)
    return F.coalesce(nested_texts(given, sort), F.array().cast("array<string>"))


def normalize_params(params: Column, sort_lists: bool = False) -> Column:
    """The parameters of :func:`normalized_entries`, none of them nested."""
    entries = normalized_entries(params, None, sort_lists)
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["value"])))


def canonical_json(params: Column, kinds: Column | None = None) -> Column:
    """Ordered JSON of parameters with ``", "`` and ``": "``; lists sorted.

    A one-element array stands for a scalar, unless ``kinds`` (a map from key to kind) says
    ``list``; ``numbers`` is a list whose items are written bare, in order of size, ``null`` a
    parameter without a value, and ``json`` one item of JSON text, which is sorted all through.
    """

    def value(e: Column, nested: Column | None = None) -> Column:
        items = F.transform(F.sort_array(e["value"]), json_string)
        as_list = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
        scalar = F.size(e["value"]) == 1
        if kinds is None:
            return F.when(scalar, F.get(items, F.lit(0))).otherwise(as_list)
        kind = F.coalesce(F.try_element_at(kinds, e["key"]), F.lit(""))
        sized = F.array_sort(F.transform(e["value"], lambda x: F.struct(x.try_cast("double").alias("n"), x.alias("s"))))
        bare = F.concat(F.lit("["), F.array_join(F.transform(sized, lambda x: x["s"]), ", "), F.lit("]"))
        return (
            F.when(kind == "null", F.lit("null"))
            .when(kind == "json", nested)
            .when(kind == "numbers", bare)
            .when(scalar & (kind != "list"), F.get(items, F.lit(0)))
            .otherwise(as_list)
        )

    def shown(e: Column, nested: Column | None = None) -> Column:
        return F.concat(json_string(e["key"]), F.lit(": "), value(e, nested))

    entries = F.array_sort(F.map_entries(params))
    fields = F.transform(entries, lambda e: shown(e)) if kinds is None else F.zip_with(entries, _nested(entries, kinds, True), shown)
    return F.concat(F.lit("{"), F.array_join(fields, ", "), F.lit("}"))


def key_text(
    params: Column,
    call_type: Column | None = None,
    legacy: bool = False,
    kinds: Column | None = None,
) -> Column:
    """The text a call's key is the digest of.

    The call type is part of it, so that calls of different types with equal
    parameters do not share results; ``legacy`` leaves it out.
    """
    if call_type is not None and not legacy:
        own = F.map_filter(params, lambda k, v: k != "call_type")
        params = F.map_concat(own, F.create_map(F.lit("call_type"), F.array(call_type)))
    return canonical_json(params, kinds)


def call_key(text: Column | str, algo: str = "md5") -> Column:
    """32 hex digits; ``blake2b`` reproduces keys made elsewhere, ``md5`` stays in the JVM."""
    return blake2b_32(text) if algo == "blake2b" else F.md5(text)


def redact_url(url: Column | str, names: list[str] | None = None) -> Column:
    """Drop named query parameters; order and repeats of the others stay."""
    url = F.col(url) if isinstance(url, str) else url
    names = CREDENTIALS if names is None else names
    base = F.regexp_extract(url, r"^([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"(#.*)$", 1)
    kept = F.filter(
        F.split(query, "&", -1),
        # names may be encoded; one that cannot be decoded is compared as it stands
        lambda p: (p != "")
        & ~F.coalesce(F.try_url_decode(F.substring_index(p, "=", 1)), F.substring_index(p, "=", 1)).isin(names),
    )
    joined = F.array_join(kept, "&")
    return F.concat(base, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(F.lit("")), fragment)


def redact_json(body: Column | str, names: list[str] | None = None) -> Column:
    """Drop named keys from the ``request`` object of a JSON body.

    Other JSON bodies stay; a body that cannot be parsed, and so cannot be redacted, is null.
    """
    body = F.col(body) if isinstance(body, str) else body
    names = CREDENTIALS if names is None else names
    fields = F.from_json(body, "map<string,variant>")
    request = F.from_json(F.get_json_object(body, "$.request"), "map<string,variant>")
    safe = F.map_filter(request, lambda k, v: ~k.isin(names))
    redacted = F.transform_values(
        fields,
        lambda k, v: F.when(k == "request", F.try_parse_json(F.to_json(safe))).otherwise(v),
    )
    return F.when(request.isNotNull(), F.to_json(redacted)).when(F.try_parse_json(body).isNotNull(), body)


def step_kind(step: Column) -> Column:
    """``query`` (``a<attr>,<body>``), ``sample`` (``r<n>``) or ``other``."""
    return (
        F.when(step.rlike(r"^a[^,]+,"), "query").when(step.rlike(r"^r\p{Nd}+$"), "sample").otherwise("other")
    )
