"""Tables of JSON responses (``key, text``) flattened with declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexigrid.operators.freq import text_types
from lexigrid.plans.scale import explode_kept

# Field names must equal the reference's.
ITEM = "struct<Word:array<struct<n:string>>,frq:bigint,rel:double,fpm:double,reltt:double>"
DESC = "struct<arg:string,nicearg:string,rel:double,size:bigint>"
SEGMENTS = "array<struct<str:string,class:string>>"
LINE = f"struct<toknum:bigint,Refs:array<string>,Left:{SEGMENTS},Kwic:{SEGMENTS},Right:{SEGMENTS}>"
FREQS = (
    f"Blocks array<struct<Head:array<struct<id:string>>,Items:array<{ITEM}>>>, Desc array<{DESC}>, "
    "request struct<corpname:string,fmaxitems:string>"
)
STRUCTURES = (
    "structures array<struct<name:string,label:string,size:string,attributes:array<struct<"
    "name:string,label:string,size:bigint,dynamic:string,fromattr:string>>>>, "
    "request struct<struct_attr_stats:string>"
)
SIZES = "sizes map<string,string>"
TEXT_TYPES = "Blocks array<struct<Line:array<struct<name:string>>>>"
SUGGESTIONS = "suggestions array<string>"
VIEW = (
    f"concsize bigint, fromp int, request struct<corpname:string,q:array<string>>, Desc array<{DESC}>, "
    f"Lines array<{LINE}>"
)


def _parsed(responses: DataFrame, schema: str) -> DataFrame:
    return responses.select("key", F.from_json("text", schema).alias("j"))


def block_heads(blocks: Column) -> Column:
    """Each block's first head id; null when no block has heads."""
    ids = F.transform(blocks, lambda b: F.get(b["Head"], F.lit(0))["id"])
    return F.when(F.exists(blocks, lambda b: F.coalesce(F.size(b["Head"]), F.lit(0)) > 0), ids)


def item_values(items: Column) -> Column:
    """Items with their measures and the words of each joined by ``|``."""
    return F.transform(
        items,
        lambda i: F.struct(
            i["frq"].alias("frq"),
            i["rel"].alias("rel"),
            i["reltt"].alias("reltt"),
            i["fpm"].alias("fpm"),
            F.array_join(F.transform(i["Word"], lambda w: w["n"]), "|").alias("value"),
        ),
    )


def freqs_table(responses: DataFrame) -> DataFrame:
    """Frequency responses to one row per item; the first query step describes all."""
    parsed = _parsed(responses, FREQS).withColumn("heads", block_heads(F.col("j.Blocks")))
    blocks = F.transform(
        F.filter("j.Blocks", lambda b: F.col("heads").isNotNull()),
        lambda b: F.struct(F.get(b["Head"], F.lit(0))["id"].alias("attribute"), item_values(b["Items"]).alias("items")),
    )
    per_block = explode_kept(parsed, blocks, "b", "key", F.col("j.Desc").alias("d"), F.col("j.request").alias("r"))
    first = F.get(F.col("d"), F.lit(0))
    rows = explode_kept(
        per_block,
        F.col("b.items"),
        "i",
        "key",
        F.col("b.attribute").alias("attribute"),
        first.alias("d"),
        "r",
    )
    return rows.select(
        "key",
        "i.frq",
        "i.rel",
        "i.reltt",
        "i.fpm",
        "i.value",
        "attribute",
        "d.arg",
        "d.nicearg",
        "r.corpname",
        F.col("d.rel").alias("total_fpm"),
        F.col("d.size").alias("total_frq"),
        "r.fmaxitems",
    )


def wordlist_table(responses: DataFrame, item: str = "str string, frq bigint") -> DataFrame:
    """Word-list items with their attribute: per response, most frequent first.

    ``item`` declares the fields; decimals are rounded to 2, halves to even.
    """
    schema = f"Items array<struct<{item}>>, request struct<wlattr:string>"
    rows = explode_kept(_parsed(responses, schema), F.col("j.Items"), "i", "key", F.col("j.request.wlattr").alias("attribute"))
    flat = rows.select("key", "i.*", "attribute")
    rounded = [
        F.bround(f.name, 2).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in flat.schema.fields
    ]
    # ties by the other fields, so that the order is total
    rest = [c for c in flat.columns if c not in ("key", "frq")]
    return flat.select(*rounded).orderBy("key", F.desc("frq"), *rest)


def structures_table(responses: DataFrame, strict: bool = True) -> DataFrame:
    """Structures and their attributes; a structure without attributes is left out.

    Needs ``struct_attr_stats=1`` in the request; with ``strict`` its absence is an error.
    """
    parsed = _parsed(responses, STRUCTURES)
    right = F.coalesce(F.col("j.request.struct_attr_stats") == "1", F.lit(False))
    if strict:
        message = F.lit("attribute sizes are missing: ask for them with struct_attr_stats=1")
        parsed = parsed.withColumn("j", F.when(right, F.col("j")).otherwise(F.raise_error(message)))
    else:
        parsed = parsed.filter(right)
    structures = explode_kept(parsed, F.col("j.structures"), "s", "key")
    rows = explode_kept(structures, F.col("s.attributes"), "a", "key", F.col("s.name").alias("structure"))
    return rows.select("key", "structure", F.col("a.name").alias("attribute"), "a.size")


def sizes_table(responses: DataFrame) -> DataFrame:
    """Structure sizes, ``count`` cut from the names."""
    pairs = F.map_entries("j.sizes")
    rows = explode_kept(_parsed(responses, SIZES), pairs, "e", "key")
    return rows.select(
        "key",
        F.replace("e.key", F.lit("count"), F.lit("")).alias("structure"),
        F.col("e.value").cast("bigint").alias("size"),
    )


def structure_names(responses: DataFrame) -> DataFrame:
    """The structure names of a response in one string."""
    names = F.transform(
        F.map_keys("j.sizes"), lambda k: F.replace(k, F.lit("count"), F.lit(""))
    )
    return _parsed(responses, SIZES).select("key", F.array_join(names, " ").alias("structures"))


def text_types_list(
    responses: DataFrame, drops: tuple[str, ...] = ("doc.wordcount",), position: str = ""
) -> DataFrame:
    """Text types of a response, without dropped prefixes, with an optional position."""
    names = F.transform("j.Blocks", lambda b: F.get(b["Line"], F.lit(0))["name"])
    rows = explode_kept(_parsed(responses, TEXT_TYPES), names, "attribute", "key")
    return text_types(rows, drops, position, "key")


def attr_vals_table(responses: DataFrame) -> DataFrame:
    return explode_kept(_parsed(responses, SUGGESTIONS), F.col("j.suggestions"), "value", "key")


def line_annotations(line: Column) -> Column:
    """Tokens, tags and lemmas of a line, and whether any attribute segment is malformed.

    An attribute segment reads ``/tag/lemma``; digits are cut from tags.
    """
    segments = F.concat(line["Left"], line["Kwic"], line["Right"])
    attrs = F.transform(F.filter(segments, lambda s: s["class"] == "attr"), lambda s: s["str"])
    plain = F.filter(segments, lambda s: F.coalesce(s["class"] != "attr", F.lit(True)))
    pattern = r"/([^/]+)/(.+)"

    def tag(a: Column) -> Column:
        return F.trim(F.regexp_replace(F.regexp_extract(a, pattern, 1), r"\p{Nd}", ""))

    return F.struct(
        line["toknum"].alias("toknum"),
        F.transform(plain, lambda s: F.trim(s["str"])).alias("token"),
        F.transform(attrs, tag).alias("pos"),
        F.transform(attrs, lambda a: F.trim(F.regexp_extract(a, pattern, 2))).alias("lemma"),
        F.exists(attrs, lambda a: ~a.rlike(pattern)).alias("malformed"),
    )


def annotations(responses: DataFrame, strict: bool = True) -> DataFrame:
    """View responses to annotated lines: maps by index, corpus, references, steps."""
    parsed = _parsed(responses, VIEW)
    lines = explode_kept(
        parsed, F.col("j.Lines"), "line", "key", F.col("j.request.corpname").alias("corpus"), F.col("j.Desc").alias("desc")
    )
    rows = lines.select(
        "key", "corpus", "desc", F.col("line.Refs").alias("refs"), line_annotations(F.col("line")).alias("a")
    )
    if strict:
        rows = rows.withColumn(
            "a",
            F.when(F.col("a.malformed"), F.raise_error(F.lit("can't split tag and lemma"))).otherwise(F.col("a")),
        )
    return rows.select(
        "key",
        "a.toknum",
        *[indexed(F.col(f"a.{c}")).alias(c) for c in ("token", "pos", "lemma")],
        "corpus",
        "refs",
        "desc",
        *([] if strict else ["a.malformed"]),
    )


def indexed(values: Column) -> Column:
    """Array to a map keyed by index strings."""
    return F.map_from_entries(
        F.transform(values, lambda v, i: F.struct(i.cast("string").alias("key"), v.alias("value")))
    )


def refs_table(responses: DataFrame, ttypes: list[str]) -> DataFrame:
    """Token number and text types of each line; ``refs`` must be ``#`` then the types."""
    lines = explode_kept(_parsed(responses, VIEW), F.col("j.Lines"), "line", "key")
    number = F.regexp_replace(F.get("line.Refs", F.lit(0)), "#", "").cast("bigint")
    return lines.select(
        "key",
        number.alias("#"),
        *[F.get("line.Refs", F.lit(i)).alias(t) for i, t in enumerate(ttypes, 1)],
    )


def meta_table(files: DataFrame) -> DataFrame:
    """Metadata files (``key, value``) to ``url, status, reason, headers, ske_error``."""
    from lexigrid.sources.responses import META

    return files.select("key", F.from_json("value", META).alias("m")).select("key", "m.*")
