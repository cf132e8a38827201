"""Tables of calls: ``call_id, call_type, params map<string,array<string>>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexigrid.functions.request import call_key, canonical_json, key_text, normalize_params, normalized_entries, step_kind
from lexigrid.functions.text import rule_kind
from lexigrid.plans.scale import explode_kept, salted_join, top_per_group, with_once

# Must equal the reference's.
FORMATS = ["json", "xml", "csv", "txt"]
REQUIRED = {
    "AttrVals": ["corpname", "avattr"],
    "Collx": ["corpname", "q"],
    "CorpInfo": ["corpname"],
    "ExtractKeywords": ["corpname", "ref_corpname"],
    "Freqs": ["corpname", "q", "fcrit"],
    "Freqml": ["corpname", "q", "fcrit"],
    "Freqtt": ["corpname", "q", "fcrit"],
    "Subcorp": ["corpname"],
    "TextTypesWithNorms": ["corpname"],
    "Thes": ["corpname", "lemma"],
    "View": ["corpname"],
    "Wordlist": ["corpname", "wltype", "wlattr"],
    "Wsdiff": ["corpname", "lemma", "lemma2"],
    "Wsketch": ["corpname", "lemma"],
    "Call": ["corpname"],
}


def scalar(params: Column, name: str) -> Column:
    """First value of a parameter, null if absent."""
    return F.get(F.try_element_at(params, F.lit(name)), F.lit(0))


def with_defaults(calls: DataFrame) -> DataFrame:
    """``format=json``, and ``asyn=0`` for View, where not given."""

    def absent(name: str) -> Column:
        return F.coalesce(scalar(F.col("params"), name), F.lit("")) == ""

    def given(name: str, value: str, when: Column) -> Column:
        kept = F.map_filter("params", lambda k, v: k != name)
        return F.when(
            when, F.map_concat(kept, F.create_map(F.lit(name), F.array(F.lit(value))))
        ).otherwise(F.col("params"))

    no_format = ~F.array_contains(F.map_keys("params"), F.lit("format"))
    calls = calls.withColumn("params", given("format", "json", no_format))
    return calls.withColumn("params", given("asyn", "0", (F.col("call_type") == "View") & absent("asyn")))


def validate_calls(calls: DataFrame) -> DataFrame:
    """Add ``error``: empty, or what is wrong with the call."""
    calls = with_defaults(calls)
    table = F.create_map(
        *[c for k, v in REQUIRED.items() for c in (F.lit(k), F.array(*[F.lit(x) for x in v]))]
    )
    required = F.try_element_at(table, F.col("call_type"))
    missing = F.filter(
        required,
        lambda p: F.coalesce(
            F.array_join(F.try_element_at(F.col("params"), p), ""), F.lit("")
        )
        == "",
    )
    form = scalar(F.col("params"), "format")
    return calls.withColumn(
        "error",
        F.when(required.isNull(), F.concat(F.lit("unknown call type: "), "call_type"))
        .when(
            ~F.coalesce(form.isin(FORMATS), F.lit(False)),
            F.concat(F.lit(f"format must be one of {', '.join(FORMATS)}: "), F.coalesce(form, F.lit(""))),
        )
        .when(F.size(missing) > 0, F.concat(F.get(missing, F.lit(0)), F.lit(" parameter missing")))
        .otherwise(F.lit("")),
    )


def normalize_calls(calls: DataFrame, sort_lists: bool = False) -> DataFrame:
    """Strip parameters all through; a column ``kinds`` follows the keys that are kept."""
    if "kinds" not in calls.columns:
        return calls.withColumn("params", normalize_params(F.col("params"), sort_lists))
    entries = with_once(calls, "_entries", normalized_entries(F.col("params"), F.col("kinds"), sort_lists))
    told = F.filter("_entries", lambda e: e["kind"] != "")
    return entries.withColumns(
        {
            "params": F.map_from_entries(F.transform("_entries", lambda e: F.struct(e["key"], e["value"]))),
            "kinds": F.map_from_entries(F.transform(told, lambda e: F.struct(e["key"], e["kind"]))),
        }
    ).drop("_entries")


def with_key(calls: DataFrame, algo: str = "md5", legacy: bool = False) -> DataFrame:
    """Normalize the parameters, fill in the defaults and add ``key``.

    A call with an explicit default and the same call without it have one key. A column
    ``kinds`` (as :func:`lexigrid.sources.calls.calls_of` makes it) tells lists from scalars.
    """
    normal = with_defaults(normalize_calls(calls))
    kinds = F.col("kinds") if "kinds" in calls.columns else None
    text = key_text(F.col("params"), F.col("call_type"), legacy, kinds)
    texts = with_once(normal, "_text", text)
    return texts.withColumn("key", call_key("_text", algo)).drop("_text")


def with_canonical(calls: DataFrame) -> DataFrame:
    kinds = F.col("kinds") if "kinds" in calls.columns else None
    return normalize_calls(calls).withColumn("canonical", canonical_json(F.col("params"), kinds))


def split_cached(calls: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls already answered, and calls still to run, by ``key``."""
    keys = responses.select("key")
    return calls.join(keys, "key", "left_semi"), calls.join(keys, "key", "left_anti")


def dedupe_calls(calls: DataFrame) -> DataFrame:
    """One call per key: the first, with the number of equal ones.

    Equal calls are combined before the shuffle, so a popular call is no hot spot.
    """
    rest = [c for c in calls.columns if c != "key"]
    first = F.min_by(F.struct(*rest), "call_id")
    return calls.groupBy("key").agg(first.alias("c"), F.count("*").alias("n_calls")).select(
        "key", "c.*", "n_calls"
    )


def expand_pages(calls: DataFrame, sizes: DataFrame, max_pages: int = 0) -> DataFrame:
    """One row per page to get: ``fromp`` up to the last page, at most ``max_pages``.

    ``sizes`` has ``key, concsize``. Pages come out in blocks of 10,000, so that no
    row ever holds the list of all pages.
    """
    params = F.col("params")
    first = F.coalesce(scalar(params, "fromp").cast("bigint"), F.lit(1))
    pagesize = F.coalesce(scalar(params, "pagesize").cast("bigint"), F.lit(100))
    sized = salted_join(calls, sizes.select("key", "concsize"), ["key"])
    n_pages = F.ceil(F.col("concsize") / F.col("_pagesize"))
    last = F.when(n_pages == 1, F.col("_first")).otherwise(n_pages)
    if max_pages > 0:
        last = F.least(last, F.col("_first") + (max_pages - 1))
    block = 10_000
    ranged = (
        sized.withColumn("_first", first)
        .withColumn("_pagesize", pagesize)
        .withColumn("_last", last)
        .filter((F.col("concsize") > 0) & (F.col("_first") <= F.col("_last")))
    )
    blocks = ranged.withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_last") - F.col("_first")) / block)))
    )
    start = F.col("_first") + F.col("_block") * block
    return blocks.withColumn(
        "fromp", F.explode(F.sequence(start, F.least(start + (block - 1), F.col("_last"))))
    ).drop("_first", "_pagesize", "_last", "_block")


def expand_by_values(templates: DataFrame, values: DataFrame, block: int = 1000) -> DataFrame:
    """Calls of a template, one per value of its text type, with a ``within`` clause.

    ``templates``: ``call_id, call_type, corpname, attribute, q array<string>``;
    ``values``: ``corpname, attribute, value``. The values of a text type are dealt into lists of
    about ``block``, as many as their number asks for; a template meets each list once and opens it
    on its own row. So neither a list nor a task grows with the number of values.
    """
    keys = ["corpname", "attribute"]
    distinct = values.select(*keys, "value").distinct()
    counts = distinct.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    dealt = salted_join(distinct, counts, keys).withColumn("_block", F.pmod(F.xxhash64("value"), F.col("_blocks")).cast("int"))
    lists = dealt.groupBy(*keys, "_block").agg(F.collect_list("value").alias("_values"))
    spread = salted_join(templates, counts, keys)
    spread = spread.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")
    pairs = spread.join(lists, [*keys, "_block"]).withColumn("value", F.explode("_values")).drop("_values", "_block")
    clause = F.concat(
        F.lit(" within <"),
        F.substring_index("attribute", ".", 1),
        F.lit(" "),
        F.substring_index("attribute", ".", -1),
        F.lit('="'),
        F.col("value"),
        F.lit('" />'),
    )
    q = F.transform(F.col("q"), lambda s, i: F.when(i == 0, F.concat(s, clause)).otherwise(s))
    return pairs.withColumn("q", q)


def calls_by_type(calls: DataFrame, first: int = 3) -> DataFrame:
    """Number of calls per type and the first few of each."""
    totals = calls.groupBy("call_type").agg(F.count("*").alias("total"))
    head = top_per_group(calls.select("call_type", "call_id"), ["call_type"], [F.col("call_id")], first)
    return totals.join(head, "call_type").select("call_type", "total", "rank", "call_id")


def write_by_type(calls: DataFrame, path: str) -> None:
    """Write calls to one folder per type. Folders of types that occur in ``calls`` are replaced,
    all others stay; no type is moved into one task, however many calls it has."""
    calls.write.partitionBy("call_type").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_by_type(spark: SparkSession, path: str, types: list[str] | None = None) -> DataFrame:
    """Calls written by :func:`write_by_type`, of some types only if named: the folders of others
    are not read."""
    calls = spark.read.option("basePath", path).parquet(path)
    calls = calls.withColumn("call_type", F.col("call_type").cast("string"))
    return calls if types is None else calls.filter(F.col("call_type").isin(types))


def step_fields(calls: DataFrame) -> DataFrame:
    """One row per query step: kind, attribute, body and its kind, sample size."""
    numbered = F.transform(
        F.try_element_at("params", F.lit("q")), lambda s, i: F.struct(i.alias("step"), s.alias("text"))
    )
    steps = explode_kept(calls, numbered, "s", "call_id")
    text, kind = F.col("s.text"), step_kind(F.col("s.text"))
    body = F.regexp_extract(text, r"^a[^,]+,(?s)(.*)$", 1)
    return steps.select(
        "call_id",
        F.col("s.step").cast("bigint").alias("step"),
        kind.alias("kind"),
        F.when(kind == "query", F.regexp_extract(text, r"^a([^,]+),", 1)).alias("attribute"),
        F.when(kind == "query", body).alias("body"),
        F.when(kind == "query", rule_kind(body)).alias("rule_kind"),
        # a size beyond 64 bits is null
        F.when(kind == "sample", F.substr(text, F.lit(2)).try_cast("bigint")).alias("sample"),
    )


def call_errors(responses: DataFrame) -> DataFrame:
    """``error`` and ``ok`` per response; bodies other than JSON are not looked into."""
    error = F.when(
        F.col("format") == "json", F.coalesce(F.get_json_object("text", "$.error"), F.lit(""))
    ).otherwise(F.lit("unimplemented"))
    return responses.withColumn("error", error).withColumn(
        "ok", F.col("error").isin("", "unimplemented")
    )


def job_summary(checked: DataFrame) -> DataFrame:
    """Calls in all, and how many ended with each error."""
    counts = checked.groupBy("error").agg(
        F.count("*").alias("n"), F.max((~F.col("ok")).cast("int")).alias("failed")
    )
    # both read all columns, so the total reuses the shuffle of the counts
    sums = counts.agg(F.sum("n").alias("calls"), F.max("failed").alias("failed"))
    total = sums.select(F.struct("calls", "failed")).scalar()
    return (
        counts.withColumn("_all", total)
        .filter(F.col("failed") == 1)
        .select("error", "n", "_all.calls")
    )
