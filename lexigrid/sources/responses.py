"""Stored responses: scanning, appending, writing, guarding."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import MapType

from lexigrid.functions.text import strip_bom

META = "url string, status int, reason string, headers map<string,string>, ske_error string"
FORMATS = {"json", "csv", "xml", "txt"}


def read_response_files(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, value`` of a directory of ``<key>.<format>`` and ``<key>.meta.json``."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"), "value"
    )


def responses_of(files: DataFrame) -> DataFrame:
    """Pair bodies with metadata; a response counts only if both files exist."""
    key = F.substring_index("file_name", ".", 1)
    is_meta = F.col("file_name").endswith(".meta.json")
    meta = files.filter(is_meta).select(key.alias("key"), F.from_json("value", META).alias("m"))
    bodies = files.filter(~is_meta).select(
        key.alias("key"),
        F.substring_index("file_name", ".", -1).alias("format"),
        strip_bom("value").alias("text"),
    )
    return bodies.join(meta, "key").select("key", "format", "text", "m.*")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return responses_of(read_response_files(spark, path))


def keepable(responses: DataFrame) -> DataFrame:
    """What may be stored: JSON without an error, and everything else."""
    return responses.filter(F.col("ske_error").isin("", "unimplemented"))


def new_responses(responses: DataFrame, store: DataFrame) -> DataFrame:
    """Keepable responses whose key is not stored yet, one per key: the first by all other columns.

    Maps, which have no order, are compared by their sorted entries.
    """
    rest = [c for c in responses.columns if c != "key"]
    kinds = dict(zip(responses.columns, responses.schema))
    order = [
        F.array_sort(F.map_entries(c)).alias(c) if isinstance(kinds[c].dataType, MapType) else F.col(c) for c in rest
    ]
    unseen = keepable(responses).join(store.select("key"), "key", "left_anti")
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return unseen.groupBy("key").agg(first.alias("r")).select("key", "r.*")


def open_store(spark: SparkSession, path: str, like: DataFrame | None = None, buckets: int = 256) -> DataFrame:
    """The store at ``path``: a table in buckets by ``key``, sorted within each file.

    ``like`` (rows with its columns) and the number of buckets are needed where there is no store
    yet; the number is kept next to the data. A join on ``key`` needs no shuffle of the store, and
    a filter on given keys reads only their buckets. Choose so many buckets that one of them, at
    the size the store is to reach, is a task's work.
    """
    name = _store_table(path)
    if not spark.catalog.tableExists(name):
        kept = _kept_form(spark, path)
        if kept is None:
            if like is None:
                raise ValueError(f"there is no store at {path}")
            columns = ["key", *[c for c in like.columns if c != "key"]]
            kept = [buckets, ", ".join(f"`{c}` {like.schema[c].dataType.simpleString()}" for c in columns)]
            form = spark.createDataFrame([tuple(kept)], "buckets int, columns string")
            form.coalesce(1).write.mode("errorifexists").json(f"{path}/{FORM}")
        place = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({kept[1]}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {kept[0]} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)


#: Spark's listings skip what begins with an underscore
FORM = "_form"
#: so many keys are looked up by value, more of them by a join
LOOKED_UP = 1000


def _store_table(path: str) -> str:
    return f"store_{hashlib.md5(path.encode()).hexdigest()}"


def _kept_form(spark: SparkSession, path: str) -> list | None:
    try:
        row = spark.read.schema("buckets int, columns string").json(f"{path}/{FORM}").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return list(row)


def stored(store: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of a store for a table of keys, each row once.

    A few keys (1,000 at most) become a filter, which reads only their buckets and row groups; more
    of them meet the store bucket by bucket.
    """
    few = keys.select("key").filter("key IS NOT NULL").distinct().limit(LOOKED_UP + 1).collect()
    if len(few) <= LOOKED_UP:
        return store.filter(F.col("key").isin([row["key"] for row in few]))
    return store.join(keys.select("key"), "key", "left_semi")


def append_new(spark: SparkSession, responses: DataFrame, path: str, buckets: int = 256) -> None:
    """Append to the store at ``path``; it is made on first use.

    Each call adds one file to each bucket that it has new keys for.
    """
    store = open_store(spark, path, responses, buckets)
    kept = _kept_form(spark, path)
    seen = stored(store.select("key"), responses)
    fresh = new_responses(responses, seen).select(store.columns)
    # the same hash as that of the buckets, so that every bucket is written by one task
    fresh.repartition(kept[0], "key").write.insertInto(_store_table(path))
    spark.catalog.refreshTable(_store_table(path))


def write_result(df: DataFrame, path: str, fmt: str) -> None:
    """Write a result as json, csv, xml or txt (one tab-separated line per row)."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {sorted(FORMATS)}: {fmt}")
    if fmt == "txt":
        df.select(rendered(df, "txt").alias("value")).write.text(path)
    elif fmt == "csv":
        df.write.csv(path, header=True)
    elif fmt == "xml":
        df.write.xml(path, rowTag="row")
    else:
        df.write.json(path)


def rendered(df: DataFrame, fmt: str) -> Column:
    """One row as text in a result format."""
    row = F.struct(*df.columns)
    if fmt == "json":
        return F.to_json(row)
    if fmt == "csv":
        return F.to_csv(row)
    if fmt == "xml":
        return F.to_xml(row, {"indent": "", "rowTag": "row"})
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])


def require_format(responses: DataFrame, fmt: str = "json", strict: bool = True) -> DataFrame:
    """Keep responses of one format; with ``strict`` any other one is an error."""
    right = (F.col("format") == fmt) & F.coalesce(
        F.contains(F.try_element_at("headers", F.lit("Content-Type")), F.lit(f"/{fmt}")), F.lit(False)
    )
    if not strict:
        return responses.filter(right)
    message = F.concat(F.lit(f"needs a {fmt} response, got "), "format")
    return responses.withColumn(
        "text", F.when(right, F.col("text")).otherwise(F.raise_error(message))
    )
