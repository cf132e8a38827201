"""Plan shapes shared by the operators that must hold at any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType


def explode_kept(df: DataFrame, array: Column, alias: str, *keep: str | Column) -> DataFrame:
    """One row per array element.

    The outer form with a filter after it yields the rows of the inner form, but
    keeps the optimizer from adding a ``size(array) > 0`` filter under the
    generator, which would compute the array (a tokenization) a second time.
    """
    return df.select(*keep, F.explode_outer(array).alias(alias)).filter(F.col(alias).isNotNull())


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column behind a generator of one element.

    A filter on the column stays above the generator; over a plain projection it would
    be pushed below, and the column would be computed in both places. For the same
    reason a Python UDF over the column is planned on its own.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def posexplode_kept(
    df: DataFrame, array: Column, alias: str, *keep: str | Column, pos: str = "pos"
) -> DataFrame:
    """Like :func:`explode_kept`, with the 0-based position; runs as generated code."""
    rows = df.select(*keep, F.posexplode_outer(array).alias(pos, alias))
    return rows.filter(F.col(pos).isNotNull())


def running_offsets(
    rows: DataFrame, key: str, size: str | dict[str, str], out: str = "offset", parts: int | None = None
) -> DataFrame:
    """``key``, sizes, and for each size its sum over all smaller keys, for unique keys.

    ``size`` is one column (its sum is called ``out``), or a map from columns to the names of
    their sums. The numbers are computed once and kept; they are dealt out by ranges of the key, each
    range adds up its own, and what came before it is joined on by the number of the range: one row
    for each of the ``parts`` (the session's shuffle partitions). Only keys and sizes are moved: join
    what else is needed on.
    """
    sizes = {size: out} if isinstance(size, str) else size
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # kept first, since cutting the ranges reads the keys once more
    numbers = materialized(rows.select(key, *sizes))
    # and kept in ranges, so that all that follows sees the same ones
    ranged = materialized(numbers.repartitionByRange(parts, key).withColumn("_part", F.spark_partition_id()))
    totals = ranged.groupBy("_part").agg(*[F.sum(s).alias(s) for s in sizes])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_part", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_{s}") for s in sizes])
    before = Window.partitionBy("_part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumns({name: F.coalesce(F.sum(s).over(before), F.lit(0)) for s, name in sizes.items()})
    placed = inside.join(F.broadcast(starts), "_part")
    return placed.select(key, *sizes, *[(F.col(name) + F.col(f"_{s}")).alias(name) for s, name in sizes.items()])


def materialized(df: DataFrame) -> DataFrame:
    """Compute a table once that several parts of a plan read, and cut its lineage.

    It goes to the folder of ``spark.checkpoint.dir``. Only a local session may leave that unset (then
    the folder lies in its warehouse): on a cluster the executors have to share it.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
        context.setCheckpointDir(folder)
    return df.checkpoint()


def shuffles_ended(df: DataFrame) -> None:
    """Let files of shuffles that nothing refers to any more go now, not when memory runs low.

    Spark drops them once the driver's collector has found their plans gone, for which a driver
    with room to spare may take half an hour.
    """
    df.sparkSession.sparkContext._jvm.System.gc()


BITMAP_WORDS = 1 << 14


def bitmap(keys: DataFrame, column: str, words: int = BITMAP_WORDS) -> Column:
    """The hashes of a column as bits of an array of fixed size, a scalar subquery.

    Rows are tested with :func:`may_hold` before they are moved. However many keys there are, it
    has ``words`` numbers; with very many it lets more rows pass, but never drops one of a key.
    """
    bit = F.pmod(F.xxhash64(column), F.lit(64 * words))
    set_bits = keys.filter(F.col(column).isNotNull()).select(
        F.shiftright(bit, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int")).alias("m")
    )
    empty = keys.sparkSession.range(words).select(F.col("id").alias("w"), F.lit(0).cast("bigint").alias("m"))
    joined = set_bits.unionByName(empty).groupBy("w").agg(F.bit_or("m").alias("m"))
    return joined.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "m"))), lambda x: x["m"])).scalar()


def may_hold(bits: Column, key: Column, words: int = BITMAP_WORDS) -> Column:
    """False only if the key is not one of those that the bitmap was made of."""
    bit = F.pmod(F.xxhash64(key), F.lit(64 * words))
    word = F.get(bits, F.shiftright(bit, 6).cast("int"))
    return F.call_function("shiftright", word, (bit % 64).cast("int")).bitwiseAND(F.lit(1)) == 1


def top_per_group(
    df: DataFrame, by: list[str], order: list[Column], n: int, rank: str = "rank", salts: int = 64
) -> DataFrame:
    """First ``n`` rows of each group in a total order.

    A row can only be among the group's first ``n`` if it is among the first ``n``
    of its salted part, so a hot group is cut down in parallel before its final
    sort sees at most ``salts * n`` rows.
    """
    parts = df.withColumn("_salt", _salt(df, by, salts))
    first = Window.partitionBy(*by, "_salt").orderBy(*order)
    kept = parts.withColumn("_part", F.row_number().over(first)).filter(F.col("_part") <= n)
    whole = Window.partitionBy(*by).orderBy(*order)
    return (
        kept.withColumn(rank, F.row_number().over(whole).cast("bigint"))
        .filter(F.col(rank) <= n)
        .drop("_salt", "_part")
    )


def smallest(df: DataFrame, draw: str, order: list[str], n: int) -> DataFrame:
    """The ``n`` rows with the smallest hex digest ``draw``, in no order.

    However large ``n`` is, the rows never meet in one task: they are counted per leading
    digits, whole buckets are kept, and only the bucket at the edge is ranked.
    """
    digits = F.conv(F.substring(draw, 1, 4), 16, 10).cast("bigint")
    bucketed = df.withColumn("_digits", digits)
    counts = bucketed.groupBy("_digits").agg(F.count("*").alias("_n"))
    sums = running_offsets(counts, "_digits", "_n", out="_start", parts=8).filter(F.col("_start") < n)
    # at most 16 ** 4 rows
    placed = bucketed.join(F.broadcast(sums), "_digits")
    inside = placed.filter(F.col("_start") + F.col("_n") <= n)
    edge = placed.filter(F.col("_start") + F.col("_n") > n).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_digits").orderBy(draw, *order))
    )
    edge = edge.filter(F.col("_rank") <= n - F.col("_start")).drop("_rank")
    return inside.unionByName(edge).drop("_digits", "_n", "_start")


def salted_join(
    many: DataFrame, one: DataFrame, on: list[str], how: str = "inner", salts: int | None = None
) -> DataFrame:
    """Join in which a key of ``many`` may hold a large share of its rows.

    ``one`` has unique keys (or few rows per key) and is repeated once per salt; a hot key of
    ``many`` is spread over as many tasks. If ``one`` is small the planner broadcasts it. The
    default is a salt for every four shuffle partitions of the session, eight at least.
    """
    if salts is None:
        salts = max(8, int(many.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    copies = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = many.withColumn("_salt", _salt(many, on, salts))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def join_hot(many: DataFrame, one: DataFrame, key: str, share: int = 1024) -> DataFrame:
    """Left join on one column with a table of unique keys, however unevenly ``many`` holds them.

    Fewer than ``share`` keys can hold more than a ``share``-th of the rows each: their values are
    broadcast, and their rows are dealt out evenly in the shuffle in which all other keys meet.
    """
    counts = many.groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    hot = counts.filter(F.col("_n") * share > total).select(key)
    values = [c for c in one.columns if c != key]
    few = hot.join(one, key, "left").select(key, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in values])
    marked = many.join(F.broadcast(few), key, "left")
    salted = marked.withColumn("_salt", F.when(F.col("_hot"), 1 + _salt(many, [key], 65521)).otherwise(0))
    found = salted.join(one.withColumn("_salt", F.lit(0)), [key, "_salt"], "left")
    return found.select(*many.columns, *[F.coalesce(f"_hot_{c}", c).alias(c) for c in values])


def _salt(df: DataFrame, keys: list[str], salts: int) -> Column:
    """A part number from the row's other plain values, so that a retry repeats it."""
    plain = [
        f.name
        for f in df.schema.fields
        if f.name not in keys and not isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))
    ]
    spread = F.xxhash64(*plain) if plain else F.monotonically_increasing_id()
    return F.pmod(spread, F.lit(salts)).cast("int")
