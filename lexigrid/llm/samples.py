"""Bounded samples of labelled rows: the only thing the classifiers of this package learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sample_labels(labels: DataFrame, id_col: str, label: str, per_level: int) -> DataFrame:
    """``_id, _level, _weight``: about ``per_level`` rows of each level, drawn by a hash of the id.

    All labelled rows are counted; a level with fewer rows is taken whole. Weights bring the
    levels back to their shares. Repeated ids count once, with their largest label; null ids
    and null labels do not count. The drawn part has at most about levels x ``per_level`` rows,
    so it may be broadcast.
    """
    each = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_level"))
        .dropna()
        .groupBy("_id")
        .agg(F.max("_level").alias("_level"))
    )
    counts = {r["_level"]: r["count"] for r in each.groupBy("_level").count().collect()}
    if not counts:
        return each.withColumn("_weight", F.lit(1.0))
    draw = F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(
        F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, per_level / n)))]), F.col("_level")
    )
    return each.filter(draw < share).withColumn("_weight", 1.0 / share)
