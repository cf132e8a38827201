"""Array helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also when used in inner lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def prefix_starts(sizes: Column, block: int = 128) -> Column:
    """Sum of all earlier elements, per element; blocks keep it far from quadratic."""

    def starts(s: Column) -> Column:
        return F.transform(
            s["sizes"],
            lambda x, i: total(F.slice(s["blocks"], F.lit(1), F.floor(i / block).cast("int")))
            + total(F.slice(s["sizes"], (i - i % block + 1).cast("int"), (i % block).cast("int"))),
        )

    def with_blocks(arr: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor(F.size(arr) / block).cast("int")),
            lambda b: total(F.slice(arr, b * block + 1, F.lit(block))),
        )
        return bind(F.struct(arr.alias("sizes"), blocks.alias("blocks")), starts)

    return bind(sizes, with_blocks)


def running_max(values: Column) -> Column:
    """Largest element up to each place, nulls passed over; steps of 1, 2, 4, … places, so a long
    array costs its length times the logarithm of it."""
    doublings = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int")), lambda i: F.pow(2, i).cast("int"))

    def step(so_far: Column, by: Column) -> Column:
        return F.transform(so_far, lambda x, i: F.greatest(x, F.get(so_far, i - by)))

    return F.aggregate(doublings, values, step)


def struct_of_arrays(col: Column, dtype: T.DataType) -> Column:
    """Turn an array of structs into a struct of arrays, at every depth.

    A null element counts as an empty record, so it yields nulls. Other values stay
    as they are.
    """
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        return F.struct(
            *[
                struct_of_arrays(_field(col, f.name), T.ArrayType(f.dataType)).alias(f.name)
                for f in dtype.elementType.fields
            ]
        )
    return col


def _field(array: Column, name: str) -> Column:
    return F.transform(array, lambda e: e[name])
