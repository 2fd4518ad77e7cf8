"""N-dimensional arrays as struct(shape, data) with data in row-major order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_1d(values: Column) -> Column:
    return F.when(values.isNotNull(), F.struct(F.array(F.size(values)).alias("shape"), values.alias("data")))


def array_2d(rows: Column) -> Column:
    """NULL for a ragged value; use ``is_rectangular`` to reject it."""
    return F.when(is_rectangular(rows), F.struct(F.array(F.size(rows), F.coalesce(F.size(F.get(rows, F.lit(0))), F.lit(0))).alias("shape"), F.flatten(rows).alias("data")))


def array_3d(planes: Column) -> Column:
    """NULL for a value whose planes or rows differ in size; use ``is_cuboid`` to reject it."""
    first = F.get(planes, F.lit(0))
    shape = F.array(F.size(planes), F.coalesce(F.size(first), F.lit(0)), F.coalesce(F.size(F.get(first, F.lit(0))), F.lit(0)))
    return F.when(is_cuboid(planes), F.struct(shape.alias("shape"), F.flatten(F.flatten(planes)).alias("data")))


def is_cuboid(planes: Column) -> Column:
    first = F.get(planes, F.lit(0))
    return F.forall(planes, lambda p: (F.size(p) == F.size(first)) & F.forall(p, lambda r: F.size(r) == F.size(F.get(first, F.lit(0)))))


def is_rectangular(rows: Column) -> Column:
    return F.forall(rows, lambda r: F.size(r) == F.size(F.get(rows, F.lit(0))))


def dims(value: Column) -> Column:
    return F.size(value["shape"])


def elements(value: Column) -> Column:
    """How many elements the shape asks for."""
    return F.aggregate(value["shape"], F.lit(1), lambda n, s: n * s)


def _place(value: Column, index: tuple[int | Column, ...]) -> tuple[Column, Column]:
    """Where an element lies in the data, and whether its indices are in bounds."""
    at, inside = F.lit(0), dims(value) == len(index)
    for d, i in enumerate(index):
        i = F.lit(i) if isinstance(i, int) else i
        size = F.get(value["shape"], F.lit(d))
        at, inside = at * size + i, inside & (i >= 0) & (i < size)
    return at, inside


def element(value: Column, *index: int | Column) -> Column:
    """One element by its indices; NULL out of bounds."""
    at, inside = _place(value, index)
    return F.when(inside, F.get(value["data"], at))


def with_element(value: Column, x: Column, *index: int | Column) -> Column:
    """The array with one element replaced; NULL out of bounds."""
    at, inside = _place(value, index)
    data = F.transform(value["data"], lambda v, i: F.when(i == at, x).otherwise(v))
    return F.when(inside, F.struct(value["shape"].alias("shape"), data.alias("data")))


def filled(value: Column, x: Column) -> Column:
    """An array of the same shape with every element x."""
    return F.when(value.isNotNull(), F.struct(value["shape"].alias("shape"), F.array_repeat(x, elements(value)).alias("data")))


def of_shape(shape: Column, data: Column) -> Column:
    """An array of a shape from elements appended in row-major order; NULL unless they fill it."""
    n = F.aggregate(shape, F.lit(1), lambda a, s: a * s)
    return F.when(F.size(data) == n, F.struct(shape.alias("shape"), data.alias("data")))


def reshaped(value: Column, *shape: int) -> Column:
    """The same elements under another shape; NULL if the counts differ."""
    n = 1
    for s in shape:
        n *= s
    return F.when(F.size(value["data"]) == n, F.struct(F.array(*map(F.lit, shape)).alias("shape"), value["data"].alias("data")))
