"""Nested documents: flattening, item access and nesting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions.parsing import as_column


def array_item(array: Column | str, index: int) -> Column:
    """Item by position from 0; NULL beyond the end, also under ANSI."""
    return F.get(array, F.lit(index))


def flatten(
    df: DataFrame,
    array: str,
    fields: Mapping[str, str | Column],
    parent_fields: Mapping[str, str] | None = None,
    item: str = "item",
) -> DataFrame:
    """One row per struct in ``array``.

    ``fields`` maps output names to paths inside the struct (or to expressions
    over ``item.<path>``); ``parent_fields`` maps output names to paths of the
    enclosing row. An empty or NULL array gives no row.
    """
    parents = {name: F.col(path) for name, path in (parent_fields or {}).items()}
    exploded = df.select(F.explode(array).alias(item), *[c.alias(n) for n, c in parents.items()])
    columns = [
        (F.col(f"{item}.{path}") if isinstance(path, str) else path).alias(name)
        for name, path in fields.items()
    ]
    return exploded.select(*columns, *parents)


def nest(
    parents: DataFrame,
    children: DataFrame,
    parent_key: str,
    child_key: str,
    into: str,
    order_by: Sequence[str],
    slice_by: str | Column | None = None,
    slice_name: str = "slice",
) -> DataFrame:
    """One row per parent with its children as an array of structs.

    The inverse of :func:`flatten`. A document is one value, so it must fit in
    one task. Where parents have more children than that, ``slice_by`` (a column
    or expression of the children) makes it one document per parent and slice,
    with the slice as a column of its own. A parent without children keeps one
    row with an empty array, and a NULL slice.
    """
    struct = F.struct(*order_by, *[c for c in children.columns if c not in order_by])
    slices = [] if slice_by is None else [as_column(slice_by).alias("_slice")]
    keyed = children.select(F.col(child_key).alias("_key"), struct.alias("_child"), *slices)
    groups = ["_key", *["_slice" for _ in slices]]
    arrays = keyed.groupBy(*groups).agg(F.sort_array(F.collect_list("_child")).alias("_items"))
    joined = parents.join(arrays, parents[parent_key] == arrays["_key"], "left")
    empty = F.array().cast(arrays.schema["_items"].dataType)
    shown = [F.col("_slice").alias(slice_name) for _ in slices]
    return joined.select(parents["*"], *shown, F.coalesce("_items", empty).alias(into))


def nest_snapshot(departments: DataFrame, regions: DataFrame, communes: DataFrame) -> DataFrame:
    """Administrative snapshot: ``department``, ``region`` and ``communes``, one row per department.

    ``departments(nom, code, codeRegion)``, ``regions(nom, code)`` and
    ``communes(nom, code, codeDepartement, ...)``; write it with
    :func:`landledger.sinks.write_jsonl`.
    """
    heads = departments.select(
        F.struct(*departments.columns).alias("department"),
        F.col("code").alias("_code"),
        F.col("codeRegion").alias("_region"),
    )
    region = regions.select(F.struct(*regions.columns).alias("region"), F.col("code").alias("_region"))
    with_region = heads.join(region, "_region", "left").drop("_region")
    documents = nest(with_region, communes, "_code", "codeDepartement", "communes", order_by=["code"])
    return documents.select("department", "region", "communes")
