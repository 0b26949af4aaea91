"""Ledger of values that were there and became NULL."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger.functions import parsing

Parser = Callable[[str], Column]


def parsers(
    ints: Collection[str] = (), doubles: Collection[str] = (), dates: Collection[str] = (), commas: Collection[str] = ()
) -> dict[str, Parser]:
    """How the typed projections read each column; ``commas`` are doubles with a decimal comma."""
    kinds = ((ints, parsing.parse_int), (doubles, parsing.parse_double), (dates, parsing.parse_date), (commas, parsing.decimal_comma))
    return {c: parse for columns, parse in kinds for c in columns}


def rejected(fields: Mapping[str, Parser]) -> Column:
    """Array of (column, value) of one row: texts that are not blank and do not parse, as they are."""
    entries = [
        F.when(
            parsing.blank_to_null(F.col(f"`{c}`")).isNotNull() & parse(F.col(f"`{c}`")).isNull(),
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")),
        )
        for c, parse in fields.items()
    ]
    return F.array_compact(F.array(*entries)) if entries else F.array().cast("array<struct<column:string,value:string>>")


def with_rejects(raw: DataFrame, fields: Mapping[str, Parser], name: str = "rejected") -> DataFrame:
    """Rows with the texts that their typed projection will lose, an empty array where it loses none."""
    return raw.withColumn(name, rejected(fields))


def rejected_values(raw: DataFrame, fields: Mapping[str, Parser]) -> DataFrame:
    """``(column, value, rows)`` of every text that is not blank and becomes NULL.

    One pass over the raw columns; equal texts are counted in the map tasks, so a
    mark that half the rows carry is one row per task.
    """
    lost = raw.select(F.explode(rejected(fields)).alias("r"))
    return lost.groupBy(F.col("r.column").alias("column"), F.col("r.value").alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def rejected_json(lines: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """``(column, value, rows)`` of JSON lines against a declared schema of plain fields.

    Each line is parsed once as a VARIANT. A line that is no JSON object is a
    rejected value of the column ``_corrupt_record``; a field that is there, is
    not null and does not fit its declared type is a rejected value of its own
    column, as JSON text. Fields that the schema does not name are not read.
    """
    parsed = lines.select(F.col(text).alias("_text"), F.try_parse_json(text).alias("_v"))
    whole = F.col("_v").isNotNull() & F.schema_of_variant("_v").startswith("OBJECT")
    entries = [F.when(~whole & (F.trim("_text") != ""), F.struct(F.lit("_corrupt_record").alias("column"), F.col("_text").alias("value")))]
    for f in schema.fields:
        path = f"$['{f.name}']"
        there = F.try_variant_get("_v", path, "variant")
        fits = F.try_variant_get("_v", path, f.dataType.simpleString())
        lost = whole & there.isNotNull() & ~F.is_variant_null(there) & fits.isNull()
        entries.append(F.when(lost, F.struct(F.lit(f.name).alias("column"), F.to_json(there).alias("value"))))
    found = parsed.select(F.explode(F.array_compact(F.array(*entries))).alias("r"))
    return found.groupBy(F.col("r.column").alias("column"), F.col("r.value").alias("value")).agg(F.count(F.lit(1)).alias("rows"))
