"""What landed pages hold beside their fixed schema.

Pages are read with a fixed schema, so a field that the API adds, or answers
with another type, would vanish without a word. ``rest_of_pages`` reads the page
once more as a VARIANT and keeps every field that the schema does not name, at
any depth, and every value whose type it does not expect; ``field_counts``
counts them by path. The walk is one expression built from the schema: no
Python runs on the rows, and a page is parsed once.

A path is written ``items[].track.name``. Unknown objects and arrays are kept
whole under their own path. A string field accepts any value (the reader turns
it into text); JSON null is never a wrong type. Text that is not JSON has no
rows here (``corrupt_pages`` has it).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, LongType, StringType, StructType

from tunestats.sources.pages import LAND_DATE, PAGE_KINDS

FOUND = "array<struct<path:string,problem:string,type:string,value:string>>"
UNKNOWN, WRONG_TYPE = "unknown", "type"
#: The type of a JSON value that a leaf of the schema expects.
LEAVES = {LongType(): "BIGINT", BooleanType(): "BOOLEAN"}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _row(path: Column, problem: str, value: Column) -> Column:
    return F.struct(path.alias("path"), F.lit(problem).alias("problem"), F.call_function("schema_of_variant", value).alias("type"),
                    F.to_json(value).alias("value"))


def _none() -> Column:
    return F.array().cast(FOUND)


def _rest(value: Column, kind: DataType, path: str) -> Column:
    """``FOUND`` of one value that should be of type ``kind``."""
    wrong = F.when(F.is_variant_null(value), _none()).otherwise(F.array(_row(F.lit(path), WRONG_TYPE, value)))
    if isinstance(kind, StructType):
        names = F.array(*map(F.lit, kind.fieldNames()))

        def inner(field: Column, name: str, of: DataType) -> Column:
            found = _let(field, lambda v: _rest(v, of, f"{path}.{name}" if path else name))
            return F.when(field.isNotNull(), found).otherwise(_none())

        def fields(m: Column) -> Column:
            more = F.transform(F.filter(F.map_entries(m), lambda e: ~F.array_contains(names, e["key"])),
                               lambda e: _row(F.concat(F.lit(f"{path}." if path else ""), e["key"]), UNKNOWN, e["value"]))
            known = [inner(m[f.name], f.name, f.dataType) for f in kind.fields if not isinstance(f.dataType, StringType)]
            return F.when(m.isNull(), wrong).otherwise(F.concat(more, *known))

        return _let(F.try_variant_get(value, "$", "map<string,variant>"), fields)
    if isinstance(kind, ArrayType):
        if isinstance(kind.elementType, StringType):
            return F.when(F.try_variant_get(value, "$", "array<variant>").isNull(), wrong).otherwise(_none())
        return _let(F.try_variant_get(value, "$", "array<variant>"), lambda a: F.when(a.isNull(), wrong).otherwise(
            F.flatten(F.transform(a, lambda x: F.when(x.isNull(), _none()).otherwise(_rest(x, kind.elementType, f"{path}[]"))))))
    return F.when(F.call_function("schema_of_variant", value).isin(LEAVES[kind], "VOID"), _none()).otherwise(wrong)


def rest_of_pages(df: DataFrame, text_col: str, schema: StructType, keep: list[str] | None = None) -> DataFrame:
    """One row for each field of a page's text that is not in ``schema`` or
    not of its type: the columns ``keep``, path, problem (``unknown`` or
    ``type``), type and value (JSON text)."""
    keep = keep or []
    page = F.try_parse_json(text_col)
    found = F.when(page.isNotNull(), _let(page, lambda v: _rest(v, schema, "")))
    return df.select(*keep, F.explode(found).alias("_rest")).select(*keep, "_rest.*")


def read_rest(spark: SparkSession, table: str, path: str | list[str], multi_line: bool = False, since: Column | None = None) -> DataFrame:
    """(kind, path, problem, type, value) of the landed pages of one kind."""
    text = spark.read.option("wholetext", multi_line).text(path)
    if since is not None and LAND_DATE in text.columns:
        text = text.where(F.col(LAND_DATE) >= since)
    rest = rest_of_pages(text.select("value"), "value", PAGE_KINDS[table][0])
    return rest.select(F.lit(table).alias("kind"), "path", "problem", "type", "value")


def field_counts(rest: DataFrame) -> DataFrame:
    """(kind, path, problem, n, types): how often each field was met, and the
    types that its values had, in order."""
    return rest.groupBy("kind", "path", "problem").agg(
        F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("type")), ",").alias("types"))
