"""Landed JSON payloads: unwrapping and flattening by schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gaugeworks.operators.columns import named
from gaugeworks.schema import PAYLOAD_KEYS


def read_payloads(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One row per landed payload file."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def payload_records(payloads: DataFrame) -> DataFrame:
    """Records of each payload.

    A payload with ``result`` is read inside it only; of the known keys the first
    that holds a list counts, and without one the payload has no records. Lists
    under different keys may hold records of different fields: those are merged.
    A payload that is a bare list is read by Spark as one row per record and
    passes through.
    """
    top, result = payloads.schema, _struct(payloads.schema, "result")
    inner, outer = _record_lists(result, "result."), _record_lists(top, "")
    if not inner and not outer and "result" not in top.fieldNames():
        return payloads
    fields = _merged_fields([record for _, record in inner + outer])
    kind = T.ArrayType(T.StructType([T.StructField(n, d) for n, d in fields.items()]))

    def first(lists: list[tuple[str, T.StructType]]) -> Column:
        aligned = [_aligned(F.col(path), record, fields) for path, record in lists]
        return F.coalesce(*aligned) if aligned else F.lit(None).cast(kind)

    if not fields:
        return payloads.select().limit(0)
    chosen = first(outer)
    if "result" in top.fieldNames():
        chosen = F.when(F.col("result").isNotNull(), first(inner)).otherwise(chosen)
    return (
        payloads.select(F.explode(chosen).alias("record"))
        .filter(F.col("record").isNotNull())
        .select("record.*")
    )


def _record_lists(held: T.StructType | None, prefix: str) -> list[tuple[str, T.StructType]]:
    names = [] if held is None else [k for k in PAYLOAD_KEYS if k in held.fieldNames()]
    return [(f"{prefix}{k}", held[k].dataType.elementType) for k in names if _is_record_list(held[k].dataType)]


def _merged_fields(records: list[T.StructType]) -> dict[str, T.DataType]:
    """Fields of all record types; one that differs in type is read as text."""
    fields: dict[str, T.DataType] = {}
    for record in records:
        for field in record:
            same = fields.setdefault(field.name, field.dataType) == field.dataType
            if not same:
                fields[field.name] = T.StringType()
    return fields


def _aligned(records: Column, own: T.StructType, fields: dict[str, T.DataType]) -> Column:
    """A list's records with all ``fields``, absent ones NULL."""

    def as_struct(record: Column) -> Column:
        values = [
            (record.getField(n) if n in own.fieldNames() else F.lit(None)).cast(d).alias(n) for n, d in fields.items()
        ]
        return F.when(record.isNotNull(), F.struct(*values))

    return F.transform(records, as_struct)


def _struct(schema: T.StructType, name: str) -> T.StructType | None:
    if name in schema.fieldNames() and isinstance(schema[name].dataType, T.StructType):
        return schema[name].dataType
    return None


def _is_record_list(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)


def flatten_records(records: DataFrame) -> DataFrame:
    """Nested fields one level down become ``parent.child`` columns (S3)."""
    columns = []
    for field in records.schema:
        if isinstance(field.dataType, T.StructType):
            columns += [
                named(field.name).getField(child).alias(f"{field.name}.{child}")
                for child in field.dataType.fieldNames()
            ]
        else:
            columns.append(named(field.name))
    return records.select(*columns)
