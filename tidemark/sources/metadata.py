"""Facts about tables: partition columns, types, properties, live schemas."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql.types import DataType, StructType

from tidemark.functions.predicates import PARTITION_TYPES, type_of


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """Partition columns of a catalog table in their order."""
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def live_schema(spark: SparkSession, table: str) -> dict[str, str] | None:
    """Lower-case column names and types of a readable table, else None."""
    try:
        return {f.name.lower(): f.dataType.typeName() for f in spark.table(table).schema.fields}
    except PySparkException:
        return None


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    """A table's property, None if it or the table is absent."""
    try:
        rows = spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:t)", args={"t": table}).collect()
    except PySparkException:
        return None
    return next((r["value"] for r in rows if r["key"] == key), None)


def resolve(configured: str | None, columns: list[str], schema: StructType) -> tuple[str, DataType] | None:
    """The configured column if it really is a partition column of a date or timestamp type."""
    if not configured or configured.lower() not in (c.lower() for c in columns):
        return None
    kind = type_of(schema, configured)
    return (configured, kind) if isinstance(kind, PARTITION_TYPES) else None


def discover(columns: list[str], schema: StructType) -> tuple[str, DataType] | None:
    """The first partition column of a date or timestamp type."""
    return next(((c, k) for c in columns if isinstance(k := type_of(schema, c), PARTITION_TYPES)), None)
