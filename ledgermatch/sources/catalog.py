"""Column catalogs (SC5, SC6, F5): one row per column of a table's schema.

Schemas are metadata held by the driver; the catalog is a tiny DataFrame so
that schema checks are ordinary joins and aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CATALOG_SCHEMA = ("table_name string, ordinal_position int, column_name string, data_type string, "
                  "is_nullable string")


def catalog_rows(schema: T.StructType, table_name: str) -> list[tuple]:
    return [(table_name, i + 1, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO")
            for i, f in enumerate(schema.fields)]


def column_catalog(spark: SparkSession, tables: dict[str, DataFrame | T.StructType]) -> DataFrame:
    """Catalog of several tables at once (``table_name`` tells them apart).

    Values may be DataFrames or declared ``StructType`` schemas; Parquet marks
    every column nullable, so nullability checks need declared schemas.
    """
    rows = []
    for name, t in tables.items():
        schema = t if isinstance(t, T.StructType) else t.schema
        rows += catalog_rows(schema, name)
    return small_frame(spark, rows, CATALOG_SCHEMA)


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A DataFrame from a handful of driver-side rows (schemas, rule tables),
    shipped as one Arrow batch: no Python worker is involved. The values stay
    Python objects, so that a null among whole numbers is no NaN where the
    session converts without Arrow."""
    import pandas as pd

    names = [f.split()[0] for f in schema.split(",")]
    return spark.createDataFrame(pd.DataFrame(rows, columns=names, dtype=object), schema)
