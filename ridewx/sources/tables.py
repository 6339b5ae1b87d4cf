"""Reading tables by name or path, fixture files and the current namespace."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table (``t``, ``schema.t`` or ``catalog.schema.t``) or a
    file path. Paths are recognised by a slash or a URI scheme."""
    if "/" in name_or_path or "://" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.read.table(name_or_path)


def use_namespace(spark: SparkSession, catalog: str | None = None,
                  schema: str | None = None) -> None:
    """Set the current catalog and schema for unqualified names."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if schema:
        spark.catalog.setCurrentDatabase(schema)


def read_fixture(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 lines: bool = False) -> DataFrame:
    """A JSON array file or a CSV file (or folder) with a header.

    JSON is read as one multi-line document, or with ``lines`` as one
    document per line, which splits (typed by ``schema`` when given); CSV columns stay strings, as nothing is inferred. Any other
    suffix is rejected.
    """
    suffix = os.path.splitext(path)[1].lower()
    if suffix == ".json":
        reader = spark.read.option("multiLine", str(not lines).lower())
        if schema is not None:
            reader = reader.schema(schema)
        return reader.json(path)
    if suffix == ".csv":
        reader = spark.read.option("header", "true").option("inferSchema", "false")
        return reader.csv(path)
    raise ValueError(f"Unsupported fixture type for: {os.path.basename(path)}")


def rows_to_frame(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """Small local rows (fixtures) → DataFrame with a declared schema."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def preview(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows, repeatable when ``order`` names a sort key
    (a bare ``limit`` returns whichever rows arrive first)."""
    return (df.orderBy(*order) if order else df).limit(n)
