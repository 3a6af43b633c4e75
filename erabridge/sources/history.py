"""History tables: a catalog table or a path, with text or typed columns."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_history(
    spark: SparkSession,
    table: str | None = None,
    path: str | None = None,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One history table, by catalog name or by path.

    ``options`` go to Spark's reader of the format: a file saved from a
    spreadsheet, say, needs ``header`` and maybe ``sep``.
    """
    if (table is None) == (path is None):
        raise ValueError("give either a table name or a path")
    if table is not None:
        return spark.table(table)
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
