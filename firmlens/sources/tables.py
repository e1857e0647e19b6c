"""Reading and writing company tables (Parquet and CSV) and the submission log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a raw table. The schema is declared, never inferred; NaN in float columns becomes NULL."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV table needs a declared schema")
        reader = reader.option("header", True).option("enforceSchema", False)
    return nan_to_null(reader.format(fmt).load(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats})


def read_clean(spark: SparkSession, path: str, schema: T.StructType, index: str | None = "_c0") -> DataFrame:
    """Read a cleaned CSV whose first column is a saved row index, and discard that column."""
    if index is not None:
        schema = T.StructType([T.StructField(index, T.StringType())] + list(schema.fields))
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
    return nan_to_null(df if index is None else df.drop(index))


def write_clean(
    df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite", key: str | None = None, with_key: bool = True
) -> None:
    """Write a table as CSV or Parquet; ``with_key=False`` leaves the key column out."""
    if key is not None and not with_key:
        df = df.drop(key)
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
    writer.format(fmt).save(path)


LOG_SCHEMA = T.StructType(
    [T.StructField("company_id", T.StringType(), False), T.StructField("place", T.StringType(), False)]
)


def append_log(df: DataFrame, path: str) -> None:
    """Append submissions (company id, place)."""
    df.select(*(F.col(f.name).cast(f.dataType) for f in LOG_SCHEMA.fields)).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)
