"""Small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firmlens.session import ship

#: Whole documents per Arrow batch at most; its bytes are bounded too, so long ones come in fewer.
DOCUMENTS_PER_BATCH = 1024


def whole_texts(spark: SparkSession) -> None:
    """Bound the rows and bytes of an Arrow batch, since each row may be a very long document; and
    send the package to the executors."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > DOCUMENTS_PER_BATCH:
        spark.conf.set(key, str(DOCUMENTS_PER_BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    whole_texts(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def share(key: Column, seed: int) -> Column:
    """An even number in [0, 1) that depends on the key alone; the same at every run."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 52)).cast("double") / float(1 << 52)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's texts; null is the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in batches if b.num_rows)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
