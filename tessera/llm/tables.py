"""Tables in the shared folder: reading inputs, cutting lineage, spreading rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet below ``spark.checkpoint.dir`` and read it back:
    later steps neither recompute it nor depend on any one executor."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def numbered(df: DataFrame, name: str = "rid") -> DataFrame:
    """Number the rows of a table scan. A file scan has the same partitions and the
    same row order each time it is read, so two reads of the same table agree;
    rows that repeat (or share an id, or have none) stay apart."""
    return df.withColumn(name, F.monotonically_increasing_id())


def set_aside(docs: DataFrame, key: str = "rid"):
    """(numbered rows under plain column names c0, c1, ...; name of the text column;
    function that takes the original columns back out): whatever the columns of
    ``docs`` are called, they cannot clash with those an operator adds."""
    plain = [f"c{k}" for k in range(len(docs.columns))]
    text = plain[docs.columns.index("text")] if "text" in docs.columns else None
    return numbered(docs.toDF(*plain), key), text, lambda df: df.select(*plain).toDF(*docs.columns)


def with_text(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and text as a string; other columns, whatever their names, are left."""
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("text"))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: one scalar, to choose how many blocks there are."""
    return docs.select(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
