"""File-source streaming ingestion of transcript call files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.readers import TARGET_COLUMNS, TARGET_FILE_SUFFIX

_SPARK_TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}


def target_call_schema(extra: list[str] = ()) -> T.StructType:
    """Streams need a declared schema: the 7 typed columns (+ any extra string
    columns present in the files, in file order)."""
    fields = [T.StructField(c, _SPARK_TYPES[t]) for c, t in TARGET_COLUMNS]
    fields += [T.StructField(c, T.StringType()) for c in extra]
    return T.StructType(fields)


def ingest_target_calls(spark: SparkSession, landing: str, out_path: str, checkpoint: str,
                        slide_pattern: str = r"/([^/]+)/[^/]*" + TARGET_FILE_SUFFIX.replace(".", r"\.") + "$",
                        max_files_per_trigger: int | None = None, extra_columns: list[str] = ()) -> int:
    """Append every not-yet-seen ``*__complete_code_cell_target_call_coord.csv``
    under ``landing`` to a parquet table partitioned by slide.

    ``checkpoint`` must be on shared storage; it records which files were
    committed, so re-running (or recovering from a lost executor or driver)
    never reads a file twice. Returns the number of rows added in this run.
    """
    r = (spark.readStream.schema(target_call_schema(list(extra_columns)))
         .option("header", True)
         .option("recursiveFileLookup", True)
         .option("pathGlobFilter", "*" + TARGET_FILE_SUFFIX))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    s = r.csv(landing)
    s = s.withColumn("slide", F.regexp_extract(F.col("_metadata.file_path"), slide_pattern, 1))
    before = _count(spark, out_path)
    q = (s.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
          .partitionBy("slide").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return _count(spark, out_path) - before


def _count(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.parquet(path).count()
    except Exception:  # noqa: BLE001  (no table yet)
        return 0
