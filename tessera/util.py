"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_file_order(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """Attach a sortable row index that follows file order.

    (file path, block start, monotonically increasing id) restores the order in
    which rows appear in the input files, without a global sort or a single
    partition. Used for every "first row"/"last row wins" rule.
    """
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("mid"),
        ),
    )


def rnd(c: Column | str, places: int = 6) -> Column:
    """Round a DOUBLE for comparisons with the SQL oracle."""
    return F.round(F.col(c) if isinstance(c, str) else c, places)


def dense_index(distinct: DataFrame, col: str, out: str) -> DataFrame:
    """0-based position of each value in sorted order (null first): partitions of a
    distributed sort are numbered on from each other. Their bounds come from a sample of
    the values, so values spread over tasks whatever they begin with. The sorted values
    are written once (their sort is a job of its own), so both passes see the same rows."""
    at = (saved_table(distinct.repartitionByRange(F.col(col).asc_nulls_first()).sortWithinPartitions(F.col(col).asc_nulls_first())
                      .withColumn("_pos", F.monotonically_increasing_id())).withColumn("_run", F.shiftright("_pos", 33)))
    runs = at.groupBy("_run").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row a sort partition, so the window is over a bounded handful
    lower = F.coalesce(F.sum("_n").over(Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("_run", "_first", lower.alias("_lower"))
    place = (F.col("_lower") + F.col("_pos") - F.col("_first")).cast("int")
    return at.join(runs, "_run").withColumn(out, place).drop("_run", "_pos", "_first", "_lower")


def scratch_table(spark) -> str:
    """A new path below the shared checkpoint folder."""
    import uuid
    from .session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"


def saved_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back."""
    path = scratch_table(df.sparkSession)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def attach(df: DataFrame, small: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Attach the columns of a per-group aggregate ``small`` to ``df``.

    With keys: equi-join (``small`` has one row per group, e.g. per slide;
    adaptive execution broadcasts it when its bytes turn out small). Without keys ``small`` is a single row of scalars: it is fetched once
    to the driver and added as literals, so no cross join is planned.
    """
    keys = list(keys)
    if keys:
        return df.join(small, keys)
    row = small.first()
    for name in small.columns:
        v = None if row is None else row[name]
        typ = dict(small.dtypes)[name]
        df = df.withColumn(name, F.lit(v).cast(typ))
    return df
