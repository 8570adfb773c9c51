"""File readers of a slide tree.

S1 read_cell_metadata, S2 read_expression, S3 read_target_calls,
S4 read_fov_offsets, S5 read_manifests, S7 read_mtx, S8 read_dictionary
(S6 file_inventory is in :mod:`tessera.sources.inventory`).

Readers declare types and keep file order where a rule needs "first"/"last"
(``row_idx`` from :func:`tessera.util.with_file_order`). Files are chosen by conditions
on their paths and headers are read where the files are; nothing that grows with the
number of files comes to the driver. gzip CSV is not splittable: one task reads one
file, and later shuffles spread its rows.
"""

from __future__ import annotations

import csv
import gc
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.cells import detect_cell_type_column
from ..util import saved_table, scratch_table, with_file_order
from .inventory import few_listing_tasks, file_inventory, some_tasks

# ---------------------------------------------------------------------------
# File names and column sets of the instrument exports.
TARGET_FILE_SUFFIX = "__complete_code_cell_target_call_coord.csv"
TARGET_LAYOUTS = [r"FOV[0-9][^/]*/FOV_Analysis_Summary/[^/]+", r"FOV[0-9][^/]*/[^/]+", r"[^/]+"]
TARGET_COLUMNS = [("fov", "int"), ("CellId", "int"), ("x", "double"), ("y", "double"), ("z", "int"),
                  ("target", "string"), ("CellComp", "string")]
FOV_LOCATIONS_SUFFIX = "FOV_Locations.csv"
LEGACY_FOVS_FILE = "latest.fovs.csv"
LEGACY_FOV_COLUMNS = ["Slide", "X_mm", "Y_mm", "Z_mm", "ZOffset_mm", "ROI", "FOV", "Order"]
Z_OFFSET_MM = -2.0
EXPR_KEYS = ["fov", "cell_ID"]
# ---------------------------------------------------------------------------


VISIBLE = "[^_.]*"  # folders that a recursive listing enters
MAX_LAYOUTS = 1000  # distinct header lines of one kind of file
BROADCAST_FILES = 100_000  # files whose paths and layouts every task may hold
BATCH_FOLDERS = 20_000  # folders (or files) of manifests that are read at once


def named(root: str, pattern: str, path: str = "_metadata.file_path") -> Column:
    """Files whose path below ``root`` matches ``pattern``, or the part files of a folder of
    that name written by a Spark job. A condition on the file path alone: Spark leaves
    other files out when it plans the scan."""
    base = re.sub(r"^file:/*(?=/)", "", root.rstrip("/"))
    return F.col(path).rlike(re.escape(base) + "/" + pattern + r"(/[^/]+)?$")


def _recursive(spark: SparkSession):
    return spark.read.option("recursiveFileLookup", True)


def literal(path: str) -> str:
    """``path`` as a pattern that matches it alone."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def csv_headers(spark: SparkSession, root: str | list[str], files: Column) -> DataFrame:
    """(_path, header): the first line of every file, found where the files are read. One row a file; it stays in the executors."""
    lines = _recursive(spark).text(root).where(files & (F.col("_metadata.file_block_start") == 0)).select(
        F.col("_metadata.file_path").alias("_path"), F.monotonically_increasing_id().alias("_id"), "value")
    # The least id of each file is a number, so it is found without sorting lines; a second
    # scan of the same splits, which numbers them alike, gives the line. One number a file is
    # sent out, less than the list of files that every scan needs.
    first = lines.groupBy("_path").agg(F.min("_id").alias("_id")).select("_id")
    heads = lines.join(F.broadcast(first), "_id", "left_semi")
    return heads.select("_path", F.regexp_replace("value", "^\ufeff", "").alias("header")).where("header <> ''")


def read_csv_by_name(spark: SparkSession, root: str | list[str], files: Column, columns: Callable | None = None,
                     of_file: Callable | None = None) -> DataFrame:
    """CSV files (those of ``files`` below ``root``, one or more folders) with differing headers, matched by name; strings. What comes to the driver
    is the distinct header lines, however many files there are.

    Files of one layout are one plain CSV scan. Where layouts differ, lines meet the
    layout of their file in a join of the (file, header) table and fields are taken by
    their place in it. ``columns(names)`` may give {output column: file column} for a
    layout (default: every column under its own name). Adds _path and row_idx (file order).

    Spark tests ``files`` again for every line, which takes far longer than reading the line
    if it is a pattern. ``of_file`` takes (_path, header), one row a file, and gives the rows
    of the files to read, with more columns that their lines get in the struct ``_of``:
    patterns belong there, and ``files`` may be a plain condition that all these files meet."""
    with few_listing_tasks(spark):
        return _csv_by_name(spark, root, files, columns, of_file)


def _csv_by_name(spark: SparkSession, root: str | list[str], files: Column, columns: Callable | None, of_file: Callable | None) -> DataFrame:
    try:
        headers = csv_headers(spark, root, files)
        if of_file:  # saved first, else Spark would test of_file's conditions on the lines
            headers = of_file(saved_table(headers))
            headers = saved_table(headers.select("_path", "header", F.struct(*[c for c in headers.columns if c not in ("_path", "header")]).alias("_of")))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no such files under {root}") from e
    found = headers.groupBy("header").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LAYOUTS + 1).collect()
    if not found:
        raise FileNotFoundError(f"no such files under {root}")
    if len(found) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} different headers under {root}")
    lines = sorted(r["header"] for r in found)
    layouts = [[n.strip() for n in next(csv.reader([line]))] for line in lines]
    columns = columns or (lambda names: {n: n for n in names})
    wanted = [columns(names) for names in layouts]
    out_names = list(dict.fromkeys(n for w in wanted for n in w))
    width = max(map(len, layouts))
    fields = [f"_c{k}" for k in range(width)]
    schema = ", ".join(f"{f} string" for f in fields)
    more = ["_of"] if of_file else []
    # where the files are few, they go to the lines and not the lines to their files
    small = F.broadcast if sum(r["n"] for r in found) <= BROADCAST_FILES else lambda df: df
    where = [F.col("_metadata.file_path").alias("_path"), F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("mid")).alias("row_idx")]
    if len(layouts) == 1:
        rows = _recursive(spark).schema(schema).option("header", True).csv(root).where(files).select(*fields, *where)
        if of_file:
            rows = rows.join(small(headers.select("_path", *more)), "_path")
        place = lambda n: F.col(fields[layouts[0].index(wanted[0][n])])
    else:
        layout = F.array_position(F.array(*map(F.lit, lines)), F.ltrim("value", F.lit("\ufeff")))
        text = _recursive(spark).text(root).where(files).select("value", *where)
        known = headers.select(F.col("_path").alias("_file"), F.array_position(F.array(*map(F.lit, lines)), F.col("header")).alias("_layout"), *more)
        rows = text.join(small(known), text["_path"] == known["_file"]).drop("_file")
        # lines equal to their file's header are headers
        rows = rows.where((F.trim("value") != "") & (layout != F.col("_layout"))).select(
            "*", F.from_csv("value", F.lit(schema)).alias("_f")).select("_layout", "_path", "row_idx", *more, *[F.col(f"_f.{f}").alias(f) for f in fields])
        place = lambda n: F.coalesce(*[F.when(F.col("_layout") == k + 1, F.col(fields[names.index(w[n])]))
                                       for k, (names, w) in enumerate(zip(layouts, wanted)) if n in w])
    return rows.select(*[place(n).alias(n) for n in out_names], "_path", "row_idx", *more)


def named_cell_columns(names) -> list[str]:
    """Column names that Spark can tell apart: the string ``cell_id`` becomes
    ``cell_name`` beside the number ``cell_ID``."""
    return ["cell_name" if n == "cell_id" else n for n in names]


def cell_columns(cell_type_column: str | None = None, keep_type: bool = False) -> Callable:
    """{output column: file column} of a cell metadata layout: names Spark can tell apart,
    and ``cell_type`` from the layout's own typing column (P15; with ``keep_type`` only
    where there is no ``cell_type`` yet)."""
    def columns(names: list[str]) -> dict[str, str]:
        out = dict(zip(named_cell_columns(names), names))
        if "cell_type" not in out or cell_type_column or not keep_type:
            typed = detect_cell_type_column(list(out), cell_type_column)
            if typed:
                out["cell_type"] = out[typed]
        return out
    return columns


def _typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    if "cell_type" not in df.columns:
        df = df.withColumn("cell_type", F.lit(None).cast("string"))
    for c, t in types.items():
        if c in df.columns:
            df = df.withColumn(c, F.col(c).try_cast(t))
    return df


def read_raw_metadata(spark: SparkSession, paths: list[str], cell_type_column: str | None = None) -> DataFrame:
    """Cell metadata files as the instrument writes them, or as the metadata job does:
    columns by name, a ``cell_type`` column (P15 per header unless it is there
    already), fov and cell_ID as INT, coordinates as DOUBLE."""
    frames = []
    for p in paths:
        seen = ~F.col("_metadata.file_path").rlike(r"/[_.][^/]*$")
        frames.append(read_csv_by_name(spark, p, seen, cell_columns(cell_type_column, keep_type=True)).drop("_path", "row_idx"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    types = {"fov": "int", "cell_ID": "int"} if "cell_name" in out.columns else {"fov": "int"}
    return _typed(out, {**types, "UMAP_1": "double", "UMAP_2": "double"})


# S1 -------------------------------------------------------------------------
def read_cohort_metadata(spark: SparkSession, experiment_root: str, slides: list[str] | None = None,
                         cell_type_column: str | None = None) -> DataFrame:
    """Cell metadata of every slide and run under an experiment, as one frame.

    Files ``<run>/flatFiles/<slide>/<slide>_metadata_file.csv.gz`` are read by name
    (:func:`read_csv_by_name`); runs name their typing column differently, which is found
    per layout (P15).

    Columns: slide, run, source_idx (run listing order within the slide),
    row_idx (file order), fov INT, cell_ID INT, cell_name (the string
    ``cell_id``; renamed because Spark column names are case-insensitive),
    cellSegmentationSetId, cell_type.
    """
    root = experiment_root.rstrip("/")
    name = r"([^/]+)/flatFiles/([^/]+)/\2_metadata_file\.csv\.gz"
    files = named(root, name)
    if slides is not None:
        files = files & F.regexp_extract("_metadata.file_path", r"/flatFiles/([^/]+)/", 1).isin(list(slides))
    place = f"{root}/{VISIBLE}/flatFiles"  # the other folders of a run hold most of its files
    df = read_csv_by_name(spark, place, files, cell_columns(cell_type_column)).withColumn(
        "run", F.regexp_extract("_path", r"/([^/]+)/flatFiles/", 1)).withColumn("slide", F.regexp_extract("_path", r"/flatFiles/([^/]+)/", 1))
    # runs of a slide in listing order, from the list of files
    own = file_inventory(spark, place).where(F.col("path").rlike(r"/" + name + r"(/[^/]+)?$")).select(
        F.regexp_extract("path", r"/([^/]+)/flatFiles/", 1).alias("run"), F.regexp_extract("path", r"/flatFiles/([^/]+)/", 1).alias("slide")).distinct()
    source = own.withColumn("source_idx", (F.row_number().over(Window.partitionBy("slide").orderBy("run")) - 1).cast("int"))
    return _typed(df.drop("_path").join(source, ["slide", "run"]), {"fov": "int", "cell_ID": "int"})


def read_cell_metadata(spark: SparkSession, experiment_root: str, slide: str,
                       cell_type_column: str | None = None) -> DataFrame:
    """All runs' metadata files of one slide (see :func:`read_cohort_metadata`)."""
    return read_cohort_metadata(spark, experiment_root, [slide], cell_type_column)


# S2 -------------------------------------------------------------------------
def read_expression(spark: SparkSession, path: str, genes: list[str] | None = None,
                    long: bool = False) -> DataFrame:
    """Wide expression CSV; only the key columns and the requested genes are
    read (CSV column pruning). ``long`` unpivots to (fov, cell_ID, gene, count)."""
    df = spark.read.option("header", True).csv(path)
    genes = genes if genes is not None else [c for c in df.columns if c not in EXPR_KEYS]
    df = df.select(*[F.col(k).cast("int").alias(k) for k in EXPR_KEYS],
                   *[F.col(f"`{g}`").cast("long").alias(g) for g in genes])
    if long:
        return df.unpivot(EXPR_KEYS, [f"`{g}`" for g in genes], "gene", "count")
    return df


# S3 -------------------------------------------------------------------------
def read_target_calls(spark: SparkSession, root: str) -> DataFrame:
    """Transcript calls of a slide folder, 7 typed columns. Three layouts are
    tried in order (FOV*/FOV_Analysis_Summary/, FOV*/, the folder itself); the
    first with any file wins. Columns are taken by name, file by file."""
    file = r"[a-zA-Z0-9_][^/]*" + re.escape(TARGET_FILE_SUFFIX)
    for layout in TARGET_LAYOUTS:
        files = named(root, layout.removesuffix("[^/]+") + file)
        try:
            df = read_csv_by_name(spark, root, files)
        except FileNotFoundError:
            continue
        return df.select(*[F.col(c).cast(t).alias(c) for c, t in TARGET_COLUMNS])
    raise FileNotFoundError(f"no target call files under {root}")


# S4 -------------------------------------------------------------------------
def read_fov_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """FOV locations: the (last listed) ``*FOV_Locations.csv`` with Z in mm,
    ZOffset_mm = -2.0 and ROI = 0 added; otherwise the headerless legacy file.
    ``ord`` keeps the file row order."""
    base = folder.rstrip("/")
    name = F.regexp_extract("path", r"/([^/]*" + re.escape(FOV_LOCATIONS_SUFFIX) + r")(?:/[^/]+)?$", 1)
    last = file_inventory(spark, base).where(name != "").agg(F.max(name).alias("n")).first()["n"]
    if last:
        df = with_file_order(spark.read.option("header", True).option("inferSchema", True).csv(f"{base}/{last}"), "ord")
        df = df.withColumn("Z_um", F.col("Z_um") / 1e3).withColumnRenamed("Z_um", "Z_mm")
        cols = df.columns
        i = cols.index("Z_mm")
        df = df.withColumn("ZOffset_mm", F.lit(Z_OFFSET_MM)).withColumn("ROI", F.lit(0))
        df = df.select(*cols[:i + 1], "ZOffset_mm", "ROI", *cols[i + 1:])
    else:
        df = spark.read.option("header", False).option("inferSchema", True).csv(f"{base}/{LEGACY_FOVS_FILE}")
        df = with_file_order(df, "ord")
        n = len(df.columns) - 1
        df = df.toDF(*(LEGACY_FOV_COLUMNS[:n] + df.columns[len(LEGACY_FOV_COLUMNS):n]), "ord")
    return df


# S5 -------------------------------------------------------------------------
def read_manifests(spark: SparkSession, glob: str, multi_line: bool = True, below: bool = False) -> DataFrame:
    """Segmentation manifest JSON files (schemas unioned by name) with the
    segmentation folder taken from the file path. ``multi_line``: one
    (pretty-printed) document per file; False for JSON-lines files. ``below``: all JSON
    files under a folder.

    The driver holds the list of all files that one scan reads. Where ``glob`` matches more
    than ``BATCH_FOLDERS``, they are read in batches of the folders that hold the matches and
    the rows are saved; types are still those of all documents together."""
    batches = [] if below else _batches(spark, glob)
    with few_listing_tasks(spark):
        if len(batches) > 1:
            return _read_in_batches(spark, batches, multi_line)
        reader = spark.read.option("multiLine", multi_line)
        if below:
            reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
        df = reader.json(glob)
    return df.withColumn("dir", _manifest_dir())


def _manifest_dir() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"(Segmentation_[^/]+)", 1)


def _batches(spark: SparkSession, glob: str) -> list[list[str]]:
    """``glob`` as lists of patterns, one a folder that holds matches; a list matches about
    ``BATCH_FOLDERS`` at most, or is one folder's."""
    parent, _, last = glob.rstrip("/").rpartition("/")
    if not parent or "{" in glob:
        return [[glob]]
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(parent).getFileSystem(spark._jsc.hadoopConfiguration())
    out, held = [], 0
    for folder in fs.globStatus(path(parent)) or []:
        one = f"{literal(folder.getPath().toString())}/{last}"
        n = len(fs.globStatus(path(one)) or [])
        if n and (not out or held + n > BATCH_FOLDERS):
            out.append([])
            held = 0
            gc.collect()
        if n:
            out[-1].append(one)
            held += n
    return out


def _read_in_batches(spark: SparkSession, batches: list[list[str]], multi_line: bool) -> DataFrame:
    """Two scans of every batch, as Spark itself does: one for the types, one for the rows."""
    at, tasks = scratch_table(spark), some_tasks(spark)
    for paths in batches:
        spark.read.text(paths, wholetext=multi_line).select("value").coalesce(tasks).write.mode("append").parquet(f"{at}/text")
        gc.collect()  # Python's references to a batch are cyclic; until they go the JVM holds its list of files
    text = spark.read.schema("value string").parquet(f"{at}/text")
    lines = getattr(text._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    schema = DataFrame(spark.read._jreader.json(lines), spark).schema
    for paths in batches:
        rows = spark.read.option("multiLine", multi_line).schema(schema).json(paths).withColumn("dir", _manifest_dir())
        rows.coalesce(tasks).write.mode("append").parquet(f"{at}/rows")
        types = rows.schema
        del rows
        gc.collect()
    return spark.read.schema(types).parquet(f"{at}/rows")


# S7 -------------------------------------------------------------------------
def read_mtx(spark: SparkSession, path: str) -> DataFrame:
    """MatrixMarket coordinate file -> (cell_idx, gene_idx, count) 0-based.
    Comment lines start with ``%``; the first other line is the size line."""
    t = with_file_order(spark.read.text(path), "_i")
    t = t.where(~F.col("value").startswith("%") & (F.trim("value") != ""))
    first = t.agg(F.min("_i").alias("m")).first()["m"]
    parts = F.split(F.trim(F.col("value")), r"\s+")
    size_line = (F.col("_i.file") == F.lit(first["file"])) & (F.col("_i.block") == F.lit(first["block"])) \
        & (F.col("_i.mid") == F.lit(first["mid"]))
    return t.where(~size_line).select(
        (parts[0].cast("long") - 1).alias("cell_idx"), (parts[1].cast("long") - 1).alias("gene_idx"),
        parts[2].cast("double").cast("int").alias("count"))


def mtx_shape(spark: SparkSession, path: str) -> tuple[int, int, int]:
    t = spark.read.text(path).where(~F.col("value").startswith("%") & (F.trim("value") != ""))
    row = t.first()
    a, b, c = row["value"].split()
    return int(a), int(b), int(c)


# S8 -------------------------------------------------------------------------
def read_dictionary(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """plex (``ProbeID, DisplayName``; delimiter sniffed from the header line),
    ncoder (``colorCode, Protein``) or colors (headerless value, colour).
    ``ord`` keeps file order (duplicate-key rules)."""
    if kind == "plex":
        head = spark.read.text(path).first()["value"]
        sep = "\t" if "\t" in head else (";" if ";" in head and "," not in head else ",")
        df = with_file_order(spark.read.option("header", True).option("sep", sep).csv(path), "ord") \
            .select("ProbeID", "DisplayName", "ord")
    elif kind == "ncoder":
        df = with_file_order(spark.read.option("header", True).csv(path), "ord").select("colorCode", "Protein", "ord")
    elif kind == "colors":
        df = with_file_order(spark.read.option("header", False).csv(path), "ord").toDF("value", "color", "ord")
    else:
        raise ValueError(kind)
    return df


# J12 helper -----------------------------------------------------------------
def read_indexed_csv(spark: SparkSession, path: str, index_first_column: bool = True) -> DataFrame:
    """CSV with a dense 0-based ``idx`` in file order (positional joins).

    Two plain scans: the first counts the rows of every file split, the second adds each
    row's place in its split to the rows of the splits before it. A file scan deals the
    same splits to the same tasks each time, so a row's place is its running id less the
    least one of its split. No sort, no shuffle of rows; the join brings one row a split."""
    df = spark.read.option("header", True).csv(path)
    cols = df.columns
    rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_id"))
    splits = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("_file", "_block", (before - F.col("_first")).alias("_shift"))
    out = rows.join(splits, ["_file", "_block"]).select(*[F.col(f"`{c}`") for c in cols], (F.col("_id") + F.col("_shift")).cast("long").alias("idx"))
    return out.withColumnRenamed(cols[0], "name") if index_first_column else out
