"""File inventory: listing, selection, slide discovery, classification, checks.

S6 file_inventory, F5 select_inventory, F7 discover_slides,
F9 classify_image_files, A10 inventory_stats, A12 check_slide_layout.

An inventory is a DataFrame (path, length[, modificationTime]) — one row per
object — so a whole bucket of slides is filtered, classified and summarised by
ordinary distributed projections and aggregations instead of per-directory
listing loops.
"""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# File-name rules (matched at the start of the upper-cased base
# name, like Python's re.match) and slide layout names.
LABEL_FILE = r"CELLLABELS_F[0-9]+\.TIF"
MORPHOLOGY_FILE = r".*C902_P99_N99_F[0-9]+{z}\.TIF"       # z = "_Z%03d" or "" for z = 0
COMPOSITE_FILE = r"CELLCOMPOSITE_F[0-9]*\.JPG"
PROTEIN_FILE = r".*_C{cycle:03d}_F.*_{probe}\.TIF"
ENCODED_FILE = r".*_C{cycle:03d}_.*_N[0-9]+_F[0-9]+.TIF"
SELECTION_INCLUDES = {
    "CellStatsDir": ["FOV*/CellLabels_F*.tif", "FOV*/CellLabels_F*.TIF",
                     "Morphology2D/*.TIF", "Morphology2D/*.tif"],
    "segmentation": ["{subdir}/FOV*/CellLabels_F*.tif", "{subdir}/FOV*/CellLabels_F*.TIF"],
    "RunSummary": ["*.fovs.csv", "*FOV_Locations*"],
}
REQUIRED_DIRS = ["CellStatsDir", "RunSummary", "AnalysisResults", "ProteinDir"]
# ---------------------------------------------------------------------------


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
KEEP_LISTINGS = "spark.sql.hive.manageFilesourcePartitions"


def some_tasks(spark: SparkSession) -> int:
    """Tasks of a job whose cost is its files, not their bytes."""
    return max(32, 8 * spark.sparkContext.defaultParallelism)


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """Folders are listed in some tasks a core; by itself Spark starts one for every folder.
    Nor is the listing kept by the driver after its DataFrame is gone."""
    before = {k: spark.conf.get(k) for k in (LISTING_TASKS, KEEP_LISTINGS)}
    spark.conf.set(LISTING_TASKS, str(min(int(before[LISTING_TASKS]), some_tasks(spark))))
    spark.conf.set(KEEP_LISTINGS, "false")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# S6 -------------------------------------------------------------------------
def file_inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Recursive listing (path, length, modificationTime) of everything under
    ``root``; the file content column is never read (column pruning). Spark would start a
    task for every few files, and whoever saves the listing would get as many files."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    with few_listing_tasks(spark):
        return r.load(root).select("path", "length", "modificationTime").coalesce(some_tasks(spark))


def relative_path(col: str | Column, base: str | Column) -> Column:
    """Path relative to a base prefix (both without trailing slash)."""
    c = F.col(col) if isinstance(col, str) else col
    b = F.lit(base) if isinstance(base, str) else base
    b = F.regexp_replace(b, "/+$", "")
    return F.when(c.startswith(F.concat(b, F.lit("/"))), F.substr(c, F.length(b) + 2, F.lit(1 << 30)))


def glob_to_regex(g: str) -> str:
    """Sync-style include glob -> anchored Java regex (``*`` also crosses '/')."""
    out = []
    for ch in g:
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        else:
            out.append(re.escape(ch))
    return "^" + "".join(out) + "$"


# F5 -------------------------------------------------------------------------
def select_inventory(inv: DataFrame, includes: list[str], rel_col: str = "rel") -> DataFrame:
    """Flag objects matched by any include glob (``keep``)."""
    cond = F.lit(False)
    for g in includes:
        cond = cond | F.col(rel_col).rlike(glob_to_regex(g))
    return inv.withColumn("keep", F.coalesce(cond, F.lit(False)))


def selection_summary(flagged: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Kept / dropped object counts and bytes (one conditional aggregation)."""
    k = F.col("keep")
    return flagged.groupBy(*keys).agg(
        F.sum(k.cast("long")).alias("kept_files"),
        F.sum((~k).cast("long")).alias("dropped_files"),
        F.coalesce(F.sum(F.when(k, F.col("length"))), F.lit(0)).cast("long").alias("kept_bytes"),
        F.coalesce(F.sum(F.when(~k, F.col("length"))), F.lit(0)).cast("long").alias("dropped_bytes"))


def slide_selection_includes(subdirs: list[str], analysis_subdir: str | None) -> list[str]:
    """Include globs (relative to the slide base) of a selective download."""
    inc = [f"CellStatsDir/{g}" for g in SELECTION_INCLUDES["CellStatsDir"]]
    for s in subdirs:
        inc += [f"CellStatsDir/{g.format(subdir=s.strip())}" for g in SELECTION_INCLUDES["segmentation"]]
    inc += [f"RunSummary/{g}" for g in SELECTION_INCLUDES["RunSummary"]]
    if analysis_subdir:
        inc.append(f"AnalysisResults/{analysis_subdir}/*")
    return inc


# F7 -------------------------------------------------------------------------
def discover_slides(inv: DataFrame, experiment_prefix: str, col: str = "path") -> DataFrame:
    """``<experiment>/<run>/DecodedFiles/<slide>/<scan>/...`` -> distinct
    (run, slide, scan_id, slide_base_path); ``Logs`` is skipped at the slide and
    scan level."""
    pre = experiment_prefix.rstrip("/") + "/"
    rel = F.when(F.col(col).startswith(pre), F.substr(F.col(col), F.lit(len(pre) + 1), F.lit(1 << 30)))
    parts = F.split(rel, "/")
    d = inv.select(F.element_at(parts, 1).alias("run"), F.element_at(parts, 2).alias("decoded"),
                   F.element_at(parts, 3).alias("slide"), F.element_at(parts, 4).alias("scan_id"),
                   F.size(parts).alias("n"))
    d = d.where((F.col("decoded") == "DecodedFiles") & (F.col("n") >= 5)
                & (F.col("slide") != "Logs") & (F.col("scan_id") != "Logs"))
    d = d.select("run", "slide", "scan_id").distinct()
    return d.withColumn("slide_base_path", F.concat_ws("/", F.lit(experiment_prefix.rstrip("/")), "run",
                                                       F.lit("DecodedFiles"), "slide", "scan_id"))


# F9 -------------------------------------------------------------------------
def classify_image_files(inv: DataFrame, zslice: int = 0, cycle: int | None = None,
                         probe_col: str | None = None, col: str = "path") -> DataFrame:
    """Kind of each image file by its upper-cased base name (first rule wins):
    labels, morphology (z-slice suffix ``_Z%03d`` unless z = 0), composite,
    protein (needs cycle and probe), encoded (needs cycle); then its FOV."""
    from ..functions.keys import acquisition_field, base_name
    name = F.upper(base_name(col))
    z = f"_Z{zslice:03d}" if zslice != 0 else ""
    kind = (F.when(name.rlike("^" + LABEL_FILE), "labels")
             .when(name.rlike("^" + MORPHOLOGY_FILE.format(z=z)), "morphology")
             .when(name.rlike("^" + COMPOSITE_FILE), "composite"))
    if cycle is not None:
        if probe_col is not None:
            prot = F.concat(F.lit(f"^.*_C{cycle:03d}_F.*_"), F.upper(F.col(probe_col)), F.lit(r"\.TIF"))
            kind = kind.when(F.regexp_like(name, prot), "protein")
        kind = kind.when(name.rlike("^" + ENCODED_FILE.format(cycle=cycle)), "encoded")
    return inv.withColumn("kind", kind).withColumn("fov", acquisition_field(col, "fov"))


# A10 ------------------------------------------------------------------------
def inventory_stats(inv: DataFrame, keys: list[str] = (), fov_dir_col: str = "fov_dir") -> DataFrame:
    """FOV directory count, total bytes, GB total per slide."""
    return inv.groupBy(*keys).agg(
        F.count_distinct(fov_dir_col).alias("fov_count"),
        F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("total_bytes")).withColumn(
        "total_gb", F.round(F.col("total_bytes") / F.lit(1024 ** 3), 6))


# A12 ------------------------------------------------------------------------
def check_slide_layout(inv: DataFrame, keys: list[str], rel_col: str = "rel") -> DataFrame:
    """One validity row per slide: required top-level folders present, exactly
    one visible AnalysisResults child, ProteinImages under all or none of its
    FOV folders, a plex file at the top. Failure reasons as an array."""
    parts = F.split(F.col(rel_col), "/")
    top = F.element_at(parts, 1)
    n = F.size(parts)
    ar_child = F.when((top == "AnalysisResults") & (n >= 3) & ~F.element_at(parts, 2).startswith("."),
                      F.element_at(parts, 2))
    fov_dir = F.when((top == "AnalysisResults") & (n >= 4), F.concat_ws("/", F.slice(parts, 2, 2)))
    has_pi = F.when((top == "AnalysisResults") & (n >= 5) & (F.element_at(parts, 4) == "ProteinImages"),
                    F.concat_ws("/", F.slice(parts, 2, 2)))
    aggs = [F.max(((top == d) & (n >= 2)).cast("int")).alias(f"has_{d}") for d in REQUIRED_DIRS]
    aggs += [F.count_distinct(ar_child).alias("analysis_children"),
             F.count_distinct(fov_dir).alias("analysis_fov_dirs"),
             F.count_distinct(has_pi).alias("protein_image_dirs"),
             F.max(((n == 1) & F.col(rel_col).startswith("plex")).cast("int")).alias("has_plex")]
    g = inv.groupBy(*keys).agg(*aggs)
    reasons = [F.when(F.col(f"has_{d}") == 0, F.lit(f"missing {d}")) for d in REQUIRED_DIRS]
    reasons += [F.when(F.col("analysis_children") != 1, F.lit("AnalysisResults must have exactly one subfolder")),
                F.when((F.col("protein_image_dirs") > 0) & (F.col("protein_image_dirs") < F.col("analysis_fov_dirs")),
                       F.lit("ProteinImages missing in some FOV folders")),
                F.when(F.col("has_plex") == 0, F.lit("missing plex file"))]
    g = g.withColumn("reasons", F.filter(F.array(*reasons), lambda x: x.isNotNull()))
    g = g.withColumn("protein_images_in_analysis_results",
                     (F.col("protein_image_dirs") > 0) & (F.col("protein_image_dirs") == F.col("analysis_fov_dirs")))
    return g.withColumn("valid", F.size("reasons") == 0)
