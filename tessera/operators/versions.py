"""Segmentation-version choice and source precedence, as set operations.

W1 select_segmentations, W2 latest_manifest, W3 merge_metadata_sources,
W4 pick_label_tiles, W8 primary_segmentation, J6 skip_processed,
J7 match_segmentation_dir, O2 first_nonempty_source.

The reference walks lists with mutable sets and early exits; every rule here is
rewritten as aggregates ("first source / version that has X" = a min over a
rank), so it runs for all slides of a cohort in one job with no per-slide loop.
All tables involved are per (slide, version, FOV) or per file, i.e. small
dimensions next to the transcript data; aggregations use partial aggregation,
never a window over an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import SEG_PREFIX, segmentation_uuid, segmentation_version

BIG_RANK = 1 << 30  # "never covered" cut


# W8 -------------------------------------------------------------------------
def primary_segmentation(meta: DataFrame, keys: list[str], seg_col: str = "cellSegmentationSetId",
                         order: str = "row_idx", runs: DataFrame | None = None) -> DataFrame:
    """Segmentation id of a run = stripped id on the first metadata row; runs
    without rows (when ``runs`` is given) get ''."""
    p = meta.groupBy(*keys).agg(F.min_by(F.trim(F.col(seg_col)), F.col(order)).alias("primary_seg_id"))
    p = p.withColumn("primary_seg_id", F.coalesce("primary_seg_id", F.lit("")))
    if runs is not None:
        p = runs.select(*keys).distinct().join(p, keys, "left").withColumn(
            "primary_seg_id", F.coalesce("primary_seg_id", F.lit("")))
    return p


# J7 -------------------------------------------------------------------------
def match_segmentation_dir(runs: DataFrame, dirs: DataFrame, keys: list[str] = (),
                           id_col: str = "primary_seg_id") -> DataFrame:
    """Folder of each run's segmentation id: equi-join on the folder uuid (the
    id is the uuid part of ``Segmentation_<uuid>_<NNN>``); ties -> smallest name.
    Runs without a match get NULL."""
    keys = list(keys)
    d = (dirs.select(*keys, "dir").distinct()
         .withColumn("uuid", segmentation_uuid("dir")))
    cond = [runs[id_col] == d["uuid"]] + [runs[k] == d[k] for k in keys]
    j = runs.join(d, cond, "left").select(runs["*"], d["dir"])
    out_keys = keys + [id_col]
    other = [c for c in runs.columns if c not in out_keys]
    return j.groupBy(*[runs[k] for k in out_keys], *[runs[c] for c in other]).agg(F.min("dir").alias("primary_dir"))


# W2 -------------------------------------------------------------------------
def latest_manifest(manifests: DataFrame, keys: list[str] = (), version_col: str = "Version") -> DataFrame:
    """Highest integer version per slide (ties -> largest folder name)."""
    v = F.col(version_col).cast("string").try_cast("int")
    m = manifests.select(*keys, "dir", v.alias("version")).where(F.col("version").isNotNull())
    g = m.groupBy(*keys).agg(F.max(F.struct("version", "dir")).alias("m"))
    return g.select(*keys, F.col("m.dir").alias("dir"), F.col("m.version").alias("version"),
                    segmentation_uuid(F.col("m.dir")).alias("uuid"))


# W1 -------------------------------------------------------------------------
def select_segmentations(seg: DataFrame, primary: DataFrame, keys: list[str] = ()):
    """Choose the folders that cover a slide's FOVs.

    ``seg`` = (keys, dir, fov): one row per FOV folder of each segmentation
    folder. ``primary`` = (keys, primary_dir).

    Rule: start with the primary version; if it misses FOVs of the lowest
    version (the reference set), add older versions newest-first whenever they
    bring a new FOV, and stop once the reference set is covered; never newer.

    Set form: eligible = primary (rank 0) + folders with a lower version,
    ranked by (version desc, dir asc). winner(fov) = min rank holding the FOV.
    cut = max winner over reference FOVs (BIG if one is uncovered). A folder is
    kept if it is the primary, or it wins some FOV and its rank <= cut.

    Returns (selected (keys, dir, uuid, version, rank), uncovered (keys, fov)).
    """
    keys = list(keys)
    s = seg.select(*keys, "dir", "fov").distinct().withColumn("version", segmentation_version("dir"))
    p = primary.select(*keys, F.col("primary_dir")).withColumn("pversion", segmentation_version("primary_dir"))
    # Folder catalogue (one row per folder) with its rank; dimension-sized.
    folders = s.select(*keys, "dir", "version").distinct()
    folders = folders.join(p, keys) if keys else _attach_one(folders, p)
    elig = folders.where((F.col("dir") == F.col("primary_dir")) | (F.col("version") < F.col("pversion")))
    # Ranking runs over the folder catalogue only (a handful of versions per slide).
    w = Window.partitionBy(*keys).orderBy(F.when(F.col("dir") == F.col("primary_dir"), 0).otherwise(1),
                                          F.desc("version"), "dir")
    elig = elig.withColumn("rank", F.row_number().over(w) - 1).select(*keys, "dir", "version", "rank")
    # Reference FOVs = FOVs of the lowest-version folder (first by name on ties).
    low = folders.groupBy(*keys).agg(F.min(F.struct("version", "dir")).alias("m")).select(
        *keys, F.col("m.dir").alias("ref_dir"))
    ref = (s.select(*keys, "dir", "fov")
           .join(low.withColumnRenamed("ref_dir", "dir"), keys + ["dir"])
           .select(*keys, "fov").distinct())
    winner = (s.select(*keys, "dir", "fov")
              .join(elig.select(*keys, "dir", "rank"), keys + ["dir"])
              .groupBy(*keys, "fov").agg(F.min("rank").alias("win")))
    cov = ref.join(winner, keys + ["fov"], "left")
    cut = cov.groupBy(*keys).agg(F.max(F.coalesce("win", F.lit(BIG_RANK))).alias("cut"))
    wins = winner.select(*keys, F.col("win").alias("rank")).distinct()
    sel = elig.join(wins, keys + ["rank"], "left_semi")
    sel = sel.unionByName(elig.where(F.col("rank") == 0)).distinct()
    sel = (sel.join(cut, keys, "left") if keys else _attach_one(sel, cut))
    sel = sel.where((F.col("rank") == 0) | (F.col("rank") <= F.col("cut"))).drop("cut")
    sel = sel.withColumn("uuid", segmentation_uuid("dir"))
    uncovered = cov.where(F.col("win").isNull()).select(*keys, "fov")
    return sel.select(*keys, "dir", "uuid", "version", "rank"), uncovered


def _attach_one(df: DataFrame, one: DataFrame) -> DataFrame:
    from ..util import attach
    return attach(df, one)


# W3 -------------------------------------------------------------------------
def merge_metadata_sources(rows: DataFrame, ids: str | None, seg_col: str = "cellSegmentationSetId",
                           source_col: str = "source_idx", keys: list[str] = (),
                           matching: bool = True) -> DataFrame:
    """Concatenate matching rows of the sources in order until every requested
    segmentation id has been seen; later sources are ignored.

    first(id) = min source index holding the id; cut = max over requested ids
    (all sources if one is never seen); keep matching rows with source <= cut
    (``matching=False``: all rows of the sources that are read, up to the cut).
    Only the tiny (id -> first source) table is aggregated; rows are filtered.
    """
    keys = list(keys)
    if ids is None or ids.strip() == "":
        return rows
    wanted = sorted({s.strip() for s in ids.split(",") if s.strip()})
    m = rows.where(F.trim(F.col(seg_col)).isin(wanted))
    first = m.groupBy(*keys, F.trim(F.col(seg_col)).alias("_id")).agg(F.min(source_col).alias("_first"))
    found = first.groupBy(*keys).agg(F.max("_first").alias("_cut"), F.count(F.lit(1)).alias("_n"))
    found = found.select(*keys, F.when(F.col("_n") < len(wanted), F.lit(BIG_RANK))
                         .otherwise(F.col("_cut")).alias("_cut"))
    if keys:
        j = (m if matching else rows).join(found, keys)
    else:
        from ..util import attach
        j = attach(m if matching else rows, found)
    return j.where(F.col(source_col) <= F.col("_cut")).drop("_cut")


# W4 -------------------------------------------------------------------------
def pick_label_tiles(files: DataFrame, ordered_dirs: DataFrame, keys: list[str] = ()) -> DataFrame:
    """One label tile per FOV: the first listed folder (``ordered_dirs`` =
    (keys, dir, priority)) holding a label file for it; FOVs still missing come
    from base folders outside ``Segmentation_*``; several files -> first path.

    ``files`` = (keys, dir, fov, path). A min over (priority, path) per FOV is a
    plain aggregate with partial aggregation.
    """
    keys = list(keys)
    f = files.join(ordered_dirs.select(*keys, "dir", "priority"), keys + ["dir"], "left")
    base = ~F.col("dir").startswith(SEG_PREFIX)
    pr = F.when(F.col("priority").isNotNull(), F.col("priority")).when(base, F.lit(BIG_RANK))
    f = f.withColumn("_p", pr).where(F.col("_p").isNotNull())
    g = f.groupBy(*keys, "fov").agg(F.min(F.struct("_p", "path", "dir")).alias("m"))
    return g.select(*keys, "fov", F.col("m.dir").alias("dir"), F.col("m.path").alias("path"))


# J6 -------------------------------------------------------------------------
def skip_processed(slides: DataFrame, outputs: DataFrame, depth: int,
                   prefix_col: str = "output_prefix", key_col: str = "key") -> DataFrame:
    """Drop slides whose output prefix already holds any object. Object keys
    are cut to the prefix depth so the test is an equi anti-join."""
    parts = F.split(F.col(key_col), "/")
    have = (outputs.where(F.size(parts) > depth)
            .select(F.array_join(F.slice(parts, 1, depth), "/").alias(prefix_col)).distinct())
    return slides.join(have, prefix_col, "left_anti")


# O2 -------------------------------------------------------------------------
def first_nonempty_source(rows: DataFrame, keys: list[str] = (), priority_col: str = "priority") -> DataFrame:
    """Keep the rows of the first (lowest priority) source that has any rows."""
    keys = list(keys)
    best = rows.groupBy(*keys).agg(F.min(priority_col).alias(priority_col))
    if keys:
        return rows.join(best, keys + [priority_col], "left_semi")
    from ..util import attach
    b = best.withColumnRenamed(priority_col, "_best")
    return attach(rows, b).where(F.col(priority_col) == F.col("_best")).drop("_best")
