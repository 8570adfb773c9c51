"""End-to-end jobs (compositions exposed to users).

X1 slide_metadata_job, X2 slide_processing_job, X3 dotplot_job,
X4 reclassification_job, X5 density_job / cluster_label_job / histogram_job,
X6 roi_annotation_job.

Each job is one lazy plan over all slides (slide is a column, not a loop);
results are written through the sinks, so any step can be re-run alone.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.color import deterministic_color, rgba_from_hex
from ..functions.keys import OUTPUT_ROOT, acquisition_field, parse_slide_path, segmentation_version
from ..operators import blocks as BL
from ..operators import cells as C
from ..operators import raster as R
from ..operators import runlog as L
from ..operators import transcripts as T
from ..operators import versions as V
from ..sources import inventory as I
from ..sources import readers as RD
from ..sources import sinks as S
from ..util import saved_table


# X1 -------------------------------------------------------------------------
def slide_metadata(meta: DataFrame, seg_ids: str | None, seg_col: str = "cellSegmentationSetId",
                   id_col: str = "cell_name", keys: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """From raw metadata rows of all sources (with ``source_idx``, ``row_idx``
    and a ``cell_type`` column, see S1 / P15): without ids the first source is
    used; with ids the matching rows of the sources up to the one completing
    the id set (W3). Returns (rows (cell_ID, cell_type, hex_color), stats)."""
    keys = list(keys)
    if seg_ids is None or seg_ids.strip() == "":
        kept = V.first_nonempty_source(meta.withColumn("priority", F.col("source_idx")), keys).drop("priority")
        raw = kept
    else:
        kept = V.merge_metadata_sources(meta, seg_ids, seg_col=seg_col, keys=keys)
        raw = V.merge_metadata_sources(meta, seg_ids, seg_col=seg_col, keys=keys, matching=False)
    ct = F.coalesce(F.col("cell_type"), F.lit(""))
    out = kept.select(*keys, F.coalesce(F.col(id_col), F.lit("")).alias("cell_ID"), ct.alias("cell_type"),
                      deterministic_color(ct).alias("hex_color"), "source_idx", "row_idx")
    stats = C.metadata_stats(raw.withColumn(seg_col, F.coalesce(F.trim(F.col(seg_col)), F.lit(""))),
                             out, seg_col=seg_col, keys=keys)
    return out, stats


def slide_metadata_job(spark: SparkSession, experiment_root: str, slide: str, seg_ids: str | None,
                       out_path: str | None = None, cell_type_column: str | None = None):
    meta = RD.read_cell_metadata(spark, experiment_root, slide, cell_type_column)
    rows, stats = slide_metadata(meta, seg_ids)
    if out_path:
        S.write_cell_metadata(rows.orderBy("source_idx", "row_idx").withColumn("slide", F.lit(slide)), out_path)
    return rows, stats


# X2 -------------------------------------------------------------------------
KEYS = ["study", "experiment", "run", "slide"]
BASE = ["slide_base_path"]
SOURCE_KEYS = ["run", "slide"]
LOCATIONS = r"RunSummary/([^/]*" + re.escape(RD.FOV_LOCATIONS_SUFFIX) + ")"
CALLS = r"AnalysisResults/[^/]+/((?:[^/]+/)*[^/]*" + re.escape(RD.TARGET_FILE_SUFFIX) + ")"


def _calls_layout(inner) -> Column:
    """Place of a transcript file's folder layout in the order of preference."""
    out = F.lit(None).cast("int")
    for i, pattern in reversed(list(enumerate(RD.TARGET_LAYOUTS, start=1))):
        out = F.when((F.col(inner) if isinstance(inner, str) else inner).rlike("^" + pattern + "$"), F.lit(i)).otherwise(out)
    return out


def _below(inv: DataFrame, pattern: str, *names: str) -> DataFrame:
    """slide_base_path, path and the groups of ``pattern`` (below the slide folder)."""
    full = r"^(.*/DecodedFiles/[^/]+/[^/]+)/" + re.sub(r"\$$", r"(?:/[^/]+)?$", pattern)  # or part files of a folder of that name
    cols = [F.regexp_extract("rel", full, i + 2).alias(n) for i, n in enumerate(names)]
    return inv.where(F.col("rel").rlike(full)).select(F.regexp_extract("rel", full, 1).alias("slide_base_path"), "path", "length", "rel", *cols)


def highest_version(spark: SparkSession, inv: DataFrame, seg: DataFrame, root: str) -> DataFrame:
    """(slide_base_path, fallback_dir): the folder with the highest manifest Version
    (W2); slides without a readable manifest use the folders' own version numbers."""
    files = _below(inv, r"CellStatsDir/(Segmentation_[^/]+)/[^/]*\.json$", "dir")
    named = V.latest_manifest(seg.select("slide_base_path", "dir", segmentation_version("dir").alias("Version")).distinct(), ["slide_base_path"])
    out = named.select("slide_base_path", F.col("dir").alias("_named"))
    if not files.isEmpty():
        m = RD.read_manifests(spark, root, below=True)
        if "Version" in m.columns:
            tail = r"([^/]+/DecodedFiles/[^/]+/[^/]+)"  # run, slide and scan name a slide of one experiment
            base = F.regexp_extract(F.col("_metadata.file_path"), tail + "/CellStatsDir/Segmentation_", 1)
            m = V.latest_manifest(m.select(base.alias("_base"), "dir", "Version").where("_base <> ''"), ["_base"])
            out = out.join(m.select("_base", F.col("dir").alias("_manifest")),
                           F.regexp_extract("slide_base_path", tail + "$", 1) == F.col("_base"), "left")
            return out.select("slide_base_path", F.coalesce("_manifest", "_named").alias("fallback_dir"))
    return out.select("slide_base_path", F.col("_named").alias("fallback_dir"))


def cohort_metadata(meta: DataFrame, todo: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """X1 for all slides at once. ``wanted`` = (KEYS, uuid): the segmentation ids of
    each slide; sources are the metadata files of the same slide name in all runs, the
    slide's own run first. Returns (kept rows, stats) by KEYS."""
    m = meta.withColumn("_id", F.trim(F.coalesce(F.col("cellSegmentationSetId"), F.lit(""))))
    own = todo.select(*KEYS).withColumnRenamed("run", "_run")
    rows = m.withColumnRenamed("run", "source_run").join(own, "slide").withColumnRenamed("_run", "run")
    rows = rows.withColumn("source_idx", F.when(F.col("source_run") == F.col("run"), F.lit(-1)).otherwise(F.col("source_idx")))
    ids = wanted.select(*KEYS, F.col("uuid").alias("_id")).distinct()
    match = rows.join(ids, KEYS + ["_id"], "left_semi")
    first = match.groupBy(*KEYS, "_id").agg(F.min("source_idx").alias("_first"))
    cut = (ids.join(first, KEYS + ["_id"], "left").groupBy(*KEYS)
           .agg(F.max(F.coalesce("_first", F.lit(V.BIG_RANK))).alias("_cut")))
    seen = rows.join(cut, KEYS).where(F.col("source_idx") <= F.col("_cut"))
    kept = seen.join(ids, KEYS + ["_id"], "left_semi")
    ct = F.coalesce(F.col("cell_type"), F.lit(""))
    name = F.col("cell_name") if "cell_name" in kept.columns else F.lit(None).cast("string")
    out = kept.select(*KEYS, F.coalesce(name, F.lit("")).alias("cell_ID"), ct.alias("cell_type"),
                      deterministic_color(ct).alias("hex_color"), "source_idx", "row_idx")
    return out, C.metadata_stats(seen, out, seg_col="_id", keys=KEYS)


FINE, WRONG = "success", "failed"


def committed(spark: SparkSession, out_root: str, table: str) -> DataFrame:
    """A table the job wrote, as far as its slides are done: rows of the attempt that the
    slide's status names. What a broken run left behind is not seen."""
    status = spark.read.parquet(f"{out_root}/status").where(F.col("status") == FINE).select(*KEYS, "attempt")
    data = spark.read.option("header", True).csv(f"{out_root}/{table}") if table == "metadata" else spark.read.parquet(f"{out_root}/{table}")
    return data.join(status, [*KEYS, "attempt"], "left_semi").drop("attempt")


def slide_processing_job(spark: SparkSession, bucket_root: str, experiment_prefix: str, out_root: str,
                         run_log_path: str | None = None, tiles: DataFrame | None = None,
                         fov_size: tuple[int, int] = (4256, 4256), um_per_px: float = 0.1203,
                         resources: tuple[int, int] = (0, 0), processed_root: str = OUTPUT_ROOT,
                         images: DataFrame | None = None, block: int = BL.BLOCK) -> dict:
    """All slides of an experiment in one application; slide and run are columns.

    Steps: find slides that are not done yet (J6 over the status rows in ``out_root`` and
    over ``processed_root``), choose segmentation folders (W1; without an id, or without a
    folder for it, the highest manifest version, W2) and label files (W4), select the
    files to read (F5), stitch labels (R2, from ``tiles``: decoded label pixels
    slide_base_path, dir, fov, row, col, val) and morphology (F9, R1, R6, A9, from
    ``images``: decoded files slide_base_path, path, channel, height, width, depth,
    pixels as in :mod:`tessera.operators.blocks`), write slide geometry (K5), transcript
    calls (K2), cell metadata (X1, K1) and the run log (A11, K4).

    Every slide is committed by itself. Data goes under the run's ``attempt`` and counts
    (:func:`committed`) once the slide has its ``status`` row, written last; a run that is
    killed leaves slides without status, which the next run takes up again. A slide
    without a label file or FOV locations, or with a location that is no number, fails
    at ``stitch``; one without transcript files, or with a value or a column that cannot
    be read, at ``read_targets``; one without matching metadata rows at ``metadata``. It
    is logged as failed with that step while the others go on. If a step raises (a file
    that cannot be read at all), the slides are split in halves that are processed
    apart, until only the failing ones fail. A slide with a status, failed or not, is
    not processed again."""
    root, out_root = bucket_root.rstrip("/"), out_root.rstrip("/")
    inv = I.file_inventory(spark, root).withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    # one listing: every step reads this table
    inv = saved_table(inv.withColumn("rel", I.relative_path("path", re.sub("^file:/*(?=/)", "", root))))
    slides = parse_slide_path(I.discover_slides(inv.select(F.col("rel").alias("path")), experiment_prefix), "slide_base_path", processed_root)
    outputs = inv.where(F.col("rel").startswith(processed_root + "/")).select(F.col("rel").alias("key"))
    try:
        mine = I.file_inventory(spark, f"{out_root}/status").select(F.concat_ws("/", F.lit(processed_root), *[
            F.regexp_extract("path", rf"/{k}=([^/]+)/", 1) for k in KEYS], F.lit("x")).alias("key"))
        outputs = outputs.union(mine)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    todo = V.skip_processed(slides, outputs, depth=5).select("slide_base_path", *KEYS).distinct()
    # The list of work is needed by every step and must not change while outputs appear.
    todo = saved_table(todo)
    place = F.xxhash64("slide_base_path")
    done, waiting = [], [(0, 0)]  # (bits, value): the slides whose hash ends in these bits
    while waiting:
        bits, value = waiting.pop()
        part = todo.where(place.bitwiseAND((1 << bits) - 1) == value)
        if part.isEmpty():
            continue
        run = SlideRun(spark, inv, root, experiment_prefix, out_root, part, tiles, images, fov_size, um_per_px, block)
        try:
            run.steps()
        except Exception as e:  # whatever a step raises is a failure of the slides at hand
            if bits < 62 and part.limit(2).count() > 1:
                waiting += [(bits + 1, value), (bits + 1, value | 1 << bits)]
                continue
            run.give_up(e)
        done.append(run)
        log = run_log(spark, run.times, run.logged(), resources)
        run.log = log
        if run_log_path:
            S.write_run_log(log, run_log_path)
    result = {"slides": todo}
    for name in ("selected", "uncovered", "label_tiles", "selection", "status", "log", "metadata_stats"):
        frames = [getattr(r, name) for r in done if getattr(r, name, None) is not None]
        if frames:
            result[name] = reduce(DataFrame.unionByName, frames)
    return result


class SlideRun:
    """The steps of :func:`slide_processing_job` for the slides ``todo``, as one attempt."""

    def __init__(self, spark, inv, root, experiment_prefix, out_root, todo, tiles, images, fov_size, um_per_px, block):
        self.spark, self.inv, self.root, self.out_root, self.todo = spark, inv, root, out_root, todo
        self.experiment_root = f"{root}/{experiment_prefix.strip('/')}"
        self.tiles, self.images, self.fov_size, self.um_per_px, self.block = tiles, images, fov_size, um_per_px, block
        self.attempt = "a" + uuid.uuid4().hex  # a letter first: a partition value that stays a string
        self.keys = [*KEYS, "attempt"]
        self.times: list[tuple] = []

    def steps(self) -> None:
        for step in (self.download, self.stitch, self.read_targets, self.metadata, self.upload):
            self.times.append((step.__name__, datetime.now(), None))
            step()
            self.times[-1] = (*self.times[-1][:2], datetime.now())

    def give_up(self, error: Exception) -> None:
        """Status of a slide whose step raised."""
        step = self.times[-1][0]
        self.times[-1] = (*self.times[-1][:2], datetime.now())
        self.status = saved_table(self.todo.withColumn("status", F.lit(WRONG)).withColumn("failed_step", F.lit(step))
                                  .withColumn("error", F.lit(str(error)[:500])))
        self.write_status()

    def write_status(self) -> None:
        rows = self.status.withColumn("attempt", F.lit(self.attempt))
        S.write_status(rows.select(*KEYS, "status", "failed_step", "error", "attempt"), f"{self.out_root}/status", KEYS)

    def logged(self) -> DataFrame:
        fovs = _below(self.inv, r"CellStatsDir/(?:Segmentation_[^/]+/)?(FOV[0-9]+)/", "fov_dir")
        sizes = I.inventory_stats(fovs.join(self.todo.select(*BASE), BASE, "left_semi"), BASE)
        return self.status.join(sizes, BASE, "left")

    def read_files(self, good: DataFrame, folder: str, suffix: str, pattern: str, of_file) -> DataFrame:
        """CSV files of the slides ``good`` (the list of slides is the run's list of work).
        Only ``folder`` of each is listed again: label folders hold most of a slide's files.
        ``of_file`` is given the files of ``pattern`` with their slide (see RD.read_csv_by_name)."""
        own = [r["slide_base_path"] for r in good.select("slide_base_path").distinct().collect()]
        files = RD.named(self.root, r".*/DecodedFiles/[^/]+/[^/]+/" + pattern, "_path")
        return RD.read_csv_by_name(self.spark, [f"{self.root}/{RD.literal(base)}/{folder}" for base in own],
                                   F.contains(F.col("_metadata.file_path"), F.lit(suffix)), None,
                                   lambda found: of_file(found.where(files).withColumn("slide_base_path", self.of_slide())))

    def of_slide(self) -> Column:
        return F.regexp_extract("_path", re.escape(re.sub("^file:/*(?=/)", "", self.root)) + r"/(.*/DecodedFiles/[^/]+/[^/]+)/", 1)

    def download(self) -> None:
        """Which segmentations, label files, FOV locations and calls each slide has."""
        inv, todo = self.inv, self.todo
        seg = saved_table(_below(inv, r"CellStatsDir/(Segmentation_[^/]+)/FOV(\d+)/", "dir", "fov").select(
            *BASE, "dir", F.col("fov").cast("int").alias("fov")).distinct().join(todo.select(*BASE), BASE, "left_semi"))
        names = [r["slide"] for r in todo.select("slide").distinct().collect()]
        try:
            self.meta = RD.read_cohort_metadata(self.spark, self.experiment_root, names)
            # first row of the run's own metadata file (W8), matched to a folder
            prim = V.primary_segmentation(self.meta, SOURCE_KEYS, order="row_idx")
            runs = todo.join(prim, SOURCE_KEYS, "left").withColumn("primary_seg_id", F.coalesce("primary_seg_id", F.lit("")))
        except FileNotFoundError:
            self.meta, runs = None, todo.withColumn("primary_seg_id", F.lit(""))
        matched = V.match_segmentation_dir(runs.select(*BASE, "primary_seg_id"), seg.select(*BASE, "dir"), BASE)
        primary = (matched.join(highest_version(self.spark, inv, seg, self.experiment_root), BASE, "left")
                   .select(*BASE, F.coalesce("primary_dir", "fallback_dir").alias("primary_dir")).where("primary_dir IS NOT NULL"))
        selected, uncovered = V.select_segmentations(seg, saved_table(primary), BASE)
        self.selected = selected = saved_table(selected)
        lab = inv.where(F.upper(F.regexp_extract("rel", r"([^/]*)$", 1)).rlike("^" + I.LABEL_FILE)).select(
            F.regexp_extract("rel", r"^(.*)/CellStatsDir/", 1).alias("slide_base_path"),
            F.regexp_extract("rel", r"/CellStatsDir/(Segmentation_[^/]+)/", 1).alias("dir"), F.col("rel").alias("path"))
        lab = lab.withColumn("dir", F.when(F.col("dir") == "", F.lit("CellStatsDir")).otherwise(F.col("dir")))
        lab = lab.withColumn("fov", acquisition_field("path", "fov")).join(todo.select(*BASE), BASE, "left_semi")
        label_tiles = V.pick_label_tiles(lab, selected.select(*BASE, "dir", F.col("rank").alias("priority")), BASE)
        self.uncovered, self.label_tiles = saved_table(uncovered), saved_table(label_tiles)
        own = inv.join(todo.select(*BASE), F.regexp_extract("rel", r"^(.*/DecodedFiles/[^/]+/[^/]+)/", 1) == F.col("slide_base_path"))
        flagged = I.select_inventory(own.withColumn("rel", I.relative_path("rel", F.col("slide_base_path"))),
                                     I.slide_selection_includes(["Segmentation_*"], "*"))
        self.selection = I.selection_summary(flagged, BASE)
        loc = _below(inv, LOCATIONS + "$", "name").join(todo.select(*BASE), BASE, "left_semi")
        self.locations = saved_table(loc.groupBy(*BASE).agg(F.max("name").alias("name")))
        tf = _below(inv, CALLS + "$", "inner").join(todo.select(*BASE), BASE, "left_semi")
        tf = tf.withColumn("layout", _calls_layout("inner")).groupBy(*BASE).agg(F.min("layout").alias("layout"))
        self.layouts = saved_table(tf.where("layout IS NOT NULL"))
        self.rows = self.metadata_stats = None
        if self.meta is not None:
            self.rows, self.metadata_stats = cohort_metadata(self.meta, todo, self.selected.join(todo, BASE).select(*KEYS, "uuid"))
        has = lambda df, name: df.select(*BASE).distinct().withColumn(name, F.lit(True))
        kept = (self.rows.select(*KEYS).distinct().withColumn("has_metadata", F.lit(True)) if self.rows is not None
                else todo.select(*KEYS).withColumn("has_metadata", F.lit(None).cast("boolean")))
        state = (todo.join(has(self.label_tiles, "has_labels"), BASE, "left").join(has(self.locations, "has_locations"), BASE, "left")
                 .join(has(self.layouts, "has_calls"), BASE, "left").join(kept, KEYS, "left"))
        failed = (F.when(F.col("has_labels").isNull() | F.col("has_locations").isNull(), "stitch")
                  .when(F.col("has_calls").isNull(), "read_targets").when(F.col("has_metadata").isNull(), "metadata").otherwise(""))
        self.state = saved_table(state.withColumn("failed_step", failed).withColumn("error", F.lit("")).select(*BASE, *KEYS, "failed_step", "error"))

    def good(self) -> DataFrame:
        return self.state.where("failed_step = ''").select(*BASE, *KEYS).withColumn("attempt", F.lit(self.attempt))

    def fail(self, slides: DataFrame, step: str, error: str) -> None:
        """The slides (KEYS) fail at ``step`` unless they failed before."""
        bad = slides.select(*KEYS).distinct().withColumn("_bad", F.lit(True))
        hit = (F.col("failed_step") == "") & F.col("_bad").isNotNull()
        self.state = saved_table(self.state.join(bad, KEYS, "left").withColumn("error", F.when(hit, F.lit(error)).otherwise(F.col("error")))
                                 .withColumn("failed_step", F.when(hit, F.lit(step)).otherwise(F.col("failed_step"))).drop("_bad"))

    def stitch(self) -> None:
        good = self.good()
        if good.isEmpty():
            return
        name = F.regexp_extract("_path", "/" + LOCATIONS + r"(?:/[^/]+)?$", 1)
        f = self.read_files(good, "RunSummary", RD.FOV_LOCATIONS_SUFFIX, LOCATIONS, lambda found: found.withColumn("name", name)
                            .join(self.locations, [*BASE, "name"], "left_semi").join(good, BASE).select("_path", "header", *self.keys))
        number = lambda c, t: (F.col(c).try_cast(t) if c in f.columns else F.lit(None).cast(t)).alias(c)
        f = f.select("_of.*", number("FOV", "int"), number("X_mm", "double"), number("Y_mm", "double"), "row_idx")
        f = saved_table(f.withColumn("ord", F.col("row_idx.mid")).drop("row_idx"))
        self.fail(f.where("FOV IS NULL OR X_mm IS NULL OR Y_mm IS NULL"), "stitch", "FOV locations that cannot be read")
        good = self.good()
        f = f.join(good, self.keys, "left_semi")
        if f.isEmpty():
            return
        S.write_slide_geometry(f, f"{self.out_root}/geometry", *self.fov_size, self.um_per_px, "1", self.keys)
        origins = R.fov_origins(f, *self.fov_size, 1000 / self.um_per_px, self.keys)
        if self.tiles is not None:
            px = self.tiles.join(self.label_tiles.select(*BASE, "dir", "fov"), BASE + ["dir", "fov"], "left_semi").join(good, BASE).drop(*BASE, "dir")
            S.write_mosaic(R.stitch_labels(px, origins, self.keys), f"{self.out_root}/labels", keys=self.keys)
        if self.images is not None:
            self.morphology(good, origins)

    def morphology(self, good: DataFrame, origins: DataFrame) -> None:
        """Mosaics of the morphology images in blocks, all pyramid levels, and each channel's
        contrast window from the coarsest level."""
        kinds = I.classify_image_files(self.inv.select("path", "rel"), col="rel").where("kind = 'morphology'").select(F.col("rel").alias("path"), "fov")
        own = self.images.join(kinds, "path").join(good, BASE).drop("path", *BASE)
        pieces = BL.cut_tiles(own, [*self.keys, "fov", "channel"])
        levels = saved_table(BL.pyramid_blocks(BL.stitch_blocks(pieces, origins, self.block, self.keys), self.block))
        S.write_blocks(levels, f"{self.out_root}/images", [*self.keys, "channel", "level"])
        top = R.pyramid_levels(F.col("canvas_h"), F.col("canvas_w")) - 1
        pixels = BL.blocks_to_long(levels.where(F.col("level") == top), self.block)
        S.write_windows(R.contrast_window(pixels, [*self.keys, "channel"]), f"{self.out_root}/windows", self.keys)

    def read_targets(self) -> None:
        """Calls of the chosen layout. A row with a number that cannot be read, or without a
        target, goes to the null FOV, whose partition marks its slide as failed."""
        good = self.good()
        if good.isEmpty():
            return
        layout = _calls_layout(F.regexp_extract("_path", "/" + CALLS + r"(?:/[^/]+)?$", 1))
        calls = self.read_files(good, "AnalysisResults", RD.TARGET_FILE_SUFFIX, CALLS, lambda found: found.withColumn("layout", layout)
                                .join(self.layouts, [*BASE, "layout"], "left_semi").join(good, BASE).select("_path", "header", *self.keys))
        calls = calls.select("_of.*", *[(F.col(c).try_cast(t) if c in calls.columns else F.lit(None).cast(t)).alias(c) for c, t in RD.TARGET_COLUMNS])
        whole = F.lit(True)
        for c, t in RD.TARGET_COLUMNS:
            if c == "target" or t != "string":
                whole = whole & F.col(c).isNotNull()
        path = f"{self.out_root}/targets"
        # the attempt is new, so nothing is replaced
        S.write_targets(calls.withColumn("fov", F.when(whole, F.col("fov"))), path, [*self.keys, "fov"], replace=False)
        wrong = self.spark.read.parquet(path).where((F.col("attempt") == self.attempt) & F.col("fov_group").isNull())
        self.fail(wrong, "read_targets", "values or columns that cannot be read")

    def metadata(self) -> None:
        if self.rows is not None:
            S.write_cell_metadata(self.rows.join(self.good().select(*self.keys), KEYS), f"{self.out_root}/metadata", self.keys)

    def upload(self) -> None:
        status = F.when(F.col("failed_step") == "", FINE).otherwise(WRONG)
        self.status = saved_table(self.state.withColumn("status", status).select(*BASE, *KEYS, "status", "failed_step", "error"))
        self.write_status()


def run_log(spark: SparkSession, times: list[tuple], state: DataFrame, resources: tuple[int, int]) -> DataFrame:
    """One row per slide, 17 columns: the steps ran once for all slides, so their
    durations (A11) are the application's; status and failed step are the slide's."""
    steps = spark.createDataFrame([("all", *t) for t in times], "app string, step string, start timestamp, end timestamp")
    d = L.run_durations(steps, keys=["app"]).drop("app", "status", "failed_step").first()
    text = lambda v: F.lit("" if v is None else str(v))
    return state.select(F.col("slide").alias("slide_name"), "study", "experiment", "run", F.lit(resources[0]).alias("vcpus"),
                        F.lit(resources[1]).alias("memory_mb"), F.coalesce("fov_count", F.lit(0)).alias("fov_count"),
                        F.coalesce("total_bytes", F.lit(0)).alias("fov_bytes"), F.lit(times[0][1]).alias("start_time"),
                        *[text(d[f"duration_{s}_s"]).alias(f"duration_{s}_s") for s in (*L.STEPS, "total")],
                        "status", "failed_step")


# X3 -------------------------------------------------------------------------
def dotplot_job(expr_a: DataFrame, meta_a: DataFrame, expr_b: DataFrame, meta_b: DataFrame,
                genes: list[str], fovs_b=None, only: list[str] | None = None) -> DataFrame:
    ta = C.drop_unannotated(C.expression_with_type(expr_a, meta_a))
    eb = C.filter_fovs(expr_b, fovs_b) if fovs_b is not None else expr_b
    tb = C.drop_unannotated(C.expression_with_type(eb, meta_b))
    return C.dotplot_matrix(C.dotplot_stats_wide(ta, genes), C.dotplot_stats_wide(tb, genes), only=only)


# X4 -------------------------------------------------------------------------
def reclassification_job(meta_a: DataFrame, meta_b: DataFrame, slide_col: str = "slide"):
    """Flows for every slide present in both experiments; node colours from
    the type name (P7), link colours = source colour at 30 % alpha (P9)."""
    both = C.shared_and_exclusive_slides(meta_a, meta_b, slide_col).where(F.col("status") == "both").select(slide_col)
    a = meta_a.join(both, slide_col, "left_semi")
    b = meta_b.join(both, slide_col, "left_semi")
    la = a.select(slide_col, "cell_name", F.coalesce("cell_type", F.lit("")).alias("type_a"), "row_idx")
    lb = b.select(slide_col, "cell_name", F.coalesce("cell_type", F.lit("")).alias("type_b"), "row_idx")
    la = la.groupBy(slide_col, "cell_name").agg(F.max_by("type_a", "row_idx").alias("type_a"))
    lb = lb.groupBy(slide_col, "cell_name").agg(F.max_by("type_b", "row_idx").alias("type_b"))
    matched = la.join(lb, [slide_col, "cell_name"])
    links, nodes, summary = C.type_flows(matched, [slide_col])
    nodes = nodes.withColumn("color", deterministic_color("type"))
    links = links.withColumn("color", rgba_from_hex(deterministic_color("type_a")))
    return links, nodes, summary


# X5 -------------------------------------------------------------------------
def density_job(meta_a: DataFrame, meta_b: DataFrame, fovs_b=None) -> DataFrame:
    a = C.type_density(C.drop_unannotated(meta_a))
    mb = C.drop_unannotated(meta_b)
    b = C.type_density(C.filter_fovs(mb, fovs_b) if fovs_b is not None else mb)
    return C.density_compare(a, b)


def cluster_label_job(umap_a: DataFrame, umap_b: DataFrame, fovs_b=None):
    from ..functions.color import palette_color
    ub = C.filter_fovs(umap_b, fovs_b) if fovs_b is not None else umap_b
    ua, ub = C.drop_unannotated(umap_a), C.drop_unannotated(ub)
    shared = ua.select("cell_type").union(ub.select("cell_type")).distinct()
    return (palette_color(C.cluster_labels(ua), "cell_type", dictionary=shared),
            palette_color(C.cluster_labels(ub), "cell_type", dictionary=shared))


def histogram_job(meta: DataFrame) -> DataFrame:
    return C.cell_type_counts(meta)


# X6 -------------------------------------------------------------------------
MAX_LAYERS = 1000  # annotation layers of one job: drawn by hand, one column each


def roi_annotation_job(shapes: DataFrame, labels: DataFrame, meta: DataFrame, targets: DataFrame,
                       mm_per_px: float, top_left_mm, height, width, points: DataFrame | None = None, keys: list[str] = ()):
    """Cells inside drawn shapes, and under the points of point layers (J8; ``points`` =
    (keys, layer, y, x)) -> per-layer flags on the cell table -> transcript counts per
    gene in those cells. With ``keys`` on all frames every slide has its own. At most
    ``MAX_LAYERS`` layers: their names become columns."""
    keys = list(keys)
    inside = R.cells_in_shapes(shapes, labels, mm_per_px, top_left_mm, height, width, keys=keys)
    by_layer = inside.select(*keys, "UID", F.concat(F.lit("shape_"), F.col("shape_id").cast("string")).alias("layer"))
    names = shapes.select(F.concat(F.lit("shape_"), F.col("shape_id").cast("string")).alias("layer"))
    if points is not None:
        at = R.cells_at_points(points.select(*keys, F.concat(F.lit("points_"), "layer").alias("layer"), "y", "x"), labels, mm_per_px, top_left_mm, keys)
        by_layer = by_layer.union(at.select(*keys, "UID", "layer"))
        names = names.union(points.select(F.concat(F.lit("points_"), "layer")))
    layers = sorted(r["layer"] for r in names.distinct().limit(MAX_LAYERS + 1).collect())
    if len(layers) > MAX_LAYERS:
        raise ValueError(f"more than {MAX_LAYERS} annotation layers")
    flags = C.flag_cells(meta, by_layer, layers, keys=keys)
    counts = T.target_counts_for_cells(by_layer.select(*keys, "UID").distinct(), T.drop_control_probes(targets), keys=keys)
    return flags, counts
