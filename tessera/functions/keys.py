"""Key and name parsing as Column expressions (no Python UDFs).

P1 parse_slide_path, P2 parse_segmentation_dir, P3 parse_acquisition_name,
P4 cell_uid, P5 pair_key / unpair_key, P6 key_label_pixels, P10 short_run_name,
P13 parse_barcode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the instrument's naming conventions.
# File-name fields of an acquisition image (matched on the base name, Java regex):
ACQ_PATTERNS = {
    "timestamp": r"^([0-9]{8}_[0-9]{6})_",
    "slide": r"(?:^|_)S([0-9])(?:_|$)",
    "cycle": r"(?:^|_)C([0-9]+)(?:_|[.]|$)",
    "pool": r"(?:^|_)P([0-9]+)(?:_|[.]|$)",
    "spot": r"(?:^|_)N([0-9]+)(?:_|[.]|$)",
    "fov": r"(?:^|_)F(?:OV)?([0-9]+)(?:_|[.]|$)",
    "zslice": r"(?:^|_)Z([0-9]+)(?:_|[.]|$)",
}
# Cell id strings look like c_<slide>_<fov>_<cell>; greedy, unanchored.
CELL_ID_PATTERN = r"c_.*_(.*)_(.*)"
# Segmentation folders: Segmentation_<uuid>[_<NNN>]
SEG_PREFIX = "Segmentation_"
SEG_VERSION_PATTERN = r"_(\d+)$"
# ---------------------------------------------------------------------------
OUTPUT_ROOT = "processed"  # default first folder of a processed slide's output prefix


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P1 -------------------------------------------------------------------------
def parse_slide_path(df: DataFrame, col: str = "slide_base_path", output_root: str = OUTPUT_ROOT) -> DataFrame:
    """Split ``Study/Experiment/Run/DecodedFiles/Slide/ScanId`` from the right."""
    parts = F.split(F.regexp_replace(F.col(col), "/+$", ""), "/")
    out = (df.withColumn("slide", F.element_at(parts, -2))
             .withColumn("scan_id", F.element_at(parts, -1))
             .withColumn("run", F.element_at(parts, -4))
             .withColumn("experiment", F.element_at(parts, -5))
             .withColumn("study", F.element_at(parts, -6)))
    return (out.withColumn("experiment_prefix", F.concat_ws("/", "study", "experiment"))
               .withColumn("output_prefix",
                           F.concat_ws("/", F.lit(output_root), "study", "experiment", "run", "slide")))


def split_s3_uri(c: Column | str) -> tuple[Column, Column]:
    """``s3://bucket/prefix`` -> (bucket, prefix)."""
    c = _c(c)
    body = F.regexp_replace(c, r"^s3://", "")
    return (F.regexp_extract(body, r"^([^/]*)", 1),
            F.regexp_replace(F.regexp_extract(body, r"^[^/]*/?(.*)$", 1), "/+$", ""))


# P2 -------------------------------------------------------------------------
def segmentation_version(c: Column | str) -> Column:
    """Trailing ``_NNN`` of a segmentation folder as INT, else 0."""
    v = F.regexp_extract(_c(c), SEG_VERSION_PATTERN, 1)
    return F.coalesce(F.when(v == "", None).otherwise(v).try_cast("int"), F.lit(0))


def segmentation_uuid(c: Column | str) -> Column:
    """Folder name without the ``Segmentation_`` prefix and version suffix."""
    c = _c(c)
    no_prefix = F.when(c.startswith(SEG_PREFIX), F.substring(c, len(SEG_PREFIX) + 1, 1 << 30)).otherwise(c)
    return F.regexp_replace(no_prefix, SEG_VERSION_PATTERN, "")


def parse_segmentation_dir(df: DataFrame, col: str = "dir") -> DataFrame:
    return (df.withColumn("uuid", segmentation_uuid(col))
              .withColumn("version", segmentation_version(col)))


# P3 -------------------------------------------------------------------------
def base_name(c: Column | str) -> Column:
    return F.regexp_extract(_c(c), r"([^/]*)$", 1)


def acquisition_field(c: Column | str, field: str) -> Column:
    """One field of an acquisition file name; NULL when absent."""
    s = F.regexp_extract(base_name(c), ACQ_PATTERNS[field], 1)
    s = F.when(s == "", None).otherwise(s)
    return s if field == "timestamp" else s.try_cast("int")


def parse_acquisition_name(df: DataFrame, col: str = "path") -> DataFrame:
    for f in ACQ_PATTERNS:
        df = df.withColumn(f, acquisition_field(col, f))
    return df


def fov_dir_number(c: Column | str) -> Column:
    """``.../FOV00012`` -> 12 (FOV directories); NULL otherwise."""
    s = F.regexp_extract(_c(c), r"FOV(\d+)$", 1)
    return F.when(s == "", None).otherwise(s).try_cast("int")


# P5 -------------------------------------------------------------------------
def pair_key(x: Column | str, y: Column | str) -> Column:
    """Szudzik pairing of two non-negative integers, as LONG."""
    x = _c(x).cast("long")
    y = _c(y).cast("long")
    return F.when(x >= y, x * x + x + y).otherwise(y * y + x)


def unpair_key(df: DataFrame, z: str, x_out: str = "fov", y_out: str = "CellId") -> DataFrame:
    """Inverse of :func:`pair_key`, adding (x_out, y_out) columns.

    floor(sqrt(z)) is estimated in double and corrected by one step either way
    (exact for LONG z beyond 2^52). Each step is its own projection so the
    optimizer does not inline the square root into every later reference.
    """
    zc = F.col(z).cast("long")
    df = df.withColumn("_uf", F.floor(F.sqrt(zc.cast("double"))).cast("long"))
    df = df.withColumn("_uf", F.when(F.col("_uf") * F.col("_uf") > zc, F.col("_uf") - 1).otherwise(F.col("_uf")))
    df = df.withColumn("_uf", F.when((F.col("_uf") + 1) * (F.col("_uf") + 1) <= zc, F.col("_uf") + 1)
                       .otherwise(F.col("_uf")))
    df = df.withColumn("_ur", zc - F.col("_uf") * F.col("_uf"))
    lo = F.col("_ur") < F.col("_uf")
    df = df.withColumn(x_out, F.when(lo, F.col("_ur")).otherwise(F.col("_uf")))
    df = df.withColumn(y_out, F.when(lo, F.col("_uf")).otherwise(F.col("_ur") - F.col("_uf")))
    return df.drop("_uf", "_ur")


# P4 -------------------------------------------------------------------------
def cell_uid(df: DataFrame, col: str = "cell_ID", out: str = "UID") -> DataFrame:
    """UID = pair(fov, cell) parsed from ``c_<..>_<fov>_<cell>``; an existing UID
    column is kept as is."""
    if out in df.columns:
        return df
    fov = F.regexp_extract(F.col(col), CELL_ID_PATTERN, 1).try_cast("long")
    cell = F.regexp_extract(F.col(col), CELL_ID_PATTERN, 2).try_cast("long")
    return df.withColumn(out, pair_key(fov, cell))


# P6 -------------------------------------------------------------------------
def key_label_pixels(df: DataFrame, fov_col: str = "fov", val_col: str = "val") -> DataFrame:
    """Background (0) stays 0, any other label becomes pair(fov, label)."""
    return df.withColumn(val_col, F.when(F.col(val_col) == 0, F.lit(0).cast("long"))
                         .otherwise(pair_key(fov_col, val_col)))


# P10 ------------------------------------------------------------------------
def short_run_name(c: Column | str) -> Column:
    """Tokens split on ``_`` up to the first all-digit token that follows at least
    one kept token (``Liver_A_06_04_2026_..`` -> ``Liver_A``)."""
    last = F.element_at(F.split(F.regexp_replace(_c(c), "/+$", ""), "/"), -1)
    toks = F.split(last, "_")
    idx = F.transform(toks, lambda t, i: F.when((i > 0) & t.rlike(r"^[0-9]+$"), i))
    cut = F.array_min(F.filter(idx, lambda v: v.isNotNull()))
    kept = F.when(cut.isNull(), toks).otherwise(F.slice(toks, 1, cut))
    return F.array_join(kept, "_")


def strip_run_suffix(c: Column | str) -> Column:
    """Variant: drop a trailing ``\\d[\\d_]*`` then trailing underscores."""
    return F.regexp_replace(F.regexp_replace(_c(c), r"\d[\d_]*$", ""), "_+$", "")


# P13 ------------------------------------------------------------------------
def parse_barcode(df: DataFrame, col: str = "colorCode") -> DataFrame:
    """colour = first two-capital run of the code, spot = its 1-based position,
    id = ``N<spot:02>_<colour>``."""
    color = F.regexp_extract(F.col(col), "([A-Z]{2})", 1)
    return (df.withColumn("color", color)
              .withColumn("spot", F.instr(F.col(col), color))
              .withColumn("id", F.format_string("N%02d_%s", F.col("spot"), F.col("color"))))
