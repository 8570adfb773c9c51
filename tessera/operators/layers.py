"""Image-layer catalogue and export batching.

S9 layer_catalog, R13 layer_catalog_ome, W5 batch_layers,
W6 resolve_requested_layers, W7 random_groups.

Layer catalogues have one row per image layer (tens to hundreds); the request
string is a parameter. All logic stays in DataFrame expressions so catalogues of
many slides are handled in one job (``keys`` = slide columns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# ---------------------------------------------------------------------------
# Fixed values.
RESERVED_LAYERS = ["labels", "protein", "composite", "targets", "fovgrid"]
DEFAULT_COLORMAPS = {"DAPI": "blue", "DNA": "blue", "PanCK": "green", "U": "blue", "G": "green"}
DEFAULT_COLOR = "gray"
DEFAULT_WINDOW = (0, 65535)
EMPTY_WINDOW_END = 1000
# Last colour of each named colormap, as RRGGBB; unknown names -> FFFFFF.
COLORMAP_HEX = {"gray": "FFFFFF", "blue": "0000FF", "green": "00FF00", "red": "FF0000",
                "cyan": "00FFFF", "magenta": "FF00FF", "yellow": "FFFF00"}
SEGMENTATION_ROW = ("segmentation", "00FFFF", 0, 1)
KEEP_WHOLE = "Cathepsin B"           # multi-word layer name kept whole when splitting
# ---------------------------------------------------------------------------


def _map(d: dict):
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


# S9 -------------------------------------------------------------------------
def layer_catalog(channels: DataFrame, proteins: DataFrame | None = None,
                  windows: DataFrame | None = None, keys: list[str] = ()) -> DataFrame:
    """One row per layer: channels (names without ``.zarr``, reserved names
    removed) then proteins, with colour and window (start, end).

    ``windows`` = (keys, name, type, min, max, start, end, color) stored per
    layer; missing -> 0..65535. Degenerate window (start == end): end 0 ->
    end 1000, else start 0."""
    keys = list(keys)
    ch = (channels.select(*keys, F.regexp_replace("name", r"\.zarr$", "").alias("name")).distinct()
          .where(~F.col("name").isin(RESERVED_LAYERS)).withColumn("type", F.lit("channel")))
    cat = ch
    if proteins is not None:
        pr = (proteins.select(*keys, F.regexp_replace("name", r"\.zarr$", "").alias("name")).distinct()
              .withColumn("type", F.lit("protein")))
        cat = cat.unionByName(pr)
    if windows is not None:
        w = windows.select(*keys, "name", "type", F.col("start").alias("_s"), F.col("end").alias("_e"),
                           F.col("color").alias("_c") if "color" in windows.columns else F.lit(None).cast("string").alias("_c"))
        cat = cat.join(w, keys + ["name", "type"], "left")
    else:
        cat = (cat.withColumn("_s", F.lit(None).cast("long")).withColumn("_e", F.lit(None).cast("long"))
                  .withColumn("_c", F.lit(None).cast("string")))
    s = F.coalesce(F.col("_s").cast("long"), F.lit(DEFAULT_WINDOW[0]).cast("long"))
    e = F.coalesce(F.col("_e").cast("long"), F.lit(DEFAULT_WINDOW[1]).cast("long"))
    cat = cat.withColumn("start", s).withColumn("end", e)
    same = F.col("start") == F.col("end")
    cat = (cat.withColumn("start", F.when(same & (F.col("end") != 0), F.lit(0).cast("long")).otherwise(F.col("start")))
              .withColumn("end", F.when(same & (F.col("end") == 0), F.lit(EMPTY_WINDOW_END).cast("long"))
                          .otherwise(F.col("end"))))
    color = F.coalesce(F.col("_c"), F.element_at(_map(DEFAULT_COLORMAPS), F.col("name")), F.lit(DEFAULT_COLOR))
    # try_element_at semantics: element_at on a missing map key returns NULL (non-ANSI) -> coalesce.
    cat = cat.withColumn("color", color)
    order = F.when(F.col("type") == "channel", 0).otherwise(1)
    return cat.select(*keys, "name", "type", "color", "start", "end").withColumn("_o", order) \
              .orderBy(*keys, "_o", "name").drop("_o")


# R13 ------------------------------------------------------------------------
def layer_catalog_ome(catalog: DataFrame, active: list[str] | None = None, keys: list[str] = ()) -> DataFrame:
    """OME channel list: colour name -> RRGGBB (unknown -> FFFFFF), active flag,
    label without ``protein/``, plus a fixed segmentation row (00FFFF, 0..1).
    With no active list nothing is active."""
    keys = list(keys)
    act = list(active or [])
    c = catalog.select(
        *keys, F.regexp_replace("name", "^protein/", "").alias("label"),
        F.coalesce(F.try_element_at(_map(COLORMAP_HEX), F.col("color")), F.lit("FFFFFF")).alias("color"),
        F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
        F.col("name").isin(act).alias("active"))
    seg = catalog.select(*keys).distinct() if keys else catalog.sparkSession.range(1).select()
    seg = seg.select(*keys, F.lit(SEGMENTATION_ROW[0]).alias("label"), F.lit(SEGMENTATION_ROW[1]).alias("color"),
                     F.lit(SEGMENTATION_ROW[2]).cast("long").alias("start"),
                     F.lit(SEGMENTATION_ROW[3]).cast("long").alias("end"), F.lit(True).alias("active"))
    return c.unionByName(seg)


# W6 -------------------------------------------------------------------------
def split_request(spark: SparkSession, request: str | None) -> DataFrame:
    """(pos, item): what a request names, in order. An item is the one name of two words,
    where it stands between separators (spaces, commas), or else a run without them."""
    item = rf"(?<![^ ,]){KEEP_WHOLE}(?![^ ,])|[^ ,]+"
    found = F.regexp_extract_all(F.lit(request or ""), F.lit(item), F.lit(0))
    return spark.range(1).select(F.posexplode(found).alias("pos", "item"))


def resolve_requested_layers(spark: SparkSession, request: str | None, catalog: DataFrame,
                             prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """Returns (kept (pos, name), invalid (pos, name)); an empty request keeps the
    whole catalogue in name order. Duplicated requests are kept."""
    names = catalog.select(F.col("name")).distinct()
    req = split_request(spark, request).select("pos", F.concat(F.lit(prefix), F.col("item")).alias("name"))
    if request is None or request.strip(" ,") == "":
        kept = names.withColumn("pos", F.row_number().over(Window.orderBy("name")) - 1).select("pos", "name")
        return kept, req.limit(0)
    kept = req.join(names, "name", "left_semi").select("pos", "name")
    bad = req.join(names, "name", "left_anti").select("pos", "name")
    return kept, bad


# W5 -------------------------------------------------------------------------
def batch_layers(items: DataFrame, n: int, labels: str | None = None) -> DataFrame:
    """Fill batches of ``n`` in order (``items`` = (seq, name); channels then
    proteins share the counter). The label layer, when given, is prepended to
    every batch and not counted. Returns (batch, items ARRAY) with at most n+1
    entries per batch (bounded collect)."""
    w = Window.orderBy("seq")
    i = items.withColumn("_i", F.row_number().over(w) - 1)
    i = i.withColumn("batch", F.floor(F.col("_i") / n).cast("int"))
    g = i.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("_i", "name"))).alias("_l"))
    arr = F.transform("_l", lambda s: s["name"])
    if labels:
        arr = F.concat(F.array(F.lit(labels)), arr)
    return g.select("batch", arr.alias("items"))


def digest_group(n: int, seed: int, *columns: Column) -> Column:
    """1..n from the first 8 hex digits of md5("seed|value|value...") (null = empty)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % n + 1


# W7 -------------------------------------------------------------------------
def random_groups(df: DataFrame, n: int, seed: int = 0, out: str = "grp") -> DataFrame:
    """Integer 1..n per row, uniform over rows, from a digest of the seed and the
    row's values: the same whatever the partitioning, and after a retry."""
    return df.withColumn(out, digest_group(n, seed, *[F.col(f"`{c}`") for c in df.columns]).cast("int"))
