"""Image-description parsing: P11 infer_scale, P12 morphology_markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .geometry import ALPHA_UM_PER_PX, BETA_UM_PER_PX, DASH_UM_PER_PX

# ---------------------------------------------------------------------------
# Morphology channels in order and their default markers.
MORPHOLOGY_CHANNELS = ["B", "G", "Y", "R", "U"]
DEFAULT_MARKERS = ["Histone", "Empty", "rRNA", "GFAP", "DAPI"]
BETA_DIVISOR = 133
# ---------------------------------------------------------------------------

_REAGENTS = T.StructType([T.StructField("MorphologyKit", T.StructType([
    T.StructField("MorphologyReagents", T.ArrayType(T.StructType([
        T.StructField("Fluorophore", T.StructType([T.StructField("ChannelId", T.StringType())])),
        T.StructField("BiologicalTarget", T.StringType())])))]))])


def infer_scale(desc: Column, height: Column, width: Column, user_scale: float = 1.0) -> Column:
    """um/px = round(PixelSize_um / Magnification, 4) from the image description
    JSON; if it is missing or unparsable, by FOV shape: not square -> 0.18, both
    sides divisible by 133 -> 0.1203, else 0.1681. Then divided by the user scale
    and rounded to 4 places (half-even)."""
    mag = F.get_json_object(desc, "$.Magnification").try_cast("double")
    px = F.get_json_object(desc, "$.PixelSize_um").try_cast("double")
    from_json = F.bround(F.try_divide(px, mag), 4)
    h, w = height.cast("long"), width.cast("long")
    by_shape = (F.when(h != w, F.lit(DASH_UM_PER_PX))
                 .when((h % BETA_DIVISOR == 0) & (w % BETA_DIVISOR == 0), F.lit(BETA_UM_PER_PX))
                 .otherwise(F.lit(ALPHA_UM_PER_PX)))
    um = F.coalesce(from_json, by_shape)
    return F.bround(um / F.lit(float(user_scale)), 4)


def with_scales(df: DataFrame, desc: str, height: str, width: str, user_scale: float = 1.0) -> DataFrame:
    um = infer_scale(F.col(desc), F.col(height), F.col(width), user_scale)
    return (df.withColumn("um_per_px", um)
              .withColumn("mm_per_px", F.col("um_per_px") / 1000)
              .withColumn("px_per_mm", 1 / F.col("mm_per_px")))


def morphology_markers(df: DataFrame, desc: str) -> DataFrame:
    """Marker per morphology channel (``marker_B`` ... ``marker_U``) from the
    description JSON (``/`` -> ``_``; duplicated channel ids: last wins). If the
    JSON does not parse or any channel is missing, all five fall back to the
    defaults together."""
    r = F.from_json(F.col(desc), _REAGENTS)["MorphologyKit"]["MorphologyReagents"]
    out = df
    picks = []
    for ch in MORPHOLOGY_CHANNELS:
        last = F.try_element_at(F.filter(r, lambda x: x["Fluorophore"]["ChannelId"] == F.lit(ch)), F.lit(-1))
        picks.append(F.regexp_replace(last["BiologicalTarget"], "/", "_"))
    ok = F.lit(True)
    for p in picks:
        ok = ok & p.isNotNull()
    for ch, p, dflt in zip(MORPHOLOGY_CHANNELS, picks, DEFAULT_MARKERS):
        out = out.withColumn(f"marker_{ch}", F.when(ok, p).otherwise(F.lit(dflt)))
    return out
