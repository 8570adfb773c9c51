"""Registered queries for keys/parsers, inventory, run log and layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.scalars import morphology_markers, with_scales
from ..operators import layers as L
from ..operators import runlog as RL
from ..operators import transcripts as TR
from ..sources import inventory as I
from .bindings import RUN_STEPS, Bindings, with_ctes
from .registry import query

_PAIR_SQL = "CASE WHEN {x} >= {y} THEN CAST({x} AS BIGINT) * {x} + {x} + {y} ELSE CAST({y} AS BIGINT) * {y} + {x} END"


# ---------------------------------------------------------------- P4 / P5 / P6
@query("cell_uid", with_ctes(f"""
SELECT cell_name, {_PAIR_SQL.format(x="CAST(regexp_extract(cell_name, 'c_.*_(.*)_(.*)', 1) AS BIGINT)",
                                    y="CAST(regexp_extract(cell_name, 'c_.*_(.*)_(.*)', 2) AS BIGINT)")} AS UID
FROM cell_meta""", "cell_meta"))
def q_cell_uid(spark, d):
    return K.cell_uid(Bindings(spark, d).cell_meta.select("cell_name"), "cell_name")


@query("unpair_key", with_ctes(f"""
SELECT UID, CAST(CASE WHEN UID - f * f < f THEN UID - f * f ELSE f END AS BIGINT) AS fov,
       CAST(CASE WHEN UID - f * f < f THEN f ELSE UID - f * f - f END AS BIGINT) AS CellId
FROM (SELECT UID, CAST(floor(sqrt(UID)) AS BIGINT) AS f FROM (
  SELECT {_PAIR_SQL.format(x='fov', y='cell_ID')} AS UID FROM cell_meta))""", "cell_meta"))
def q_unpair_key(spark, d):
    m = Bindings(spark, d).cell_meta
    u = m.select(K.pair_key("fov", "cell_ID").alias("UID"))
    return K.unpair_key(u, "UID")


query("key_label_pixels", with_ctes(f"""
SELECT fov, row, col, CASE WHEN val = 0 THEN CAST(0 AS BIGINT) ELSE {_PAIR_SQL.format(x='fov', y='val')} END AS val
FROM label_pixels""", "fovs", "label_pixels"))(
    lambda spark, d: K.key_label_pixels(Bindings(spark, d).label_pixels))


# ---------------------------------------------------------------- F7 / P1
def _slide_tree(b: Bindings):
    p = b.t("pages").select("page_id", "url")
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
    lang = F.regexp_extract("url", "/([a-z]{2})/", 1)
    slide = F.when(F.col("page_id") % 7 == 0, F.lit("Logs")).otherwise(F.concat(F.lit("slide_"), lang))
    scan = F.when(F.col("page_id") % 11 == 0, F.lit("Logs")).otherwise(
        F.concat(F.lit("scan"), (F.col("page_id") % 3).cast("string")))
    path = F.concat_ws("/", F.lit("study/exp1"), host, F.lit("DecodedFiles"), slide, scan,
                       F.concat(F.lit("file"), F.col("page_id").cast("string")))
    return p.select(path.alias("path"), F.lit(1).cast("long").alias("length"))


_TREE_SQL = """
tree AS (SELECT 'study/exp1/' || regexp_extract(url, '^[a-z]+://([^/]+)', 1) || '/DecodedFiles/'
                || CASE WHEN page_id % 7 = 0 THEN 'Logs' ELSE 'slide_' || regexp_extract(url, '/([a-z]{2})/', 1) END
                || '/' || CASE WHEN page_id % 11 = 0 THEN 'Logs' ELSE 'scan' || CAST(page_id % 3 AS VARCHAR) END
                || '/file' || CAST(page_id AS VARCHAR) AS path FROM pages),
disc AS (SELECT DISTINCT string_split(path, '/')[3] AS run, string_split(path, '/')[5] AS slide,
                string_split(path, '/')[6] AS scan_id FROM tree
         WHERE string_split(path, '/')[4] = 'DecodedFiles' AND string_split(path, '/')[5] <> 'Logs'
           AND string_split(path, '/')[6] <> 'Logs')"""

query("discover_slides", with_ctes("""
SELECT run, slide, scan_id, 'study/exp1/' || run || '/DecodedFiles/' || slide || '/' || scan_id AS slide_base_path
FROM disc""", extra=_TREE_SQL))(
    lambda spark, d: I.discover_slides(_slide_tree(Bindings(spark, d)), "study/exp1"))

query("parse_slide_path", with_ctes(f"""
SELECT slide_base_path, slide, scan_id, run, 'exp1' AS experiment, 'study' AS study,
       'study/exp1' AS experiment_prefix, '{K.OUTPUT_ROOT}/study/exp1/' || run || '/' || slide AS output_prefix
FROM (SELECT run, slide, scan_id, 'study/exp1/' || run || '/DecodedFiles/' || slide || '/' || scan_id AS slide_base_path
      FROM disc)""", extra=_TREE_SQL))(
    lambda spark, d: K.parse_slide_path(
        I.discover_slides(_slide_tree(Bindings(spark, d)), "study/exp1").select("slide_base_path")))


# ---------------------------------------------------------------- F5
_INCLUDES = ["https://blog.*", "*/en/*.html", "*?utm_source=feed"]


def _selected(spark, d):
    inv = Bindings(spark, d).inventory.withColumn("rel", F.col("path"))
    return I.select_inventory(inv, _INCLUDES)


_SEL_SQL = """
sel AS (SELECT path, length, regexp_matches(path, '^https://blog\\..*$') OR regexp_matches(path, '^.*/en/.*\\.html$')
                             OR regexp_matches(path, '^.*\\?utm_source=feed$') AS keep FROM inventory)"""
query("select_inventory", with_ctes("SELECT path, length, path AS rel, keep FROM sel", "inventory", extra=_SEL_SQL))(
    _selected)
query("selection_summary", with_ctes("""
SELECT CAST(sum(CASE WHEN keep THEN 1 ELSE 0 END) AS BIGINT) AS kept_files,
       CAST(sum(CASE WHEN keep THEN 0 ELSE 1 END) AS BIGINT) AS dropped_files,
       CAST(coalesce(sum(CASE WHEN keep THEN length END), 0) AS BIGINT) AS kept_bytes,
       CAST(coalesce(sum(CASE WHEN NOT keep THEN length END), 0) AS BIGINT) AS dropped_bytes FROM sel""",
                                     "inventory", extra=_SEL_SQL))(
    lambda spark, d: I.selection_summary(_selected(spark, d)))


# ---------------------------------------------------------------- F9 / P3
def _image_files(b: Bindings):
    doc = b.t("documents").select("doc_id")
    k = F.col("doc_id")
    n5 = F.lpad(k.cast("string"), 5, "0")
    name = (F.when(k % 6 == 0, F.concat(F.lit("CellLabels_F"), n5, F.lit(".TIF")))
             .when(k % 6 == 1, F.concat(F.lit("20241205_101010_S"), (k % 10).cast("string"), F.lit("_C902_P99_N99_F"), n5,
                                        F.when(k % 4 == 1, F.lit("_Z003")).otherwise(F.lit("")), F.lit(".TIF")))
             .when(k % 6 == 2, F.concat(F.lit("CellComposite_F"), n5, F.lit(".jpg")))
             .when(k % 6 == 3, F.concat(F.lit("20241205_101010_S1_C003_F"), n5, F.lit("_P"), (k % 4).cast("string"), F.lit(".TIF")))
             .when(k % 6 == 4, F.concat(F.lit("run_C003_P12_N"), F.lpad((k % 100).cast("string"), 2, "0"), F.lit("_F"), n5, F.lit(".TIF")))
             .otherwise(F.concat(F.lit("notes_"), k.cast("string"), F.lit(".txt"))))
    return doc.select("doc_id", F.concat(F.lit("root/FOV"), n5, F.lit("/"), name).alias("path"),
                      F.concat(F.lit("P"), (k % 4).cast("string")).alias("probe"))


_FILES_SQL = """
files AS (SELECT doc_id, 'root/FOV' || lpad(CAST(doc_id AS VARCHAR), 5, '0') || '/' || CASE
    WHEN doc_id % 6 = 0 THEN 'CellLabels_F' || lpad(CAST(doc_id AS VARCHAR), 5, '0') || '.TIF'
    WHEN doc_id % 6 = 1 THEN '20241205_101010_S' || CAST(doc_id % 10 AS VARCHAR) || '_C902_P99_N99_F'
         || lpad(CAST(doc_id AS VARCHAR), 5, '0') || CASE WHEN doc_id % 4 = 1 THEN '_Z003' ELSE '' END || '.TIF'
    WHEN doc_id % 6 = 2 THEN 'CellComposite_F' || lpad(CAST(doc_id AS VARCHAR), 5, '0') || '.jpg'
    WHEN doc_id % 6 = 3 THEN '20241205_101010_S1_C003_F' || lpad(CAST(doc_id AS VARCHAR), 5, '0') || '_P'
         || CAST(doc_id % 4 AS VARCHAR) || '.TIF'
    WHEN doc_id % 6 = 4 THEN 'run_C003_P12_N' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') || '_F'
         || lpad(CAST(doc_id AS VARCHAR), 5, '0') || '.TIF'
    ELSE 'notes_' || CAST(doc_id AS VARCHAR) || '.txt' END AS path,
    'P' || CAST(doc_id % 4 AS VARCHAR) AS probe FROM documents),
named AS (SELECT *, upper(regexp_extract(path, '([^/]*)$', 1)) AS uname, regexp_extract(path, '([^/]*)$', 1) AS bname
          FROM files)"""


def _fld(pat, cast=True):
    e = f"nullif(regexp_extract(bname, '{pat}', 1), '')"
    return f"TRY_CAST({e} AS INTEGER)" if cast else e


query("classify_image_files", with_ctes(f"""
SELECT doc_id, path, probe, CASE
    WHEN regexp_matches(uname, '^CELLLABELS_F[0-9]+\\.TIF') THEN 'labels'
    WHEN regexp_matches(uname, '^.*C902_P99_N99_F[0-9]+\\.TIF') THEN 'morphology'
    WHEN regexp_matches(uname, '^CELLCOMPOSITE_F[0-9]*\\.JPG') THEN 'composite'
    WHEN regexp_matches(uname, '^.*_C003_F.*_' || upper(probe) || '\\.TIF') THEN 'protein'
    WHEN regexp_matches(uname, '^.*_C003_.*_N[0-9]+_F[0-9]+.TIF') THEN 'encoded' END AS kind,
    {_fld(K.ACQ_PATTERNS['fov'])} AS fov
FROM named""", extra=_FILES_SQL))(
    lambda spark, d: I.classify_image_files(_image_files(Bindings(spark, d)), zslice=0, cycle=3, probe_col="probe"))

query("parse_acquisition_name", with_ctes(f"""
SELECT doc_id, path, {_fld(K.ACQ_PATTERNS['timestamp'], cast=False)} AS timestamp,
       {_fld(K.ACQ_PATTERNS['slide'])} AS slide, {_fld(K.ACQ_PATTERNS['cycle'])} AS cycle,
       {_fld(K.ACQ_PATTERNS['pool'])} AS pool, {_fld(K.ACQ_PATTERNS['spot'])} AS spot,
       {_fld(K.ACQ_PATTERNS['fov'])} AS fov, {_fld(K.ACQ_PATTERNS['zslice'])} AS zslice
FROM named""", extra=_FILES_SQL))(
    lambda spark, d: K.parse_acquisition_name(_image_files(Bindings(spark, d)).select("doc_id", "path")))


# ---------------------------------------------------------------- P2
query("parse_segmentation_dir", with_ctes("""
SELECT dir, regexp_replace(CASE WHEN starts_with(dir, 'Segmentation_') THEN substr(dir, 14) ELSE dir END, '_(\\d+)$', '') AS uuid,
       CAST(coalesce(TRY_CAST(nullif(regexp_extract(dir, '_(\\d+)$', 1), '') AS INTEGER), 0) AS INTEGER) AS version
FROM (SELECT DISTINCT dir FROM seg UNION SELECT 'Segmentation_' || source FROM documents)""", "seg"))(
    lambda spark, d: K.parse_segmentation_dir(
        Bindings(spark, d).seg.select("dir").union(
            Bindings(spark, d).t("documents").select(F.concat(F.lit("Segmentation_"), F.col("source")).alias("dir")))
        .distinct()))


# ---------------------------------------------------------------- P10
def _run_dirs(b: Bindings):
    doc = b.t("documents").select("doc_id", "lang")
    k = F.col("doc_id")
    name = F.concat_ws("_", F.concat(F.lit("Liver"), F.col("lang")),
                       F.when(k % 3 == 0, F.lit("A")).otherwise(F.lit("07B")),
                       F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("04_2026_12_30_21"),
                       (k % 1000).cast("string"))
    return doc.select("doc_id", F.concat(F.lit("bucket/study/"), name, F.lit("/")).alias("run_dir"))


_RUNDIR_SQL = """
rd AS (SELECT doc_id, 'bucket/study/' || 'Liver' || lang || '_' || CASE WHEN doc_id % 3 = 0 THEN 'A' ELSE '07B' END
              || '_' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '_04_2026_12_30_21_'
              || CAST(doc_id % 1000 AS VARCHAR) || '/' AS run_dir FROM documents),
rt AS (SELECT doc_id, run_dir, string_split(string_split(regexp_replace(run_dir, '/+$', ''), '/')[-1], '_') AS toks
       FROM rd)"""

query("short_run_name", with_ctes("""
SELECT doc_id, run_dir,
       array_to_string(CASE WHEN cut IS NULL THEN toks ELSE toks[1:cut] END, '_') AS short_name,
       regexp_replace(regexp_replace(run_dir, '\\d[\\d_]*$', ''), '_+$', '') AS stripped
FROM (SELECT doc_id, run_dir, toks,
             list_min(list_filter(list_transform(range(1, len(toks)),
                      lambda i: CASE WHEN regexp_full_match(toks[i + 1], '[0-9]+') THEN i END),
                      lambda x: x IS NOT NULL)) AS cut FROM rt)""", extra=_RUNDIR_SQL))(
    lambda spark, d: _run_dirs(Bindings(spark, d)).select(
        "doc_id", "run_dir", K.short_run_name("run_dir").alias("short_name"),
        K.strip_run_suffix("run_dir").alias("stripped")))


# ---------------------------------------------------------------- P11
def _descs(b: Bindings):
    ev = b.t("events").select("event_id", "event_type", "props", "user_id", "value")
    k = F.get_json_object("props", "$.k").cast("int")
    desc = F.when(F.col("event_type") == "error", F.lit("not json")).when(
        F.col("event_type") == "view", F.lit("{}")).otherwise(
        F.concat(F.lit('{"Magnification": '), (k % 7 + 1).cast("string"), F.lit(', "PixelSize_um": '),
                 F.col("value").cast("string"), F.lit("}")))
    h = F.when(F.col("user_id") % 3 == 0, F.lit(4256)).when(F.col("user_id") % 3 == 1, F.lit(3648)).otherwise(F.lit(3192))
    w = F.when(F.col("user_id") % 3 == 1, F.lit(5472)).when(F.col("user_id") % 3 == 0, F.lit(4256)).otherwise(F.lit(3192))
    return ev.select("event_id", desc.alias("description"), h.alias("fov_height"), w.alias("fov_width"))


query("infer_scale", with_ctes("""
SELECT event_id, description, fov_height, fov_width, um_per_px FROM (
  SELECT *, round_even(coalesce(
      CASE WHEN json_valid(description) THEN round_even(
          TRY_CAST(json_extract_string(description, '$.PixelSize_um') AS DOUBLE)
          / nullif(TRY_CAST(json_extract_string(description, '$.Magnification') AS DOUBLE), 0), 4) END,
      CASE WHEN fov_height <> fov_width THEN 0.18
           WHEN fov_height % 133 = 0 AND fov_width % 133 = 0 THEN 0.1203 ELSE 0.1681 END) / 1.0, 4) AS um_per_px
  FROM (SELECT event_id,
               CASE WHEN event_type = 'error' THEN 'not json' WHEN event_type = 'view' THEN '{}'
                    ELSE '{"Magnification": ' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 + 1 AS VARCHAR)
                         || ', "PixelSize_um": ' || CAST(value AS VARCHAR) || '}' END AS description,
               CASE WHEN user_id % 3 = 0 THEN 4256 WHEN user_id % 3 = 1 THEN 3648 ELSE 3192 END AS fov_height,
               CASE WHEN user_id % 3 = 1 THEN 5472 WHEN user_id % 3 = 0 THEN 4256 ELSE 3192 END AS fov_width
        FROM events))"""))(
    lambda spark, d: with_scales(_descs(Bindings(spark, d)), "description", "fov_height", "fov_width")
    .select("event_id", "description", "fov_height", "fov_width", "um_per_px"))


# ---------------------------------------------------------------- P12
def _kits(b: Bindings):
    p = b.t("part").select("p_partkey", "p_type", "p_name", "p_size")

    def reagent(ch, target):
        return F.concat(F.lit('{"Fluorophore": {"ChannelId": "' + ch + '"}, "BiologicalTarget": "'), target, F.lit('"}'))

    parts = [reagent("B", F.col("p_type")), reagent("G", F.concat(F.col("p_name"), F.lit("/x"))),
             reagent("Y", F.lit("rRNA")), reagent("R", F.col("p_type"))]
    body = F.concat_ws(", ", *parts, F.when(F.col("p_size") % 4 != 0, reagent("U", F.lit("DNA"))))
    desc = F.when(F.col("p_size") % 9 == 0, F.lit("{bad")).otherwise(
        F.concat(F.lit('{"MorphologyKit": {"MorphologyReagents": ['), body, F.lit("]}}")))
    return p.select("p_partkey", desc.alias("description"))


_KIT_SQL = """
kits AS (SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN '{bad' ELSE
    '{"MorphologyKit": {"MorphologyReagents": [' ||
    '{"Fluorophore": {"ChannelId": "B"}, "BiologicalTarget": "' || p_type || '"}, ' ||
    '{"Fluorophore": {"ChannelId": "G"}, "BiologicalTarget": "' || p_name || '/x"}, ' ||
    '{"Fluorophore": {"ChannelId": "Y"}, "BiologicalTarget": "rRNA"}, ' ||
    '{"Fluorophore": {"ChannelId": "R"}, "BiologicalTarget": "' || p_type || '"}' ||
    CASE WHEN p_size % 4 <> 0 THEN ', {"Fluorophore": {"ChannelId": "U"}, "BiologicalTarget": "DNA"}' ELSE '' END ||
    ']}}' END AS description FROM part),
kp AS (SELECT p_partkey, description,
              CASE WHEN json_valid(description) THEN
                from_json(json_extract(description, '$.MorphologyKit.MorphologyReagents'),
                          '[{"Fluorophore": {"ChannelId": "VARCHAR"}, "BiologicalTarget": "VARCHAR"}]') END AS r
       FROM kits),
km AS (SELECT p_partkey, description,
              replace(list_filter(r, lambda x: x.Fluorophore.ChannelId = 'B')[-1].BiologicalTarget, '/', '_') AS b,
              replace(list_filter(r, lambda x: x.Fluorophore.ChannelId = 'G')[-1].BiologicalTarget, '/', '_') AS g,
              replace(list_filter(r, lambda x: x.Fluorophore.ChannelId = 'Y')[-1].BiologicalTarget, '/', '_') AS y,
              replace(list_filter(r, lambda x: x.Fluorophore.ChannelId = 'R')[-1].BiologicalTarget, '/', '_') AS rr,
              replace(list_filter(r, lambda x: x.Fluorophore.ChannelId = 'U')[-1].BiologicalTarget, '/', '_') AS u
       FROM kp)"""

query("morphology_markers", with_ctes("""
SELECT p_partkey, description,
       CASE WHEN ok THEN b ELSE 'Histone' END AS marker_B, CASE WHEN ok THEN g ELSE 'Empty' END AS marker_G,
       CASE WHEN ok THEN y ELSE 'rRNA' END AS marker_Y, CASE WHEN ok THEN rr ELSE 'GFAP' END AS marker_R,
       CASE WHEN ok THEN u ELSE 'DAPI' END AS marker_U
FROM (SELECT *, coalesce(b IS NOT NULL AND g IS NOT NULL AND y IS NOT NULL AND rr IS NOT NULL AND u IS NOT NULL, false)
                AS ok FROM km)""", extra=_KIT_SQL))(
    lambda spark, d: morphology_markers(_kits(Bindings(spark, d)), "description"))


# ---------------------------------------------------------------- A10 / A12
query("inventory_stats", with_ctes("""
SELECT regexp_extract(path, '^[a-z]+://([^/]+)', 1) AS host,
       count(DISTINCT regexp_extract(path, '/([a-z]{2})/', 1)) AS fov_count,
       CAST(coalesce(sum(length), 0) AS BIGINT) AS total_bytes,
       round(CAST(coalesce(sum(length), 0) AS BIGINT) / 1073741824.0, 6) AS total_gb
FROM inventory GROUP BY 1""", "inventory"))(
    lambda spark, d: I.inventory_stats(
        Bindings(spark, d).inventory.select(
            F.regexp_extract("path", r"^[a-z]+://([^/]+)", 1).alias("host"), "length",
            F.regexp_extract("path", "/([a-z]{2})/", 1).alias("fov_dir")), ["host"]))


def _layout_tree(b: Bindings):
    doc = b.t("documents").select("doc_id")
    k = F.col("doc_id")
    rel = (F.when(k % 9 == 0, F.lit("CellStatsDir/FOV001/CellLabels_F001.TIF"))
            .when(k % 9 == 1, F.lit("RunSummary/x.fovs.csv"))
            .when(k % 9 == 2, F.concat(F.lit("AnalysisResults/ar"), (k % 2).cast("string"), F.lit("/FOV00"),
                                       (k % 3).cast("string"), F.lit("/ProteinImages/p.TIF")))
            .when(k % 9 == 3, F.concat(F.lit("AnalysisResults/ar0/FOV00"), (k % 5).cast("string"), F.lit("/a.csv")))
            .when(k % 9 == 4, F.lit("ProteinDir/x.TIF"))
            .when(k % 9 == 5, F.lit("plex_file.txt"))
            .when(k % 9 == 6, F.lit("AnalysisResults/.hidden/z"))
            .otherwise(F.lit("Other/readme")))
    return doc.select(F.concat(F.lit("S"), (k % 13).cast("string")).alias("slide"), rel.alias("rel"))


query("check_slide_layout", with_ctes("""
WITH t AS (SELECT 'S' || CAST(doc_id % 13 AS VARCHAR) AS slide, CASE
    WHEN doc_id % 9 = 0 THEN 'CellStatsDir/FOV001/CellLabels_F001.TIF'
    WHEN doc_id % 9 = 1 THEN 'RunSummary/x.fovs.csv'
    WHEN doc_id % 9 = 2 THEN 'AnalysisResults/ar' || CAST(doc_id % 2 AS VARCHAR) || '/FOV00' || CAST(doc_id % 3 AS VARCHAR)
                             || '/ProteinImages/p.TIF'
    WHEN doc_id % 9 = 3 THEN 'AnalysisResults/ar0/FOV00' || CAST(doc_id % 5 AS VARCHAR) || '/a.csv'
    WHEN doc_id % 9 = 4 THEN 'ProteinDir/x.TIF'
    WHEN doc_id % 9 = 5 THEN 'plex_file.txt'
    WHEN doc_id % 9 = 6 THEN 'AnalysisResults/.hidden/z'
    ELSE 'Other/readme' END AS rel FROM documents),
p AS (SELECT slide, string_split(rel, '/') AS parts, rel FROM t),
g AS (SELECT slide,
        max(CAST(parts[1] = 'CellStatsDir' AND len(parts) >= 2 AS INTEGER)) AS has_CellStatsDir,
        max(CAST(parts[1] = 'RunSummary' AND len(parts) >= 2 AS INTEGER)) AS has_RunSummary,
        max(CAST(parts[1] = 'AnalysisResults' AND len(parts) >= 2 AS INTEGER)) AS has_AnalysisResults,
        max(CAST(parts[1] = 'ProteinDir' AND len(parts) >= 2 AS INTEGER)) AS has_ProteinDir,
        count(DISTINCT CASE WHEN parts[1] = 'AnalysisResults' AND len(parts) >= 3 AND NOT starts_with(parts[2], '.')
                            THEN parts[2] END) AS analysis_children,
        count(DISTINCT CASE WHEN parts[1] = 'AnalysisResults' AND len(parts) >= 4 THEN parts[2] || '/' || parts[3] END)
              AS analysis_fov_dirs,
        count(DISTINCT CASE WHEN parts[1] = 'AnalysisResults' AND len(parts) >= 5 AND parts[4] = 'ProteinImages'
                            THEN parts[2] || '/' || parts[3] END) AS protein_image_dirs,
        max(CAST(len(parts) = 1 AND starts_with(rel, 'plex') AS INTEGER)) AS has_plex
      FROM p GROUP BY slide)
SELECT *, array_to_string(list_filter([
          CASE WHEN has_CellStatsDir = 0 THEN 'missing CellStatsDir' END,
          CASE WHEN has_RunSummary = 0 THEN 'missing RunSummary' END,
          CASE WHEN has_AnalysisResults = 0 THEN 'missing AnalysisResults' END,
          CASE WHEN has_ProteinDir = 0 THEN 'missing ProteinDir' END,
          CASE WHEN analysis_children <> 1 THEN 'AnalysisResults must have exactly one subfolder' END,
          CASE WHEN protein_image_dirs > 0 AND protein_image_dirs < analysis_fov_dirs
               THEN 'ProteinImages missing in some FOV folders' END,
          CASE WHEN has_plex = 0 THEN 'missing plex file' END], lambda x: x IS NOT NULL), ';') AS reasons,
       protein_image_dirs > 0 AND protein_image_dirs = analysis_fov_dirs AS protein_images_in_analysis_results,
       len(list_filter([
          CASE WHEN has_CellStatsDir = 0 THEN 1 END, CASE WHEN has_RunSummary = 0 THEN 1 END,
          CASE WHEN has_AnalysisResults = 0 THEN 1 END, CASE WHEN has_ProteinDir = 0 THEN 1 END,
          CASE WHEN analysis_children <> 1 THEN 1 END,
          CASE WHEN protein_image_dirs > 0 AND protein_image_dirs < analysis_fov_dirs THEN 1 END,
          CASE WHEN has_plex = 0 THEN 1 END], lambda x: x IS NOT NULL)) = 0 AS valid
FROM g"""))(
    lambda spark, d: I.check_slide_layout(_layout_tree(Bindings(spark, d)), ["slide"])
    .withColumn("reasons", F.array_join("reasons", ";")))


# ---------------------------------------------------------------- A11 / K4
_STEPS_SQL = ", ".join(f"'{s}'" for s in RUN_STEPS)


def _dur_sql():
    cols = []
    for st in RUN_STEPS:
        cols.append(f"max(CASE WHEN step = '{st}' THEN (epoch_us(\"end\") - epoch_us(start)) // 1000000 END)"
                    f" AS duration_{st}_s")
    first, last = RUN_STEPS[0], RUN_STEPS[-1]
    cols.append(f"(max(CASE WHEN step = '{last}' THEN epoch_us(\"end\") END) - "
                f"max(CASE WHEN step = '{first}' THEN epoch_us(start) END)) // 1000000 AS duration_total_s")
    return ", ".join(cols)


query("run_durations", with_ctes(f"""
SELECT run, {_dur_sql()},
       CASE WHEN count(DISTINCT CASE WHEN step IN ({_STEPS_SQL}) AND "end" IS NOT NULL THEN step END) = {len(RUN_STEPS)}
            THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN count(DISTINCT CASE WHEN step IN ({_STEPS_SQL}) AND "end" IS NOT NULL THEN step END) = {len(RUN_STEPS)}
            THEN '' ELSE coalesce(arg_max(step, start) FILTER (WHERE step IN ({_STEPS_SQL})), '') END AS failed_step
FROM run_steps GROUP BY run""", "run_steps"))(
    lambda spark, d: RL.run_durations(Bindings(spark, d).run_steps, RUN_STEPS))

query("latest_status", """
SELECT user_id AS slide, arg_max(CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END, ts) AS status,
       arg_max(event_type, ts) AS failed_step
FROM events GROUP BY user_id""")(
    lambda spark, d: RL.latest_status(Bindings(spark, d).t("events").select(
        F.col("user_id").alias("slide"), F.col("ts").alias("start_time"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.col("event_type").alias("failed_step"))))


# ---------------------------------------------------------------- S9 / R13 / W5 / W6 / W7
_CH_NAMES = ["ECONOMY", "LARGE", "MEDIUM"]


def _catalog(spark, d):
    from .q_raster import _mosaic
    b = Bindings(spark, d)
    chans = b.channels.unionByName(spark.range(1).select(F.lit("labels").alias("name")))
    cw = _contrast(spark, d)
    win = cw.select(F.element_at(F.array(*[F.lit(x) for x in _CH_NAMES]), (F.col("channel") + 1).cast("int")).alias("name"),
                    F.lit("channel").alias("type"), "start", "end")
    return L.layer_catalog(chans, b.proteins, win)


def _contrast(spark, d):
    from ..operators import raster as R
    from .q_raster import _mosaic
    return R.contrast_window(_mosaic(Bindings(spark, d)))


from .q_raster import _GEO  # noqa: E402

_CAT_SQL = """
cw AS (SELECT channel, CASE WHEN s = e AND e <> 0 THEN 0 ELSE s END AS start,
              CASE WHEN s = e AND e = 0 THEN 1000 ELSE e END AS "end"
       FROM (SELECT channel, CAST(floor(quantile_cont(CASE WHEN val <> 0 THEN val END, 0.001)) AS BIGINT) AS s,
                    CAST(floor(quantile_cont(CASE WHEN val <> 0 THEN val END, 0.999)) AS BIGINT) AS e
             FROM mosaic GROUP BY channel)),
win AS (SELECT (['ECONOMY', 'LARGE', 'MEDIUM'])[channel + 1] AS name, 'channel' AS type, start, "end" FROM cw),
names AS (SELECT DISTINCT name, 'channel' AS type FROM (SELECT name FROM channels UNION ALL SELECT 'labels')
          WHERE name NOT IN ('labels', 'protein', 'composite', 'targets', 'fovgrid')
          UNION ALL SELECT DISTINCT name, 'protein' AS type FROM proteins),
cat AS (SELECT n.name, n.type,
               CASE n.name WHEN 'DAPI' THEN 'blue' WHEN 'DNA' THEN 'blue' WHEN 'PanCK' THEN 'green'
                           WHEN 'U' THEN 'blue' WHEN 'G' THEN 'green' ELSE 'gray' END AS color,
               CASE WHEN coalesce(w.start, 0) = coalesce(w."end", 65535) AND coalesce(w."end", 65535) <> 0 THEN 0
                    ELSE coalesce(w.start, 0) END AS start,
               CASE WHEN coalesce(w.start, 0) = coalesce(w."end", 65535) AND coalesce(w."end", 65535) = 0 THEN 1000
                    ELSE coalesce(w."end", 65535) END AS "end"
        FROM names n LEFT JOIN win w ON n.name = w.name AND n.type = w.type)"""


def _lsql(body):
    return with_ctes(body, "fovs", "pixels", "label_pixels", "channels", "proteins", extra=_GEO + "," + _CAT_SQL)


query("layer_catalog", _lsql("SELECT name, type, color, CAST(start AS BIGINT) AS start, CAST(\"end\" AS BIGINT) AS \"end\" FROM cat"))(
    _catalog)

query("layer_catalog_ome", _lsql("""
SELECT regexp_replace(name, '^protein/', '') AS label,
       CASE color WHEN 'gray' THEN 'FFFFFF' WHEN 'blue' THEN '0000FF' WHEN 'green' THEN '00FF00' WHEN 'red' THEN 'FF0000'
                  WHEN 'cyan' THEN '00FFFF' WHEN 'magenta' THEN 'FF00FF' WHEN 'yellow' THEN 'FFFF00' ELSE 'FFFFFF' END AS color,
       CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end", name IN ('ECONOMY', 'Brand#1') AS active
FROM cat UNION ALL SELECT 'segmentation', '00FFFF', 0, 1, true"""))(
    lambda spark, d: L.layer_catalog_ome(_catalog(spark, d), active=["ECONOMY", "Brand#1"]))

_REQUEST = "ECONOMY, LARGE,BOGUS Cathepsin B  PROMO,,LARGE"
_REQ_SQL = """
req2 AS (SELECT CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, rtrim(unnest(l), ' ,') AS name
         FROM (SELECT regexp_extract_all('""" + _REQUEST + """' || ' ', 'Cathepsin B[ ,]|[^ ,]+') AS l))"""


def _resolved(spark, d):
    b = Bindings(spark, d)
    cat = b.channels
    return L.resolve_requested_layers(spark, _REQUEST, cat)


query("resolve_requested_layers", with_ctes(
    "SELECT pos, name FROM req2 WHERE name IN (SELECT name FROM channels)", "channels", extra=_REQ_SQL))(
    lambda spark, d: _resolved(spark, d)[0].withColumn("pos", F.col("pos").cast("int")))
query("invalid_requested_layers", with_ctes(
    "SELECT pos, name FROM req2 WHERE name NOT IN (SELECT name FROM channels)", "channels", extra=_REQ_SQL))(
    lambda spark, d: _resolved(spark, d)[1].withColumn("pos", F.col("pos").cast("int")))


@query("batch_layers", with_ctes("""
SELECT CAST(floor(i / 2) AS INTEGER) AS batch, 'labels,' || string_agg(name, ',' ORDER BY i) AS items
FROM (SELECT name, row_number() OVER (ORDER BY seq) - 1 AS i FROM (
        SELECT pos AS seq, name FROM req2 WHERE name IN (SELECT name FROM channels)
        UNION ALL
        SELECT 1000 + row_number() OVER (ORDER BY name) AS seq, name FROM (SELECT DISTINCT name FROM proteins)))
GROUP BY 1""", "channels", "proteins", extra=_REQ_SQL))
def q_batch_layers(spark, d):
    b = Bindings(spark, d)
    kept = _resolved(spark, d)[0].select(F.col("pos").alias("seq"), "name")
    from pyspark.sql import Window
    prot = b.proteins.select("name").distinct().withColumn("seq", 1000 + F.row_number().over(Window.orderBy("name")))
    items = kept.unionByName(prot.select("seq", "name"))
    return L.batch_layers(items, 2, labels="labels").select("batch", F.array_join("items", ",").alias("items"))


# Random assignment cannot be matched value-by-value by another engine: rows-only.
query("random_groups", with_ctes("""
SELECT fov, CellId, target,
       CAST(CAST('0x' || substr(md5('7|' || fov || '|' || CellId || '|' || target), 1, 8) AS BIGINT) % 4 + 1 AS INTEGER) AS grp
FROM target_calls""", "target_calls"))(
    lambda spark, d: L.random_groups(Bindings(spark, d).target_calls.select("fov", "CellId", "target"), 4, seed=7))
query("transcript_raster_random", with_ctes("""
SELECT fov, CAST(least(floor(y), 511) AS INTEGER) AS row, CAST(least(floor(x), 511) AS INTEGER) AS col,
       max(CAST('0x' || substr(md5('7|' || fov || '|' || CellId || '|' || x || '|' || y || '|' || z || '|' || target), 1, 8) AS BIGINT) % 3 + 1) AS val
FROM target_calls WHERE x BETWEEN 0 AND 512 AND y BETWEEN 0 AND 512 GROUP BY 1, 2, 3""", "target_calls"))(
    lambda spark, d: TR.transcript_raster(Bindings(spark, d).target_calls, 512, 512, "random", groups=3, seed=7))
