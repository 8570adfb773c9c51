"""Registered segmentation-version / precedence queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import versions as V
from .bindings import PRIMARY_VERSION, Bindings, with_ctes
from .registry import query

PRIMARY_DIR = f"Segmentation_src{PRIMARY_VERSION}_{PRIMARY_VERSION:03d}"

_UUID = "regexp_replace(CASE WHEN starts_with({c}, 'Segmentation_') THEN substr({c}, 14) ELSE {c} END, '_(\\d+)$', '')"
_VERSION = "CAST(coalesce(TRY_CAST(nullif(regexp_extract({c}, '_(\\d+)$', 1), '') AS INTEGER), 0) AS INTEGER)"

_W1_SQL = f"""
s AS (SELECT DISTINCT dir, fov, {_VERSION.format(c='dir')} AS version FROM seg),
folders AS (SELECT DISTINCT dir, version FROM s),
p AS (SELECT '{PRIMARY_DIR}' AS primary_dir, {_VERSION.format(c="'" + PRIMARY_DIR + "'")} AS pversion),
elig AS (SELECT dir, version,
                CAST(row_number() OVER (ORDER BY CASE WHEN dir = primary_dir THEN 0 ELSE 1 END, version DESC, dir) - 1
                     AS INTEGER) AS rank
         FROM folders, p WHERE dir = primary_dir OR version < pversion),
ref AS (SELECT DISTINCT fov FROM s WHERE dir = (SELECT dir FROM folders ORDER BY version, dir LIMIT 1)),
winner AS (SELECT s.fov, min(e.rank) AS win FROM s JOIN elig e ON s.dir = e.dir GROUP BY s.fov),
cov AS (SELECT ref.fov, winner.win FROM ref LEFT JOIN winner ON ref.fov = winner.fov),
cutv AS (SELECT max(coalesce(win, 1073741824)) AS cut FROM cov),
selected AS (SELECT e.dir, {_UUID.format(c='e.dir')} AS uuid, e.version, e.rank
             FROM elig e, cutv
             WHERE e.rank = 0 OR (e.rank IN (SELECT win FROM winner) AND e.rank <= cutv.cut))"""


def _selected(b: Bindings):
    prim = b.spark.range(1).select(F.lit(PRIMARY_DIR).alias("primary_dir"))
    return V.select_segmentations(b.seg, prim)


query("select_segmentations", with_ctes("SELECT dir, uuid, version, rank FROM selected", "seg", extra=_W1_SQL))(
    lambda spark, d: _selected(Bindings(spark, d))[0])

# Two folders of one version: only the primary one counts, so FOVs that are in the other
# (the first by name, whose FOVs are the ones to cover) alone stay uncovered.
_TIED_SQL = _W1_SQL.replace("FROM seg)", "FROM tied)").replace(PRIMARY_DIR, "Segmentation_bbb_001")
_TIED = """
tied AS (SELECT 'Segmentation_aaa_001' AS dir, fov FROM seg WHERE fov % 3 = 0 OR fov % 5 = 0
         UNION ALL SELECT 'Segmentation_bbb_001', fov FROM seg WHERE fov % 3 <> 0),""" + _TIED_SQL


def _tied(b: Bindings):
    folder = lambda name, cond: b.seg.where(cond).withColumn("dir", F.lit(name))
    seg = folder("Segmentation_aaa_001", "fov % 3 = 0 OR fov % 5 = 0").unionByName(folder("Segmentation_bbb_001", "fov % 3 <> 0"))
    return V.select_segmentations(seg, b.spark.range(1).select(F.lit("Segmentation_bbb_001").alias("primary_dir")))


query("uncovered_fovs", with_ctes("SELECT fov FROM cov WHERE win IS NULL", "seg", extra=_TIED))(
    lambda spark, d: _tied(Bindings(spark, d))[1])


# ---------------------------------------------------------------- W2
query("latest_manifest", with_ctes(f"""
SELECT dir, version, {_UUID.format(c='dir')} AS uuid FROM (
  SELECT dir, TRY_CAST(Version AS INTEGER) AS version FROM manifests WHERE TRY_CAST(Version AS INTEGER) IS NOT NULL
  ORDER BY version DESC, dir DESC LIMIT 1)""", "manifests"))(
    lambda spark, d: V.latest_manifest(Bindings(spark, d).manifests))


# ---------------------------------------------------------------- W8
query("primary_segmentation", with_ctes("""
SELECT fov, coalesce(arg_min(trim(seg_id), row_idx), '') AS primary_seg_id FROM cell_meta GROUP BY fov""",
                                        "cell_meta"))(
    lambda spark, d: V.primary_segmentation(Bindings(spark, d).cell_meta, ["fov"], seg_col="seg_id"))


# ---------------------------------------------------------------- J7
def _runs(b: Bindings):
    return (b.t("documents").select(
        F.concat(F.lit("run"), (F.col("doc_id") % 25).cast("string")).alias("run"),
        F.concat(F.lit("src"), (F.col("doc_id") % 25).cast("string")).alias("primary_seg_id")).distinct())


query("match_segmentation_dir", with_ctes(f"""
SELECT r.run, r.primary_seg_id, min(d.dir) AS primary_dir
FROM (SELECT DISTINCT 'run' || CAST(doc_id % 25 AS VARCHAR) AS run,
                      'src' || CAST(doc_id % 25 AS VARCHAR) AS primary_seg_id FROM documents) r
LEFT JOIN (SELECT DISTINCT dir, {_UUID.format(c='dir')} AS uuid FROM seg) d ON r.primary_seg_id = d.uuid
GROUP BY 1, 2""", "seg"))(
    lambda spark, d: V.match_segmentation_dir(_runs(Bindings(spark, d)), Bindings(spark, d).seg))


# ---------------------------------------------------------------- W3
_W3_CTES = """
m AS (SELECT * FROM cell_meta WHERE trim(seg_id) IN ({ids})),
firsts AS (SELECT trim(seg_id) AS id, min(source_idx) AS first FROM m GROUP BY 1),
cutv AS (SELECT CASE WHEN count(*) < {n} THEN 1073741824 ELSE max(first) END AS cut FROM firsts)"""
_W3_BODY = "SELECT m.cell_name, m.seg_id, m.source_idx FROM m, cutv WHERE m.source_idx <= cutv.cut"


def _w3(name: str, ids: str):
    wanted = sorted({s.strip() for s in ids.split(",")})
    ctes = _W3_CTES.format(ids=", ".join(f"'{x}'" for x in wanted), n=len(wanted))
    query(name, with_ctes(_W3_BODY, "cell_meta", extra=ctes))(
        lambda spark, d: V.merge_metadata_sources(Bindings(spark, d).cell_meta, ids, seg_col="seg_id")
        .select("cell_name", "seg_id", "source_idx"))


_w3("merge_metadata_sources", "seg1, seg2")
_w3("merge_metadata_sources_missing", "seg1,seg9")


# ---------------------------------------------------------------- W4
def _label_files(b: Bindings):
    seg_files = b.seg.select("dir", "fov")
    base = (b.t("documents").select((F.floor(F.col("doc_id") / 20) % 45 + 1).cast("int").alias("fov"))
            .distinct().withColumn("dir", F.lit("CellLabels")))
    files = seg_files.unionByName(base)
    return files.withColumn("path", F.concat_ws("/", "dir", F.format_string("CELLLABELS_F%03d.TIF", "fov")))


@query("pick_label_tiles", with_ctes("""
SELECT fov, arg_min(dir, (p, path)) AS dir, arg_min(path, (p, path)) AS path FROM (
  SELECT f.fov, f.dir, f.path, coalesce(e.rank, CASE WHEN NOT starts_with(f.dir, 'Segmentation_') THEN 1073741824 END) AS p
  FROM (SELECT dir, fov, dir || '/' || printf('CELLLABELS_F%03d.TIF', fov) AS path FROM (
          SELECT dir, fov FROM seg
          UNION ALL
          SELECT DISTINCT 'CellLabels' AS dir, CAST(CAST(floor(doc_id / 20) AS BIGINT) % 45 + 1 AS INTEGER) AS fov
          FROM documents)) f
  LEFT JOIN selected e ON f.dir = e.dir) x
WHERE p IS NOT NULL GROUP BY fov""", "seg", extra=_W1_SQL))
def q_pick_label_tiles(spark, d):
    b = Bindings(spark, d)
    sel = _selected(b)[0].select("dir", F.col("rank").alias("priority"))
    return V.pick_label_tiles(_label_files(b), sel)


# ---------------------------------------------------------------- J6
query("skip_processed", with_ctes("""
SELECT page_id, slide, run, output_prefix FROM slides
WHERE output_prefix NOT IN (
  SELECT DISTINCT array_to_string(list_slice(string_split(key, '/'), 1, 3), '/') FROM outputs
  WHERE len(string_split(key, '/')) > 3)""", "outputs", "slides"))(
    lambda spark, d: V.skip_processed(Bindings(spark, d).slides, Bindings(spark, d).outputs, 3))


# ---------------------------------------------------------------- O2
def _layout_rows(b: Bindings):
    p = b.t("pages").select("page_id", "url")
    return p.select("page_id", "url",
                    F.regexp_extract("url", "/([a-z]{2})/", 1).alias("lang"),
                    F.when(F.col("url").endswith(".html"), 1).when(F.col("url").endswith("/"), 2)
                     .otherwise(3).alias("priority"))


query("first_nonempty_source", with_ctes("""
WITH r AS (SELECT page_id, url, regexp_extract(url, '/([a-z]{2})/', 1) AS lang,
                  CASE WHEN ends_with(url, '.html') THEN 1 WHEN ends_with(url, '/') THEN 2 ELSE 3 END AS priority
           FROM pages)
SELECT r.* FROM r JOIN (SELECT lang, min(priority) AS priority FROM r GROUP BY lang) b
  ON r.lang = b.lang AND r.priority = b.priority"""))(
    lambda spark, d: V.first_nonempty_source(_layout_rows(Bindings(spark, d)), ["lang"]))
