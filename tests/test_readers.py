"""File readers, sinks and streaming ingestion on hand-made slide folders."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from tessera.sources import inventory as I
from tessera.sources import readers as RD
from tessera.sources import sinks as S
from tessera.streaming import ingest_target_calls

HDR = "fov,CellId,cell_ID,x,y,z,target,CellComp,extra\n"


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)


def test_target_call_layouts(spark, scratch):
    root = f"{scratch}/slide"
    suffix = "__complete_code_cell_target_call_coord.csv"
    # layout 2 (FOV folders) and layout 3 (root) both exist: layout 1 is absent, so layout 2 wins
    _write(f"{root}/FOV001/R1{suffix}", HDR + "1,0,5,1.5,2.5,1,GeneA,Nuclear,q\n")
    _write(f"{root}/FOV002/R1{suffix}", HDR + "2,3,6,4.0,1.0,2,GeneB,Membrane,q\n")
    _write(f"{root}/R1{suffix}", HDR + "9,9,9,9,9,9,Wrong,Nuclear,q\n")
    df = RD.read_target_calls(spark, root)
    assert sorted(r["target"] for r in df.collect()) == ["GeneA", "GeneB"]
    assert dict(df.dtypes) == {"fov": "int", "CellId": "int", "x": "double", "y": "double", "z": "int",
                               "target": "string", "CellComp": "string"}
    # layout 1 present -> only it is read
    _write(f"{root}/FOV003/FOV_Analysis_Summary/R1{suffix}", HDR + "3,1,1,0,0,0,GeneC,Nuclear,q\n")
    assert [r["target"] for r in RD.read_target_calls(spark, root).collect()] == ["GeneC"]


def test_fov_offsets_formats(spark, scratch):
    new = f"{scratch}/rs_new"
    _write(f"{new}/run_FOV_Locations.csv", "Slide,X_mm,Y_mm,Z_um,FOV\n1,0.5,1.0,2000,1\n1,1.5,2.0,3000,2\n")
    df = RD.read_fov_offsets(spark, new)
    assert df.columns[:7] == ["Slide", "X_mm", "Y_mm", "Z_mm", "ZOffset_mm", "ROI", "FOV"]
    rows = df.orderBy("FOV").collect()
    assert rows[0]["Z_mm"] == 2.0 and rows[0]["ZOffset_mm"] == -2.0 and rows[0]["ROI"] == 0
    old = f"{scratch}/rs_old"
    _write(f"{old}/latest.fovs.csv", "1,0.5,1.0,2.0,-2.0,0,1,1\n1,1.5,2.0,3.0,-2.0,0,2,2\n")
    df = RD.read_fov_offsets(spark, old)
    assert df.columns == ["Slide", "X_mm", "Y_mm", "Z_mm", "ZOffset_mm", "ROI", "FOV", "Order", "ord"]
    assert [r["FOV"] for r in df.orderBy("ord").collect()] == [1, 2]


def test_cell_metadata_two_runs(spark, scratch):
    exp = f"{scratch}/exp"
    t1 = "RNA_RNA_Cell.Typing.InSituType.a_clusters"
    t2 = "RNA_RNA_Cell.Typing.InSituType.b_clusters"
    _write(f"{exp}/r1/flatFiles/S9/S9_metadata_file.csv.gz",
           f"fov,cell_ID,cell_id,cellSegmentationSetId,{t1}\n1,1,c_1_1_1, segA ,T\n1,2,c_1_1_2,segA,\n", gz=True)
    _write(f"{exp}/r2/flatFiles/S9/S9_metadata_file.csv.gz",
           f"fov,cell_ID,cell_id,other,cellSegmentationSetId,{t2}\n2,1,c_1_2_1,x,segB,B\n", gz=True)
    _write(f"{exp}/r3/flatFiles/S8/S8_metadata_file.csv.gz", "fov,cell_ID\n1,1\n", gz=True)
    m = RD.read_cell_metadata(spark, exp, "S9")
    rows = sorted((r["run"], r["source_idx"], r["cell_name"], r["cell_type"]) for r in m.collect())
    assert rows == [("r1", 0, "c_1_1_1", "T"), ("r1", 0, "c_1_1_2", None), ("r2", 1, "c_1_2_1", "B")]
    from tessera.plans.jobs import slide_metadata
    out, stats = slide_metadata(m, "segB")
    assert [(r["cell_ID"], r["cell_type"]) for r in out.collect()] == [("c_1_2_1", "B")]
    s = stats.first()
    assert (s["rows_read"], s["rows_written"], s["seg_ids_seen"]) == (3, 1, ["segA", "segB"])


def test_mtx_and_dictionaries(spark, scratch):
    _write(f"{scratch}/m.mtx", "%%MatrixMarket matrix coordinate integer general\n% c\n3 2 3\n1 1 5\n3 2 7\n2 1 1\n")
    got = sorted(tuple(r) for r in RD.read_mtx(spark, f"{scratch}/m.mtx").collect())
    assert got == [(0, 0, 5), (1, 0, 1), (2, 1, 7)]
    assert RD.mtx_shape(spark, f"{scratch}/m.mtx") == (3, 2, 3)
    _write(f"{scratch}/plex.txt", "ProbeID\tDisplayName\tX\nCPRO1\tCD3\t1\nCPRO1\tCD3e\t2\n")
    d = RD.read_dictionary(spark, f"{scratch}/plex.txt", "plex")
    from tessera.operators.cells import probe_label
    probes = spark.createDataFrame([("CPRO1",), ("OTHER",)], "probe string")
    got = {r["probe"]: r["label"] for r in probe_label(probes, d).collect()}
    assert got == {"CPRO1": "CD3e", "OTHER": "OTHER"}   # last duplicate wins
    _write(f"{scratch}/cell_type_colors.csv", "T,#FF0000\nB,#00FF00\n")
    c = RD.read_dictionary(spark, f"{scratch}/cell_type_colors.csv", "colors")
    assert {r["value"]: r["color"] for r in c.collect()} == {"T": "#FF0000", "B": "#00FF00"}


def test_indexed_csv_positional(spark, scratch):
    _write(f"{scratch}/obs.csv", "cell,type\nc3,T\nc1,B\nc2,T\n")
    obs = RD.read_indexed_csv(spark, f"{scratch}/obs.csv")
    assert [(r["idx"], r["name"]) for r in obs.orderBy("idx").collect()] == [(0, "c3"), (1, "c1"), (2, "c2")]


def test_inventory_and_sinks(spark, scratch):
    _write(f"{scratch}/tree/a/CellLabels_F001.TIF", "x")
    _write(f"{scratch}/tree/a/b/20240101_S1_C902_P99_N99_F002.TIF", "xy")
    inv = I.file_inventory(spark, f"{scratch}/tree")
    k = I.classify_image_files(inv)
    kinds = {os.path.basename(r["path"]): (r["kind"], r["fov"]) for r in k.collect()}
    assert kinds == {"CellLabels_F001.TIF": ("labels", 1), "20240101_S1_C902_P99_N99_F002.TIF": ("morphology", 2)}
    px = spark.createDataFrame([("c", 0, r, c, (r * 7 + c) % 3) for r in range(20) for c in range(20)],
                               "channel string, level int, row int, col int, val long")
    S.write_mosaic(px, f"{scratch}/mosaic", block=8)
    back = S.unpack_blocks(spark.read.parquet(f"{scratch}/mosaic"), 8)
    assert back.count() == px.where(F.col("val") != 0).count()
    assert back.join(px, ["channel", "level", "row", "col", "val"], "left_anti").count() == 0


def test_streaming_ingest_once(spark, scratch):
    land, out, ck = f"{scratch}/landing", f"{scratch}/table", f"{scratch}/ckpt"
    suffix = "__complete_code_cell_target_call_coord.csv"
    hdr = "fov,CellId,x,y,z,target,CellComp\n"
    _write(f"{land}/slideA/R{suffix}", hdr + "1,1,0.5,0.5,1,G1,Nuclear\n1,2,1.5,0.5,1,G2,Nuclear\n")
    assert ingest_target_calls(spark, land, out, ck) == 2
    assert ingest_target_calls(spark, land, out, ck) == 0          # already seen: nothing re-read
    _write(f"{land}/slideB/R{suffix}", hdr + "3,0,2.5,2.5,1,G1,Membrane\n")
    assert ingest_target_calls(spark, land, out, ck) == 1
    t = spark.read.parquet(out)
    assert sorted((r["slide"], r["target"]) for r in t.collect()) == [("slideA", "G1"), ("slideA", "G2"), ("slideB", "G1")]


def test_cohort_metadata_many_slides(spark, scratch):
    exp = f"{scratch}/cohort"
    t1 = "RNA_RNA_Cell.Typing.InSituType.a_clusters"
    t2 = "RNA_RNA_Cell.Typing.InSituType.b_clusters"
    for slide in ("S1", "S2"):
        _write(f"{exp}/r1/flatFiles/{slide}/{slide}_metadata_file.csv.gz",
               f"fov,cell_ID,cell_id,cellSegmentationSetId,{t1}\n1,1,c_1_1_1,segA,T\n", gz=True)
        _write(f"{exp}/r2/flatFiles/{slide}/{slide}_metadata_file.csv.gz",
               f"fov,cell_ID,cell_id,cellSegmentationSetId,{t2}\n2,1,c_1_2_1,segB,B\n", gz=True)
    _write(f"{exp}/r0/flatFiles/S2/S2_metadata_file.csv.gz",
           f"fov,cell_ID,cell_id,cellSegmentationSetId,{t2}\n3,1,c_1_3_1,segC,C\n", gz=True)
    m = RD.read_cohort_metadata(spark, exp)
    got = sorted((r["slide"], r["run"], r["source_idx"], r["cell_type"]) for r in m.collect())
    assert got == [("S1", "r1", 0, "T"), ("S1", "r2", 1, "B"),
                   ("S2", "r0", 0, "C"), ("S2", "r1", 1, "T"), ("S2", "r2", 2, "B")]


def test_first_lines_without_sorting_lines(spark, scratch):
    """The header of every file is found without a sort of all its lines."""
    root = f"{scratch}/many"
    for k in range(3):
        _write(f"{root}/f{k}.csv", f"﻿a,b{k}\n" + "\n".join(f"{i},{k}" for i in range(50, 0, -1)) + "\n") if k else _write(f"{root}/f{k}.csv", "a,b0\n1,2\n")
    heads = RD.csv_headers(spark, root, RD.named(root, r"f[0-9]\.csv"))
    assert sorted(r["header"] for r in heads.collect()) == ["a,b0", "a,b1", "a,b2"]
    assert "Sort" not in heads._jdf.queryExecution().executedPlan().toString()


def test_listings_start_some_tasks_a_core(spark, scratch, monkeypatch):
    for k in range(40):
        _write(f"{scratch}/wide/d{k}/f.txt", "x")
    conf, before = "spark.sql.sources.parallelPartitionDiscovery.parallelism", spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    with I.few_listing_tasks(spark):
        assert int(spark.conf.get(conf)) <= max(32, 8 * spark.sparkContext.defaultParallelism)
    assert spark.conf.get(conf) == before and I.file_inventory(spark, f"{scratch}/wide").count() == 40


def test_targets_take_few_folders(spark, scratch):
    """FOVs share folders; a FOV written again is replaced, the others of its folder stay."""
    path, cols = f"{scratch}/targets", "fov int, CellId int, target string"
    S.write_targets(spark.createDataFrame([(f, 1, "a") for f in range(600)] + [(None, 1, "n")], cols), path, ["fov"])
    assert len([n for n in os.listdir(path) if "=" in n]) == 4
    S.write_targets(spark.createDataFrame([(3, 2, "b"), (3, 3, "c"), (700, 1, "a")], cols), path, ["fov"])
    got = sorted(((r["fov"], r["CellId"], r["target"]) for r in spark.read.parquet(path).collect()), key=str)
    assert got == sorted([(f, 1, "a") for f in range(600) if f != 3] + [(None, 1, "n"), (3, 2, "b"), (3, 3, "c"), (700, 1, "a")], key=str)


def test_folders_are_dealt_to_many_tasks(spark, scratch):
    """One file a folder, written by several tasks a core however few bytes there are."""
    from tessera.plans.q_files import write_folders
    path = f"{scratch}/folders"
    df = spark.range(400).selectExpr("id % 200 AS fov", "'x' AS value")
    write_folders(df, "fov").text(path)
    files = [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]
    assert len(files) == 200 and len({f.split("-")[1] for f in files}) > 4
    assert spark.read.text(path).count() == 400


@pytest.mark.parametrize("multi_line", [False, True])
def test_manifests_of_many_folders_are_read_in_batches(spark, scratch, monkeypatch, multi_line):
    """No scan has more folders than a batch; types are those of all documents together."""
    docs = ['{"Version": 3, "only": null}', '{"Version": "x"}', '{"Version": 1e3, "n": 2}', '[{"Version": 5}, {"Version": 6}]', '{"n": 2.5}', '{}']
    for k in range(24):
        folder = f"{scratch}/m/S{k % 6}/Segmentation_u{k}_001"
        os.makedirs(folder)
        with open(f"{folder}/manifest.json", "w") as f:
            f.write(docs[k % 5 if k < 20 else 5].replace(": ", ":\n " if multi_line else ": ") + "\n")
    order = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    whole = RD.read_manifests(spark, f"{scratch}/m/*/Segmentation_*", multi_line)
    monkeypatch.setattr(RD, "BATCH_FOLDERS", 8)
    scans, read = [], RD._read_in_batches
    monkeypatch.setattr(RD, "_read_in_batches", lambda s, batches, *a: scans.extend(batches) or read(s, batches, *a))
    parts = RD.read_manifests(spark, f"{scratch}/m/*/Segmentation_*", multi_line)
    assert [len(b) for b in scans] == [2, 2, 2]
    assert dict(parts.dtypes) == dict(whole.dtypes) and order(parts) == order(whole) and parts.count() == 28


@pytest.mark.parametrize("shared", [False, True])
def test_json_folders(spark, scratch, monkeypatch, shared):
    from tessera.plans import q_files
    monkeypatch.setattr(q_files, "mounted", lambda spark: shared)
    rows = [(f"Segmentation_u{k % 40}" if k % 50 else None, None if k % 9 == 0 else f'"\\{k}\u00e9') for k in range(400)]
    q_files.write_json_folders(spark.createDataFrame(rows, "dir string, Version string"), "dir", f"file://{scratch}/j")
    got = RD.read_manifests(spark, f"{scratch}/j/*/*", multi_line=False).select("dir", "Version").collect()
    key = lambda r: (r[0] or "", r[1] or "")
    assert sorted(map(key, got)) == sorted(map(key, rows))
    folders = [d for d, _, names in os.walk(f"{scratch}/j") if any(n.endswith(".json") for n in names)]
    assert len(folders) == 41 and len({os.path.dirname(d) for d in folders}) > 1
