"""Command line: histogram and reclassification on metadata CSVs."""

import os

from tessera.cli import main


def _csv(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_cli_histogram_and_sankey(spark, scratch):
    a = f"{scratch}/a/slide=S1/metadata.csv"
    b = f"{scratch}/b/slide=S1/metadata.csv"
    _csv(a, "cell_ID,cell_type,hex_color\nc_1_1_1,T,#111111\nc_1_1_2,T,\nc_1_1_3,B,#222222\n")
    _csv(b, "cell_ID,cell_type,hex_color\nc_1_1_1,T,#111111\nc_1_1_2,B,#222222\nc_1_1_3,B,#222222\n")
    assert main(["--master", "local[2]", "histogram", "--metadata", a, "--out", f"{scratch}/h"]) == 0
    h = {(r["slide"], r["cell_type"]): (r["n"], r["color"], r["rank"]) for r in spark.read.parquet(f"{scratch}/h").collect()}
    assert h == {("S1", "T"): (2, "#111111", 1), ("S1", "B"): (1, "#222222", 2)}
    assert main(["--master", "local[2]", "sankey", "--a", a, "--b", b, "--out", f"{scratch}/s"]) == 0
    links = {(r["type_a"], r["type_b"]): r["n"] for r in spark.read.parquet(f"{scratch}/s/links").collect()}
    assert links == {("T", "T"): 1, ("T", "B"): 1, ("B", "B"): 1}
    summ = spark.read.parquet(f"{scratch}/s/summary").first()
    assert (summ["total"], summ["changed"]) == (3, 1)


TYPING = "RNA_RNA_Cell.Typing.InSituType.X_clusters"


def test_cli_reads_raw_files(spark, scratch):
    """Files as the instrument writes them: cell_id beside cell_ID, the typing column
    under its own name, columns in any order."""
    _csv(f"{scratch}/ma.csv", f"fov,cell_ID,cell_id,{TYPING},UMAP_1,UMAP_2\n1,1,c_1_1_1,L4.neuron,0.5,1\n1,2,c_1_1_2,Glia,1.5,2\n1,3,c_1_1_3,,9,9\n")
    _csv(f"{scratch}/mb.csv", f"UMAP_2,UMAP_1,{TYPING},cell_id,cell_ID,fov\n1,0.5,L4.neuron,c_1_1_1,1,1\n2,1.5,Glia,c_1_1_2,2,1\n")
    for k in "ab":
        _csv(f"{scratch}/e{k}.csv", "fov,cell_ID,G1,G2\n1,1,2,0\n1,2,0,4\n1,3,7,7\n")
    run = lambda *a: main(["--master", "local[2]", *a])
    dots = lambda: {(r["slide"], r["cell_type"], r["gene"]): (r["pct_expressed"], r["mean_expression"]) for r in spark.read.parquet(f"{scratch}/d").collect()}
    args = ["dotplot", "--expr-a", f"{scratch}/ea.csv", "--meta-a", f"{scratch}/ma.csv", "--expr-b", f"{scratch}/eb.csv", "--meta-b", f"{scratch}/mb.csv", "--genes", "G1,G2", "--out", f"{scratch}/d"]
    assert run(*args) == 0
    assert dots()[("A", "L4.neuron", "G1")] == (1.0, 2.0) and len(dots()) == 8
    assert run(*args, "--neurons-only") == 0
    assert {k[1] for k in dots()} == {"L4.neuron"}
    assert run("umap", "--a", f"{scratch}/ma.csv", "--b", f"{scratch}/mb.csv", "--out", f"{scratch}/u") == 0
    assert {(r["cell_type"], r["median_1"]) for r in spark.read.parquet(f"{scratch}/u/a").collect()} == {("L4.neuron", 0.5), ("Glia", 1.5)}
    assert run("proportions", "--a", f"{scratch}/ma.csv", "--b", f"{scratch}/mb.csv", "--out", f"{scratch}/p") == 0
    assert {(r["cell_type"], r["density_a"], r["density_b"]) for r in spark.read.parquet(f"{scratch}/p").collect()} == {("L4.neuron", 1.0, 1.0), ("Glia", 1.0, 1.0)}


def test_cli_roi(spark, scratch):
    from tessera.functions.keys import pair_key
    from pyspark.sql import functions as F
    _csv(f"{scratch}/m.csv", f"fov,cell_ID,cell_id,{TYPING}\n1,1,c_1_1_1,T\n1,2,c_1_1_2,T\n")
    _csv(f"{scratch}/s.json", '{"shape_id": 1, "kind": "polygon", "vertices": [{"y": -1, "x": -1}, {"y": -1, "x": 3}, {"y": 3, "x": 3}, {"y": 3, "x": -1}]}\n')
    px = spark.createDataFrame([(1, 1, 1, 1), (8, 8, 1, 2)], "row int, col int, fov int, c int")
    px.select("row", "col", pair_key(F.col("fov"), F.col("c")).alias("val")).write.parquet(f"{scratch}/l")
    spark.createDataFrame([(1, 1, "G"), (1, 1, "G"), (1, 2, "H"), (1, 1, "NegPrb1")], "fov int, CellId int, target string").write.parquet(f"{scratch}/t")
    assert main(["--master", "local[2]", "roi", "--shapes", f"{scratch}/s.json", "--labels", f"{scratch}/l", "--metadata", f"{scratch}/m.csv", "--targets", f"{scratch}/t",
                 "--mm-per-px", "1", "--top", "0", "--left", "0", "--height", "10", "--width", "10", "--out", f"{scratch}/o"]) == 0
    assert {(r["cell_ID"], r["shape_1"]) for r in spark.read.parquet(f"{scratch}/o/cells").collect()} == {(1, True), (2, False)}
    assert {(r["target"], r["count"]) for r in spark.read.parquet(f"{scratch}/o/counts").collect()} == {("G", 2)}
