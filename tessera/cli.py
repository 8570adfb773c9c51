"""Command line for the end-to-end jobs.

    python -m tessera.cli metadata   --root R --slide S [--seg-ids a,b] --out O
    python -m tessera.cli process    --root R --experiment St/Exp --out O [--run-log L]
    python -m tessera.cli ingest     --landing L --out O --checkpoint C
    python -m tessera.cli histogram  --metadata M [M2 ...] --out O
    python -m tessera.cli sankey     --a A --b B --out O
    python -m tessera.cli proportions --a A --b B [--fovs-b 1-20,35] --out O
    python -m tessera.cli dotplot    --expr-a E --meta-a M --expr-b E2 --meta-b M2 --genes g1,g2 --out O
    python -m tessera.cli umap       --a A --b B [--fovs-b ...] --out O

Metadata tables are the ``cell_ID, cell_type, hex_color`` CSVs written by the
metadata job (a ``slide`` column is taken from a ``slide=`` folder or the file's
parent folder). Spark's file sources skip names that start with ``_``, so a file
named ``_metadata.csv`` must be renamed (e.g. ``metadata.csv``) before it is
passed here. Outputs are parquet folders (one per result table).
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .session import get_spark


def _fovs(spec: str | None):
    if not spec:
        return None
    out = []
    for part in spec.split(","):
        if "-" in part:
            a, b = part.split("-")
            out.append((int(a), int(b)))
        elif part.strip():
            out.append(int(part))
    return out


def _meta(spark, paths):
    df = spark.read.option("header", True).csv(paths)
    slide = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)
    if "slide" not in df.columns:
        df = df.withColumn("slide", F.regexp_replace(slide, "^slide=", ""))
    from .util import with_file_order
    return with_file_order(df, "row_idx")


def main(argv=None):
    ap = argparse.ArgumentParser(prog="tessera")
    ap.add_argument("--master", help="Spark master (default: from the launcher)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("metadata")
    p.add_argument("--root", required=True)
    p.add_argument("--slide", required=True)
    p.add_argument("--seg-ids")
    p.add_argument("--cell-type-column")
    p.add_argument("--out", required=True)
    p = sub.add_parser("process")
    p.add_argument("--root", required=True)
    p.add_argument("--experiment", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--run-log")
    p = sub.add_parser("ingest")
    p.add_argument("--landing", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True)
    p = sub.add_parser("histogram")
    p.add_argument("--metadata", nargs="+", required=True)
    p.add_argument("--out", required=True)
    for name in ("sankey", "proportions", "umap"):
        p = sub.add_parser(name)
        p.add_argument("--a", nargs="+", required=True)
        p.add_argument("--b", nargs="+", required=True)
        p.add_argument("--fovs-b")
        p.add_argument("--out", required=True)
    p = sub.add_parser("dotplot")
    for k in ("expr-a", "meta-a", "expr-b", "meta-b", "genes", "out"):
        p.add_argument(f"--{k}", required=True)
    p.add_argument("--fovs-b")
    p.add_argument("--neurons-only", action="store_true")
    p = sub.add_parser("roi")
    for k in ("shapes", "labels", "metadata", "targets", "out"):
        p.add_argument(f"--{k}", required=True)
    for k in ("mm-per-px", "top", "left"):
        p.add_argument(f"--{k}", type=float, required=True)
    for k in ("height", "width"):
        p.add_argument(f"--{k}", type=int, required=True)
    args = ap.parse_args(argv)

    spark = get_spark(args.master)
    from .plans import jobs as J

    if args.cmd == "metadata":
        rows, stats = J.slide_metadata_job(spark, args.root, args.slide, args.seg_ids,
                                           out_path=args.out, cell_type_column=args.cell_type_column)
        stats.write.mode("overwrite").parquet(args.out.rstrip("/") + "_stats")
    elif args.cmd == "process":
        res = J.slide_processing_job(spark, args.root, args.experiment, args.out, args.run_log)
        for k in ("slides", "selected", "uncovered", "label_tiles"):
            res[k].write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{k}")
    elif args.cmd == "ingest":
        from .streaming import ingest_target_calls
        print(ingest_target_calls(spark, args.landing, args.out, args.checkpoint))
    elif args.cmd == "histogram":
        J.histogram_job(_meta(spark, args.metadata)).write.mode("overwrite").parquet(args.out)
    elif args.cmd == "sankey":
        a = _meta(spark, args.a).withColumnRenamed("cell_ID", "cell_name")
        b = _meta(spark, args.b).withColumnRenamed("cell_ID", "cell_name")
        links, nodes, summary = J.reclassification_job(a, b)
        for name, df in (("links", links), ("nodes", nodes), ("summary", summary)):
            df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
    elif args.cmd in ("proportions", "umap"):
        from .sources.readers import read_raw_metadata
        a, b = read_raw_metadata(spark, args.a), read_raw_metadata(spark, args.b)
        if args.cmd == "proportions":
            J.density_job(a, b, _fovs(args.fovs_b)).write.mode("overwrite").parquet(args.out)
        else:
            la, lb = J.cluster_label_job(a, b, _fovs(args.fovs_b))
            la.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/a")
            lb.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/b")
    elif args.cmd == "dotplot":
        from .operators.cells import NEURONAL_TYPES
        from .sources.readers import read_expression, read_raw_metadata
        genes = [g.strip() for g in args.genes.split(",") if g.strip()]
        ea, eb = read_expression(spark, args.expr_a, genes), read_expression(spark, args.expr_b, genes)
        ma, mb = read_raw_metadata(spark, [args.meta_a]), read_raw_metadata(spark, [args.meta_b])
        only = NEURONAL_TYPES if args.neurons_only else None
        J.dotplot_job(ea, ma, eb, mb, genes, _fovs(args.fovs_b), only=only).write.mode("overwrite").parquet(args.out)
    elif args.cmd == "roi":
        # shapes: JSON lines (shape_id, kind, vertices [{y, x}]); labels: (row, col, val) of
        # one slide; metadata: cell metadata CSVs; targets: a written transcript table
        from .functions.keys import cell_uid
        from .sources.readers import read_raw_metadata
        shapes = spark.read.schema("shape_id int, kind string, vertices array<struct<y:double,x:double>>").json(args.shapes)
        meta = read_raw_metadata(spark, [args.metadata])
        meta = cell_uid(meta, "cell_name" if "cell_name" in meta.columns else "cell_ID")
        flags, counts = J.roi_annotation_job(shapes, spark.read.parquet(args.labels), meta, spark.read.parquet(args.targets),
                                             args.mm_per_px, (args.top, args.left), args.height, args.width)
        flags.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/cells")
        counts.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/counts")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
