"""Command line: publish one set of tables from raw inputs.

    spark-submit -m strata markets      --prices PATH            --out ROOT
    spark-submit -m strata carbon       --intensity PATH --generation PATH --out ROOT
    spark-submit -m strata readmissions --csv PATH               --out ROOT

Inputs are Parquet folders of the raw tables, or the published files: JSON
snapshots (``--prices-json``), JSON documents (``--documents``), CSV with a header. The session comes from the submitting
environment: master, sizes and ``spark.checkpoint.dir`` are the cluster's.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.plans import publish
from strata.plans import readmissions as rd
from strata.session import apply_conf, ensure_checkpoint_dir
from strata.sources.documents import (
    check_landing, flatten_generation_mix, flatten_regional_intensity, read_carbon_documents, read_price_snapshots,
)
from strata.sources.files import read_csv_strings
from strata.sources.sinks import stamp_source_file


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="what", required=True)
    m = sub.add_parser("markets")
    source = m.add_mutually_exclusive_group(required=True)
    source.add_argument("--prices", help="Parquet folder of raw snapshots")
    source.add_argument("--prices-json", help="landing folder of snapshot files, in _batch_id=<unix seconds> folders")
    m.add_argument("--chunk-width", type=int, default=86400, help="batch-id units per lag chunk")
    c = sub.add_parser("carbon")
    c.add_argument("--intensity", help="Parquet folder (with --generation)")
    c.add_argument("--generation")
    c.add_argument("--documents", help="landing folder of document files, instead of both")
    c.add_argument("--wrap-midnight", action="store_true")
    h = sub.add_parser("readmissions")
    h.add_argument("--csv", required=True)
    h.add_argument("--order-by", default="Facility ID,Measure Name,Start Date",
                   help="columns (raw header names) of the dedupe order; all other columns break its ties")
    h.add_argument("--allow-losses", action="store_true", help="publish although numbers or dates did not parse")
    for p in (m, c, h):
        p.add_argument("--out", required=True)
        p.add_argument("--prefix", default=None)
    args = ap.parse_args(argv)
    if args.what == "carbon" and not (args.documents or (args.intensity and args.generation)):
        ap.error("carbon needs --documents, or --intensity and --generation")

    spark = SparkSession.builder.appName(f"strata-{args.what}").getOrCreate()
    apply_conf(spark)
    ensure_checkpoint_dir(spark)
    if args.what == "markets":
        if args.prices_json:
            prices = check_landing(read_price_snapshots(spark, args.prices_json)) \
                .withColumn("_batch_id", F.col("_batch_id").cast("long")).withColumn("_ingested_at", F.current_timestamp())
        else:
            prices = spark.read.parquet(args.prices)
        paths = publish.publish_markets(spark, prices, args.out,
                                        prefix=args.prefix or "crypto", chunk_width=args.chunk_width)
    elif args.what == "carbon":
        if args.documents:
            docs = check_landing(read_carbon_documents(spark, args.documents))
            intensity, generation = flatten_regional_intensity(docs), flatten_generation_mix(docs)
        else:
            intensity, generation = spark.read.parquet(args.intensity), spark.read.parquet(args.generation)
        paths = publish.publish_carbon(spark, intensity, generation, args.out,
                                       prefix=args.prefix or "energy", wrap_midnight=args.wrap_midnight)
    else:
        raw = stamp_source_file(read_csv_strings(spark, args.csv, rd.RAW_HEADER))
        bronze = rd.bronze_hrrp(raw)
        order = [rd.snake_case_names([c])[c] for c in args.order_by.split(",")]
        paths = publish.publish_readmissions(spark, bronze, args.out, order_by=order,
                                             allow_losses=args.allow_losses,
                                             prefix=args.prefix or "healthcare")
    print(json.dumps(paths))


if __name__ == "__main__":
    main()
