"""Command line for the batch jobs; also usable as a ``spark-submit`` script.

    python -m forecastry ingest   --raw R --processed P [--training T] [--eda E]
    python -m forecastry ingest-v1 --raw R --processed P --training T
    python -m forecastry ingest-stream --raw R --processed P --checkpoint C [--drop-nulls]
    python -m forecastry explore  --processed P --eda E
    python -m forecastry features --processed P --features F [--leak-free]
    python -m forecastry train    --features F --predictions O --models M [--forest tuned|light]
    python -m forecastry status   --runs R --jobs J (--listing L | --tree FOLDER) --out O

Reports (profiles, RMSE) are printed as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from forecastry.plans import jobs
from forecastry.schema import SEED
from forecastry.session import get_session
from forecastry.sources import list_objects, read_parquet, write_parquet
from forecastry.streaming import ingest_stream


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="forecastry")
    sub = p.add_subparsers(dest="cmd", required=True)
    common = {"--seed": {"type": int, "default": SEED}, "--split-mode": {"choices": ["random", "exact", "hash", "cutoff"], "default": "random"}}

    a = sub.add_parser("ingest", help="raw CSV -> typed, imputed, scaled Parquet (+ split CSVs, summaries)")
    for k in ("--raw", "--processed"):
        a.add_argument(k, required=True)
    a.add_argument("--training")
    a.add_argument("--eda")
    a.add_argument("--scale-method", choices=["expr", "ml"], default="expr")
    a = sub.add_parser("ingest-v1", help="raw CSV -> text Parquet without null rows, split CSVs")
    for k in ("--raw", "--processed", "--training"):
        a.add_argument(k, required=True)
    a = sub.add_parser("ingest-stream", help="incremental raw CSV -> typed Parquet (Structured Streaming)")
    for k in ("--raw", "--processed", "--checkpoint"):
        a.add_argument(k, required=True)
    a.add_argument("--drop-nulls", action="store_true")
    a.add_argument("--max-files-per-trigger", type=int, default=100)
    a = sub.add_parser("explore", help="profile + monthly/store/item summary CSVs")
    for k in ("--processed", "--eda"):
        a.add_argument(k, required=True)
    a = sub.add_parser("features", help="calendar, lag and rolling-mean features")
    for k in ("--processed", "--features"):
        a.add_argument(k, required=True)
    a.add_argument("--leak-free", action="store_true")
    a.add_argument("--partition-by", nargs="*")
    a.add_argument("--unique-keys", choices=["trust", "sum"], default="trust")
    a.add_argument("--chunk-days", type=int)
    a.add_argument("--pieces", type=int, help="cut series of more than 1 / so many of all rows")
    a = sub.add_parser("train", help="fit least squares + forest, RMSE, predictions, saved models")
    for k in ("--features", "--predictions", "--models"):
        a.add_argument(k, required=True)
    a.add_argument("--forest", choices=["tuned", "light"], default="tuned")
    a.add_argument("--keep-keys", action="store_true")
    a.add_argument("--handle-invalid", choices=["error", "skip", "keep"], default="error")
    a.add_argument("--cutoff", help="first date of the test side, with --split-mode cutoff")
    a = sub.add_parser("status", help="latest run per job, newest artefact per prefix")
    for k in ("--runs", "--jobs", "--out"):
        a.add_argument(k, required=True)
    which = a.add_mutually_exclusive_group(required=True)
    which.add_argument("--listing", help="a Parquet table of prefix, key, last_modified")
    which.add_argument("--tree", help="a folder whose files are listed; prefixes are its first folders")
    for name in ("ingest", "ingest-v1", "train"):
        for flag, kw in common.items():
            sub.choices[name].add_argument(flag, **kw)
    sub.choices["train"].set_defaults(split_mode="hash")
    return p


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or get_session(app=f"forecastry-{args.cmd}")
    if args.cmd == "ingest":
        out = jobs.ingest(spark, args.raw, args.processed, args.training, args.eda, args.seed,
                          args.split_mode, args.scale_method)
    elif args.cmd == "ingest-v1":
        jobs.ingest_v1(spark, args.raw, args.processed, args.training, args.seed, args.split_mode)
        out = {}
    elif args.cmd == "ingest-stream":
        q = ingest_stream(spark, args.raw, args.processed, args.checkpoint, args.drop_nulls,
                          args.max_files_per_trigger)
        progress = q.lastProgress or {}
        out = {"batch": progress.get("batchId"), "rows": progress.get("numInputRows")}
    elif args.cmd == "explore":
        out = jobs.explore(spark, args.processed, args.eda)
    elif args.cmd == "features":
        jobs.build_features(spark, args.processed, args.features, args.leak_free, args.partition_by,
                            args.unique_keys, args.chunk_days, args.pieces)
        out = {}
    elif args.cmd == "train":
        out = jobs.train(spark, args.features, args.predictions, args.models, args.forest, args.seed,
                         args.split_mode, args.keep_keys, args.handle_invalid, args.cutoff)
    else:
        if args.tree:
            listing = list_objects(spark, args.tree).select("prefix", "key", "last_modified")
        else:
            listing = read_parquet(spark, args.listing)
        rep = jobs.status_report(read_parquet(spark, args.runs), read_parquet(spark, args.jobs), listing)
        for name, df in rep.items():
            write_parquet(df, os.path.join(args.out, name))
        out = {}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
