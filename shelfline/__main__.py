"""Command line: the daily steps as Spark jobs.

    python -m shelfline ingest --raw <archives> --root <warehouse> --nomenclatures <folder> [--force-from YYYY-MM-DD]
    python -m shelfline sync   --root <warehouse>
    python -m shelfline stream --raw <archives> --root <warehouse> --nomenclatures <folder> --checkpoint <folder>

Run under ``spark-submit`` (the session comes from the submit settings; the
local master below is only a default for a plain ``python`` run).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from shelfline.plans.ingest import Nomenclatures, run_ingest
from shelfline.plans.sync import run_sync
from shelfline.session import apply_conf, ensure_checkpoint_dir, ship_package
from shelfline.sources.nomenclature import category_lookup, settlement_lookup


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("shelfline").getOrCreate()
    apply_conf(spark)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="shelfline")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("ingest", "stream"):
        s = sub.add_parser(name)
        s.add_argument("--raw", required=True)
        s.add_argument("--root", required=True)
        s.add_argument("--nomenclatures", required=True)
        if name == "ingest":
            s.add_argument("--force-from", default="")
        else:
            s.add_argument("--checkpoint", required=True)
            s.add_argument("--max-files-per-trigger", type=int, default=None)
    s = sub.add_parser("sync")
    s.add_argument("--root", required=True)
    s.add_argument("--lookback-text", default=None)
    args = p.parse_args(argv)

    spark = _session()
    if args.cmd == "sync":
        print(json.dumps({"serving_version": run_sync(spark, args.root, lookback_text=args.lookback_text)}))
        return 0
    noms = Nomenclatures(settlement_lookup(spark, args.nomenclatures),
                         category_lookup(spark, args.nomenclatures))
    if args.cmd == "ingest":
        res = run_ingest(spark, args.raw, args.root, noms, force_from=args.force_from)
        print(json.dumps({"processed": res.processed_dates, "max_processed_date": res.max_processed_date}))
        return 0
    from shelfline.streaming.incremental import start_archive_stream

    start_archive_stream(spark, args.raw, args.root, noms, args.checkpoint,
                         args.max_files_per_trigger).awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
