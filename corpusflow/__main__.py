"""Command line: the pipeline run, the reset tool and the resume plan.

    python -m corpusflow run   --config config.json --state STATE_ROOT [--list-pages P] [--outcomes P]
    python -m corpusflow reset --state STATE_ROOT [--page-slug SLUG]
    python -m corpusflow plan  --config config.json --state STATE_ROOT --out PARQUET_DIR

Under spark-submit the cluster session is used; ``--local`` starts a local one.
"""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session(local: bool) -> SparkSession:
    from corpusflow.session import local_session, ship_package, work_dir

    if local:
        return local_session()
    spark = SparkSession.builder.appName("corpusflow").getOrCreate()
    work_dir(spark)
    ship_package(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="corpusflow")
    ap.add_argument("--local", action="store_true", help="start a local session")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="catalogue -> state upsert -> resume plan -> stage outcomes -> new state version")
    run.add_argument("--config", required=True)
    run.add_argument("--state", required=True)
    run.add_argument("--list-pages", help="Parquet with page_url, html of the fetched list pages")
    run.add_argument("--outcomes", help="Parquet with stage outcomes (page_slug, id, download_ok, ...)")
    run.add_argument("--metadata", help="Parquet with item_id, metadata (JSON; null: not fetched) for the config's domain handlers")
    run.add_argument("--download-base", help="where resolved files are (needed with --metadata)")
    run.add_argument("--modules", action="store_true", help="import the config's handler modules and let them resolve URLs")
    run.add_argument("--cache", help="folder of the provider's answers, kept from run to run")
    run.add_argument("--enrich-languages", default="", help="language prefixes whose names go through --provider, comma-separated")
    run.add_argument("--provider", help="module:function, Series of texts -> Series of answers")
    rst = sub.add_parser("reset", help="failed / in-progress rows back to pending")
    rst.add_argument("--state", required=True)
    rst.add_argument("--page-slug")
    pl = sub.add_parser("plan", help="write the resume plan (rows still to process, in order)")
    pl.add_argument("--config", required=True)
    pl.add_argument("--state", required=True)
    pl.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    spark = _session(args.local)
    from corpusflow.operators import state as ST
    from corpusflow.operators.resolve import HandlerRegistry, metadata_resolver
    from corpusflow.plans import workflow as P
    from corpusflow.sources import config as CFG
    from corpusflow.sources import state as SS

    if args.cmd == "run":
        lists = spark.read.parquet(args.list_pages) if args.list_pages else None
        outcomes = spark.read.parquet(args.outcomes) if args.outcomes else None
        registry = None
        if args.metadata and not args.download_base:
            ap.error("--metadata needs --download-base")
        if args.metadata:
            resolver = metadata_resolver(spark.read.parquet(args.metadata), args.download_base)
            registry = HandlerRegistry(default=resolver)
        provider = None
        if args.provider:
            module, _, name = args.provider.partition(":")
            provider = getattr(importlib.import_module(module), name)
        languages = set(filter(None, args.enrich_languages.split(",")))
        result = P.run_once(spark, args.config, args.state, outcomes=outcomes, list_pages=lists, registry=registry, enrich_languages=languages, provider=provider, modules=args.modules, cache_dir=args.cache)
    elif args.cmd == "reset":
        result = P.reset(spark, args.state, args.page_slug)
    else:
        pages = CFG.enabled_pages(CFG.config_pages(CFG.read_config(spark, args.config), keep=["config_path"]))
        limits = pages.select("page_slug", "config_path", "page_pos", F.col("page_limit").alias("limit"))
        plan = ST.resume_plan(SS.load_state(spark, args.state), limits, order=["config_path", "page_pos"])
        plan.withColumn("remaining", F.array_join("remaining", ",")).write.mode("errorifexists").parquet(args.out)
        result = {"plan": args.out}
    print(json.dumps(result))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
