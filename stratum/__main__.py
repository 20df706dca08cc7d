"""Run the lakehouse from the command line.

usage: python -m stratum {ingest,silver,check-silver,gold,check-gold,freshness,expire,run} --config FILE --root PATH

Exits with 1 when a gate blocks promotion, a source could not be ingested or a table is too old.
"""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import date

from stratum.operators.quality import QualityGateError
from stratum.plans import lakehouse, marts
from stratum.session import build_session
from stratum.sources.bronze import expire, ingest
from stratum.sources.registry import load_sources

STEPS = ("ingest", "silver", "check-silver", "gold", "check-gold")


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stratum", description=__doc__.splitlines()[0])
    parser.add_argument("step", choices=(*STEPS, "freshness", "expire", "run"))
    parser.add_argument("--config", help="source registry, needed for ingest, freshness, expire and run")
    parser.add_argument("--root", required=True, help="folder that holds bronze, silver and gold")
    parser.add_argument("--format", default="parquet", help="format of the silver and gold tables")
    parser.add_argument("--as-of", type=date.fromisoformat, help="business date, default today (UTC)")
    parser.add_argument("--reporting-start", default=marts.REPORTING_START)
    parser.add_argument("--full-snapshot", action="store_true", help="close customers the feed omits")
    parser.add_argument(
        "--incremental", action="store_true", help="silver: only what the day landed now changes"
    )
    parser.add_argument(
        "--schemas", help="keep tables in catalog schemas of these names, such as '{layer}' or 'dev_{layer}'"
    )
    parser.add_argument("--allow-missing", action="store_true", help="gate: skip missing tables")
    options = parser.parse_args(arguments)
    if options.step in ("ingest", "freshness", "expire", "run") and not options.config:
        parser.error("--config is needed")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")

    spark = build_session()
    lake = lakehouse.Lake.now(
        options.root,
        reporting_start=options.reporting_start,
        fmt=options.format,
        schemas=options.schemas,
    )
    if options.as_of:
        lake = lake.on(options.as_of)
    try:
        return max(
            run_step(spark, step, lake, options)
            for step in (STEPS if options.step == "run" else (options.step,))
        )
    except QualityGateError as error:
        logging.getLogger("stratum").error("%s", error)
        return 1


def run_step(spark, step: str, lake: lakehouse.Lake, options) -> int:
    if step == "ingest":
        config = load_sources(options.config)
        results = ingest(
            spark, config.sources, lake.path("bronze"), lake.batch_ts, config.partition_column, lake.schema("bronze")
        )
        return int(any(result.status != "success" for result in results))
    if step == "freshness":
        report = lakehouse.freshness_report(spark, load_sources(options.config), lake).collect()
        for row in report:
            logging.getLogger("stratum").info("%s: %s, %s s old", row["name"], row["status"], row["age_seconds"])
        return int(any(row["status"] == "error" for row in report))
    if step == "expire":
        config = load_sources(options.config)
        expire(
            spark, config.sources, lake.path("bronze"), lake.as_of, config.bronze_retention_days,
            config.partition_column, lake.schema("bronze"),
        )
    elif step == "silver":
        days = [lake.batch_ts.date()] if options.incremental else None
        lakehouse.build_silver(spark, lake, options.full_snapshot, days)
    elif step == "gold":
        lakehouse.build_gold(spark, lake)
    else:
        layer = step.removeprefix("check-")
        rules = lakehouse.silver_rules() if layer == "silver" else lakehouse.gold_rules()
        lakehouse.check_layer(spark, lake, layer, rules, options.allow_missing)
    return 0


if __name__ == "__main__":
    sys.exit(main())
