"""Command line: run one table, one stage or a whole day.

    python -m lendscape land --table bureau --landing /in --lake /lake --date 2026-05-12
    python -m lendscape day --landing /in --lake /lake
"""

from __future__ import annotations

import argparse
import logging
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession

from lendscape.operators import quality as q
from lendscape.plans import daily
from lendscape.plans.silver import business_rules, run_silver
from lendscape.session import tune
from lendscape.sources import landing
from lendscape.specs import SOURCES

log = logging.getLogger("lendscape")


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lendscape")
    parser.add_argument(
        "stage",
        choices=[
            "land", "bronze-gate", "refine", "silver-gate", "model", "gold-gate", "summary", "day"
        ],
    )
    parser.add_argument("--table", choices=sorted(SOURCES), help="default: all tables")
    parser.add_argument("--landing", help="folder of the source files")
    parser.add_argument("--lake", required=True, help="root folder of the layers")
    parser.add_argument("--env", default="dev", choices=["dev", "staging", "prod"])
    parser.add_argument("--date", type=date.fromisoformat, default=date.today())
    parser.add_argument(
        "--run-ts",
        type=datetime.fromisoformat,
        default=datetime.now(timezone.utc).replace(tzinfo=None),
        help="pass the same value to repeat a run",
    )
    parser.add_argument(
        "--no-business-rules",
        dest="business_rules",
        action="store_false",
        help="land applications without outcome or credit as clean rows",
    )
    parser.add_argument("--salt", help="text mixed into masked values")
    parser.add_argument("--input-bytes", type=int, default=0, help="sizes the shuffles")
    parser.add_argument("--cores", type=int, default=8, help="cores of the cluster")
    args = parser.parse_args(argv)
    if args.stage in ("land", "day") and not args.landing:
        parser.error(f"{args.stage} needs --landing")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> object:
    lake = daily.Lake(args.lake)
    if args.stage == "land":
        if args.table is None:
            landed = daily.land(
                spark, args.landing, lake, args.date, args.run_ts, args.env, args.business_rules
            )
        else:
            spec = SOURCES[args.table]
            rules = business_rules(spec) if args.business_rules else {}
            landed = {
                args.table: landing.ingest(
                    spark,
                    spec,
                    args.landing,
                    lake.bronze,
                    args.date,
                    args.run_ts,
                    env=args.env,
                    rules=rules,
                )
            }
        for result in landed.values():
            log.info("%s", result)
        return landed
    if args.stage == "bronze-gate":
        return q.gate(daily.bronze_gate(spark, lake, args.date))
    if args.stage == "refine":
        if args.table is None:
            return daily.refine(spark, lake, args.date, args.salt)
        return run_silver(
            spark, SOURCES[args.table], lake.bronze, lake.silver, args.date, args.salt
        )
    if args.stage == "silver-gate":
        return q.gate(daily.silver_gate(spark, lake))
    if args.stage == "model":
        return daily.model(spark, lake, args.run_ts)
    if args.stage == "gold-gate":
        return q.gate(daily.gold_gate(spark, daily.stored_marts(spark, lake, args.run_ts)))
    if args.stage == "summary":
        return daily.summarise(
            spark, lake, daily.stored_marts(spark, lake, args.run_ts), args.run_ts
        )
    return daily.run_day(
        spark,
        args.landing,
        lake,
        args.date,
        args.run_ts,
        args.env,
        args.business_rules,
        salt=args.salt,
    )


def main() -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    args = parse()
    builder = SparkSession.builder.appName(f"lendscape {args.stage}")
    spark = tune(builder, args.input_bytes, args.cores).getOrCreate()
    run(spark, args)
    spark.stop()


if __name__ == "__main__":
    main()
