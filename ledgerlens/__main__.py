"""Run all steps or one step:  spark-submit ... -m ledgerlens SOURCE WORK [--step N] [--trials N] [--space wide]"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ledgerlens.plans.runner import STEPS, Settings, run_all, run_step, run_summary


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerlens")
    parser.add_argument("source", help="CSV file or folder of transactions")
    parser.add_argument("work", help="folder for the stage tables, reachable from every executor")
    parser.add_argument("--step", type=int, choices=range(1, len(STEPS) + 1), help="run only this step, from the saved tables")
    parser.add_argument("--trials", type=int, help="number of search trials")
    parser.add_argument("--minutes", type=float, help="time limit of the search")
    parser.add_argument("--space", choices=["narrow", "wide"], default="narrow")
    parser.add_argument("--rounds", type=int, help="most boosting rounds per fit; without it patience alone ends a fit")
    args = parser.parse_args(argv)
    settings = Settings(n_trials=args.trials, timeout_minutes=args.minutes, space=args.space, max_iter=args.rounds)
    spark = SparkSession.builder.appName("ledgerlens").getOrCreate()
    if args.step:
        record = run_step(spark, args.step, args.source, args.work, settings)
        print(record)
        return 0 if record["success"] else 1
    log = run_all(spark, args.source, args.work, settings)
    log.orderBy("step").show(truncate=False)
    summary = run_summary(log)
    summary.show(truncate=False)
    return 0 if summary.first()["failures"] == 0 else 1


if __name__ == "__main__":
    sys.exit(main())
