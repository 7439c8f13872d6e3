"""python -m tilewright batch|query|plan: batches over manifests, registered queries, component plans."""

from __future__ import annotations

import argparse
import json
import logging

from tilewright.plans.components import COMPONENTS, plan
from tilewright.plans.config import Config


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tilewright", description=__doc__)
    p.add_argument("--quiet", action="store_true")
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("batch", help="jobs of a manifest: what would run, or their summary")
    b.add_argument("manifest")
    b.add_argument("--outcomes", required=True, help="table of outcomes so far")
    b.add_argument("--config", action="append", default=[])
    b.add_argument("--columns", default="stain,bank")
    b.add_argument("--retry-failed", action="store_true")
    b.add_argument("--force", action="store_true")
    q = sub.add_parser("query", help="a registered query over a folder of tables")
    q.add_argument("name")
    q.add_argument("tables")
    q.add_argument("--explain", action="store_true")
    c = sub.add_parser("plan", help="what a selection of components needs and makes")
    c.add_argument("--components", default=",".join(COMPONENTS))
    c.add_argument("--supplied", default="")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.WARNING if args.quiet else logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    if args.command == "plan":
        split = lambda s: {x for x in s.split(",") if x}
        made = plan(split(args.components), supplied=split(args.supplied))
        print(json.dumps(made.__dict__, indent=2))
        return 0 if made.valid else 2
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("tilewright").getOrCreate()
    if args.command == "query":
        from tilewright.plans.catalog import QUERIES

        df = QUERIES[args.name](spark, args.tables)
        df.explain("formatted") if args.explain else df.show(truncate=False)
        return 0
    from tilewright.operators import batch
    from tilewright.plans import workflow
    from tilewright.sources import records

    todo = workflow.jobs(records.manifest(spark, args.manifest), args.columns.split(","), Config.load(*args.config))
    latest = batch.latest_runs(workflow.outcomes(spark, args.outcomes))
    decided = batch.resume(todo, latest, retry_failed=args.retry_failed, force=args.force)
    decided.groupBy("action").count().show()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
