"""Command line over a lake of bronze, silver and gold folders."""

from __future__ import annotations

import argparse
import os
from datetime import date, timedelta

from .plans import gold, retention, runs, serving, silver
from .plans.registry import DATASETS
from .session import get_session
from .sources import tables


def _days(first: date, last: date):
    while first <= last:
        yield first
        first += timedelta(days=1)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wattmill", description=__doc__)
    p.add_argument("--root", default=os.environ.get("WATTMILL_ROOT", "lake"))
    sub = p.add_subparsers(dest="verb", required=True)
    day = date.fromisoformat
    for verb in ("transform", "backfill", "pipeline"):
        s = sub.add_parser(verb)
        s.add_argument("source")
        s.add_argument("dataset", nargs="?")
        s.add_argument("--start", type=day, required=True)
        s.add_argument("--end", type=day)
    s = sub.add_parser("ingest", help="land a file that was fetched elsewhere")
    for a in ("source", "dataset", "file"):
        s.add_argument(a)
    s.add_argument("--day", type=day, required=True)
    s = sub.add_parser("build")
    s.add_argument("name", choices=["system_marginal_price"])
    s.add_argument("--start", type=day, required=True)
    s.add_argument("--end", type=day, required=True)
    s = sub.add_parser("export-csv")
    s.add_argument("view")
    s.add_argument("out")
    s.add_argument("--start")
    s.add_argument("--end")
    s.add_argument("--limit", type=int)
    sub.add_parser("status")
    sub.add_parser("quality")
    s = sub.add_parser("reset")
    s.add_argument("--layer", action="append", default=[])
    s.add_argument("--dataset", action="append", default=[])
    s.add_argument("--apply", action="store_true")
    s = sub.add_parser("prune")
    s.add_argument("--before", type=day, required=True)
    s.add_argument("--layer", action="append", default=[])
    s.add_argument("--apply", action="store_true")
    sub.add_parser("init")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    a = _parser().parse_args(argv)
    at = lambda *parts: os.path.join(a.root, *parts)
    if a.verb == "init":
        for layer in (*retention.LAYERS, "state"):
            os.makedirs(at(layer), exist_ok=True)
        return 0
    if a.verb == "prune":
        print(*retention.prune(a.root, a.before, tuple(a.layer) or ("bronze",), a.apply), sep="\n")
        return 0
    if a.verb == "reset":
        print(*retention.reset(a.root, tuple(a.layer), tuple(a.dataset), a.apply), sep="\n")
        return 0
    if a.verb == "ingest":
        from .sources.bronze import write_raw

        with open(a.file, "rb") as f:
            print(write_raw(at("bronze"), a.source, a.dataset, a.day, f.read(), {}, os.path.splitext(a.file)[1].lstrip(".") or "json"))
        return 0
    spark = spark or get_session()
    log = runs.RunLog(spark, at("state", "runs"))
    if a.verb in ("transform", "backfill", "pipeline"):
        names = [a.dataset] if a.dataset else sorted(n for s, n in DATASETS if s == a.source)
        bad = 0
        for name in names:
            last = a.end or a.start
            if a.verb == "backfill" and a.end:  # a chunk's end is exclusive
                last -= timedelta(days=1)
            for day in _days(a.start, last):
                run_id, started = log.start(a.source, name)
                try:
                    done = silver.execute(spark, at("bronze"), at("silver"), a.source, name, day, run_id)
                    bad += done.status == "failed"
                    log.finish(run_id, a.source, name, started, done.status, done.written, done.message)
                except Exception as e:  # a day that fails leaves the others alone
                    bad += 1
                    log.finish(run_id, a.source, name, started, "failed", 0, str(e)[:500])
        if a.verb == "pipeline" and a.source == "elexon":
            tables.write_gold(gold.system_marginal_price(spark, at("silver"), a.start, a.end or a.start), at("gold", "system_marginal_price"))
        return int(bad > 0)
    if a.verb == "build":
        print(tables.write_gold(gold.system_marginal_price(spark, at("silver"), a.start, a.end), at("gold", a.name)))
    elif a.verb == "export-csv":
        with serving.Client(spark, at("silver")):
            tables.export_csv(spark.table(a.view), a.out, a.start, a.end, a.limit)
    elif a.verb == "status":
        log.recent().show(20, False)
    else:
        report = serving.quality_sweep(spark, at("silver")).cache()
        runs.write_report(report, at("state", "quality"), "sweep")
        report.show(200, False)
        return int(report.filter("not passed").count() > 0)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
