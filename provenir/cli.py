"""Command line: sources, discover, collect, run weekly, validate, export, review export, stats."""

from __future__ import annotations

import argparse
import json
import os
import sys
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import functions as F

from .plans import ingest
from .session import session
from .sinks import export as exports
from .sinks.archive import choose_store
from .sinks.progress import Progress
from .sinks.store import Store
from .sources import catalog
from .sources.http import Fetcher
from .operators.quality import validate


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="provenir")
    p.add_argument("--data", default=os.environ.get("PROVENIR_DATA_DIR", "data"))
    p.add_argument("--sources", default=os.environ.get("PROVENIR_SOURCES_DIR", "config/sources"))
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("sources").add_subparsers(dest="action", required=True)
    s.add_parser("list"), s.add_parser("check")
    for name in ("discover", "collect"):
        c = sub.add_parser(name)
        c.add_argument("--source", required=True)
        c.add_argument("--dry-run", action="store_true")
        c.add_argument("--resume", action="store_true")
        c.add_argument("--run-id")
    weekly = sub.add_parser("run").add_subparsers(dest="action", required=True).add_parser("weekly")
    weekly.add_argument("--dry-run", action="store_true")
    weekly.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True)
    weekly.add_argument("--bootstrap", default=os.environ.get("PROVENIR_BOOTSTRAP_DIR", "data/current"), help="public CSV export that empty tables start from")
    sub.add_parser("validate").add_argument("--release", action="store_true")
    e = sub.add_parser("export")
    e.add_argument("--format", choices=exports.FORMATS, default="csv")
    e.add_argument("--output", default="data/current")
    r = sub.add_parser("review").add_subparsers(dest="action", required=True).add_parser("export")
    r.add_argument("--output", default="data/reports/review_queue")
    sub.add_parser("stats")
    return p


def main(argv: list[str] | None = None, collect=None) -> int:
    args = _parser().parse_args(argv)
    sources = catalog.load(args.sources)
    if args.command == "sources":
        if args.action == "check":
            errors = catalog.check(sources)
            print("\n".join(errors) or "ok")
            return int(bool(errors))
        for s in sources.values():
            print(f"{s.id}\t{'enabled' if s.enabled else 'disabled'}\t{s.access_mode}\t{s.name}")
        return 0
    spark = session()
    store, report = Store(spark, f"{args.data}/tables"), Progress(Path(args.data) / "logs", args.command)
    if collect is None:
        from .sources.collect import collect as fetch

        archive = choose_store({"RAW_DIR": f"{args.data}/raw", **os.environ})
        agent = os.environ.get("PROVENIR_USER_AGENT", "provenir/0.1") + (f" ({contact})" if (contact := os.environ.get("PROVENIR_CONTACT")) else "")

        def collect(source):
            fetcher = Fetcher(source.requests_per_minute, agent, report=report)
            run = getattr(args, "run_id", None) or ingest.run_id(source.id, datetime.now(UTC))
            return fetch(spark, source, fetcher, dict(os.environ), None if getattr(args, "dry_run", False) else archive, run, report)

    if args.command in ("discover", "collect"):
        print(json.dumps(ingest.run_source(store, sources[args.source], collect, args.dry_run, args.resume, args.run_id, report=report)))
    elif args.command == "run":
        if not args.dry_run and Path(args.bootstrap, "companies.csv").exists() and ingest.bootstrap(store, args.bootstrap):
            report("bootstrapped", folder=args.bootstrap)
        try:
            print(json.dumps(ingest.run_weekly(store, sources, collect, report, dry_run=args.dry_run, resume=args.resume)))
        except RuntimeError as e:
            print(e, file=sys.stderr)
            return 1
    elif args.command == "validate":
        issues, metrics = validate(store.tables(), catalog.as_table(spark, sources), catalog.check(sources), args.release)
        out = Path(args.data) / "reports"
        exports.write(issues, str(out / "issues.jsonl"), "jsonl")
        counts = {r["code"]: r["n"] for r in issues.groupBy("code").agg(F.count("*").alias("n")).orderBy("code").collect()}  # one row a rule
        out.mkdir(parents=True, exist_ok=True)
        (out / "validation.json").write_text(json.dumps({"ok": not counts, "errors": counts, "issues": str(out / "issues.jsonl"), "warnings": [], "metrics": metrics}, indent=2), encoding="utf-8")
        print(json.dumps({"ok": not counts, "errors": sum(counts.values()), **metrics}))
        return int(bool(counts))
    elif args.command == "export":
        print(json.dumps(exports.export(store.tables(), sources, args.output, args.format)))
    elif args.command == "review":
        print(exports.export_review(store.tables(), args.output))
    else:
        print(json.dumps(ingest.stats(store.tables())))
    return 0


if __name__ == "__main__":
    sys.exit(main())
