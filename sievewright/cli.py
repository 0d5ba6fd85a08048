"""Command line: check settings, ingest sources, report on a ledger.

Exit codes: 0 done, 1 failed, 2 wrong use or settings, 130 interrupted.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from sievewright.config import ConfigError, load


def _positive(text: str) -> int:
    if not text.isdigit() or int(text) < 1:
        raise argparse.ArgumentTypeError("a positive whole number is needed")
    return int(text)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sievewright")
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("plan", help="check settings and ingest the sources of a run")
    run.add_argument("n", nargs="?", type=_positive)
    run.add_argument("--target-count", type=_positive)
    run.add_argument("--config", required=True)
    run.add_argument("--input")
    run.add_argument("--image")
    run.add_argument("--prompt")
    run.add_argument("--workers")
    run.add_argument("--resume", action="store_true")
    report = commands.add_parser("report", help="outcomes and costs of a ledger")
    report.add_argument("ledger")
    return top


def wrong_use(args: argparse.Namespace) -> str | None:
    if args.command != "plan":
        return None
    if args.n is not None and args.target_count is not None:
        return "give N or --target-count, not both"
    if args.resume and any(v is not None for v in (args.n, args.target_count, args.prompt, args.image)):
        return "a resumed run keeps its N, prompt and image"
    return None


def _overrides(args: argparse.Namespace) -> dict:
    return {
        "run": {"target_count": args.n if args.n is not None else args.target_count},
        "dataset": {"input_dir": args.input, "image": args.image},
        "generation": {"augmentation_prompt": args.prompt},
        "execution": {"selected_gpu_ids": args.workers},
    }


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if message := wrong_use(args):
        print(message, file=sys.stderr)
        return 2
    try:
        if args.command == "plan":
            cfg = load(args.config, _overrides(args))
            from sievewright.operators.ingest import ingest, manifest_sources
            from sievewright.session import session
            from sievewright.sources import readers

            spark = session()
            data = cfg["dataset"]
            if data.get("manifest"):
                rows = manifest_sources(readers.manifest(spark, data["manifest"]), readers.images(spark, f"file://{data['root']}"))
            else:
                rows = readers.images(spark, data["input_dir"], data.get("image"))
                for name in ("split", "group_id", "preserve_hint"):
                    rows = rows.selectExpr("*", f"cast(null as string) as {name}")
            kept, dropped = ingest(rows)
            summary = {"sources": kept.count(), "duplicates": dropped.count()}
        else:
            from pyspark.sql import functions as F

            from sievewright.operators import reporting
            from sievewright.session import session
            from sievewright.sources import readers

            ledger = readers.ledger(session(), args.ledger)
            cost = reporting.mean_cost(ledger, "attempt_elapsed_seconds").first().asDict()
            summary = {"outcomes": {r["outcome"]: r["n"] for r in reporting.outcome_counts(ledger).collect()}, **cost, "cleanup_pending": ledger.where(F.col("cleanup_state") == "pending").count()}
        print(json.dumps(summary, sort_keys=True))
        return 0
    except ConfigError as e:
        print(e, file=sys.stderr)
        return 2
    except KeyboardInterrupt:
        return 130
    except Exception as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
