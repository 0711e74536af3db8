"""Command line: `run` (page text of a table of pages) and `manifest` (pages of a gold table).

    python -m quorumtext run --pages pages.parquet --output-dir out [--config c.json] [--engine ensemble] [--force-ocr] [--progress-csv p.csv] [--status-bar]
                             [--validate-only] [--dry-run] [-- --ocr-fallback none ...]
    python -m quorumtext manifest --csv gold.csv --pdf-root folder --out manifest.tsv [--expand-ranges] [--strict]
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from contextlib import nullcontext

from quorumtext.plans.options import EnsembleProfile, PipelineOptions, validate


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="quorumtext")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="page text of a table of pages")
    run.add_argument("-c", "--config")
    run.add_argument("--pages", help="parquet of page_id, pdf_name, page, page_width, layer_text, layer_ok")
    run.add_argument("--lines", help="parquet of recorded lines with a column engine")
    run.add_argument("--input-dir")
    run.add_argument("--input-file")
    run.add_argument("--output-dir")
    run.add_argument("--engine")
    run.add_argument("--profile")
    run.add_argument("--force-ocr", action="store_true")
    run.add_argument("--progress-csv", help="CSV of one row for each page")
    run.add_argument("--status-bar", action="store_true", help="say on stderr how far the output is")
    run.add_argument("--validate-only", action="store_true")
    run.add_argument("--dry-run", action="store_true")
    run.add_argument("passthrough", nargs=argparse.REMAINDER, help="options of page-text (--ocr-fallback paddle|ensemble|none, --inputs, --manifest, --output-root, ..), which count last")
    made = commands.add_parser("manifest", help="pages of a gold table")
    made.add_argument("--csv", required=True)
    made.add_argument("--pdf-root", required=True)
    made.add_argument("--out", required=True)
    made.add_argument("--expand-ranges", action="store_true")
    made.add_argument("--strict", action="store_true")
    return parser.parse_args(argv)


def session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("quorumtext").getOrCreate()


def run(args: argparse.Namespace) -> int:
    if args.validate_only:
        wrong = validate(args.config, args.input_dir, args.input_file)
        print("\n".join(wrong) or "configuration is sound", file=sys.stderr if wrong else sys.stdout)
        return int(bool(wrong))
    try:
        options = PipelineOptions.resolve(args.config, input_dir=args.input_dir, input_file=args.input_file, output_dir=args.output_dir, engine=args.engine, force_ocr=args.force_ocr, profile=args.profile, progress_csv=args.progress_csv, status_bar=args.status_bar, passthrough=tuple(x for k, x in enumerate(args.passthrough) if k or x != "--"))
        settled = options.settled()
    except FileNotFoundError as error:
        print(f"Input file not found: {error}", file=sys.stderr)
        return 1
    except ValueError as error:
        print(error, file=sys.stderr)
        return 2
    if args.dry_run:
        print(options.explain())
        return 0
    options = settled
    if not args.pages:
        print("run needs --pages", file=sys.stderr)
        return 2
    from pyspark.sql import functions as F

    from quorumtext.operators.detect import DetectionProfile
    from quorumtext.plans.extract import page_text
    from quorumtext.sources import engines, sinks

    spark = session()
    sources = {}
    if args.lines:
        lines = spark.read.parquet(args.lines)
        sources = {name: engines.recorded(lines.where(lines["engine"] == name).drop("engine", "engine_ord")) for name in engines.DEFAULT_ENGINES}
    detection = DetectionProfile.from_json(options.profile) if options.profile else DetectionProfile()
    os.makedirs(options.output_root, exist_ok=True)
    began, note = time.time(), (lambda n: print(f"\r{n} pages", end="", file=sys.stderr)) if options.status_bar else None
    with engines.registering(**sources) if sources else nullcontext():
        found = page_text(spark.read.parquet(args.pages), options, EnsembleProfile.load(options.profile), detection).persist()
        n = sinks.write_page_text(found, os.path.join(options.output_root, "client_page_text.csv"), note)
        if options.progress_csv:
            # pages are read together, so each has its share of the time
            timed = found.withColumns({"ms": F.lit(round(1000 * (time.time() - began) / max(n, 1))), "timestamp": F.current_timestamp()})
            sinks.write_progress(timed.orderBy("pdf_name", "page"), options.progress_csv)
        found.unpersist()
    print(f"{n} pages")
    return 0


def manifest(args: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    from quorumtext.operators import manifest as m
    from quorumtext.sources import tables

    for path in (args.csv, args.pdf_root):
        if not os.path.exists(path):
            print(f"nothing at {path}", file=sys.stderr)
            return 1
    spark = session()
    gold = tables.gold_csv(spark, args.csv)
    root = os.path.abspath(args.pdf_root)
    there = spark.createDataFrame([(n,) for n in os.listdir(root)] or [("",)], "pdf_path string")
    rows = m.build_manifest(gold, there, args.expand_ranges, args.strict).toLocalIterator()
    os.makedirs(os.path.dirname(os.path.abspath(args.out)), exist_ok=True)
    n = 0
    with open(args.out, "w", encoding="utf-8", newline="\n") as f:
        for row in rows:
            f.write(f"{os.path.join(root, row.pdf_path)}\t{row.page}\n")
            n += 1
    missing = m.missing_files(gold, there).where(F.col("pdf_path") != "")
    gone = not missing.isEmpty()
    print(f"{n} rows" + ("\n" + m.missing_report(gold, there) if gone else ""), file=sys.stderr if gone else sys.stdout)
    return int(gone and args.strict)


if __name__ == "__main__":
    parsed = arguments()
    sys.exit(run(parsed) if parsed.command == "run" else manifest(parsed))
