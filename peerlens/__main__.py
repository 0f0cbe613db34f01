"""Command line: run the stages over a run root, or take new pages from a landing folder.

    python -m peerlens run --program-a LANDING --program-b FILE --root ROOT [--year 2022]
                           [--stage bronze --stage silver ...] [--register]
    python -m peerlens run --fixtures /root/testdata/sf0.1 --root ROOT --year 1998
    python -m peerlens run --feed-url URL --program-b FILE --root ROOT
    python -m peerlens reload-months --program-b FILE --month 2022-03 --root ROOT [--year 2022]
    python -m peerlens stream-pages --landing LANDING --target DIR --checkpoint DIR

Program A is a landing folder of page files (``--program-a-format pages``,
the default), a paged HTTP feed that the tasks fetch (``--feed-url``) or a table (``parquet``); program B is any file Spark reads.
``reload-months`` brings a finished run up to date after months of program B came again.
"""

from __future__ import annotations

import argparse
import json

from peerlens.plans.stages import STAGES, reload_months, run_stages
from peerlens.session import session_for_job
from peerlens.sources.fixtures import program_a_raw, program_b_raw
from peerlens.sources.paged import http_fetch, read_paged
from peerlens.sources.pages import landed_pages, page_audit, read_page_files, require_complete
from peerlens.sources.tables import read_source, with_audit
from peerlens.streaming.pages import stream_page_files
from peerlens import schemas as S


def _run(args: argparse.Namespace) -> None:
    spark = session_for_job(app_name="peerlens-run")
    stages = tuple(args.stage or STAGES)
    raw_a = raw_b = None
    if "bronze" in stages:
        if args.fixtures:
            raw_a, raw_b = program_a_raw(spark, args.fixtures), program_b_raw(spark, args.fixtures)
        else:
            if args.feed_url:
                raw_a = read_paged(spark, http_fetch(args.feed_url))
            elif args.program_a_format == "pages":
                raw_a = read_page_files(spark, args.program_a, multi_line=args.multi_line)
                require_complete(page_audit(raw_a, landed=landed_pages(spark, args.program_a)), args.allow_open_end)
            else:
                raw_a = with_audit(read_source(spark, args.program_a, args.program_a_format), S.SOURCE_TAG_A)
            raw_b = with_audit(read_source(spark, args.program_b, args.program_b_format), S.SOURCE_TAG_B)
    result = run_stages(
        spark, raw_a, raw_b, snapshot_year=args.year, root=args.root, register=args.register, echo=True, stages=stages, compact=args.compact
    )
    print(json.dumps({"root": result.root, "row_counts": result.row_counts, "seconds": result.seconds}))
    for name, df in result.reports.items():
        print(f"\n== {name}")
        df.show(1000, truncate=False)  # reports are 50 rows or one per state
    spark.stop()


def _reload(args: argparse.Namespace) -> None:
    spark = session_for_job(app_name="peerlens-reload")
    raw_b = program_b_raw(spark, args.fixtures) if args.fixtures else with_audit(read_source(spark, args.program_b, args.program_b_format), S.SOURCE_TAG_B)
    result = reload_months(spark, raw_b, args.month, args.root, snapshot_year=args.year, register=args.register, echo=True)
    print(json.dumps({"root": result.root, "row_counts": result.row_counts, "seconds": result.seconds}))
    spark.stop()


def _stream(args: argparse.Namespace) -> None:
    spark = session_for_job(app_name="peerlens-stream")
    rows = stream_page_files(spark, args.landing, args.target, args.checkpoint, max_files_per_trigger=args.max_files, multi_line=args.multi_line)
    print(json.dumps({"rows_taken": rows}))
    spark.stop()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="peerlens")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run stages bronze -> silver -> quality -> gold -> reports")
    run.add_argument("--program-a", help="landing folder of program A pages (or a table path)")
    run.add_argument("--feed-url", help="paged JSON endpoint of program A, fetched by the tasks")
    run.add_argument("--program-a-format", default="pages", help="pages | parquet | json | ...")
    run.add_argument("--multi-line", action="store_true", help="a page file is one JSON array")
    run.add_argument("--allow-open-end", action="store_true", help="accept a feed whose last page is full")
    run.add_argument("--program-b", help="program B file or folder")
    run.add_argument("--program-b-format", default="parquet")
    run.add_argument("--fixtures", help="derive both inputs from a folder of the star-schema tables instead")
    run.add_argument("--root", help="run root (default: a folder under spark.checkpoint.dir)")
    run.add_argument("--year", type=int, default=S.DEFAULT_SNAPSHOT_YEAR)
    run.add_argument("--stage", action="append", choices=STAGES, help="repeat to pick stages; default all")
    run.add_argument("--compact", action="store_true", help="compact bronze and gold after their writes")
    run.add_argument("--register", action="store_true", help="register gold tables as gold.<name>")
    run.set_defaults(func=_run)
    again = sub.add_parser("reload-months", help="take months of program B anew into a finished run")
    again.add_argument("--program-b", help="program B file or folder that holds the months")
    again.add_argument("--program-b-format", default="parquet")
    again.add_argument("--fixtures", help="derive program B from a folder of the star-schema tables instead")
    again.add_argument("--month", action="append", required=True, help="YYYY-MM; repeat for several")
    again.add_argument("--root", required=True)
    again.add_argument("--year", type=int, default=S.DEFAULT_SNAPSHOT_YEAR)
    again.add_argument("--register", action="store_true", help="register gold tables as gold.<name>")
    again.set_defaults(func=_reload)
    stream = sub.add_parser("stream-pages", help="take newly landed pages (availableNow) into a bronze folder")
    stream.add_argument("--landing", required=True)
    stream.add_argument("--target", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--multi-line", action="store_true", help="a page file is one JSON array")
    stream.add_argument("--max-files", type=int, default=None)
    stream.set_defaults(func=_stream)
    args = parser.parse_args(argv)
    args.func(args)


if __name__ == "__main__":
    main()
