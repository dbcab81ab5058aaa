"""Command line: one vendor run, or the drop-folder stream.

    python -m taxorule run --store <root> --match <file> --vendor <name> [--json-lines] [--export-json]
                           [--import-stable <json>] [--import-reference <json>] [--lenient-reference]
    python -m taxorule stream --store <root> --drop <folder> --checkpoint <folder> [--continuous]
"""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict

from .config import Thresholds
from .session import build_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="taxorule")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="one vendor delivery")
    run.add_argument("--store", required=True)
    run.add_argument("--match", required=True, nargs="+")
    run.add_argument("--vendor", required=True)
    run.add_argument("--run-ts")
    run.add_argument("--json-lines", action="store_true")
    run.add_argument("--export-json", action="store_true")
    run.add_argument("--import-stable", help="JSON file of an existing stable dataset, for an empty store")
    run.add_argument("--import-reference", help="JSON file of an existing mapping reference, for an empty store")
    run.add_argument("--lenient-reference", action="store_true", help="read an unreadable reference as empty")
    st = sub.add_parser("stream", help="one run per file dropped into a folder")
    st.add_argument("--store", required=True)
    st.add_argument("--drop", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--continuous", action="store_true")
    for p in (run, st):
        for f in Thresholds.__dataclass_fields__:
            p.add_argument("--" + f.replace("_", "-"), type=int, default=getattr(Thresholds(), f))
    args = ap.parse_args(argv)
    th = Thresholds(**{f: getattr(args, f) for f in Thresholds.__dataclass_fields__})
    spark = build_session()
    if args.cmd == "run":
        from .plans.pipeline import import_files, run_vendor
        import_files(spark, args.store, args.import_stable, args.import_reference, args.lenient_reference)
        res = run_vendor(spark, args.store, args.match, args.vendor, th, run_ts=args.run_ts,
                         json_lines=args.json_lines, export_json=args.export_json)
        print(json.dumps(asdict(res)))
    else:
        from .streaming.vendor_drop import start_vendor_drop_stream
        q = start_vendor_drop_stream(spark, args.drop, args.store, args.checkpoint, th,
                                     available_now=not args.continuous)
        q.awaitTermination()


if __name__ == "__main__":
    main()
