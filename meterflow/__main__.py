"""Command line: build the layers, run SQL reports over them.

    python -m meterflow build --sf-dir /root/testdata/sf0.01 --root /shared/cdr
    python -m meterflow build --landing /landing/cdr --dated --control /landing/control --root /shared/cdr
    python -m meterflow reconcile --root /shared/cdr
    python -m meterflow sql --root /shared/cdr --file reports.sql

``sql`` registers the layer tables as views under their table names and runs
each ``;``-terminated statement of the file. ``--out`` writes every whole result as
Parquet (one folder per statement); without it the first rows are shown, with a note
if there are more.

The session is the platform's (master and tuning come from the submit command);
``--local N`` makes a local one.
"""

from __future__ import annotations

import argparse
import re

from meterflow.session import cluster_session, local_session

# What a ``;`` may stand in without ending a statement: strings, quoted names, comments.
_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;", re.S)


def _statements(text: str) -> list[str]:
    out, at, kept = [], 0, ""
    for m in _QUOTED.finditer(text + ";"):
        kept += text[at : m.start()]
        at = m.end()
        if m[0] == ";":
            out.append(kept.strip())
            kept = ""
        elif not m[0].startswith(("--", "/*")):
            kept += m[0]
    return [s for s in out if s]


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="meterflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="write all layer tables")
    b.add_argument("--root", required=True)
    src = b.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="build bronze from the driver's events table (test fixture)")
    src.add_argument("--landing", help="raw CDR files (CSV with header)")
    b.add_argument("--dated", action="store_true", help="landing is laid out as source/yyyy/mm/dd")
    b.add_argument("--control", help="the senders' announcements (CSV with header: batch keys, expected_record_count ...)")
    b.add_argument("--replay", action="store_true", help="replace only the batches present in the input")
    r = sub.add_parser("reconcile", help="re-run batch reconciliation over the written tables")
    r.add_argument("--root", required=True)
    s = sub.add_parser("sql", help="run a SQL file over the layer tables")
    s.add_argument("--root", required=True)
    s.add_argument("--file", required=True)
    s.add_argument("--rows", type=int, default=50, help="rows to show of each result without --out")
    s.add_argument("--out", help="folder that every whole result is written to")
    for p in (b, r, s):
        p.add_argument("--local", metavar="N", help="run on N local cores (* for all) instead of the platform's session")
    args = ap.parse_args(argv)
    spark = local_session(args.local) if args.local else cluster_session()

    if args.cmd == "build":
        from meterflow.plans.layers import write_layers
        from meterflow.plans.layerset import LayerSet

        if args.sf_dir:
            ls = LayerSet.from_fixture(spark, args.sf_dir)
            write_layers(ls.bronze, ls.metadata, args.root, as_of=ls.as_of, replay=args.replay)
        else:
            from meterflow.plans.layers import build_from_landing
            from meterflow.sources.landing import read_control

            control = read_control(spark, args.control) if args.control else None
            build_from_landing(spark, args.landing, args.root, dated=args.dated, replay=args.replay, control=control)
    elif args.cmd == "reconcile":
        from meterflow.plans.layers import reconcile_layers

        reconcile_layers(spark, args.root)
    else:
        from meterflow.sources.tables import register_views

        register_views(spark, args.root)
        with open(args.file) as fh:
            for k, stmt in enumerate(_statements(fh.read()), 1):
                print(f"-- {stmt.splitlines()[0][:100]}")
                result = spark.sql(stmt)
                if args.out:
                    result.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{k:03d}")
                    continue
                result.show(args.rows, truncate=False)
                if result.offset(args.rows).limit(1).count():
                    print(f"-- more than {args.rows} rows; --out writes them all")


if __name__ == "__main__":
    main()
