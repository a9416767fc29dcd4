"""Command line: ``index`` builds store and index of a snapshot, ``diff`` runs change files through the loop."""

from __future__ import annotations

import argparse

from .session import session
from .sources.store import read_snapshot
from .streaming.loop import Loop


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="terraloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    index = sub.add_parser("index", help="build the store and the dependency index of an ORC snapshot")
    index.add_argument("--snapshot", required=True)
    index.add_argument("--root", required=True)
    diff = sub.add_parser("diff", help="publish the augmented difference of numbered change files")
    diff.add_argument("--changes", required=True, help="path template with AAA/BBB/CCC")
    diff.add_argument("--root", required=True)
    diff.add_argument("--range", required=True, help="START,END; END -1 never ends")
    diff.add_argument("--compact-every", type=int, default=5)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = session("terraloom")
    if args.command == "index":
        Loop(spark, args.root).create(read_snapshot(spark, args.snapshot))
    else:
        start, end = map(int, args.range.split(","))
        Loop(spark, args.root, args.compact_every).run(args.changes, start, end)


if __name__ == "__main__":
    main()
