"""Command line: ``spark-submit`` or ``python -m widerow COMMAND OPTIONS IN OUT``.

Loads read text and append to a cell table, dumps read a cell table and write text,
the prepare commands read and write text. With ``--batch`` a load writes its cells and
rejects as one batch, and ``merge`` brings a base up to date with batches.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    DEFAULT_NAMES,
    FamilySpec,
    LoadResult,
    append_cells,
    compact,
    discard,
    dump_column_names,
    dump_map,
    dump_super_map,
    dump_table,
    load_columns,
    load_key_value,
    load_map,
    load_super_map,
    load_super_pairs,
    load_table,
    map_pieces,
    map_prepare,
    name_pieces,
    open_base,
    prepared_pieces,
    read_lines,
    scan_batches,
    scan_cells,
    scan_rejects,
    split_records,
    super_map_prepare,
    write_batch,
    write_lines,
    write_pieces,
)
from .functions import tab_line

LOADS = ["table", "columns", "map", "super-map", "super-pairs", "key-value"]
DUMPS = ["table", "columns", "map", "super-map"]
PREPARES = ["map", "super-map"]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="widerow")
    commands = top.add_subparsers(dest="command", required=True)

    family = argparse.ArgumentParser(add_help=False)
    family.add_argument("--ks", default="Keyspace1", help="keyspace")
    family.add_argument("--cf", default="Standard1", help="column family")
    family.add_argument("--longnames", action="store_true", help="names are longs")
    family.add_argument("--super", action="store_true", help="a super family")
    family.add_argument(
        "--col-names",
        type=lambda text: text.split(","),
        default=DEFAULT_NAMES,
        help="names of the fields in their order, with commas between",
    )
    output = argparse.ArgumentParser(add_help=False)
    output.add_argument("--rm", action="store_true", help="overwrite the output")

    for kind in LOADS:
        load = commands.add_parser(f"load-{kind}", parents=[family])
        load.add_argument("--key-field", type=int, default=0, help="field of the row key")
        load.add_argument("--ts-field", type=int, help="field of the timestamp")
        load.add_argument("--fill-value", default="0", help="value of a column load")
        load.add_argument("--on-bad-ts", choices=["now", "reject"], default="now")
        load.add_argument("--wide", action="store_true", help="wide table layout, '-' skips")
        load.add_argument("--failfast", action="store_true", help="stop at a bad record")
        load.add_argument("--dry-run", action="store_true", help="count, store nothing")
        load.add_argument("--batch", help="write a batch of this name, rejects included")
        load.add_argument("--rejects", help="write reason, key, super, name and line here")
        load.add_argument("input")
        load.add_argument("table")
    for kind in DUMPS:
        dump = commands.add_parser(f"dump-{kind}", parents=[family, output])
        dump.add_argument("--compacted", action="store_true", help="the table is compacted")
        dump.add_argument("--base", action="store_true", help="the table is a base")
        if kind in ("columns", "map"):
            dump.add_argument("--any-size", action="store_true", help="rows of any size")
        dump.add_argument("--max-super", type=int, help="supers per row to keep")
        dump.add_argument("--pieces", type=int, default=1, help="lines a row is dealt over")
        dump.add_argument("table")
        dump.add_argument("output")
    for kind in PREPARES:
        prepare = commands.add_parser(f"prepare-{kind}", parents=[output])
        prepare.add_argument("--pieces", type=int, default=1, help="lines a row is dealt over")
        prepare.add_argument("--any-size", action="store_true", help="rows of any size")
        prepare.add_argument("--rejects", help="write rejected lines here")
        prepare.add_argument("input")
        prepare.add_argument("output")
    compaction = commands.add_parser("compact")
    compaction.add_argument("table")
    compaction.add_argument("output")
    compaction.add_argument("--by-name", action="store_true", help="lay cells out by name")
    merge = commands.add_parser("merge")
    merge.add_argument("--first", help="first batch")
    merge.add_argument("--last", help="last batch")
    merge.add_argument("--buckets", type=int, help="buckets of a new base")
    merge.add_argument("batches")
    merge.add_argument("base")
    return top


def load(spark: SparkSession, kind: str, args: argparse.Namespace) -> dict[str, int]:
    spec = FamilySpec(args.ks, args.cf, args.longnames, kind.startswith("super"))
    lines = read_lines(spark, args.input)
    options = {"mode": "failfast" if args.failfast else "permissive", "count": True}
    result: LoadResult
    if kind == "table":
        wide = {
            "skip_name": "-",
            "collapse_tabs": True,
            "keep_key": True,
            "drop_missing_key": True,
        }
        result = load_table(
            lines,
            spec,
            args.col_names,
            key_field=args.key_field,
            ts_field=args.ts_field,
            on_bad_ts=args.on_bad_ts,
            **(wide if args.wide else {}),
            **options,
        )
    elif kind == "columns":
        result = load_columns(lines, spec, args.key_field, args.fill_value, **options)
    else:
        loader = {
            "map": load_map,
            "super-map": load_super_map,
            "super-pairs": load_super_pairs,
            "key-value": load_key_value,
        }[kind]
        result = loader(lines, spec, **options)
    rejects = result.rejects
    if args.dry_run:
        discard(result.cells)
        counters = result.counters()
    elif args.batch:
        counters = write_batch(result, args.table, args.batch)
        rejects = scan_rejects(spark, args.table, args.batch, args.batch)
    else:
        append_cells(result.cells, args.table)
        counters = result.counters()
    if args.rejects and counters["bad"]:
        columns = ("reason", "row_key", "super", "name", "line")
        bad = rejects.select(tab_line(*map(F.col, columns)).alias("value"))
        write_lines(bad, args.rejects)
    return counters


def dump(spark: SparkSession, kind: str, args: argparse.Namespace) -> None:
    spec = FamilySpec(
        args.ks, args.cf, args.longnames, args.super or kind == "super-map"
    )
    cells = (
        open_base(spark, args.table).scan(spec)
        if args.base
        else scan_cells(spark, args.table, spec)
    )
    done = {"reconciled": args.compacted or args.base}
    lines: DataFrame
    if kind in ("columns", "map") and args.any_size:
        pieces = name_pieces if kind == "columns" else map_pieces
        write_pieces(pieces(cells, spec, **done), args.output, overwrite=args.rm)
        return
    if kind == "table":
        lines = dump_table(cells, spec, args.col_names, **done)
    elif kind == "columns":
        lines = dump_column_names(cells, spec, pieces=args.pieces, bucketed=args.base, **done)
    elif kind == "map":
        lines = dump_map(cells, spec, pieces=args.pieces, bucketed=args.base, **done)
    else:
        lines = dump_super_map(cells, spec, args.max_super, **done)
    write_lines(lines, args.output, overwrite=args.rm)


def prepare(spark: SparkSession, kind: str, args: argparse.Namespace) -> dict[str, int]:
    lines = read_lines(spark, args.input)
    names = ["row_key", *(["super"] if kind == "super-map" else []), "name", "value"]
    records, rejects = split_records(lines, *names)
    if args.any_size:
        pieces = prepared_pieces(records, super="super" if kind == "super-map" else None)
        write_pieces(pieces, args.output, overwrite=args.rm)
    else:
        make = super_map_prepare if kind == "super-map" else map_prepare
        prepared = make(records, pieces=args.pieces)
        out = prepared.select(tab_line(prepared["row_key"], prepared["json"]).alias("value"))
        write_lines(out, args.output, overwrite=args.rm)
    # Reads the lines again, without a shuffle: counters within a plan that shuffles
    # would count tasks that run twice.
    bad = rejects.count()
    if args.rejects and bad:
        write_lines(rejects.select(tab_line(F.col("reason"), F.col("line")).alias("value")), args.rejects)
    return {"bad": bad}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"widerow {args.command}").getOrCreate()
    action, _, kind = args.command.partition("-")
    if action in ("load", "prepare"):
        counters = (load if action == "load" else prepare)(spark, kind, args)
        print(" ".join(f"{name}={n}" for name, n in counters.items()), file=sys.stderr)
    elif action == "dump":
        dump(spark, kind, args)
    elif action == "merge":
        deltas = scan_batches(spark, args.batches, first=args.first, last=args.last)
        n = open_base(spark, args.base, args.buckets).merge(deltas)
        print(f"buckets={n}", file=sys.stderr)
    else:
        compact(spark, args.table, args.output, by_name=args.by_name)


if __name__ == "__main__":
    main()
