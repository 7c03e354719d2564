"""Run a step: ``spark-submit``-able, or ``python -m dropweave <step> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from dropweave.functions.registry import (
    LOCATION_IDS, UPRN_CHILDREN, UPRN_CHUNK, UPRN_PARENT, USRN_CHILDREN, USRN_CHUNK, USRN_PARENT, Registry)
from dropweave.plans import jobs
from dropweave.session import build_session, clear_staging
from dropweave.sources.lines import TEXT_FILES


def _ids(text: str) -> tuple[str, ...]:
    return tuple(part.strip() for part in text.split(",") if part.strip())


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dropweave")
    steps = top.add_subparsers(dest="step", required=True)

    def step(name: str, text: str) -> argparse.ArgumentParser:
        p = steps.add_parser(name, help=text)
        p.add_argument("--input", help="folder of drop files")
        p.add_argument("--output", required=True)
        p.add_argument("--source", default="file", help="what a drop is: file, directory, or a partition column")
        p.add_argument("--glob", default=TEXT_FILES)
        if name != "count":
            p.add_argument("--landed", help="landed table: written when --input is given, else read")
            p.add_argument("--schema", help="YAML file of record types; the standard ones if left out")
            p.add_argument("--no-compact", dest="compact", action="store_false", help="land one file per split and type, without the shuffle that evens them out")
            p.add_argument("--manifest", help="what count has written: only files that hold a line of the step's types are read")
            p.add_argument("--scan-mode", choices=("line", "record"), default="line")
            p.add_argument("--mode", choices=("errorifexists", "overwrite", "ignore"), default="errorifexists")
        return p

    step("count", "count record types per file into a manifest")
    for name, text in (("split", "one output per file and type"), ("merge", "one output per type")):
        p = step(name, text)
        p.add_argument("--types", type=_ids, default=LOCATION_IDS)
        p.add_argument("--include-headers", action="store_true")
        p.add_argument("--trim", choices=("type", "position"), default="type")
        p.add_argument("--rejects")
        if name == "merge":
            p.add_argument("--prefix", default="Records_")
    p = step("sort", "sort types by a field")
    p.add_argument("--types", type=_ids, required=True)
    p.add_argument("--field", default="UPRN")
    p.add_argument("--prefix", default="Records_")
    p.add_argument("--rejects")
    for name, size in (("group-uprn", UPRN_CHUNK), ("group-usrn", USRN_CHUNK)):
        p = step(name, "parents followed by their related records")
        p.add_argument("--chunk-size", type=int, default=size)
        p.add_argument("--rejects")
        if name == "group-usrn":
            p.add_argument("--limit-per-key", type=int)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    embedded = SparkSession.getActiveSession() is not None
    spark = build_session()
    try:
        run(spark, args)
    finally:
        if not embedded:
            clear_staging(spark)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.step == "count":
        if not args.input:
            raise SystemExit("count needs --input")
        jobs.count_all(spark, args.input, args.output, args.source, args.glob)
        return
    registry = Registry.from_yaml(args.schema) if args.schema else Registry.standard()
    if args.input:
        groups = {"group-uprn": (UPRN_PARENT, *UPRN_CHILDREN), "group-usrn": (USRN_PARENT, *USRN_CHILDREN)}
        types = (groups.get(args.step) or args.types) if args.manifest else None
        lines = jobs.prepare(spark, args.input, registry, args.landed, args.scan_mode, args.source, args.glob,
                             args.compact, args.manifest, types)
    elif args.landed:
        lines = jobs.reopen(spark, args.landed, args.scan_mode)
    else:
        raise SystemExit("give --input, --landed or both")
    if args.step == "split":
        jobs.split_all(lines, args.output, registry, args.types, args.include_headers, args.trim, args.mode, args.rejects)
    elif args.step == "merge":
        jobs.merge_all(lines, args.output, registry, args.types, args.prefix, args.include_headers,
                       args.trim, args.mode, args.rejects)
    elif args.step == "sort":
        jobs.sort_records(lines, args.output, registry, args.types, args.field, args.prefix,
                          rejects=args.rejects, mode=args.mode)
    elif args.step == "group-uprn":
        jobs.group_uprn(lines, args.output, registry, args.chunk_size, args.rejects, args.mode)
    else:
        jobs.group_usrn(lines, args.output, registry, args.chunk_size, args.limit_per_key, args.rejects, args.mode)


if __name__ == "__main__":
    main()
