"""Command line: ``python -m spindle <command> ...``; every command prints JSON."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

import yaml


def session():
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="spindle", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *args: str, **options: str) -> None:
        own = sub.add_parser(name)
        for a in args:
            own.add_argument(a)
        for o, default in options.items():
            own.add_argument(f"--{o.replace('_', '-')}", default=default, action="store_true" if default is False else "store", **({} if default is False else {"type": type(default) if default is not None else str}))

    command("schemas", "schemas")
    command("show", "schemas", "schema")
    command("validate", "file")
    command("register", "schemas", "file")
    command("extend", "schemas", "schema", "patch", concept=None)
    command("attach", "schemas", "schema", "dataset", catalogue="", eda="", concept=None)
    command("eda", "data", "out")
    command("values", "data", "variable", by=None)
    command("match", "schemas", catalogue=None, eda=None)
    command("describe", "inputs", "name")
    command("synth", "schemas", "schema", "out", visits=200, seed=7)
    command("load", "schemas", "schema", "csv", "warehouse", source=None, force=False, synthetic=False)
    command("check", "schemas", "schema", "source", "warehouse")
    command("run", "schemas", "schema", "warehouse", sources="")
    command("constellation", "schemas", highlight=None, out=None)
    command("query", "warehouse", "sql")
    return p


def run(args: argparse.Namespace):
    from spindle.plans import describe, extend, match, runs
    from spindle.plans.registry import Registry, constellation, markdown, svg
    from spindle.plans.spec import load
    from spindle.sources import dictionary, staging
    from spindle.sources.warehouse import Warehouse

    registry = Registry(args.schemas) if hasattr(args, "schemas") else None
    concept = yaml.safe_load(Path(args.concept).read_text()) if getattr(args, "concept", None) else None
    variables = lambda: dictionary.merge_sources(
        dictionary.load_eda(args.eda) if args.eda else None, dictionary.load_dictionary(args.catalogue) if args.catalogue else None
    )
    match args.command:
        case "schemas":
            return registry.list()
        case "show":
            return registry.get(args.schema).to_dict()
        case "validate":
            return {"valid": True, "schema_id": load(Path(args.file)).schema_id}
        case "register":
            return {"registered": registry.register(args.file).schema_id}
        case "extend":
            patch = yaml.safe_load(Path(args.patch).read_text())
            return {"changelog": extend.extend(args.schema, patch, registry, concept).changelog}
        case "attach":
            extend.require_placement(concept, args.schema, "attach to")
            schema = registry.get(args.schema)
            fed = extend.attach_dataset(schema, args.dataset, variables(), args.catalogue, args.eda)
            registry.save(schema)
            return {"columns": fed}
        case "match":
            return match.match_all(variables(), registry.all(), registry.config()["new_schema_min_difference"])
        case "constellation":
            view = constellation(registry, args.highlight)
            if args.out:
                Path(args.out).write_text((svg if args.out.endswith(".svg") else markdown)(view), encoding="utf-8")
            return view
    spark = session()
    house = Warehouse(spark, args.warehouse) if hasattr(args, "warehouse") else None
    match args.command:
        case "eda":
            from spindle.operators.profile import profile

            eda = profile(staging.read_typed(spark, args.data), max_categories=50)
            dictionary.write_eda(eda, args.out)
            return {"rows": eda["rows"], "variables": len(eda["variables"])}
        case "values":
            from spindle.operators.vocabulary import label_counts

            entries = staging.data_entries(args.data) if Path(args.data).is_dir() else [args.data]
            return [r.asDict() for r in label_counts([staging.read_entry(spark, e) for e in entries], args.variable, args.by).collect()]
        case "describe":
            return describe.describe(spark, args.inputs, args.name)
        case "synth":
            from spindle.operators.synthetic import write_dataset

            return write_dataset(spark, registry.get(args.schema), args.out, args.visits, args.seed)
        case "load":
            summary = house.load(registry.get(args.schema), args.csv, args.source, args.synthetic, args.force)
            house.record_issues(registry.get(args.schema), summary["source_id"], summary)
            return summary
        case "check":
            return house.check(registry.get(args.schema), args.source)
        case "run":
            return runs.run_pipeline(house, registry.get(args.schema), [s for s in args.sources.split(",") if s])
        case "query":
            return [r.asDict() for r in house.query(args.sql).limit(1000).collect()]
    raise SystemExit(f"unknown command {args.command}")


def main(argv: list[str] | None = None) -> int:
    try:
        out = run(parser().parse_args(argv))
    except (ValueError, TypeError, RuntimeError) as e:
        print(json.dumps({"error": str(e)}))
        return 1
    print(json.dumps(out, indent=2, default=str))
    return int(isinstance(out, dict) and out.get("ok") is False)


if __name__ == "__main__":
    sys.exit(main())
