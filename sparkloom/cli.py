"""Command line: discover, run, gold, search, config. Exit code 1 if some of the work failed, 2 for wrong use or what is not there."""

from __future__ import annotations

import argparse
import json
import os
import sys
import tomllib

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sparkloom import pipeline, sinks
from sparkloom.operators import catalog, routing, versioning
from sparkloom.sources import corpus


def load_settings(path: str | None, environ: dict[str, str] | None = None) -> dict[str, dict]:
    """Defaults, then a TOML file, then SPARKLOOM_SECTION__NAME variables; two levels deep. Values of variables are read as TOML where they are valid TOML."""
    out: dict[str, dict] = {"chunking": {"size": 1000, "overlap": 120}, "search": {"k": 5}}
    if path:
        with open(path, "rb") as f:
            for section, values in tomllib.load(f).items():
                out.setdefault(section, {}).update(values)
    for name, value in (environ or {}).items():
        if name.startswith("SPARKLOOM_") and "__" in name:
            section, key = name.removeprefix("SPARKLOOM_").lower().split("__", 1)
            try:
                value = tomllib.loads(f"v = {value}")["v"]
            except tomllib.TOMLDecodeError:
                pass
            out.setdefault(section, {})[key] = value
    if out["chunking"]["overlap"] > out["chunking"]["size"]:
        raise ValueError("chunking.overlap is larger than chunking.size")
    return out


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sparkloom")
    p.add_argument("--config", help="settings in TOML")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("discover", help="files of a corpus by extension")
    s.add_argument("root")
    s = sub.add_parser("run", help="read what is new in a corpus and publish it as the next version")
    s.add_argument("root")
    s.add_argument("out")
    s.add_argument("--force", action="store_true", help="do everything again")
    s = sub.add_parser("gold", help="build the index of the active chunks")
    s.add_argument("out")
    s = sub.add_parser("search", help="ask the newest index that can be loaded")
    s.add_argument("out")
    s.add_argument("question")
    s.add_argument("--client")
    s.add_argument("--category")
    sub.add_parser("config", help="settings in force and the fingerprints of the routes")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    try:
        settings = load_settings(args.config, dict(os.environ))
    except (OSError, ValueError) as e:
        print(f"settings: {e}", file=sys.stderr)
        return 2
    if args.command == "config":
        print(json.dumps({"settings": settings, "fingerprints": routing.route_fingerprints(settings)}, indent=1, sort_keys=True))
        return 0
    spark = SparkSession.builder.appName("sparkloom").getOrCreate()
    if args.command == "discover":
        files = corpus.corpus_files(spark, args.root)
        files.groupBy(catalog.extension(F.col("relative_path")).alias("extension")).count().orderBy(F.desc("count"), "extension").show(50, False)
        return 0
    prior = pipeline.sealed_manifest(spark, args.out)
    if args.command == "run":
        ordinal = 1 if prior is None else prior.agg(F.max("run_ordinal")).first()[0] + 1
        while sinks.exists(spark, f"{args.out}/records/version=r{ordinal:06d}"):
            ordinal += 1  # a run that broke off keeps its number and is never sealed
        scopes = catalog.discover_scopes(corpus.corpus_files(spark, args.root), []).withColumn("scope_id", catalog.scope_id(F.col("category"), F.col("client")))
        tables = pipeline.run(spark, args.root, scopes, prior=prior, ordinal=ordinal, force=args.force, **settings["chunking"]) | {"scopes": scopes}
        pipeline.publish(tables, args.out, ordinal)
        told = tables["records"].select("status").unionByName(tables["member_records"].select("status"))
        told.groupBy("status").count().orderBy("status").show()
        return int(not told.where("status = 'failed'").isEmpty())
    if prior is None:
        print("no sealed run there", file=sys.stderr)
        return 2
    if args.command == "gold":
        chunks = pipeline.active_chunks(spark, args.out, prior)
        ordinal = sinks.next_version(spark, f"{args.out}/index/vectors")
        sinks.write_index(pipeline.build_index(chunks), f"{args.out}/index", f"g{ordinal:06d}", "characters")
        return 0
    try:
        index = sinks.newest_index(spark, f"{args.out}/index")
    except (AnalysisException, LookupError) as e:
        print(f"no index can be loaded: {str(e)[:200]}", file=sys.stderr)
        return 2
    scopes = spark.read.parquet(f"{args.out}/scopes").select("scope_id", "client", "category").dropDuplicates(["scope_id"])
    pipeline.ask(index.join(scopes, "scope_id"), args.question, settings["search"]["k"], client=args.client, category=args.category).select("score", "client", "unit_ref", "text").show(truncate=120)
    return 0


if __name__ == "__main__":
    sys.exit(main())
