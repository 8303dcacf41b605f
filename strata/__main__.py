"""Command-line entry: run a layer job or a profiling report.

    python -m strata curated  --users U --countries C --horoscopes H --facts F --target ROOT [--database DB]
    python -m strata refined  --curated ROOT --target ROOT2 [--curated-database DB] [--database DB2]
    python -m strata profile-raw     --users U --countries C --facts F --out DIR
    python -m strata profile-curated --curated ROOT --out DIR
    python -m strata stream-facts    --facts-dir DIR --users U --target ROOT/facts_stream [--checkpoint CK] [--continuous]

On a cluster, launch it with ``spark-submit strata/__main__.py <command> ...``
(the master and resources come from the launcher). The layer jobs append
their steps to ``<target>/_run_log``.
"""

from __future__ import annotations

import argparse
import sys

from strata.session import build_session, require_persistent_catalog


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata")
    p.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    p.add_argument("--target-file-mb", type=int, default=None, help="file size the layer writes aim at (AQE partition size)")
    sub = p.add_subparsers(dest="command", required=True)

    c = sub.add_parser("curated", help="raw files -> curated layer")
    for name in ("users", "countries", "horoscopes", "facts"):
        c.add_argument(f"--{name}", required=True)
    c.add_argument("--target", required=True)
    c.add_argument("--database")
    c.add_argument("--buckets", type=int, help="partition facts by this many hash buckets of the user, not by user")
    c.add_argument("--bucketed", type=int, help="publish facts as a native bucketed table of this many buckets")
    c.add_argument("--switch", action="store_true", help="publish a new version of the layer and switch readers to it at the end")
    c.add_argument("--counts", help="folder for the quality counts taken while writing")
    c.add_argument(
        "--rules",
        help="JSON file with any of: prefix_rules [[prefix, name], ...], continent_map {from: to}, "
        "added_countries [[pais, country, continente, continent], ...] (defaults: the dataset's own)",
    )

    r = sub.add_parser("refined", help="curated layer -> refined layer")
    r.add_argument("--curated", required=True)
    r.add_argument("--target", required=True)
    r.add_argument("--curated-database")
    r.add_argument("--database")
    r.add_argument("--buckets", type=int, help="as for curated")
    r.add_argument("--bucketed", type=int, help="as for curated")
    r.add_argument("--switch", action="store_true", help="as for curated")

    pr = sub.add_parser("profile-raw", help="checks over the raw files, written as tables")
    for name in ("users", "countries", "facts"):
        pr.add_argument(f"--{name}", required=True)
    pr.add_argument("--horoscopes", help="adds the preview of this table")
    pr.add_argument("--out", required=True)
    pr.add_argument("--rules", help="JSON file of mapping rules, as for curated")

    pc = sub.add_parser("profile-curated", help="checks over the curated layer, written as tables")
    pc.add_argument("--curated", required=True)
    pc.add_argument("--out", required=True)

    s = sub.add_parser("stream-facts", help="clean arriving raw fact files into the curated facts table")
    s.add_argument("--facts-dir", required=True)
    s.add_argument("--users", required=True)
    s.add_argument("--target", required=True)
    s.add_argument("--checkpoint", help="default: <target>_checkpoint")
    s.add_argument("--buckets", type=int, help="as for curated")
    s.add_argument("--max-files-per-trigger", type=int, default=1000)
    s.add_argument("--continuous", action="store_true", help="keep polling instead of processing what is there")
    return p


def _load_rules(path: str | None) -> dict:
    """Mapping rules from a JSON file, as the curated job's arguments."""
    if not path:
        return {}
    import json

    with open(path, encoding="utf-8") as fh:
        raw = json.load(fh)
    unknown = set(raw) - {"prefix_rules", "continent_map", "added_countries"}
    if unknown:
        raise SystemExit(f"unknown rule keys: {sorted(unknown)}")
    rules = {}
    if "prefix_rules" in raw:
        rules["prefix_rules"] = tuple((str(p), str(v)) for p, v in raw["prefix_rules"])
    if "continent_map" in raw:
        rules["continent_map"] = {str(k): str(v) for k, v in raw["continent_map"].items()}
    if "added_countries" in raw:
        rules["added_countries"] = tuple(tuple(r) for r in raw["added_countries"])
    return rules


def _write_checks(checks, out: str) -> None:
    from strata.sinks.writers import write_table

    for name, df in checks.items():
        write_table(df, f"{out.rstrip('/')}/{name}")


def main(argv: list[str] | None = None) -> int:
    """Parse the command line, run the chosen job, return the exit code."""
    args = _parser().parse_args(argv)
    spark = build_session(args.master, app_name=f"strata-{args.command}")
    if getattr(args, "database", None) or getattr(args, "curated_database", None):
        require_persistent_catalog(spark)
    target = args.target_file_mb * 1024 * 1024 if args.target_file_mb else None
    if args.command == "curated":
        from strata.plans.curated import run_curated

        from strata.operators import Probes

        paths = {k: getattr(args, k) for k in ("users", "countries", "horoscopes", "facts")}
        probes = Probes() if args.counts else None
        run_curated(
            spark,
            paths,
            args.target,
            database=args.database,
            buckets=args.buckets,
            bucketed=args.bucketed,
            switch=args.switch,
            probes=probes,
            log_path=f"{args.target}/_run_log",
            target_file_bytes=target,
            **_load_rules(args.rules),
        )
        if probes:
            _write_checks({"counts": probes.frame(spark)}, args.counts)
    elif args.command == "refined":
        from strata.plans.refined import run_refined

        run_refined(
            spark,
            args.curated,
            args.target,
            curated_database=args.curated_database,
            refined_database=args.database,
            buckets=args.buckets,
            bucketed=args.bucketed,
            switch=args.switch,
            log_path=f"{args.target}/_run_log",
            target_file_bytes=target,
        )
    elif args.command == "profile-raw":
        from strata.plans.profiling import profile_raw
        from strata.sources.readers import read_countries, read_facts, read_horoscopes, read_users

        checks = profile_raw(
            read_users(spark, args.users),
            read_countries(spark, args.countries),
            read_facts(spark, args.facts),
            stage_path=f"{args.out.rstrip('/')}/_staged",
            horoscopes=read_horoscopes(spark, args.horoscopes) if args.horoscopes else None,
            **_load_rules(args.rules),
        )
        _write_checks(checks, args.out)
    elif args.command == "profile-curated":
        from strata.plans.layers import read_layer
        from strata.plans.profiling import profile_curated

        _write_checks(profile_curated(**read_layer(spark, args.curated)), args.out)
    elif args.command == "stream-facts":
        from strata.sources.readers import read_users
        from strata.streaming import start_curated_facts

        query = start_curated_facts(
            spark,
            args.facts_dir,
            lambda: read_users(spark, args.users),  # anew for each micro-batch
            args.target,
            checkpoint=args.checkpoint,
            available_now=not args.continuous,
            buckets=args.buckets,
            max_files_per_trigger=args.max_files_per_trigger,
        )
        query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
