"""Command line: import, prepare-update, update [N], help."""

from __future__ import annotations

import argparse
import json
import sys

VERBS = ("import", "prepare-update", "update", "help")


def _rows(text: str) -> int:
    n = int(text)
    if n < 1_000:
        raise argparse.ArgumentTypeError("must be at least 1000")
    return n


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="driftline", description=__doc__)
    verbs = p.add_subparsers(dest="verb", required=True)
    every = argparse.ArgumentParser(add_help=False)
    every.add_argument("--output-dir", default="out")
    every.add_argument("--h3-resolution", type=int, default=9, choices=range(14), help="must stay the same from import on")
    every.add_argument("--update-url", default="", help="where state.txt and diffs are; kept in the manifest")
    every.add_argument("--country-index", default="")
    every.add_argument("--country-names", default="")
    every.add_argument("--change-group-rows", type=_rows, default=10_000, help="rows of a Parquet row group of the cube")
    every.add_argument("--users-history-group-rows", type=_rows, default=10_000)
    every.add_argument("--ranking-group-rows", type=_rows, default=1_000)
    one = verbs.add_parser("import", parents=[every])
    one.add_argument("versions", help="all object versions: a history PBF file, or Parquet")
    two = verbs.add_parser("update", parents=[every])
    two.add_argument("count", nargs="?", type=int, help="at most so many diffs")
    two.add_argument("--diffs", default="", help="folder of change documents; without it they are fetched from the update url")
    two.add_argument("--cookie", default="", help="Netscape cookie file for the server")
    verbs.add_parser("prepare-update", parents=[every])
    verbs.add_parser("help")
    got = p.parse_args(argv)
    if got.verb == "help":
        p.print_help()
    if getattr(got, "count", None) is not None and got.count < 1:
        p.error("update needs a positive number of diffs")
    if got.verb == "prepare-update" and not got.update_url:
        p.error("prepare-update needs --update-url")
    if got.verb == "update" and got.cookie and got.diffs:
        p.error("--cookie is only used when diffs are fetched")
    if bool(getattr(got, "country_names", "")) > bool(getattr(got, "country_index", "")):
        p.error("--country-names goes with --country-index")
    return got


def fetched(spark, options, cookie: str, count: int | None, folder: str) -> str:
    """Fetches the diffs after the applied one into ``folder`` on the driver and gives the folder; the first failure ends it, and what came before is applied."""
    from driftline.plans import runner
    from driftline.sources import fetch
    from driftline.streaming import incremental

    url = options.source.get("url")
    if not url:
        raise SystemExit("no update url: give --update-url or --diffs")
    current = int(fetch.current_state(url, folder, cookie or None)["sequenceNumber"])
    applied = runner.Store(spark, options.output).ledger.applied("history")
    fetch.diffs(url, folder, list(incremental.sequence_range(applied, current, count)), cookie or None)
    return folder


def main(argv: list[str] | None = None) -> int:
    got = parse(sys.argv[1:] if argv is None else argv)
    if got.verb == "help":
        return 0
    from pyspark.sql import SparkSession

    from driftline.plans import runner
    from driftline.sources import files, fs

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    manifest = f"{got.output_dir}/manifest.json"
    there = fs.read_text(spark, manifest) if fs.exists(spark, manifest) else None
    known = files.manifest_source(there) if there else {}
    if there and json.loads(there).get("h3_resolution") != got.h3_resolution and got.verb != "import":
        raise SystemExit(f"--h3-resolution differs from the import's {json.loads(there).get('h3_resolution')}")
    if got.verb == "update" and got.update_url and known.get("url") not in (None, got.update_url):
        raise SystemExit(f"--update-url differs from the recorded {known['url']}; prepare-update changes it")
    options = runner.Options(got.output_dir, got.h3_resolution, known | ({"url": got.update_url} if got.update_url else {}), groups=(got.change_group_rows, got.users_history_group_rows, got.ranking_group_rows))
    if got.verb == "prepare-update":
        if there is None:
            raise SystemExit(f"{manifest} is not there: import first")
        fs.replace(spark, manifest, json.dumps(json.loads(there) | {"source": options.source}, indent=1))
        return 0
    if got.verb == "import":
        if got.versions.endswith(".pbf"):
            from driftline.sources import pbf

            pbf.register(spark)
            versions = spark.read.format("history_pbf").load(got.versions)
        else:
            versions = files.versions(spark, got.versions)
        state = files.sidecar(got.versions)
        if fs.exists(spark, state):
            s = files.parse_state(fs.read_text(spark, state))
            options.source |= {"timestamp": s["timestamp"]}
            runner.run_import(spark, versions, options, int(s["sequenceNumber"]))
        else:
            runner.run_import(spark, versions, options)
        return 0
    places = None
    if got.country_index:
        from driftline.functions import geo, hexgrid
        from driftline.operators import finalize

        index, names = files.country_index(spark, got.country_index, got.country_names)

        def places(cells):
            at = cells.withColumn("c", hexgrid.centre_of("cell")).withColumn("leaf", geo.s2_leaf_of("c.lat", "c.lon"))
            return finalize.country_of(at.select("cell", "leaf"), index, names).select("cell", "iso")

    diffs = got.diffs or fetched(spark, options, got.cookie, got.count, f"{got.output_dir.rstrip('/')}-diffs")
    runner.run_update(spark, files.change_documents(spark, f"{diffs}/*.osc*"), options, places, got.count)
    return 0


if __name__ == "__main__":
    sys.exit(main())
