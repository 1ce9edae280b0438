"""Writing tables, the feed and the manifest."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import text, time
from driftline.sources import fs


def table(df: DataFrame, path: str, rows: int, stats: tuple[str, ...] = ()) -> None:
    """Parquet with ZSTD, row groups of at most ``rows`` and statistics only on the columns that prune."""
    w = df.write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", rows)
    for c in df.columns:
        if c not in stats:
            w = w.option(f"parquet.column.statistics.enabled#{c}", "false")
    w.parquet(path)


def cube(df: DataFrame, path: str, rows: int = 10_000) -> None:
    """Partitions by year, each sorted by cell and day."""
    w = df.withColumn("year", time.year_of_day("day")).repartitionByRange("year", "cell", "day").sortWithinPartitions("year", "cell", "day").write.mode("overwrite")
    w.option("compression", "zstd").option("parquet.block.row.count.limit", rows).partitionBy("year").parquet(path)


def history(df: DataFrame, path: str) -> None:
    table(df.orderBy("uid", "change_date"), path, 10_000, ("uid",))


def ranking(df: DataFrame, stats: DataFrame, path: str) -> None:
    """The ranking by name, and beside it the figures of each aspect."""
    table(df.orderBy("username", "uid"), f"{path}/ranking", 1_000, ("username", "uid"))
    table(stats, f"{path}/ranking_stats", 1_000)


def suspects(df: DataFrame, path: str) -> None:
    table(df.orderBy(F.desc("change_date"), "uid"), path, 1_000, ("change_date", "uid"))


def feed_entries(suspects: DataFrame, site: str = "", users: str = "#user=") -> DataFrame:
    """change_date, uid, entry: one Atom entry a row, newest first."""
    day, flag = time.iso_date("change_date"), F.col("suspect_flag")
    whole = lambda c: F.col(c).cast("string")
    quoted = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    name, set_ = text.escape_xml(F.col("username")), lambda bit: flag.bitwiseAND(F.lit(bit)) != 0
    terms = F.concat(text.filter_terms(flag), F.transform("countries", text.escape_xml))
    # fixed wording, filter numbers and order: readers of the feed tell the filters apart by it
    lines: list[Column] = [
        quoted("Flagged edit day for ", name, " on ", day, "."),
        quoted("Changes: ", whole("changes"), " | Ranking at day: #", whole("ranking_at_day")),
        F.when(F.size("countries") > 0, quoted("Countries: ", F.array_join(F.transform("countries", text.country_label), ", "))),
        F.when(set_(text.BURST), quoted("Filter 2 (edit burst): peak ", whole("max_edits_per_hour"), " edits/hour")),
        F.when(set_(text.MOVE), quoted("Filter 3 (node moves): ", whole("far_move_count"), " far moves, largest ", text.distance_label(F.col("max_move_meters")))),
        F.when(set_(text.SPREAD), quoted("Filter 4 (spread): peak ", F.round("peak_spread_km2").cast("long").cast("string"), " km^2")),
        F.when(set_(text.COVERAGE), quoted("Filter 5 (mass tag): ", F.array_join(F.transform("changed_keys", text.escape_xml), " "))),
        F.when(set_(text.LANGUAGE), quoted("Name-language abuse: ", whole("name_lang_events"), " event(s)")),
    ]
    body = text.escape_xml(F.concat(F.array_join(F.array_compact(F.array(*lines)), "\n"), F.lit("\n")))
    link = text.escape_xml(quoted(users, text.url_encode(F.col("username"))))
    entry = quoted(
        "<entry><title>", name, " - ", day, " (", whole("changes"), " changes)</title><id>tag:suspect,", day, ":", whole("uid"), "</id><updated>", day, "T00:00:00Z</updated>",
        "<author><name>", name, "</name><uri>", text.escape_xml(quoted(site, text.url_encode(F.col("username")))), "</uri></author><link rel='alternate' href='", link, "'/>",
        F.array_join(F.transform(terms, lambda t: F.concat(F.lit("<category term='"), t, F.lit("'/>"))), " "), "<content type='text'>", body, "</content></entry>",
    )
    return suspects.orderBy(F.desc("change_date"), "uid").select("change_date", "uid", entry.alias("entry"))


def feed(suspects: DataFrame, path: str, title: str = "Suspect activity", most: int | None = None) -> None:
    """The feed as one file. Entries come to the driver partition by partition and go straight to the file."""
    rows = feed_entries(suspects)
    newest = suspects.agg(F.max("change_date")).first()[0]
    with fs.Writer(suspects.sparkSession, path) as f:
        f.write("<?xml version='1.0' encoding='utf-8'?>\n<feed xmlns='http://www.w3.org/2005/Atom'>\n")
        f.write(f"<title>{title}</title><id>tag:suspects</id><updated>{'1970-01-01' if newest is None else time.day_key(newest)}T00:00:00Z</updated>\n")
        for r in (rows.limit(most) if most else rows).toLocalIterator():
            f.write(r["entry"] + "\n")
        f.write("</feed>\n")


def manifest(spark: SparkSession, path: str, resolution: int, source: dict, centre: tuple[float, float] | None, date_range: tuple[int, int] | None, partitions: dict[str, dict[str, list[str]]], singles: dict[str, list[str]]) -> None:
    """What there is, where it came from and what it spans. partitions: dataset to year to files; singles: dataset to files. Footer sizes are read."""
    out: dict = {"h3_resolution": resolution, "source": source}
    if centre:
        out["spatial_center"] = list(centre)
    if date_range:
        out["date_range"] = {"min_date": time.day_key(date_range[0]), "max_date": time.day_key(date_range[1])}
    sizes = lambda files: [footer_bytes(spark, f) for f in files]
    out["datasets"] = {n: {"path": n, "partitions": sorted(y), "files": {k: v for k, v in sorted(y.items())}, "partition_footer_sizes": {k: sizes(v) for k, v in sorted(y.items())}} for n, y in partitions.items()}
    out["datasets"] |= {n: {"path": n, "partitions": [], "files": f, "footer_size": sizes(f)} for n, f in singles.items() if f}
    fs.replace(spark, path, json.dumps(out, indent=1))


def files_of(spark: SparkSession, folder: str) -> list[str]:
    """The Parquet files of a folder; none if it isn't there."""
    return [f"{folder}/{name}" for name, is_dir, _ in fs.listed(spark, folder) if not is_dir and name.endswith(".parquet")]


def footer_bytes(spark: SparkSession, file: str) -> int:
    """Size of a Parquet file's footer with its length and magic."""
    return int.from_bytes(fs.read_tail(spark, file, 8)[:4], "little") + 8
