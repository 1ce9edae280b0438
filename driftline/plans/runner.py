"""Whole runs: an import of all versions, and updates along numbered diffs.

Every table has a folder for each sequence it was brought to, and tables that are kept by partition (the cube by year; minutes, cells, keys and
languages by SPAN of days) have such folders for the partitions that a run touched. The ledger says which folder holds, of each table and partition.
A run only writes new folders and moves the ledger once, as its last step, for all of them: a run that breaks off anywhere leaves the old
state, and doing it again, with or without newer diffs, counts each diff once. Feed and manifest follow the ledger; a run that finds them
behind writes them again. Folders that the ledger no longer names go when the next run starts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline import schemas
from driftline.functions import geo, hexgrid, time
from driftline.operators import activity, cube, edits, finalize, screens
from driftline.sources import files, fs, publish
from driftline.streaming import incremental

SPAN = 30


@dataclass
class Options:
    """What a run needs to know; the defaults are the usual ones."""

    output: str = "out"
    resolution: int = 9
    source: dict = field(default_factory=dict)
    span: int = incremental.SPAN_S
    over: int = screens.BURST_OVER
    move: float = screens.MOVE_OVER_M
    spread: dict = field(default_factory=dict)
    coverage: dict = field(default_factory=dict)
    compact: int = incremental.COMPACT
    groups: tuple[int, int, int] = (10_000, 10_000, 1_000)  # rows of a Parquet row group: cube, history, ranking


def prepared(versions: DataFrame, resolution: int) -> DataFrame:
    """Versions with day, minute, kind, username, ord and, for nodes with coordinates, cell. A day outside 0..65535 and too many tags are errors."""
    secs = F.unix_seconds("ts")
    at = geo.valid_location(F.col("lat"), F.col("lon")) & (F.col("type") == "node")
    df = versions.withColumn("secs", secs).withColumn("day", time.checked_day(time.day_of_seconds("secs"))).withColumn("minute", time.minute_of_seconds("secs"))
    cell = hexgrid.cell_of(F.when(at, F.col("lat")), F.when(at, F.col("lon")), F.lit(resolution))
    seq = F.col("seq") if "seq" in versions.columns else F.lit(0).cast("long")
    df = df.withColumn("seq", seq).withColumn("kind", F.when(F.col("type") == "node", 0).when(F.col("type") == "way", 1).otherwise(2))
    return df.withColumn("tags", edits.checked_tags(F.col("tags"))).withColumn("username", F.coalesce("user", F.lit(""))).withColumn("ord", F.struct("seq", "secs", "id", "version")).withColumn("cell", cell)


class Store:
    """The tables of one output folder. What a run writes is seen through ``new`` until ``commit`` moves the ledger."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.ledger = incremental.Ledger(spark, f"{root}/ledger.json")
        self.moves: dict[str, int] = {}

    def path(self, name: str, seq: int | None = None) -> str:
        return f"{self.root}/{name}/seq_{self.ledger.applied(name) if seq is None else seq}"

    def read(self, name: str, schema) -> DataFrame:
        """The table as committed; empty if it never was. A committed one whose folder is gone is an error, not an empty table."""
        if not self.ledger.known(name):
            return self.spark.createDataFrame([], schema)
        path = self.path(name)
        if not fs.exists(self.spark, path):
            raise FileNotFoundError(f"{path} is committed but not there")
        return self.spark.read.schema(schema).parquet(path)

    def scratch(self, name: str, df: DataFrame, seq: int) -> DataFrame:
        """A table of this run only."""
        path = self.path(f"run/{name}", seq)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write(self, name: str, df: DataFrame, seq: int, rows: int | None = None) -> DataFrame:
        path = self.path(name, seq)
        w = df.write.mode("overwrite").option("compression", "zstd")
        (w.option("parquet.block.row.count.limit", rows) if rows else w).parquet(path)
        self.moves[f"{name}/"] = seq
        return self.spark.read.schema(df.schema).parquet(path)

    def folders(self, name: str, part: str, new: bool = False) -> dict[str, str]:
        """Partition to the folder that holds it."""
        held = self.ledger.partitions(name)
        if new:
            held |= {k.removeprefix(f"{name}/"): v for k, v in self.moves.items() if k.startswith(f"{name}/") and k != f"{name}/"}
        return {p: f"{self.root}/{name}/seq={seq}/{part}={p}" for p, seq in sorted(held.items())}

    def read_parts(self, name: str, schema, part: str, only: list | None = None, new: bool = False) -> DataFrame:
        """A table kept by the column ``part``, or the partitions ``only`` of it."""
        paths = [f for p, f in self.folders(name, part, new).items() if only is None or p in {str(x) for x in only}]
        if not paths:
            return self.spark.createDataFrame([], schema)
        held = T.StructType([*schema.fields, T.StructField("seq", T.LongType())])
        return self.spark.read.schema(held).option("basePath", f"{self.root}/{name}").parquet(*paths).select(*schema.names)

    def write_parts(self, name: str, df: DataFrame, part: str, sort: list[str], seq: int, rows: int = 10_000) -> None:
        path = f"{self.root}/{name}/seq={seq}"
        w = df.repartitionByRange(part, *sort).sortWithinPartitions(part, *sort).write.mode("overwrite")
        w.option("compression", "zstd").option("parquet.block.row.count.limit", rows).partitionBy(part).parquet(path)
        for folder, is_dir, _ in fs.listed(self.spark, path):
            if is_dir and folder.startswith(f"{part}="):
                self.moves[f"{name}/{folder.removeprefix(f'{part}=')}"] = seq

    def fold_parts(self, name: str, new: DataFrame, schema, part: str, keys: list[str], n: str, seq: int, rows: int = 10_000) -> DataFrame:
        """Adds the new counts to the partitions that they touch and gives the whole table after it."""
        new = self.scratch(f"new_{name}", new.select(*schema.names), seq)
        touched = [r[0] for r in new.select(part).distinct().collect()]  # a row a year, or a span of days, of the diffs
        if touched:
            both = self.read_parts(name, schema, part, touched).unionByName(new)
            self.write_parts(name, both.groupBy(part, *keys).agg(F.sum(n).alias(n)), part, keys, seq, rows)
        return self.read_parts(name, schema, part, new=True)

    def commit(self) -> None:
        self.ledger.move(self.moves)
        self.moves = {}

    def sweep(self) -> None:
        """Removes folders that the ledger doesn't name: of earlier sequences, and of runs that broke off."""
        tables, parts = {}, {}
        for k, seq in self.ledger.entries.items():
            name, _, p = k.rpartition("/")
            if p:
                parts.setdefault(name, {}).setdefault(seq, set()).add(p)
            else:
                tables[name] = seq
        fs.delete(self.spark, f"{self.root}/run")
        for name, seq in tables.items():
            for folder, is_dir, _ in fs.listed(self.spark, f"{self.root}/{name}"):
                if is_dir and folder.startswith("seq_") and folder != f"seq_{seq}":
                    fs.delete(self.spark, f"{self.root}/{name}/{folder}")
        for name, held in parts.items():
            for folder, is_dir, _ in fs.listed(self.spark, f"{self.root}/{name}"):
                if not is_dir or not folder.startswith("seq="):
                    continue
                keep = held.get(int(folder.removeprefix("seq=")), set())
                if not keep:
                    fs.delete(self.spark, f"{self.root}/{name}/{folder}")
                    continue
                for p, sub, _ in fs.listed(self.spark, f"{self.root}/{name}/{folder}"):
                    if sub and p.partition("=")[2] not in keep:
                        fs.delete(self.spark, f"{self.root}/{name}/{folder}/{p}")


def _of(schema: T.StructType, part: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(part, T.IntegerType())])


NODE = schemas.of("node BIGINT")
NODES = schemas.of("node BIGINT, cell BIGINT")
MOVES = schemas.of("uid BIGINT, minute BIGINT, meters BIGINT")
CUBE = schemas.of("cell BIGINT, day INT, count BIGINT, year INT")
CENTRES = schemas.of("year INT, lat DOUBLE, lon DOUBLE, count BIGINT, first_day INT, last_day INT")
OBJECTS = "type string, id long"
TAGS = f"{OBJECTS}, tags array<struct<k:string,v:string>>"
TOTALS = schemas.of("uid BIGINT, username STRING, first_seen_day INT, " + ", ".join(f"{c} BIGINT" for c in schemas.COUNTERS))
SPANS = {"minutes": _of(schemas.MINUTES, "span"), "cells": _of(schemas.CELLS, "span"), "keys": _of(schemas.KEYS, "span"), "langs": _of(schemas.LANGS, "span")}


def _span(day: Column) -> Column:
    return F.floor(day / SPAN).cast("int")


def whole_cube(store: Store, new: bool = False) -> DataFrame:
    return store.read_parts("cube", CUBE, "year", new=new)


def run_import(spark: SparkSession, versions: DataFrame, options: Options, seq: int = 0) -> None:
    """Cube, history and ranking of all versions, and the state that updates start from. Flags are 0 and there are no suspects."""
    with incremental.Lock(spark, f"{options.output}/lock"):
        store = Store(spark, options.output)
        rows = store.scratch("work", prepared(versions, options.resolution), seq)
        nodes = rows.where("type = 'node'").select("id", "version", "visible", "day", "cell")
        history = store.scratch("positions", cube.positions(nodes), seq)
        ways = rows.where("type = 'way'").select("id", "version", "visible", "day", "refs")
        counts = cube.by_year(cube.merged(cube.counted(cube.node_events(nodes)), cube.counted(cube.way_events(ways, history))))
        store.write_parts("cube", counts.select(*CUBE.names), "year", ["cell", "day"], seq, options.groups[0])
        store.write("centres", _centres(whole_cube(store, new=True)), seq)
        alive = nodes.groupBy("id").agg(F.max_by("visible", "version").alias("v")).where("v").select(F.col("id").alias("node"))
        store.write("nodes", cube.last_positions(history).join(alive, "node", "left_semi").select("node", "cell"), seq)
        store.write("tags", screens.last_tags(rows), seq)
        for name, schema in (("overlay", NODES), ("deleted", NODE), ("tags_over", TAGS), ("tags_touched", OBJECTS)):
            store.write(name, spark.createDataFrame([], schema), seq)
        days = store.scratch("days", activity.user_days(rows), seq)
        users = store.write("totals", activity.totals(days), seq)
        store.write("history", activity.history(days).orderBy("uid", "change_date"), seq, options.groups[1])
        _rank(store, users, seq, options)
        store.commit()
        _publish(store, options)


def _rank(store: Store, users: DataFrame, seq: int, options: Options) -> DataFrame:
    store.write("ranking_stats", activity.ranking_stats(users), seq)
    return store.write("ranking", activity.ranking(users).orderBy("username", "uid"), seq, options.groups[2])


def _node_batch(rows: DataFrame, base: DataFrame, overlay: DataFrame, deleted: DataFrame, options: Options):
    """Cube events, cells and moves of a batch's nodes, and the state after it."""
    changes = rows.where("type = 'node'").select("*", F.col("id").alias("node"))
    # a node that an earlier update deleted has no position, though the base still has one
    alive = base.join(deleted, "node", "left_anti")
    known = cube.sequential_prior(changes, alive, overlay)
    at = known.withColumn("cell", F.coalesce("cell", F.when(~F.col("visible"), F.col("prior"))))
    centre = hexgrid.centre_of(F.col("prior"))
    steps = known.where("visible and version > 1 and cell is not null and prior is not null").withColumn("c", centre).select("uid", "minute", "visible", "version", "lat", "lon", F.col("c.lat").alias("lat0"), F.col("c.lon").alias("lon0"))
    return at.where("cell is not null"), screens.far_moves(steps, options.move), incremental.next_state(overlay, deleted, changes)


def _way_batch(rows: DataFrame, base: DataFrame, overlay: DataFrame, deleted: DataFrame) -> DataFrame:
    """Way versions with a row for each distinct cell, at the positions after the batch."""
    refs = edits.with_nodes(rows.where("type = 'way'")).select("id", "version", "uid", "minute", "day", "visible", F.explode(F.array_distinct("refs")).alias("node"))
    ids = refs.select("node").distinct()
    cells = cube.post_positions(ids, base, overlay, deleted).where("cell is not null")
    return refs.join(cells, "node").select("id", "version", "uid", "minute", "day", "visible", "cell").distinct()


def run_update(spark: SparkSession, diffs: DataFrame, options: Options, places=None, most: int | None = None) -> int:
    """Applies the diffs (versions with ``seq``) after the applied one and gives the new applied sequence.

    places: a function from a table of cells to (cell, iso), or None without countries.
    """
    with incremental.Lock(spark, f"{options.output}/lock"):
        store = Store(spark, options.output)
        if not store.ledger.known("history"):
            raise FileNotFoundError(f"{options.output} has no ledger: import first")
        store.sweep()
        stamp = store.ledger.applied("history")
        have = sorted(r[0] for r in diffs.where(F.col("seq") > stamp).select("seq").distinct().collect())
        todo = incremental.consecutive(have, stamp + 1)[:most]
        if not todo:
            _publish(store, options)
            return stamp
        seq = todo[-1]
        rows = store.scratch("work", prepared(diffs.where(F.col("seq").isin(todo)), options.resolution), seq)
        plan = incremental.batch_plan(rows.select("seq", "secs"), options.span)
        base, overlay, deleted = store.read("nodes", NODES), store.read("overlay", NODES), store.read("deleted", NODE)
        events = moved = spots = None
        join = lambda a, b: b if a is None else a.unionByName(b)
        for n in range(plan.agg(F.max("batch")).first()[0] + 1):
            seqs = [r[0] for r in plan.where(F.col("batch") == n).select("seq").collect()]
            batch = rows.where(F.col("seq").isin(seqs))
            nodes, moves, (overlay, deleted) = _node_batch(batch, base, overlay, deleted, options)
            overlay, deleted = store.scratch(f"overlay_{n}", overlay, seq), store.scratch(f"deleted_{n}", deleted, seq)
            ways = store.scratch(f"ways_{n}", _way_batch(batch, base, overlay, deleted), seq)
            nodes = store.scratch(f"nodes_{n}", nodes.select("id", "version", "uid", "minute", "day", "visible", "cell"), seq)
            events = join(events, nodes.select("cell", "day").unionByName(ways.select("cell", "day")))
            spots = join(spots, edits.cell_counts(nodes, ways.withColumnRenamed("id", "way")))
            moved = join(moved, moves)
        moved = store.scratch("moves", moved, seq)
        store.fold_parts("cube", cube.by_year(cube.counted(events)), CUBE, "year", ["cell", "day"], "count", seq, options.groups[0])
        _new_centres(store, seq)
        by_minute = lambda df: df.withColumn("span", _span(time.day_of_minute("minute")))
        fold = lambda name, new, keys: store.fold_parts(name, new, SPANS[name], "span", keys, "n", seq)
        minutes = fold("minutes", by_minute(edits.minute_counts(rows)), ["uid", "minute"])
        cells = fold("cells", by_minute(spots), ["uid", "minute", "cell"])
        keys = fold("keys", by_minute(edits.key_counts(rows)), ["uid", "minute", "key"])
        langs = _tag_state(store, rows, options, seq, fold)
        _node_state(store, base, overlay, deleted, options, seq)

        days = store.scratch("days", activity.user_days(rows), seq)
        users = store.write("totals", activity.merged_totals(store.read("totals", TOTALS), activity.totals(days)), seq)
        ranked = _rank(store, users, seq, options)
        previous = store.read("suspects", schemas.SUSPECTS)
        hist = finalize.history_merge(store.read("history", schemas.HISTORY), activity.history(days))
        flagged = finalize.flagged(
            hist, ranked, screens.burst_days(minutes, options.over), screens.move_days(moved), screens.spread_days(cells, minutes, geo.hexagon_km2(options.resolution), **options.spread),
            screens.coverage_days(keys, minutes, **options.coverage), screens.language_days(langs), previous,
        )
        flagged = store.scratch("flagged", flagged, seq)
        store.write("history", finalize.history_of(flagged).orderBy("uid", "change_date"), seq, options.groups[1])
        iso = places(cells.select("cell").distinct()) if places else spark.createDataFrame([], "cell long, iso string")
        store.write("suspects", finalize.suspects(flagged, finalize.countries_of_days(cells, iso, flagged.where("suspect_flag <> 0"))), seq)
        store.commit()
        _publish(store, options)
        return seq


def _node_state(store: Store, base: DataFrame, overlay: DataFrame, deleted: DataFrame, options: Options, seq: int) -> None:
    """Overlay and tombstones beside the base, until they are a tenth of it; then they are folded in."""
    none = store.spark.createDataFrame
    if incremental.compaction_due(base.count(), overlay.count(), deleted.count(), options.compact):
        store.write("nodes", cube.compacted(base, overlay, deleted), seq)
        overlay, deleted = none([], NODES), none([], NODE)
    store.write("overlay", overlay, seq)
    store.write("deleted", deleted, seq)


def _tag_state(store: Store, rows: DataFrame, options: Options, seq: int, fold) -> DataFrame:
    """Language events of the diffs, folded, and the remembered tags after them: what was touched since the base lies beside it, as the nodes do."""
    base, over, touched = store.read("tags", TAGS), store.read("tags_over", TAGS), store.read("tags_touched", OBJECTS)
    key = ["type", "id"]
    here = store.scratch("objects", rows.select(*key).distinct(), seq)
    prior = store.scratch("prior_tags", base.join(touched, key, "left_anti").unionByName(over).join(here, key, "left_semi"), seq)
    ordered = rows.withColumn("_v", F.row_number().over(Window.partitionBy("type", "id").orderBy("ord")))
    found = screens.language_events(ordered.withColumn("version", F.when(F.col("version") == 1, 1).otherwise(F.col("_v") + 1)), prior).where("lang <> ''")
    langs = fold("langs", screens.language_counts(found).withColumn("span", _span(F.col("day"))), ["uid", "day", "lang"])
    over = over.join(here, key, "left_anti").unionByName(screens.last_tags(rows.withColumn("version", F.col("ord"))))
    touched = touched.unionByName(here).distinct()
    over, touched = store.write("tags_over", over, seq), store.write("tags_touched", touched, seq)
    if incremental.compaction_due(base.count(), over.count(), touched.count(), options.compact):
        store.write("tags", base.join(touched, key, "left_anti").unionByName(over), seq)
        store.write("tags_over", store.spark.createDataFrame([], TAGS), seq)
        store.write("tags_touched", store.spark.createDataFrame([], OBJECTS), seq)
    return langs


def _centres(rows: DataFrame) -> DataFrame:
    """A row a year: the centres of its cells, added up by count, and its days."""
    cells = rows.groupBy("year", "cell").agg(F.sum("count").alias("n"), F.min("day").alias("a"), F.max("day").alias("z")).withColumn("c", hexgrid.centre_of(F.col("cell")))
    weighted = lambda c: F.sum(F.col(f"c.{c}") * F.col("n")).alias(c)
    return cells.groupBy("year").agg(weighted("lat"), weighted("lon"), F.sum("n").alias("count"), F.min("a").alias("first_day"), F.max("z").alias("last_day")).select(*CENTRES.names)


def _new_centres(store: Store, seq: int) -> None:
    """Only the touched years are read again."""
    years = [k.removeprefix("cube/") for k in store.moves if k.startswith("cube/")]
    old = store.read("centres", CENTRES).where(~F.col("year").cast("string").isin(years))
    store.write("centres", old.unionByName(_centres(store.read_parts("cube", CUBE, "year", years, new=True))), seq)


def _publish(store: Store, options: Options) -> None:
    """Feed and manifest of what the ledger says, unless they are there already."""
    spark, out, seq = store.spark, options.output, store.ledger.applied("history")
    path = f"{out}/manifest.json"
    source = options.source | {"sequence_number": seq}
    if fs.exists(spark, path) and files.manifest_source(fs.read_text(spark, path)).get("sequence_number") == seq and fs.exists(spark, f"{out}/suspect.atom") == store.ledger.known("suspects"):
        return
    if store.ledger.known("suspects"):  # an import has none
        publish.feed(store.read("suspects", schemas.SUSPECTS), f"{out}/suspect.atom")
    got = store.read("centres", CENTRES).agg(F.sum("lat").alias("lat"), F.sum("lon").alias("lon"), F.sum("count").alias("n"), F.min("first_day").alias("a"), F.max("last_day").alias("z")).first()
    years = {y: publish.files_of(spark, f) for y, f in store.folders("cube", "year").items()}
    singles = {name: publish.files_of(spark, store.path(name)) for name in ("history", "ranking", "suspects")}
    publish.manifest(spark, path, options.resolution, source, (got.lat / got.n, got.lon / got.n) if got.n else None, None if got.a is None else (got.a, got.z), {"changes": years}, singles)
