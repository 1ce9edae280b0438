import json
import os
import shutil

import pytest

from driftline import cli, schemas
from driftline.functions import hexgrid
from driftline.operators import cube, screens
from driftline.plans import runner
from driftline.sources import files

HEAD = '<?xml version="1.0"?><osmChange version="0.6">'


def osc(path, seq, body):
    (path / f"{seq}.osc").write_text(f"{HEAD}{body}</osmChange>")


def snapshot(spark):
    rows = [
        ("node", 1, 1, True, "2020-01-01 00:00:00", 10, "alice", 1.0, 1.0, [("amenity", "cafe")], []),
        ("node", 2, 1, True, "2020-01-01 00:00:00", 10, "alice", 2.0, 2.0, [], []),
        ("node", 2, 2, False, "2020-01-03 00:00:00", 11, "", None, None, [], []),
        ("way", 5, 1, True, "2020-01-02 00:00:00", 10, "alice", None, None, [("name", "Main"), ("name:de", "Haupt")], [1, 2, 2, 77]),
        ("relation", 9, 1, True, "2020-01-02 00:00:00", 11, "", None, None, [], []),
    ]
    df = spark.createDataFrame(rows, "type string, id long, version int, visible boolean, t string, uid long, user string, lat double, lon double, tags array<struct<k:string,v:string>>, refs array<long>")
    return df.selectExpr("type", "id", "version", "visible", "cast(t as timestamp) ts", "uid", "user", "lat", "lon", "tags", "refs")


def cube_of(spark, out):
    return {(r.cell, r.day): r["count"] for r in runner.whole_cube(runner.Store(spark, out)).collect()}


def alive_nodes(spark, out):
    store = runner.Store(spark, out)
    return sorted(tuple(r) for r in cube.compacted(store.read("nodes", runner.NODES), store.read("overlay", runner.NODES), store.read("deleted", runner.NODE)).collect())


def test_import_and_updates(spark, tmp_path):
    out, diffs = str(tmp_path / "out"), tmp_path / "diffs"
    diffs.mkdir()
    options = runner.Options(out, 9, {"url": "u"}, over=1)
    runner.run_import(spark, snapshot(spark), options, 100)
    a, b = (int(hexgrid.cells([x], [x], 9)[0]) for x in (1.0, 2.0))
    first = {(a, 18_262): 1, (b, 18_262): 1, (b, 18_264): 1, (a, 18_263): 1, (b, 18_263): 1}
    assert cube_of(spark, out) == first
    store = runner.Store(spark, out)
    assert {r.uid: (r["count"], r.suspect_flag) for r in store.read("history", schemas.HISTORY).where("change_date = 18262").collect()} == {10: (2, 0)}
    assert alive_nodes(spark, out) == [(1, a)] and not os.path.exists(f"{out}/suspect.atom")

    osc(diffs, 101, '<modify><node id="1" version="2" timestamp="2024-01-01T00:00:30Z" uid="12" user="carol" lat="1.5" lon="1.0"/><way id="5" version="2" timestamp="2024-01-01T00:01:00Z" uid="12" user="carol"><nd ref="1"/><tag k="name" v="Main"/></way></modify>')
    osc(diffs, 102, '<delete><node id="1" version="3" timestamp="2024-01-01T02:00:00Z" uid="13" user="dan"/></delete><create><node id="8" version="1" timestamp="2024-01-01T02:00:30Z" uid="13" user="dan" lat="2" lon="2"/></create>')
    osc(diffs, 104, '<create><node id="99" version="1" timestamp="2024-02-01T02:00:30Z" uid="13" user="dan" lat="2" lon="2"/></create>')
    changes = files.change_documents(spark, str(diffs))
    assert runner.run_update(spark, changes, options, lambda cells: cells.selectExpr("cell", "'AA' iso")) == 102
    moved = int(hexgrid.cells([1.5], [1.0], 9)[0])
    after = first | {(moved, 19_723): 2, (b, 19_723): 1}  # both diffs are one batch: the way finds its node gone
    assert cube_of(spark, out) == after
    store = runner.Store(spark, out)
    got = {(r.uid, r.change_date): r for r in store.read("suspects", schemas.SUSPECTS).collect()}
    carol = got[12, 19_723]
    # a burst of two in an hour, a far move, a low rank and a lost name variant
    assert carol.suspect_flag == 1 | 2 | 4 | 32 and carol.max_edits_per_hour == 2 and carol.far_move_count == 1 and 55_000 < carol.max_move_meters < 56_500 and carol.countries == ["AA"] and carol.name_lang_events == 1
    assert {n for n, _ in alive_nodes(spark, out)} == {8}
    m = json.loads(open(f"{out}/manifest.json").read())
    assert m["source"] == {"url": "u", "sequence_number": 102} and m["date_range"] == {"min_date": "2020-01-01", "max_date": "2024-01-01"} and m["datasets"]["changes"]["partitions"] == ["2020", "2024"]
    assert "carol" in open(f"{out}/suspect.atom").read()

    # again: nothing to do; a lost feed and manifest come back; then the missing diff comes, and both are applied
    os.remove(f"{out}/manifest.json")
    assert runner.run_update(spark, changes, options) == 102 and cube_of(spark, out) == after
    osc(diffs, 103, '<create><node id="98" version="1" timestamp="2024-02-01T02:00:30Z" uid="12" user="carol" lat="1" lon="1"/></create>')
    assert runner.run_update(spark, files.change_documents(spark, str(diffs)), options, most=1) == 103
    assert runner.run_update(spark, files.change_documents(spark, str(diffs)), options) == 104
    assert cube_of(spark, out) == after | {(a, 19_754): 1, (b, 19_754): 1}
    again = {(r.uid, r.change_date): r for r in runner.Store(spark, out).read("suspects", schemas.SUSPECTS).collect()}
    assert again[12, 19_723].suspect_flag == carol.suspect_flag and again[12, 19_723].far_move_count == 1 and again[12, 19_723].ranking_at_day == carol.ranking_at_day


class Stopped(Exception):
    pass


def state_of(spark, out):
    """All that updates start from, whatever folder it is in."""
    store = runner.Store(spark, out)
    flat = lambda df: sorted(str(tuple(r)) for r in df.collect())
    tables = {n: flat(store.read_parts(n, s, "span").drop("span")) for n, s in runner.SPANS.items()}
    tables |= {n: flat(store.read(n, s)) for n, s in (("history", schemas.HISTORY), ("suspects", schemas.SUSPECTS), ("totals", runner.TOTALS))}
    tags = store.read("tags", runner.TAGS).join(store.read("tags_touched", runner.OBJECTS), ["type", "id"], "left_anti").unionByName(store.read("tags_over", runner.TAGS))
    return tables | {"cube": cube_of(spark, out), "nodes": alive_nodes(spark, out), "tags": flat(tags), "applied": store.ledger.applied("history"), "manifest": json.load(open(f"{out}/manifest.json"))["spatial_center"]}


@pytest.fixture(scope="module")
def imported(spark, tmp_path_factory):
    """An import, diffs in two folders (with and without a newer one), and the state after an update that nothing stops."""
    root = tmp_path_factory.mktemp("stops")
    options = runner.Options(str(root / "base"), 9, over=1)
    runner.run_import(spark, snapshot(spark), options, 100)
    body = {
        101: '<modify><node id="1" version="2" timestamp="2024-01-01T00:00:30Z" uid="12" user="carol" lat="1.5" lon="1.0"/><way id="5" version="2" timestamp="2024-01-01T00:01:00Z" uid="12" user="carol"><nd ref="1"/><tag k="name" v="Main"/></way></modify>',
        102: '<delete><node id="1" version="3" timestamp="2024-01-01T02:00:00Z" uid="13" user="dan"/></delete><create><node id="8" version="1" timestamp="2024-01-01T02:00:30Z" uid="13" user="dan" lat="2" lon="2"/></create>',
        103: '<modify><node id="8" version="2" timestamp="2024-01-01T02:10:00Z" uid="12" user="carol" lat="3" lon="2"/></modify>',
    }
    for k in (102, 103):
        (root / f"to{k}").mkdir()
        for s in range(101, k + 1):
            osc(root / f"to{k}", s, body[s])
    want = {}
    for k in (102, 103):
        out = str(root / f"whole{k}")
        shutil.copytree(root / "base", out)
        assert runner.run_update(spark, files.change_documents(spark, str(root / f"to{k}")), runner.Options(out, 9, over=1)) == k
        want[k] = state_of(spark, out)
    return root, want


@pytest.mark.parametrize("where,newer", [("cube", True), ("suspects", False), ("commit", True), ("publish", False)])
def test_a_stop_and_a_rerun_count_once(spark, imported, tmp_path, monkeypatch, where, newer):
    root, want = imported
    out = str(tmp_path / "out")
    shutil.copytree(root / "base", out)
    options = runner.Options(out, 9, over=1)
    with monkeypatch.context() as m:
        if where == "commit":
            m.setattr(runner.Store, "commit", lambda self: (_ for _ in ()).throw(Stopped()))
        elif where == "publish":
            m.setattr(runner, "_publish", lambda *_: (_ for _ in ()).throw(Stopped()))
        else:
            for kind in ("write", "write_parts"):

                def stop(self, name, *a, _f=getattr(runner.Store, kind), **k):
                    got = _f(self, name, *a, **k)
                    if name == where:
                        raise Stopped
                    return got

                m.setattr(runner.Store, kind, stop)
        with pytest.raises(Stopped):
            runner.run_update(spark, files.change_documents(spark, str(root / "to102")), options)
    last = 103 if newer else 102
    assert runner.run_update(spark, files.change_documents(spark, str(root / f"to{last}")), options) == last
    assert state_of(spark, out) == want[last]


def test_updates_one_by_one_equal_one(spark, imported, tmp_path, monkeypatch):
    """State beside the base carries over, and is folded in when it has grown; each diff is a batch of its own."""
    root, _ = imported
    states = []
    for most, compact in ((None, True), (1, False)):
        monkeypatch.setattr(runner.incremental, "compaction_due", lambda *_, _c=compact: _c)
        out = str(tmp_path / f"out{most}{compact}")
        shutil.copytree(root / "base", out)
        options = runner.Options(out, 9, over=1, span=0)
        for _ in range(3 if most else 1):
            runner.run_update(spark, files.change_documents(spark, str(root / "to103")), options, most=most)
        states.append({k: v for k, v in state_of(spark, out).items() if k not in ("suspects", "history")})  # flags are judged at each update
        assert (runner.Store(spark, out).ledger.applied("nodes") > 100) == compact
    assert states[0] == states[1]


def test_a_lost_table_is_an_error(spark, imported, tmp_path):
    root, _ = imported
    out = str(tmp_path / "out")
    shutil.copytree(root / "base", out)
    shutil.rmtree(f"{out}/history")
    with pytest.raises(FileNotFoundError):
        runner.run_update(spark, files.change_documents(spark, str(root / "to102")), runner.Options(out, 9, over=1))
    with pytest.raises(FileNotFoundError):
        runner.run_update(spark, files.change_documents(spark, str(root / "to102")), runner.Options(str(tmp_path / "none"), 9))


def test_guards(spark):
    day = snapshot(spark).limit(1).selectExpr("type", "id", "version", "visible", "timestamp '1969-12-31 00:00:00' ts", "uid", "user", "lat", "lon", "tags", "refs")
    many = snapshot(spark).limit(1).selectExpr("type", "id", "version", "visible", "ts", "uid", "user", "lat", "lon", "transform(sequence(1, 65536), x -> struct('k' k, 'v' v)) tags", "refs")
    for bad, said in ((day, "day out of range"), (many, "tags")):
        with pytest.raises(Exception, match=said):
            runner.prepared(bad, 9).collect()
    with pytest.raises(Exception, match="language code"):
        screens.language_counts(spark.createDataFrame([(1, 2, "x" * 256)], "uid long, day int, lang string")).collect()


def test_a_way_sees_the_batch_end(spark, tmp_path):
    """A way on a node that moves later in the same batch counts where the node ends; in batches of their own, where it was."""
    body = {101: '<create><node id="1" version="1" timestamp="2024-01-01T00:00:00Z" uid="1" user="a" lat="1" lon="1"/><way id="5" version="1" timestamp="2024-01-01T00:01:00Z" uid="1" user="a"><nd ref="1"/></way></create>', 102: '<modify><node id="1" version="2" timestamp="2024-01-01T00:02:00Z" uid="1" user="a" lat="3" lon="3"/></modify>'}
    (tmp_path / "d").mkdir()
    for s, x in body.items():
        osc(tmp_path / "d", s, x)
    a, c = (int(hexgrid.cells([x], [x], 9)[0]) for x in (1.0, 3.0))
    for span, want in ((3_600, {a: 1, c: 2}), (0, {a: 2, c: 1})):
        out = str(tmp_path / f"o{span}")
        options = runner.Options(out, span=span)
        runner.run_import(spark, snapshot(spark).limit(0), options, 100)
        runner.run_update(spark, files.change_documents(spark, str(tmp_path / "d")), options)
        assert {k[0]: v for k, v in cube_of(spark, out).items()} == want


def test_command_line(capsys):
    got = cli.parse(["update", "5", "--diffs", "d", "--output-dir", "o"])
    assert (got.count, got.diffs, got.output_dir, got.h3_resolution) == (5, "d", "o", 9)
    assert cli.main(["help"]) == 0 and "prepare-update" in capsys.readouterr().out
    for bad in (["update", "0", "--diffs", "d"], ["prepare-update"], ["import"], ["import", "x", "--h3-resolution", "15"], ["else"], ["import", "x", "--change-group-rows", "999"], ["update", "--diffs", "d", "--cookie", "c"], ["update", "--country-names", "n"]):
        with pytest.raises(SystemExit):
            cli.parse(bad)
