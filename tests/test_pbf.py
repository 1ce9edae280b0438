import struct
import threading
import zlib
from functools import partial
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer

import pytest

from driftline.sources import fetch, pbf


def vi(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def zz(n):
    return vi((n << 1) ^ (n >> 63))


def num(k, n):
    return vi(k << 3) + vi(n)


def sub(k, b):
    return vi(k << 3 | 2) + vi(len(b)) + b


def delta(values):
    return b"".join(zz(b - a) for a, b in zip([0, *values], values, strict=False))


def block(strings, *groups):
    return sub(1, b"".join(sub(1, s.encode()) for s in strings)) + b"".join(sub(2, g) for g in groups)


def blob(kind, raw, deflate=True):
    body = num(2, len(raw)) + sub(3, zlib.compress(raw)) if deflate else sub(1, raw)
    head = sub(1, kind.encode()) + num(3, len(body))
    return struct.pack(">I", len(head)) + head + body


def test_history_file(spark, tmp_path):
    names = ["", "alice", "bob", "highway", "primary"]
    info = sub(1, vi(1) + vi(2)) + sub(2, delta([1_577_836_800, 1_577_836_860])) + sub(3, delta([1, 2])) + sub(4, delta([10, 11])) + sub(5, delta([1, 2])) + sub(6, vi(1) + vi(0))
    dense = sub(1, delta([7, 7])) + sub(5, info) + sub(8, delta([15_000_000, 0])) + sub(9, delta([-25_000_000, 0])) + sub(10, vi(3) + vi(4) + vi(0) + vi(0))
    meta = num(1, 3) + num(2, 1_577_836_900) + num(4, 10) + num(5, 1) + num(6, 1)
    way = num(1, 5) + sub(2, vi(3)) + sub(3, vi(4)) + sub(4, meta) + sub(8, delta([7, 9, 8]))
    relation = num(1, 6) + sub(4, meta)
    data = blob("OSMHeader", b"") + blob("OSMData", block(names, sub(2, dense))) + blob("OSMData", block(names, sub(3, way), sub(4, relation)), False)
    (tmp_path / "h.pbf").write_bytes(data)
    pbf.register(spark)
    got = spark.read.format("history_pbf").load(str(tmp_path / "h.pbf")).orderBy("type", "version").collect()
    assert [(r.type, r.id, r.version, r.visible, r.uid, r.user, r.lat, r.lon, [tuple(t) for t in r.tags], r.refs) for r in got] == [
        ("node", 7, 1, True, 10, "alice", 1.5, -2.5, [("highway", "primary")], []), ("node", 7, 2, False, 11, "bob", None, None, [], []),
        ("relation", 6, 3, True, 10, "alice", None, None, [], []), ("way", 5, 3, True, 10, "alice", None, None, [("highway", "primary")], [7, 9, 8]),
    ]
    assert spark.read.format("history_pbf").option("kinds", "way").load(str(tmp_path / "h.pbf")).count() == 1


@pytest.fixture
def server(tmp_path):
    class Quiet(SimpleHTTPRequestHandler):
        def log_message(self, *_):
            pass

    (tmp_path / "www/000/000").mkdir(parents=True)
    (tmp_path / "www/state.txt").write_text("sequenceNumber=3\ntimestamp=2024-01-01T00\\:00\\:00Z\n")
    for n in (1, 2):
        (tmp_path / f"www/000/000/00{n}.osc.gz").write_bytes(b"x")
    s = ThreadingHTTPServer(("127.0.0.1", 0), partial(Quiet, directory=str(tmp_path / "www")))
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_fetch(server, tmp_path):
    assert fetch.current_state(server, str(tmp_path / "f"))["sequenceNumber"] == "3"
    assert fetch.diffs(server, str(tmp_path / "f"), [1, 2, 3]) == [1, 2]
    assert sorted(p.name for p in (tmp_path / "f").iterdir()) == ["1.osc.gz", "2.osc.gz", "state.txt"]
