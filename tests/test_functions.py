import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.functions import geo, names, text, time


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_days(spark):
    assert one(spark, time.day_of_seconds("1704067260"), time.minute_of_seconds("1704067260"), time.day_of_seconds("-1")) == (19_723, 28_401_121, 0)
    assert one(spark, time.iso_date(F.lit(19_723)), time.year_of_day(F.lit(19_722)), time.day_of_iso(F.lit("2024-01-01"))) == ("2024-01-01", 2023, 19_723)
    assert time.epoch_day("2024-01-01") == 19_723 and time.day_key(19_723) == "2024-01-01"
    assert time.months_in_range("2023-11-15", "2024-02-01") == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert time.default_window("2024-02-10") == ("2023-11-01", "2024-02-10")


def test_haversine(spark):
    d = lambda *x: geo.haversine_m(*(F.lit(float(v)) for v in x))
    a, b, c = one(spark, d(0, 0, 1, 0), d(0, 0, 0, 2), d(10, 10, 10, 10))
    assert abs(a - 111_195) < 50 and abs(b - 222_389) < 50 and c == 0


def test_packed_cells(spark):
    cell = 0x89283470D93FFFF
    assert one(spark, geo.unpack_cell(geo.pack_cell(F.lit(cell)), 9)) == (cell,)
    assert len(geo.HEXAGON_KM2) == 14 and abs(geo.hexagon_km2(9) - 0.105) < 0.001


def test_s2_cells(spark):
    lat, lon = np.array([0.0, 48.8737917, -33.8567844, 89.9]), np.array([0.0, 2.2950275, 151.2152967, 10.0])
    leaf = geo.s2_leaf(lat, lon)
    assert [hex(x)[:10] for x in leaf.view(np.uint64)[:3]] == ["0x10000000", "0x47e66fec", "0x6b12ae66"]
    up = one(spark, geo.s2_ancestor(F.lit(int(leaf[1])), 10), geo.s2_ancestor(F.lit(int(leaf[1])), 30))
    assert up[1] == leaf[1] and one(spark, geo.s2_low_bit(F.lit(up[0]))) == (1 << 40,)
    near = geo.s2_leaf(np.array([48.87380]), np.array([2.29503]))
    assert one(spark, geo.s2_ancestor(F.lit(int(near[0])), 10)) == (up[0],)


def test_levenshtein_counts_bytes(spark):
    d = lambda a, b: names.levenshtein_bounded(F.lit(a), F.lit(b), 2)
    assert one(spark, d("kitten", "sitten"), d("kitten", "sitting"), d("日", "a"), d("", "ab")) == (1, 3, 3, 2)


def test_name_keys(spark):
    assert one(spark, names.name_lang(F.lit("alt_name:fr")), names.name_lang(F.lit("name")), names.wiki_lang(F.lit("wikipedia:de")), names.wiki_lang(F.lit("wikipedia"))) == ("fr", None, "de", None)


def test_labels(spark):
    assert one(spark, text.escape_xml(F.lit("<a&'\">")), text.url_encode(F.lit("a b*~é")), text.country_label(F.lit("FR")), text.country_label(F.lit("XYZ"))) == ("&lt;a&amp;&#39;&quot;&gt;", "a%20b%2A~%C3%A9", "\U0001f1eb\U0001f1f7 FR", "XYZ")
    assert one(spark, text.distance_label(F.lit(999)), text.distance_label(F.lit(1000)), text.distance_label(F.lit(12_345)), text.distance_label(F.lit(157_249))) == ("999 m", "1.0 km", "12.345 km", "157.249 km")
    assert one(spark, text.filter_terms(F.lit(0x27))) == (["filter-2", "filter-3", "filter-1", "name-language"],)
    label = lambda t, a, p: text.percentile_label(F.lit(t), F.lit(a), F.lit(p))
    assert one(spark, label(0, 3, 0.0), label(1, 1, 100.0), label(1, 3, 100.0), label(1, 3, 0.0), label(1, 3, 66.67)) == ("no activity", "only contributor", "best", "lowest", "above 66%")
    assert one(spark, text.points(F.lit(66.67), 20), text.colour(F.lit(60)), text.colour(F.lit(1), log=True)) == (13.33, "#fd8d3c", "#ffffb2")
    assert one(spark, text.update_identity(F.lit("https://x.org/europe/malta-updates/")), text.update_identity(F.lit("ftp://x")), text.unescape_timestamp(F.lit("20\\:24"))) == ("malta", None, "20:24")


@pytest.mark.parametrize("res", [0, 9, 13])
def test_areas_shrink(res):
    assert res == 13 or geo.hexagon_km2(res) > 6 * geo.hexagon_km2(res + 1)
