"""Labels and escapes for exports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Flag bits of a user's day (fixed values).
BURST, MOVE, LOW_RANK, SPREAD, COVERAGE, LANGUAGE = 0x01, 0x02, 0x04, 0x08, 0x10, 0x20
#: (bit, term) in the feed's order (fixed values).
FEED_TERMS = ((BURST, "filter-2"), (MOVE, "filter-3"), (LOW_RANK, "filter-1"), (SPREAD, "filter-4"), (COVERAGE, "filter-5"), (LANGUAGE, "name-language"))


def escape_xml(c: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def url_encode(c: Column) -> Column:
    """Percent-encoding of all but letters, digits, - _ . and ~."""
    return F.replace(F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def country_label(code: Column) -> Column:
    """Flag of a two-letter code, a space and the code; other codes as they are."""
    up = F.upper(code)
    half = lambda i: F.decode(F.unhex(F.concat(F.lit("F09F87"), F.hex(F.ascii(F.substring(up, i, 1)) - 65 + 0xA6))), "UTF-8")
    return F.when(F.length(code) == 2, F.concat(half(1), half(2), F.lit(" "), code)).otherwise(code)


def distance_label(meters: Column) -> Column:
    """Metres below 1 km, else km with six significant digits and at least one decimal."""
    km = meters / 1000
    digits = F.when(km >= 10_000, 1).when(km >= 1000, 2).when(km >= 100, 3).when(km >= 10, 4).otherwise(5)
    text = F.regexp_replace(F.when(digits == 1, F.format_string("%.1f", km)).when(digits == 2, F.format_string("%.2f", km)).when(digits == 3, F.format_string("%.3f", km)).when(digits == 4, F.format_string("%.4f", km)).otherwise(F.format_string("%.5f", km)), "(\\.\\d+?)0+$", "$1")
    return F.when(meters >= 1000, F.concat(text, F.lit(" km"))).otherwise(F.concat(meters.cast("string"), F.lit(" m")))


def filter_terms(flag: Column) -> Column:
    """Names of the set bits, in the feed's order."""
    return F.array_compact(F.array(*(F.when(flag.bitwiseAND(F.lit(b)) != 0, F.lit(n)) for b, n in FEED_TERMS)))


def points(pct: Column, cap: int) -> Column:
    return F.round(pct * cap / 100, 2)


def percentile_label(total: Column, active: Column, pct: Column) -> Column:
    return F.when(total <= 0, "no activity").when(active == 1, "only contributor").when(pct >= 100, "best").when(pct <= 0, "lowest").otherwise(F.concat(F.lit("above "), F.floor(pct).cast("string"), F.lit("%")))


def colour(count: Column, log: bool = False) -> Column:
    """The stop of the colour ramp that a count has reached."""
    value = F.greatest(F.lit(0.0), F.log10(count)) if log else count
    stops = (3, 2.3, 1.7, 1) if log else (1000, 200, 50, 10)
    out = F.when(value >= stops[0], RAMP[4])
    for s, c in zip(stops[1:], RAMP[3:0:-1], strict=True):
        out = out.when(value >= s, c)
    return out.otherwise(RAMP[0])


#: Colours of the ramp (fixed values).
RAMP = ("#ffffb2", "#fecc5c", "#fd8d3c", "#e31a1c", "#800026")


def update_identity(url: Column) -> Column:
    """Name of the extract that an http(s) update address serves: its last folder, without -updates."""
    path = F.regexp_replace(F.when(url.rlike("^https?://"), F.try_parse_url(url, F.lit("PATH"))), "/+$", "")
    return F.nullif(F.regexp_replace(F.regexp_extract(path, "([^/]+)$", 1), "-updates$", ""), F.lit(""))


def unescape_timestamp(c: Column) -> Column:
    """State files put a backslash before some characters."""
    return F.regexp_replace(c, r"\\(.)", "$1")
