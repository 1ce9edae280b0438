"""URL filters: explicit host and path rules, else a tree of path templates per host. DataFrame and SQL functions only.

A rule fits its host and all subdomains, if the path starts with the rule's; the longest wins. Rows that a rule judges are
the labels of the method. Per host, the paths form a tree of segments:

1. Distinct (host, path pattern) pairs are counted first, numbers and long hex runs being wildcards already; so a hot host
   shrinks to its patterns before anything is dealt by key.
2. Level by level, a template with many children (over MANY, or over half as many as it has urls and at least FEW) has
   them generalised into one wildcard.
3. Branches whose labelled block shares do not differ from their parent's by more than two standard errors are merged into one: their labels are
   pooled, and the next level is grown from all of their urls together. Branches without labels stay alone.
4. A template is rejected if it has at least LEAST labels and its purity, smoothed by its host's share, which is smoothed
   by the share of all hosts, reaches PURITY. A url is blocked if any template on its way down is rejected.

The tree grows as deep as the paths go. A template is not grown further where it is rejected, or where no part of its labels could make a template
below it pure enough: so long urls without blocked labels cost nothing, and the number of levels is the depth of labelled paths.

Null urls and those without :// have empty host and path, no rule, and are allowed by the method; so are urls of any length that
have no path. Ids may be null or repeat: each row is judged. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
MANY, FEW, LEAST, PURITY, WEIGHT = 64, 8, 3, 0.8, 2.0
VARIABLE = r"(?s)^([0-9]+([.][a-z]+)?|[0-9a-f]*[0-9][0-9a-f]{7,}|.*[0-9]{4,}.*)\z"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    shape = "(?s)^.*?://([^/?#]*)([^?#]*)"
    get = lambda k: F.coalesce(F.regexp_extract(url, shape, k), F.lit(""))
    return F.translate(get(1), UPPER, LOWER), get(2)


def rule_of(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and what it says."""
    name = said = None
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        h, slash, rest = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + rest)
        name = F.when(fits, F.lit(rule)) if name is None else name.when(fits, F.lit(rule))
        said = F.when(fits, F.lit(verdict)) if said is None else said.when(fits, F.lit(verdict))
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, said)


def _purity(lab: Column, blk: Column, prior: Column) -> Column:
    return (blk + WEIGHT * prior) / (lab + WEIGHT)


def _hopeful(blk: Column, prior: Column) -> Column:
    """Whether some part of the labels, at best only the blocked ones, could make a template that is rejected."""
    return (blk > 0) & (_purity(F.greatest(blk, F.lit(LEAST)), blk, prior) >= PURITY)


def _grown(live: DataFrame, hosts: DataFrame, depth: int) -> DataFrame:
    """host, tpl, seg of each branch of the level, with the template it belongs to (next), and whether that is rejected (bad) or grown further (grow)."""
    up = ["host", "tpl"]
    kids = common.written(live.groupBy(*up, F.get("segs", F.lit(depth)).alias("seg")).agg(F.sum("n").alias("n"), F.sum("lab").alias("lab"), F.sum("blk").alias("blk")), "kids")
    wide = kids.groupBy(*up).agg(F.count("seg").alias("kids"), F.sum("n").alias("urls")).select(*up, ((F.col("kids") > MANY) | ((F.col("kids") >= FEW) & (F.col("kids") * 2 > F.col("urls")))).alias("wide"))
    kids = common.written(kids.join(wide, up).withColumn("key", F.when(F.col("wide"), "*").otherwise(F.col("seg"))).drop("wide"), "kids")
    node = kids.groupBy(*up, "key").agg(F.sum("lab").alias("lab"), F.sum("blk").alias("blk"))
    pool = kids.groupBy(*up).agg(F.sum("lab").alias("pl"), F.sum("blk").alias("pb"))
    lab0, pl0 = F.nullif("lab", F.lit(0)), F.nullif("pl", F.lit(0))
    share = F.col("pb") / pl0
    error = F.sqrt(share * (1 - share) * (1 / lab0 + 1 / pl0))
    alike = (F.col("lab") > 0) & (F.abs(F.col("blk") / lab0 - share) <= 2 * error + 1e-9)
    # no segment has a slash: the name of merged branches is no segment's
    node = common.written(node.join(pool, up).withColumn("name", F.when(F.coalesce(alike, F.lit(False)), "/").otherwise(F.col("key"))).select(*up, "key", "name", "lab", "blk"), "nodes")
    merged = node.groupBy(*up, "name").agg(F.sum("lab").alias("lab"), F.sum("blk").alias("blk")).join(hosts.select("host", "ph"), "host")
    bad = (F.col("lab") >= LEAST) & (_purity(F.col("lab"), F.col("blk"), F.col("ph")) >= PURITY)
    merged = common.written(merged.select(*up, "name", bad.alias("bad"), (~bad & _hopeful(F.col("blk"), F.col("ph"))).alias("grow")), "merged")
    found = kids.select(*up, "seg", "key").join(node.select(*up, "key", "name"), [*up, "key"]).join(merged, [*up, "name"])
    return common.written(found.select(*up, "seg", F.concat_ws("/", "tpl", "name").alias("next"), "bad", "grow"), "level")


def rejected(shapes: DataFrame) -> DataFrame:
    """host, segs of the paths with a rejected template, of rows (host, segs, n, lab, blk)."""
    total = shapes.agg(((F.sum("blk") + 1) / (F.sum("lab") + 2)).alias("p0"))
    hosts = shapes.groupBy("host").agg(F.sum("lab").alias("hl"), F.sum("blk").alias("hb")).crossJoin(F.broadcast(total))  # one row
    hosts = common.written(hosts.select("host", "hb", ((F.col("hb") + WEIGHT * F.col("p0")) / (F.col("hl") + WEIGHT)).alias("ph")), "hosts")
    open_ = hosts.where(_hopeful(F.col("hb"), F.col("ph"))).select("host")
    live = common.written(shapes.join(open_, "host", "left_semi").where(F.size("segs") > 0).withColumn("tpl", F.lit("")), "tree")
    found, depth = shapes.select("host", "segs").limit(0), 0
    while not live.isEmpty():
        level = _grown(live, hosts, depth)
        depth += 1
        step = live.withColumn("seg", F.get("segs", F.lit(depth - 1))).join(level, ["host", "tpl", "seg"])
        step = common.written(step.where(F.col("bad") | (F.col("grow") & (F.size("segs") > depth))).select("host", "segs", "n", "lab", "blk", F.col("next").alias("tpl"), "bad"), "tree")
        found = found.unionByName(step.where("bad").select("host", "segs"))
        live = step.where(~F.col("bad")).drop("bad")
    return found


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict of each row."""
    host, path = parts(F.col(url_col))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, said = rule_of(rules, F.col("host"), F.col("path"))
    segs = F.transform(F.filter(F.split("path", "/+"), lambda x: x != ""), lambda x: F.when(x.rlike(VARIABLE), "*").otherwise(x))
    rows = rows.select("*", rule.alias("rule"), said.alias("said"), segs.alias("segs"))
    shapes = rows.groupBy("host", "segs").agg(F.count(F.lit(1)).alias("n"), F.count("said").alias("lab"), F.sum(F.when(F.col("said") == "block", 1).otherwise(0)).alias("blk"))
    found = common.written(rejected(common.written(shapes, "shapes")).withColumn("reject", F.lit(True)), "rejected")
    method = F.when(F.col("reject"), "block").otherwise("allow")
    return rows.join(found, ["host", "segs"], "left").select(id_col, "host", "path", "rule", F.coalesce("said", method).alias("verdict"))


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(common.table(spark, sf_dir, "pages"))


#: SQL has no loop over grouped levels: it is written out for so many, and fails on a deeper path.
SQL_LEVELS = 6


def _sql() -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[0]))
    rule = "CASE " + " ".join(f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '/{p}') THEN '{h}/{p}'" for h, p in (r[0].split("/", 1) for r in ordered)) + " END"
    said = "CASE rule " + " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES) + " END"
    shape = "'(?s)^.*?://([^/?#]*)([^?#]*)'"
    steps = [
        f"a AS (SELECT page_id, translate(coalesce(regexp_extract(url, {shape}, 1), ''), '{UPPER}', '{LOWER}') AS host, coalesce(regexp_extract(url, {shape}, 2), '') AS path FROM pages)",
        f"b AS (SELECT *, {rule} AS rule FROM a)",
        f"""r AS (SELECT *, {said} AS said, list_transform(list_filter(string_split_regex(path, '/+'), lambda x: x <> ''),
          lambda x: CASE WHEN regexp_matches(x, '{VARIABLE}') THEN '*' ELSE x END) AS segs FROM b)""",
        f"""shapes AS (SELECT host, CASE WHEN len(segs) > {SQL_LEVELS} THEN error('a path is deeper than this SQL') ELSE segs END AS segs,
          count(*) AS n, count(said) AS lab, count(*) FILTER (WHERE said = 'block') AS blk FROM r GROUP BY ALL)""",
        "tot AS (SELECT (sum(blk) + 1) / (sum(lab) + 2) AS p0 FROM shapes)",
        f"hosts AS (SELECT host, (sum(blk) + {WEIGHT} * any_value(p0)) / (sum(lab) + {WEIGHT}) AS ph FROM shapes, tot GROUP BY host)",
        "f0 AS (SELECT *, '' AS tpl, false AS reject FROM shapes)",
    ]
    for d in range(1, SQL_LEVELS + 1):
        steps += [
            f"k{d} AS (SELECT host, tpl, segs[{d}] AS seg, sum(n) AS n, sum(lab) AS lab, sum(blk) AS blk FROM f{d - 1} WHERE len(segs) >= {d} GROUP BY ALL)",
            f"""w{d} AS (SELECT *, CASE WHEN kids > {MANY} OR (kids >= {FEW} AND kids * 2 > urls) THEN '*' ELSE seg END AS key
              FROM k{d} JOIN (SELECT host, tpl, count(*) AS kids, sum(n) AS urls FROM k{d} GROUP BY ALL) USING (host, tpl))""",
            f"n{d} AS (SELECT host, tpl, key, sum(lab) AS lab, sum(blk) AS blk FROM w{d} GROUP BY ALL)",
            f"q{d} AS (SELECT *, sum(lab) OVER (PARTITION BY host, tpl) AS pl, sum(blk) OVER (PARTITION BY host, tpl) AS pb FROM n{d})",
            f"""m{d} AS (SELECT *, CASE WHEN lab > 0 AND abs(blk / lab - pb / pl) <= 2 * sqrt(pb / pl * (1 - pb / pl) * (1 / lab + 1 / pl)) + 1e-9
              THEN '/' ELSE key END AS name FROM q{d})""",
            f"x{d} AS (SELECT host, tpl, name, sum(lab) >= {LEAST} AND (sum(blk) + {WEIGHT} * any_value(ph)) / (sum(lab) + {WEIGHT}) >= {PURITY} AS bad FROM m{d} JOIN hosts USING (host) GROUP BY ALL)",
            f"l{d} AS (SELECT host, tpl, seg, name, bad FROM w{d} JOIN (SELECT host, tpl, key, name FROM m{d}) USING (host, tpl, key) JOIN x{d} USING (host, tpl, name))",
            f"""f{d} AS (SELECT f.host, f.segs, f.n, f.lab, f.blk, f.tpl || '/' || coalesce(l.name, '') AS tpl, f.reject OR coalesce(l.bad, false) AS reject
              FROM f{d - 1} f LEFT JOIN l{d} l ON l.host = f.host AND l.tpl = f.tpl AND l.seg = f.segs[{d}])""",
        ]
    last = f"SELECT page_id, host, path, rule, coalesce(said, CASE WHEN reject THEN 'block' ELSE 'allow' END) AS verdict FROM r JOIN (SELECT host, segs, reject FROM f{SQL_LEVELS}) USING (host, segs)"
    return "WITH " + ",\n".join(steps) + "\n" + last


OP8_SQL = _sql()
