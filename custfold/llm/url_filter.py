"""URL filter by rules and link-graph propagation (DataFrame functions only).

A rule ``host/path`` fits its host and all subdomains where the url's path
starts with the rule's path; the longest rule decides.  Urls without a rule
get the verdict of their host:

* Host edges come from absolute links in the pages' html and from a host to
  its parent domain where that has pages too.  They are counted per pair of
  hosts before anything else, so a hot host is a number, not a group of rows.
* Trust is a personalised PageRank along the edges; it starts from hosts in
  proportion to their pages that a rule allows.  Distrust runs against the
  edges from hosts with pages that a rule blocks: who links to blocked hosts
  is distrusted.
* A host is blocked if its distrust per page is above the average of all
  pages and above its trust per page.

Masses are whole numbers (``UNIT`` in all), so sums do not depend on the order
of rows.  The rounds read edges written once to the shared folder; joins on
hosts of very many edges are split by adaptive execution.

Defined cases: a null url or one without ``://`` has empty host and path, no
rule, and is allowed; null html has no links; repeated pages count as pages; very long html is
scanned in one task as one row; an empty table gives an empty result; without allowed (or blocked) pages no trust
(distrust) exists; no other column of the input is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custfold.llm.common import LOWER, UPPER, ascii_lower, store, table

#: Action and ``host/path`` of each rule (a bounded configuration list).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
ROUNDS, DAMPING, UNIT = 10, 0.85, 10**12
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""


def _fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    at = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
    return at & F.startswith(F.col("path"), F.lit(slash + path))


def rule_of(rules: tuple[tuple[str, str], ...]) -> Column:
    """Struct ``(action, rule)`` of the longest rule that fits, or null."""
    out = None
    for action, rule in sorted(rules, key=lambda r: -len(r[1])):
        hit = F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule"))
        out = F.when(_fits(rule), hit) if out is None else out.when(_fits(rule), hit)
    return out if out is not None else F.lit(None).cast("struct<action:string,rule:string>")


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """``src, dst, w``: links between different hosts, counted."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
    links = links.select("src", ascii_lower(F.col("dst")).alias("dst")).where("src <> '' AND src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))
    parent = hosts.select(F.col("host").alias("src"), F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1).alias("dst")).where("dst <> ''")
    known = hosts.select(F.col("host").alias("dst"))
    up = parent.join(known, "dst").select("src", "dst", F.lit(1).cast("long").alias("w"))
    return links.unionByName(up).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """``kind, host, mass`` after the rounds, from ``seeds (kind, host, mass)``
    over ``edges (kind, src, dst, part)``, ``part`` of a source summing to 1."""
    start = seeds.select("kind", "host", F.floor(F.col("mass") * F.lit(1 - damping)).alias("mass"))
    now = seeds
    for r in range(1, rounds + 1):
        flow = (now.join(edges.withColumnRenamed("src", "host"), ["kind", "host"])
                .select("kind", F.col("dst").alias("host"), F.floor(F.col("mass") * F.lit(damping) * F.col("part")).alias("mass")))
        now = start.unionByName(flow).groupBy("kind", "host").agg(F.sum("mass").cast("long").alias("mass"))
        if r % 5 == 0 or r == rounds:
            now = store(now, "rank")
    return now


def judge_pages(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, rounds: int = ROUNDS, damping: float = DAMPING,
                id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page."""
    url = F.coalesce(pages[url_col].cast("string"), F.lit(""))
    rows = pages.select(pages[id_col].alias("page_id"), pages[html_col].cast("string").alias("html"),
                        ascii_lower(F.regexp_extract(url, URL, 1)).alias("host"), F.regexp_extract(url, URL, 2).alias("path"))
    rows = rows.withColumn("hit", rule_of(rules))
    count = lambda action: F.count_if(F.col("hit.action") == action).alias(action)
    hosts = store(rows.where("host <> ''").groupBy("host").agg(F.count(F.lit(1)).alias("pages"), count("allow"), count("block")), "hosts")
    total = hosts.agg(F.sum("pages"), F.sum("allow"), F.sum("block")).first()  # one row

    edges = store(host_edges(rows, hosts), "host-edges")
    both = (edges.select(F.lit("trust").alias("kind"), "src", "dst", "w")
            .unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "w")))
    out = both.groupBy("kind", "src").agg(F.sum("w").alias("out"))
    both = store(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("w").cast("double") / F.col("out").cast("double")).alias("part")), "flow-edges")

    def seed(kind: str, col: str, n: int | None) -> DataFrame:
        mass = F.floor(F.col(col).cast("double") * F.lit(float(UNIT)) / F.lit(float(n or 1)))
        return hosts.where(F.col(col) > 0).select(F.lit(kind).alias("kind"), "host", mass.alias("mass"))

    seeds = store(seed("trust", "allow", total[1]).unionByName(seed("distrust", "block", total[2])), "seeds")
    ranks = propagate(seeds, both, rounds, damping)
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0)).alias(kind)
    ranks = ranks.groupBy("host").agg(of("trust"), of("distrust"))
    whole = ranks.agg(F.coalesce(F.sum("distrust"), F.lit(0))).first()[0]  # one number
    verdicts = (hosts.join(ranks, "host", "left").select(
        "host", F.coalesce("trust", F.lit(0)).cast("long").alias("trust"), F.coalesce("distrust", F.lit(0)).cast("long").alias("distrust"),
        (F.coalesce("distrust", F.lit(0)).cast("double") / F.col("pages") > F.lit(float(whole)) / F.lit(float(total[0] or 1))).alias("high")))
    verdicts = store(verdicts.select("host", "trust", "distrust", (F.col("high") & (F.col("distrust") > F.col("trust"))).alias("bad")), "host-verdicts")
    method = F.when(F.col("bad"), "block").otherwise("allow")
    return (rows.drop("html").join(verdicts, "host", "left")
            .select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.action", method).alias("verdict"), "trust", "distrust"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all ``pages``."""
    return judge_pages(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    def fits(rule: str) -> str:
        host, slash, path = rule.partition("/")
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + path}')"

    ordered = sorted(RULES, key=lambda r: -len(r[1]))
    case = lambda k: "CASE " + " ".join(f"WHEN {fits(r[1])} THEN '{r[k]}'" for r in ordered) + " END"
    link = LINK.replace("'", "''")
    sql = f"""
WITH u AS MATERIALIZED (SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '{URL}', 1), '{UPPER}', '{LOWER}') AS host,
                  regexp_extract(coalesce(url, ''), '{URL}', 2) AS path FROM pages),
p AS MATERIALIZED (SELECT *, {case(1)} AS rule, {case(0)} AS act FROM u),
h AS MATERIALIZED (SELECT host, count(*) AS n, count_if(act = 'allow') AS a, count_if(act = 'block') AS b FROM p WHERE host <> '' GROUP BY host),
l AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{UPPER}', '{LOWER}') AS dst FROM p WHERE host <> ''),
up AS (SELECT host AS src, regexp_extract(host, '^[^.]+\\.([^.]+\\..+)$', 1) AS dst FROM h),
e AS MATERIALIZED (SELECT src, dst, sum(w) AS w FROM (
    SELECT src, dst, count(*) AS w FROM l WHERE src <> dst GROUP BY src, dst
    UNION ALL SELECT up.src, up.dst, 1 FROM up JOIN h ON h.host = up.dst) GROUP BY src, dst),
d AS (SELECT 't' AS k, src, dst, w FROM e UNION ALL SELECT 'd', dst, src, w FROM e),
f AS MATERIALIZED (SELECT k, src, dst, CAST(w AS DOUBLE) / CAST(sum(w) OVER (PARTITION BY k, src) AS DOUBLE) AS part FROM d),
s AS MATERIALIZED (
    SELECT 't' AS k, host, CAST(floor(CAST(a AS DOUBLE) * {float(UNIT)} / (SELECT CAST(sum(a) AS DOUBLE) FROM h)) AS BIGINT) AS m FROM h WHERE a > 0
    UNION ALL SELECT 'd', host, CAST(floor(CAST(b AS DOUBLE) * {float(UNIT)} / (SELECT CAST(sum(b) AS DOUBLE) FROM h)) AS BIGINT) FROM h WHERE b > 0),
r0 AS (SELECT * FROM s)"""
    for r in range(1, ROUNDS + 1):
        sql += f""",
r{r} AS MATERIALIZED (SELECT k, host, CAST(sum(m) AS BIGINT) AS m FROM (
    SELECT k, host, CAST(floor(CAST(m AS DOUBLE) * CAST({1 - DAMPING!r} AS DOUBLE)) AS BIGINT) AS m FROM s
    UNION ALL SELECT r.k, dst, CAST(floor(CAST(m AS DOUBLE) * CAST({DAMPING!r} AS DOUBLE) * part) AS BIGINT) FROM r{r - 1} r JOIN f ON f.k = r.k AND f.src = r.host) GROUP BY k, host)"""
    return sql + f""",
v AS (SELECT h.host, n, coalesce(t.m, 0) AS t, coalesce(x.m, 0) AS d FROM h
      LEFT JOIN r{ROUNDS} t ON t.k = 't' AND t.host = h.host LEFT JOIN r{ROUNDS} x ON x.k = 'd' AND x.host = h.host),
w AS (SELECT host, d > t AND CAST(d AS DOUBLE) / n > (SELECT CAST(coalesce(sum(m), 0) AS DOUBLE) FROM r{ROUNDS} WHERE k = 'd') / (SELECT CAST(sum(n) AS DOUBLE) FROM h) AS bad FROM v)
SELECT page_id, p.host, path, rule, coalesce(act, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict FROM p LEFT JOIN w ON w.host = p.host
"""


OP1_SQL = _sql()
