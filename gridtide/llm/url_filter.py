"""URL filters with redirect equivalence, in DataFrame functions only.

Rules name a host, with all its subdomains, and the beginning of a path; the
longest rule that fits a url decides. A url without a rule is judged by its
aliases: urls are nodes (host and path without a closing slash), redirect and
canonical links are edges, and the connected components share decisions. In a
component an explicit allow goes before a block, and without either a url is allowed.
A rule that fits the url itself goes before all of that.

Defined cases: a NULL url, or one without ``://``, has an empty host and path,
fits no rule, has no alias and is allowed; all links of a page count, relative ones from the
page's folder, with the usual entities; a link without a usable target is no edge; repeated pages are judged alike; an empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)

CANONICAL = (
    "(?i)<link\\b[^>]*\\brel\\s*=\\s*[\"']?canonical\\b[^>]*?\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)",
    "(?i)<link\\b[^>]*\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)[^>]*\\brel\\s*=\\s*[\"']?canonical\\b",
)
REFRESH = "(?i)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*[\"']?refresh\\b[^>]*?\\burl\\s*=\\s*[\"']?([^\"'\\s>]+)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct (rule, verdict), or NULL."""
    found = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
    ]
    return F.coalesce(*found)


def node_of(host: Column, path: Column) -> Column:
    return F.when(host != "", F.concat(host, F.regexp_replace(path, "/+$", "")))


# Entities that may stand for characters which matter in a url.
ENTITIES = {"&(amp|#38|#x26);": "&", "&(sol|#47|#x2f);": "/", "&(colon|#58|#x3a);": ":", "&(period|#46|#x2e);": "."}

SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"


def without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments."""
    none = F.array().cast("array<string>")
    kept = F.aggregate(
        F.split(path, "/"),
        none,
        lambda done, s: F.when(s == ".", done).when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(F.concat(done, F.array(s))),
    )
    return F.array_join(kept, "/")


def resolved(url: Column, link: Column) -> Column:
    """The url that a link in the page at ``url`` leads to; NULL for a scheme without a host, as ``mailto:``."""
    root = F.regexp_extract(url, "(?s)^.*?://[^/?#]*", 0)
    folder = F.concat(F.lit("/"), F.regexp_extract(path_of(url), "(?s)^/(.*/)?", 1))
    path = F.regexp_extract(link, "(?s)^[^?#]*", 0)
    return (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.rlike(SCHEME), F.lit(None))
        .when(path == "", url)
        .when(link.startswith("/"), F.concat(root, without_dots(path)))
        .otherwise(F.concat(root, without_dots(F.concat(folder, path))))
    )


def link_targets(pages: DataFrame) -> DataFrame:
    """(url, target) of all redirect and canonical links in the pages."""
    html = F.col("html")
    some = pages.where(F.col("url").contains("://") & html.rlike("(?i)canonical|http-equiv"))
    found = F.array_distinct(F.concat(*[F.regexp_extract_all(html, F.lit(p), 1) for p in (*CANONICAL, REFRESH)]))
    link = F.col("link")
    for entity, character in ENTITIES.items():
        link = F.regexp_replace(link, f"(?i){entity}", character)
    links = some.select("url", F.explode(found).alias("link")).select("url", link.alias("link"))
    return links.select("url", resolved(F.col("url"), F.col("link")).alias("target")).where("target IS NOT NULL")


def judged(spark: SparkSession, pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, url, host, path, rule, verdict of each page.

    ``redirects`` may add (url, target) pairs from a crawl log. Decisions are
    gathered per node, so a url with very many copies is one row before the join.
    """
    links = link_targets(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target"))
    node = lambda c: node_of(host_of(F.col(c)), path_of(F.col(c)))
    roots = components(spark, links.select(node("url").alias("a"), node("target").alias("b")))

    seen = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    fit = rule_of(F.col("host"), F.col("path"), rules)
    seen = seen.withColumn("fit", fit).withColumn("node", node_of(F.col("host"), F.col("path")))
    ends = links.select("target", host_of(F.col("target")).alias("host"), path_of(F.col("target")).alias("path"))
    ruled = seen.select("node", "fit").union(ends.select(node_of(F.col("host"), F.col("path")), fit))
    ruled = ruled.where("fit IS NOT NULL AND node IS NOT NULL").select("node", F.col("fit.verdict").alias("v")).distinct()
    say = (
        ruled.join(roots, "node", "left")
        .groupBy(F.coalesce("root", "node").alias("root"))
        .agg(F.bool_or(F.col("v") == "allow").alias("allowed"), F.bool_or(F.col("v") == "block").alias("blocked"))
    )
    # Urls without a rule look at their component; one row for each node that is in question.
    open_nodes = seen.where("fit IS NULL AND node IS NOT NULL").select("node").distinct().join(roots, "node", "left")
    decided = (
        open_nodes.withColumn("root", F.coalesce("root", "node"))
        .join(say, "root")
        .select(F.col("node").alias("alias"), F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").alias("shared"))
    )
    return seen.join(decided, (F.col("node") == F.col("alias")) & F.col("fit").isNull(), "left").select(
        "page_id", "url", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), "shared", F.lit("allow")).alias("verdict")
    )


def op5(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return judged(spark, pages).select("page_id", "host", "path", "rule", "verdict")


_PARTS = """
    translate(regexp_extract(coalesce({u}, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce({u}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path"""


def _case(value: str) -> str:
    whens = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, value)}'"
        for r in sorted(RULES, key=lambda r: (-len(r.text), r.text))
    ]
    return "CASE " + " ".join(whens) + " END"


_LINKS = " UNION ".join(
    f"SELECT url, unnest(regexp_extract_all(html, '{p.replace(chr(39), chr(39) * 2)}', 1)) AS link FROM pages WHERE contains(url, '://')"
    for p in (*CANONICAL, REFRESH)
)
_DECODED = "link"
for _entity, _character in ENTITIES.items():
    _DECODED = f"regexp_replace({_DECODED}, '(?i){_entity}', '{_character}', 'g')"


def _dotless(path: str) -> str:
    steps = "lambda a, x: CASE WHEN x[1] = '.' THEN a WHEN x[1] = '..' THEN a[1:greatest(len(a) - 1, 1)] ELSE list_concat(a, x) END"
    return f"array_to_string(list_reduce(list_transform(string_split({path}, '/'), lambda x: [x]), {steps}, []::VARCHAR[]), '/')"


_PLACE = "regexp_extract(link, '(?s)^[^?#]*', 0)"
_TARGET = f"""CASE WHEN contains(link, '://') THEN link WHEN starts_with(link, '//') THEN 'http:' || link
    WHEN regexp_matches(link, '{SCHEME}') THEN NULL WHEN {_PLACE} = '' THEN url
    WHEN starts_with(link, '/') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*', 0) || {_dotless(_PLACE)}
    ELSE regexp_extract(url, '(?s)^.*?://[^/?#]*', 0) || {_dotless("'/' || regexp_extract(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '(?s)^/(.*/)?', 1) || " + _PLACE)} END"""
_NODE = "CASE WHEN host <> '' THEN host || regexp_replace(path, '/+$', '') END AS node"

SQL = f"""
WITH RECURSIVE links AS (SELECT DISTINCT url, {_TARGET} AS target FROM (SELECT url, {_DECODED} AS link FROM ({_LINKS}) WHERE link <> '')),
parts AS (SELECT page_id, url, {_PARTS.format(u='url')} FROM pages),
seen AS (SELECT page_id, host, path, {_NODE}, {_case('text')} AS rule, {_case('verdict')} AS v FROM parts),
ends AS (SELECT *, {_case('verdict')} AS v, {_NODE} FROM (SELECT url, target, {_PARTS.format(u='target')} FROM links WHERE target IS NOT NULL)),
sources AS (SELECT target, {_NODE} FROM (SELECT url, target, {_PARTS.format(u='url')} FROM links WHERE target IS NOT NULL)),
edge AS (SELECT DISTINCT s.node AS a, e.node AS b FROM sources s JOIN ends e USING (target) WHERE s.node IS NOT NULL AND e.node IS NOT NULL),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach AS (SELECT a, a AS b FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a),
roots AS (SELECT a AS node, min(b) AS root FROM reach GROUP BY a),
ruled AS (SELECT node, v FROM seen WHERE v IS NOT NULL AND node IS NOT NULL UNION SELECT node, v FROM ends WHERE v IS NOT NULL AND node IS NOT NULL),
say AS (SELECT coalesce(root, ruled.node) AS root, bool_or(v = 'allow') AS allowed, bool_or(v = 'block') AS blocked
  FROM ruled LEFT JOIN roots USING (node) GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' END, 'allow') AS verdict
FROM seen LEFT JOIN roots USING (node) LEFT JOIN say ON say.root = coalesce(roots.root, seen.node)
"""
