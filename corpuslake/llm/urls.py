"""Host and path rules on URLs, carried to aliases through redirects and canonical links.

A page names other addresses of itself by a canonical link or a refresh; two pages are
also aliases when their addresses agree without scheme, default port and fragment.
Connected components over these edges carry a block to pages without a rule of their
own; an allowed page in the component takes precedence, and so does a page's own rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.common import LOWER, UPPER, join_counted, store, table
from corpuslake.llm.components import components
from corpuslake.session import fits

#: Rules of the registered query: host, path, verdict.
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
#: A rule table of at most so many rows, of about a hundred bytes each, is broadcast.
MAX_BROADCAST_RULES = 100_000


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def address(url: Column) -> Column:
    """The URL without scheme, default port and fragment; null without ``://``."""
    host = F.regexp_replace(url_host(url), ":(80|443)$", "")
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.concat(host, F.when(rest == "", "/").otherwise(rest)))


def targets(html: Column, url: Column) -> Column:
    """Addresses that a page's canonical link and refresh name; relative ones are taken from the page's host."""
    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?i)(<(?:link|meta)\b[^>]*+>)"), F.lit(1))
    links = F.filter(tags, lambda t: t.rlike(r"(?i)rel\s*=\s*[\"']?canonical\b") | t.rlike(r"(?i)http-equiv\s*=\s*[\"']?refresh\b"))
    named = F.transform(links, lambda t: F.coalesce(
        F.nullif(F.regexp_extract(t, r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1), F.lit("")),
        F.nullif(F.regexp_extract(t, r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1), F.lit("")),
    ))
    full = F.transform(named, lambda n: F.when(F.startswith(n, F.lit("/")) & ~F.startswith(n, F.lit("//")), F.concat(F.lit("http://"), url_host(url), n))
        .when(F.startswith(n, F.lit("//")), F.concat(F.lit("http:"), n)).otherwise(n))
    return F.filter(F.transform(full, address), lambda a: a.isNotNull())


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """row, rule and rule_verdict of each URL that a rule fits; of several the longest, then the first by name.

    Rules meet a URL by each domain its host lies in, so only rules of those are tried.
    A rule table of unknown size is joined by shuffle.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = urls.filter("host <> ''").select("row", "path", F.explode(suffixes).alias("domain"))
    listed = rules.select(F.col("host").alias("domain"), F.col("path").alias("under"), "verdict")
    joined = asked.join(F.broadcast(listed) if fits(listed, MAX_BROADCAST_RULES) else listed, "domain")
    fitting = joined.filter(F.startswith("path", F.col("under"))).withColumn("rule", F.concat("domain", "under"))
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.col("rule"), F.col("verdict"))).alias("best")
    return fitting.groupBy("row").agg(best).select("row", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, host, path, rule, verdict, and component (the address its aliases share) of every page.

    A rule fits its host and all subdomains when the path starts with the rule's; the
    longest wins. Without a rule a page is blocked when a page of its component is
    blocked by rule and none is allowed by rule, and allowed otherwise. A null URL and
    one without ``://`` has empty host and path, no rule and no aliases, and is allowed.
    A null page has no links. Repeated rows give a row each. Without rules all is
    allowed. Other columns are not read, whatever their names. Empty in, empty out.
    """
    names = F.filter(F.array_distinct(F.concat(F.array(address(F.col(url))), targets(F.col(html), F.col(url)))), lambda a: a.isNotNull())
    rows, _ = store(pages.select(
        F.col(key).alias("id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"),
        names.alias("names"), F.monotonically_increasing_id().alias("row"),
    ), "urls")
    judged, _ = store(rows.select("id", "row", "host", "path", F.get("names", F.lit(0)).alias("address"))
        .join(matched(rows, rules), "row", "left"), "judged")
    edges = rows.filter(F.size("names") > 1).select(F.get("names", F.lit(0)).alias("a"), F.explode(F.slice("names", 2, F.size("names"))).alias("b"))
    roots, _ = store(components(edges, "a", "b"), "url-roots")
    # A page's address is its group until an edge joins it to another.
    counted = judged.filter(F.col("address").isNotNull()).groupBy("address").agg(
        F.count("*").alias("n"), F.max(F.col("rule_verdict") == "block").alias("blocked"), F.max(F.col("rule_verdict") == "allow").alias("allowed")
    )
    placed = counted.join(roots.withColumnRenamed("node", "address"), "address", "left").withColumn("component", F.coalesce("root", "address"))
    groups = placed.groupBy("component").agg(F.max("blocked").alias("any_blocked"), F.max("allowed").alias("any_allowed"), F.count("*").alias("parts"))
    spread = join_counted(placed.select("address", "n", "component"), groups, "component", "parts", placed.count())
    spread, _ = store(spread.select("address", "n", "component", "any_blocked", "any_allowed"), "url-groups")
    total = spread.agg(F.sum("n")).first()[0] or 0
    known = join_counted(judged, spread, "address", "n", total)
    other = judged.filter(F.col("address").isNull()).withColumns({"n": F.lit(1).cast("long"), "component": F.lit(None).cast("string"), "any_blocked": F.lit(False), "any_allowed": F.lit(False)})
    inherited = F.when(F.coalesce("any_allowed", F.lit(False)), "allow").when(F.coalesce("any_blocked", F.lit(False)), "block").otherwise("allow")
    return known.unionByName(other).select(
        F.col("id").alias(key), "host", "path", "rule", F.coalesce("rule_verdict", inherited).alias("verdict"), "component"
    )



def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE = """
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^#]*)', 1) AS named
  FROM pages
), rules(rhost, rpath, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fitting AS (
  SELECT page_id, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS nr
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
), judged AS (
  SELECT p.*, f.rule, f.verdict FROM parts p LEFT JOIN fitting f ON f.page_id = p.page_id AND nr = 1
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN named = '' THEN 'allow'
         WHEN bool_or(verdict = 'allow') OVER same THEN 'allow'
         WHEN bool_or(verdict = 'block') OVER same THEN 'block' ELSE 'allow' END) AS verdict
FROM judged WINDOW same AS (PARTITION BY named)
"""
