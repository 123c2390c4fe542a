"""Operator 5: URL filters with redirect equivalence, in DataFrame functions alone.

A page's own verdict is that of the longest rule that fits its host and path. Canonical links and
immediate refreshes in the pages' HTML are edges between URLs; the connected components of those edges
are sets of aliases. A page without a rule of its own is blocked if any alias of its URL is blocked by
a rule, and allowed otherwise. What rules say of an alias goes by paths as they are written, of pages or
of link targets: an empty path is not taken for ``/`` there. An explicit allow rule takes precedence over a block that comes from an
alias, as does every rule of the page's own.

Only URLs that take part in an edge enter the component steps, and only the blocked ones among them
are joined back to the pages. Rules are part of the plan as a literal: no join and no shuffle for them.

Defined results: a null URL or one without ``://`` has an empty host and path, no rule and the verdict
allow; null HTML has no links; repeated pages each get their row; a link that cannot be resolved or
leads to the page itself is no edge; URLs are compared without scheme and fragment, hosts in lower
case; other columns of the input are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envtrack.llm.common import components, left_join_by_key, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def own_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest fitting rule or null; of equally long ones allow wins."""
    order = sorted(rules, key=lambda r: (-len(r.host + r.path), r.verdict, r.host))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(order):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.host + rule.path).alias("rule"),
                                      F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def links(html: Column) -> Column:
    """The targets of canonical links and of refreshes, as they stand in the HTML."""
    href = r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    canonical = F.filter(F.regexp_extract_all(html, F.lit(r"(?i)(<link\b[^>]*>)"), 1),
                         lambda t: t.rlike(r"""(?i)\brel\s*=\s*["']?canonical\b"""))
    refresh = F.filter(F.regexp_extract_all(html, F.lit(r"(?i)(<meta\b[^>]*>)"), 1),
                       lambda t: t.rlike(r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b"""))

    def target(tag: Column) -> Column:
        return F.concat(*(F.regexp_extract(tag, href, k) for k in (1, 2, 3)))

    url = r"""(?i)\burl\s*=\s*["']?([^"'>\s]+)"""
    found = F.concat(F.transform(canonical, target), F.transform(refresh, lambda t: F.regexp_extract(t, url, 1)))
    has_any = html.rlike(r"(?i)<(?:link\b[^>]*canonical|meta\b[^>]*refresh)")
    return F.when(has_any, F.transform(found, lambda t: F.trim(F.replace(t, F.lit("&amp;"), F.lit("&")))))


def resolved(target: Column, host: Column, path: Column) -> Column:
    """A link's target as an absolute URL (the scheme does not matter here); null if there is none."""
    here = F.concat(F.lit("http://"), host)
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), "[^/]*$", "")
    return (F.when((target == "") | target.startswith("#"), None)
            .when(target.contains("://"), target)
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None)
            .when(host == "", None)
            .when(target.startswith("/"), F.concat(here, target))
            .when(target.startswith("?"), F.concat(here, path, target))
            .otherwise(F.concat(here, folder, target)))


def address(url: Column) -> Column:
    """What identifies a URL: host, path and query."""
    host, path = host_and_path(url)
    return F.concat(host, F.when(path == "", "/").otherwise(path),
                    F.regexp_extract(url, r"://[^?#]*(\?[^#]*)", 1))


def judge_pages(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html") -> DataFrame:
    """For each page: id, host, path, rule (or null) and verdict."""
    host, path = host_and_path(F.col("url"))
    read = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    read = read.withColumns({"host": host, "path": path}).withColumns({
        "host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    read = read.withColumns({"address": address(F.col("url")), "links": links(F.col("html"))}).drop("html")
    judged = staged(read.withColumn("own", own_rule(F.col("host"), F.col("path"), rules)), "pages")

    edges = (judged.where("address is not null and host <> ''")
             .select("host", "path", "address", F.explode("links").alias("link"))
             .withColumn("target", resolved(F.col("link"), F.col("host"), F.col("path")))
             .where("target is not null").select("address", "target", address(F.col("target")).alias("to")))
    edges = staged(edges.distinct(), "links")
    if edges.isEmpty():
        out = judged.withColumn("hit", F.lit(None).cast("boolean"))
    else:
        alias = staged(components(edges, "address", "to"), "aliases")
        targets = edges.select(F.col("to").alias("node"), own_rule(*host_and_path(F.col("target")), rules).alias("own"))
        blocked = judged.select(F.col("address").alias("node"), "own").unionByName(targets).where(
            "own.verdict = 'block'").select("node").distinct()
        bad = alias.join(blocked, "node", "left_semi").select("root").distinct()
        hit = alias.join(bad, "root", "left_semi").select(F.col("node").alias("address"), F.lit(True).alias("hit"))
        open_ = staged(judged.where("own is null and address is not null"), "open-pages")
        pages_of = open_.groupBy("address").agg(F.count("*").alias("pages"))
        per_address = staged(pages_of.join(hit, "address", "left"), "addresses")  # of every open page, hit or not
        out = left_join_by_key(open_, per_address, "address", "pages").unionByName(
            judged.where("own is not null or address is null"), allowMissingColumns=True)
    verdict = F.coalesce("own.verdict", F.when(F.col("hit"), "block"), F.lit("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("own.rule").alias("rule"),
                      verdict.alias("verdict"))


#: The rules of the registered query.
RULES = [Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"),
         Rule("org", "/fr/", "allow")]

ORACLE = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
j AS (
  SELECT page_id, html, coalesce(regexp_extract(url, '://[^?#]*(\?[^#]*)', 1), '') AS query,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(rh, rp, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
k AS (SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END || query AS node FROM j),
links AS (
  SELECT k.*, trim(replace(CASE WHEN regexp_matches(tag, '(?i)^<link') THEN
      regexp_extract(tag, '(?i)\bhref\s*=\s*["'']?([^\s"''>]+)', 1)
    ELSE regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''>\s]+)', 1) END, '&amp;', '&')) AS link
  FROM (SELECT k.*, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^>]*>')) AS tag FROM k) AS k
  WHERE host <> '' AND (regexp_matches(tag, '(?i)^<link.*\brel\s*=\s*["'']?canonical\b')
    OR regexp_matches(tag, '(?i)^<meta.*\bhttp-equiv\s*=\s*["'']?refresh\b'))),
goal AS (
  SELECT node, CASE WHEN link LIKE '%://%' THEN substr(link, instr(link, '://') + 3)
    WHEN link LIKE '//%' THEN substr(link, 3) WHEN link LIKE '/%' THEN host || link
    WHEN link LIKE '?%' THEN host || path || link
    ELSE host || regexp_replace(CASE WHEN path = '' THEN '/' ELSE path END, '[^/]*$', '') || link END AS rest
  FROM links WHERE link <> '' AND link NOT LIKE '#%'
    AND (link LIKE '%://%' OR NOT regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:'))),
gp AS (
  SELECT node AS a, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query FROM goal),
e AS (SELECT a, host || CASE WHEN path = '' THEN '/' ELSE path END || query AS b, host, path FROM gp),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(a, b) AS (SELECT a, b FROM u UNION SELECT r.a, u.b FROM reach r JOIN u ON r.b = u.a),
n AS (SELECT node AS b, host, path FROM k UNION SELECT b, host, path FROM e),
nv AS (SELECT b, arg_max(verdict, length(rh || rp)) AS verdict FROM n JOIN rules
  ON (n.host = rh OR ends_with(n.host, '.' || rh)) AND starts_with(n.path, rp) GROUP BY b, host, path),
hit AS (SELECT DISTINCT a FROM reach JOIN nv USING (b) WHERE verdict = 'block'),
own AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
  FROM k JOIN rules ON (k.host = rh OR ends_with(k.host, '.' || rh)) AND starts_with(k.path, rp) GROUP BY page_id)
SELECT k.page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, own.rule,
  coalesce(own.verdict, CASE WHEN hit.a IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM k LEFT JOIN own USING (page_id) LEFT JOIN hit ON hit.a = k.node
"""
