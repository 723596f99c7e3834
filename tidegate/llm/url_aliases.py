"""Block decisions for URLs, carried over to aliases.

Explicit rules match a host, its subdomains and a path prefix; the longest wins. Pages
that redirect to or name each other as canonical are one component; a block of any member
reaches the members that no rule names, and an explicit allow always stands for its page.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.llm.common import connected_components, prepare
from tidegate.session import materialize

#: (verdict, host, path prefix) of the registered query.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: behind the first :// up to / ? # or the end, A-Z lower-cased; path: from there
    up to ? # or the end. Both are empty for null and for a url without ://."""
    rest = F.when(F.contains(url, F.lit("://")), url.substr(F.instr(url, "://") + 3, F.lit(1 << 30))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, null where none does.

    Longest is by host, then by path; of equal ones a block wins. The rules become one
    expression, so the list must be one a driver holds; nothing is exchanged.
    """
    order = sorted(rules, key=lambda r: (-len(r[1]), -len(r[2]), r[0] != "block"))
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, name, prefix in reversed(order):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(name + prefix).alias("rule"))).otherwise(out)
    return out


def same_page(url: Column) -> Column:
    """A name for the page a url points to: host, path and query; scheme and fragment do
    not matter. Null for what is no url."""
    host, path = host_and_path(url)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    return F.when(host != "", F.xxhash64(host, path, query))


#: A character reference in an attribute; a name without ; stands for itself ahead of = or
#: a letter or digit.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*(?:;|(?![=A-Za-z0-9])))"


def decoded(text: Column) -> Column:
    """text with its character references, named and numeric, put into characters."""
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")

    def character(part: Column) -> Column:
        hexadecimal = F.regexp_extract(part, r"^&#[xX]0*([0-9a-fA-F]{1,6});?$", 1)
        decimal = F.regexp_extract(part, r"^&#0*([0-9]{1,7});?$", 1)
        code = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).when(decimal != "", decimal).cast("long")
        real = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return (
            F.when(real, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
            .when(part.startswith("&#"), "�")
            .otherwise(F.coalesce(F.try_element_at(names, F.substr(part, F.lit(2))), part))
        )

    parts = F.regexp_extract_all(text, F.lit(REFERENCE + "|[^&]+|&"), 0)
    known = F.transform(parts, lambda x: F.when(x.startswith("&") & (F.length(x) > 1), character(x)).otherwise(x))
    return F.when(F.contains(text, F.lit("&")), F.array_join(known, "")).otherwise(text)


def without_dots(path: Column) -> Column:
    """A path from / without its . and .. segments, which may be written with %2e."""
    dot, dots = r"^(?i)(\.|%2e)$", r"^(?i)(\.|%2e){2}$"
    parts = F.split(path, "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda out, x: F.when(x.rlike(dots), F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))))
        .when(x.rlike(dot), out)
        .otherwise(F.concat(out, F.array(x))),
    )
    folder = F.when(path.rlike(r"(?i)/(\.|%2e){1,2}$") & (F.size(kept) > 0), "/").otherwise("")
    whole = F.concat(F.lit("/"), F.array_join(kept, "/"), folder)
    return F.when(path.rlike(r"(?i)/(\.|%2e)"), whole).otherwise(path)


def absolute(target: Column, url: Column) -> Column:
    """A link target against the url of its page (or its base), as browsers resolve it: from
    the scheme, host, folder, path or query of the url, dot segments removed. Null where the
    url has no scheme and host, and for targets such as mailto: that name no page."""
    base = F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]"), url)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    path = F.when(path == "", "/").otherwise(path)
    whole = (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(origin, path, target))
        .when((target == "") | target.startswith("#"), F.concat(F.regexp_extract(base, "^[^#]*", 0), target))
        .otherwise(F.concat(origin, F.regexp_extract(path, "^.*/", 0), target))
    )
    start = F.regexp_extract(whole, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    middle = F.regexp_extract(whole, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.concat(start, without_dots(middle), F.regexp_extract(whole, r"^[^?#]*(.*)$", 1))


def page_edges(pages: DataFrame) -> DataFrame:
    """(url, target) of redirects and canonical links that pages declare in their html.

    Character references are decoded, and targets resolved against the page's <base> or its
    url. A whole url with dot segments links under both its forms, as written and without.
    """
    tags = F.regexp_extract_all("html", F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), 0)
    relevant = F.filter(tags, lambda t: t.rlike(r"(?i)rel\s*=\s*[\"']?canonical|http-equiv\s*=\s*[\"']?refresh"))
    # A reference's own ; does not end the url of a refresh.
    target = F.coalesce(
        F.nullif(F.regexp_extract("tag", r"(?i)href\s*=\s*[\"']?([^\"'\s>]+)", 1), F.lit("")),
        F.nullif(F.regexp_extract("tag", r"(?i)url\s*=\s*[\"']?((?:&#?[A-Za-z0-9]+;|[^\"'\s>;])+)", 1), F.lit("")),
    )
    base = F.regexp_extract("html", r"(?i)<base\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    found = (
        pages.where(F.lower("html").rlike("canonical|refresh"))
        .select("url", decoded(base).alias("base"), F.explode(relevant).alias("tag"))
        .select("url", F.coalesce(absolute(F.col("base"), F.col("url")), "url").alias("base"), decoded(target).alias("target"))
    )
    written = F.when(F.col("target").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("target"))
    both = F.array_distinct(F.array(written, absolute(F.col("target"), F.col("base"))))
    return found.select("url", F.explode(both).alias("target")).where("url is not null and target is not null")


def judge_urls(
    spark: SparkSession,
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    edges: DataFrame | None = None,
) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages (page_id, url, html).

    edges (url, target), such as redirects from crawl logs, add to those in the html; their
    targets are whole urls, while those in the html may be relative in any form. A row's own rule decides; without one it is blocked if a member of its component is
    blocked by a rule, else allowed. Null urls and urls without :// have empty host and
    path, no rule and are allowed. Ids may be null or repeated: rows are judged by url.
    Other columns are ignored. A hub of any size costs a partial aggregate per task.
    """
    prepare(spark)
    host, path = host_and_path(F.col("url"))
    rows = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), host.alias("host"), path.alias("path")
    ).withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    links = page_edges(pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")))
    if edges is not None:
        links = links.unionByName(edges.select("url", "target"))
    name = lambda c: same_page(F.col(c))
    # Only urls that no rule names need a component's answer, but any may carry a block.
    targets = links.select(F.col("target").alias("url"))
    known = materialize(
        spark,
        rows.where("host <> ''").select("url", "best").unionByName(
            targets.select("url", best_rule(*host_and_path(F.col("url")), rules).alias("best"))
        ).select(name("url").alias("node"), (F.col("best.verdict") == "block").alias("blocked"))
        .groupBy("node").agg(F.coalesce(F.bool_or("blocked"), F.lit(False)).alias("blocked")),
        "url-nodes",
    )
    pairs = links.select(name("url").alias("a"), name("target").alias("b")).where("a is not null and b is not null")
    groups = connected_components(spark, pairs, "url-groups")
    placed = known.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    bad = placed.groupBy("component").agg(F.bool_or("blocked").alias("blocked")).where("blocked").select("component")
    tainted = materialize(spark, placed.join(bad, "component", "left_semi").select("node"), "url-tainted")
    # A page without a rule may stand in a frequent component: the side looked up has one
    # row per page name, and rows that a rule decides go around the join.
    ruled = rows.where("best is not null").select("page_id", "host", "path", "best.rule", "best.verdict")
    open_rows = rows.where("best is null").withColumn("node", name("url"))
    judged = open_rows.join(tainted.withColumn("hit", F.lit(True)), "node", "left").select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
        F.when(F.col("hit"), "block").otherwise("allow").alias("verdict"),
    )
    return ruled.unionByName(judged)


def oracle_sql(rules: Sequence[tuple[str, str, str]]) -> str:
    """The same rows in DuckDB's SQL; links from the html, closure by recursion."""
    listed = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    parts = """
  CASE WHEN contains({u}, '://') THEN
    translate(regexp_extract(substr({u}, instr({u}, '://') + 3), '^[^/?#]*'), '{up}', '{low}') ELSE '' END AS host,
  CASE WHEN contains({u}, '://') THEN
    regexp_extract(substr({u}, instr({u}, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path""".replace(
        "{up}", UPPER
    ).replace("{low}", LOWER)
    page = "host || path || '?' || regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1)"
    return f"""
WITH RECURSIVE rules(verdict, name, prefix) AS (VALUES {listed}),
p AS (SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
tag AS (
  SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\b[^>]*>')) AS tag FROM p),
target AS (
  SELECT url, coalesce(nullif(regexp_extract(tag, '(?i)href\\s*=\\s*["'']?([^"''\\s>]+)', 1), ''),
                       nullif(regexp_extract(tag, '(?i)url\\s*=\\s*["'']?([^"''\\s>;]+)', 1), '')) AS target
  FROM tag
  WHERE regexp_matches(tag, '(?i)rel\\s*=\\s*["'']?canonical|http-equiv\\s*=\\s*["'']?refresh')),
seen AS (SELECT url FROM p UNION SELECT target FROM target WHERE contains(target, '://')),
place AS (SELECT url, {parts.replace("{u}", "url")} FROM seen),
named AS (SELECT *, CASE WHEN host <> '' THEN {page.replace("{u}", "url")} END AS page FROM place),
ruled AS (
  SELECT named.*, (SELECT max_by([verdict, name || prefix], length(name) * 1000 + length(prefix)) FROM rules
    WHERE (host = name OR ends_with(host, '.' || name)) AND starts_with(path, prefix)) AS best
  FROM named),
edge AS (
  SELECT a.page AS a, b.page AS b FROM target JOIN ruled a ON a.url = target.url JOIN ruled b ON b.url = target.target
  WHERE a.page IS NOT NULL AND b.page IS NOT NULL),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
bad(page) AS (
  SELECT page FROM ruled WHERE best[1] = 'block'
  UNION
  SELECT both_ways.b FROM bad JOIN both_ways ON both_ways.a = bad.page)
SELECT p.page_id, ruled.host, ruled.path, best[2] AS rule,
       coalesce(best[1], CASE WHEN ruled.page IN (SELECT page FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN ruled ON ruled.url = p.url
"""
