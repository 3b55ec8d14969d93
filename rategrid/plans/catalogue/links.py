"""Links of index pages and the newest document of each source."""

from __future__ import annotations

from pyspark.sql import functions as F

from rategrid import schemas
from rategrid.functions.arrays import exploded
from rategrid.functions.urls import absolute_url, url_key
from rategrid.operators.links import (
    absolute_links,
    award_path,
    check_order,
    check_pattern,
    latest_links,
    matching_links,
    page_links,
    resolve_sources,
    source_rejects,
)
from rategrid.plans.registry import query, table
from rategrid.plans.inputs import page_sources
from rategrid.sources.readers import read_table

_LINKS = """regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)"""
_ORIGIN = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
_SOURCES = """
    src AS (
      SELECT 'S' || page_id AS state, page_id, url,
             CASE WHEN url LIKE '%.html' THEN 'WEB' ELSE 'IDX' END AS type,
             CASE WHEN url NOT LIKE '%/de/%' THEN 'en' END AS pattern,
             CASE WHEN url LIKE 'https%' THEN 'Fwd' ELSE 'rev' END AS "order",
             html
      FROM pages)
"""


@query(
    "link_extract",
    f"""
    WITH l AS (SELECT page_id, {_LINKS} AS links FROM pages),
    u AS (SELECT page_id, links, unnest(range(len(links))) AS i FROM l)
    SELECT page_id, CAST(i AS INTEGER) AS pos, links[i + 1] AS href FROM u
    """,
)
def _link_extract(spark, sf_dir):
    pages = read_table(spark, f"{sf_dir.rstrip('/')}/pages.parquet", schemas.PAGES)
    pages = page_links(pages.select("page_id", "html"))
    return exploded(pages, ["page_id"], "links", "pos", "href")


@query(
    "link_filter",
    f"""
    WITH {_SOURCES},
    l AS (SELECT page_id, pattern, unnest({_LINKS}) AS href FROM src)
    SELECT page_id, href FROM l WHERE regexp_matches(href, pattern)
    """,
)
def _link_filter(spark, sf_dir):
    index = page_links(page_sources(spark, sf_dir, "html"))
    kept = matching_links(F.col("links"), F.col("pattern"))
    return exploded(index, ["page_id"], kept, "pos", "href").drop("pos")


@query(
    "link_absolute",
    f"""
    WITH b AS (
      SELECT page_id, {_ORIGIN} AS origin, regexp_extract(url, '^([^?#]*)', 1) AS bare,
             regexp_extract(url, '^([^#]*)', 1) AS unmarked,
             regexp_extract(url, '^(https?:)', 1) AS scheme, html
      FROM pages),
    d AS (SELECT *, regexp_extract(bare, '^(.*/)', 1) AS folder FROM b),
    l AS (
      SELECT page_id, unnest({_LINKS}) AS href, origin FROM d),
    c AS (
      SELECT page_id, unnest([
        struct_pack(href := 'x/y.pdf?a=1', url := folder || 'x/y.pdf?a=1'),
        struct_pack(href := './x', url := folder || 'x'),
        struct_pack(href := '../x', url := regexp_replace(folder, '[^/]+/$', '') || 'x'),
        struct_pack(href := '/a/../b/./c', url := origin || '/b/c'),
        struct_pack(href := '?q=2', url := bare || '?q=2'),
        struct_pack(href := '#f', url := unmarked || '#f'),
        struct_pack(href := '//cdn.example.org/z', url := scheme || '//cdn.example.org/z'),
        struct_pack(href := 'ftp://h/p', url := 'ftp://h/p'),
        struct_pack(href := 'mailto:a@b', url := 'mailto:a@b')]) AS r
      FROM d)
    SELECT page_id, href, origin || href AS url FROM l
    UNION ALL SELECT page_id, r.href, r.url FROM c
    """,
)
def _link_absolute(spark, sf_dir):
    # One link of each form a page may hold.
    forms = ["x/y.pdf?a=1", "./x", "../x", "/a/../b/./c", "?q=2", "#f",
             "//cdn.example.org/z", "ftp://h/p", "mailto:a@b"]
    pages = page_links(table(spark, sf_dir, "pages"))
    links = F.concat("links", F.array(*map(F.lit, forms)))
    pairs = F.arrays_zip(
        F.col("links").alias("href"), absolute_links(F.col("links"), F.col("url")).alias("url")
    )
    return pages.withColumn("links", links).select("page_id", F.inline(pairs))


@query(
    "latest_link",
    f"""
    WITH {_SOURCES},
    l AS (SELECT page_id, url, "order",
                 list_filter({_LINKS}, lambda h: regexp_matches(h, pattern)) AS hs FROM src)
    SELECT page_id, CASE WHEN len(hs) > 0 THEN {_ORIGIN} ||
             CASE WHEN lower("order") = 'fwd' THEN hs[-1] ELSE hs[1] END END AS latest
    FROM l
    """,
)
def _latest_link(spark, sf_dir):
    return latest_links(page_sources(spark, sf_dir, "html")).select("page_id", "latest")


@query(
    "order_rejects",
    """
    WITH s AS (
      SELECT 'S' || page_id AS state,
             CASE WHEN url LIKE '%#top' THEN 'newest' WHEN url LIKE '%/de/%' THEN NULL
                  WHEN url LIKE 'https%' THEN 'Fwd' ELSE 'rev' END AS o
      FROM pages)
    SELECT state AS key, 'ok' AS stage, CAST(NULL AS VARCHAR) AS reason
    FROM s WHERE lower(o) IN ('fwd', 'rev')
    UNION ALL
    SELECT state, 'order',
           'order must be ''fwd'' or ''rev'', not: ' || coalesce(o, 'NULL')
    FROM s WHERE o IS NULL OR lower(o) NOT IN ('fwd', 'rev')
    """,
)
def _order_rejects(spark, sf_dir):
    url = F.col("url")
    order = F.when(url.endswith("#top"), "newest").when(~url.contains("/de/"), F.col("order"))
    sources = page_sources(spark, sf_dir).withColumn("order", order)
    return check_order(sources).select(
        F.col("state").alias("key"),
        F.when(F.col("reason").isNull(), "ok").otherwise("order").alias("stage"), "reason",
    )


@query(
    "resolve_sources",
    f"""
    WITH {_SOURCES},
    l AS (SELECT *, list_filter({_LINKS}, lambda h: regexp_matches(h, pattern)) AS hs FROM src)
    SELECT state, url, type,
           CASE WHEN type <> 'IDX' THEN url
                WHEN len(hs) > 0 THEN {_ORIGIN} ||
                  CASE WHEN lower("order") = 'fwd' THEN hs[-1] ELSE hs[1] END END AS doc_url
    FROM l
    """,
)
def _resolve_sources(spark, sf_dir):
    resolved = resolve_sources(page_sources(spark, sf_dir), table(spark, sf_dir, "pages"))
    return resolved.select("state", "url", "type", "doc_url")


_RESOLVED = f"""
    WITH {_SOURCES},
    l AS (SELECT *, list_filter({_LINKS}, lambda h: regexp_matches(h, pattern)) AS hs FROM src)
    SELECT state, url, type,
           CASE WHEN type <> 'IDX' THEN url
                WHEN len(hs) > 0 THEN {_ORIGIN} ||
                  CASE WHEN lower("order") = 'fwd' THEN hs[-1] ELSE hs[1] END END AS doc_url
    FROM l
"""


@query("resolve_sources_doubled", _RESOLVED)
def _resolve_sources_doubled(spark, sf_dir):
    # Every page is there twice; a source stays one row.
    pages = table(spark, sf_dir, "pages")
    resolved = resolve_sources(page_sources(spark, sf_dir), pages.unionByName(pages))
    return resolved.select("state", "url", "type", "doc_url")


@query(
    "link_extract_loose",
    """
    SELECT p_partkey, unnest([0, 1, 2, 3]) AS pos,
           unnest(['/' || p_name, '/b', p_brand, NULL]) AS href
    FROM part
    """,
)
def _link_extract_loose(spark, sf_dir):
    # No blank before href, a slash in its place, no quotes, and an anchor without any.
    html = F.concat(
        F.lit('<a class="c"href="/'), "p_name", F.lit('">1</a><a/href="/b">2</a><a href='),
        "p_brand", F.lit(' >3</a><a name="x > href=y">4</a>'),
    )
    pages = page_links(table(spark, sf_dir, "part").select("p_partkey", html.alias("html")))
    return exploded(pages, ["p_partkey"], "links", "pos", "href")


@query(
    "award_path",
    """
    SELECT c_custkey, 'awards/' || upper(c_name) || '.' || lower(c_mktsegment)
             AS award_file
    FROM customer
    """,
)
def _award_path(spark, sf_dir):
    path = award_path(F.col("c_name"), F.col("c_mktsegment"), "awards")
    return table(spark, sf_dir, "customer").select("c_custkey", path.alias("award_file"))


@query(
    "url_forms",
    """
    SELECT page_id,
           regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/' AS root,
           url AS same
    FROM pages
    """,
)
def _url_forms(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        absolute_url(F.col("url"), F.lit("../../../../")).alias("root"),
        absolute_url(F.lit("http://other.example/x"), F.col("url")).alias("same"),
    )


# Sources with patterns that do not compile among good ones, by the page's number.
_BROKEN = {1: "(", 2: "[a", 3: "*en", 4: "(?<x", 5: "en\\"}
_BROKEN_SQL = "CASE page_id % 7 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _BROKEN.items()) + " ELSE pattern END"


def _with_broken_patterns(sources):
    pattern = F.col("pattern")
    for remainder, text in _BROKEN.items():
        pattern = F.when(F.col("page_id") % 7 == remainder, text).otherwise(pattern)
    return sources.withColumn("pattern", pattern)


@query(
    "pattern_rejects",
    f"""
    WITH {_SOURCES},
    s AS (SELECT *, {_BROKEN_SQL} AS p, page_id % 7 BETWEEN 1 AND 5 AS bad FROM src),
    l AS (SELECT *, CASE WHEN NOT bad THEN list_filter({_LINKS}, lambda h: regexp_matches(h, pattern)) END AS hs FROM s)
    SELECT state, CASE WHEN len(hs) > 0 THEN {_ORIGIN} ||
             CASE WHEN lower("order") = 'fwd' THEN hs[-1] ELSE hs[1] END END AS latest,
           CASE WHEN bad THEN 'pattern does not compile: ' || p END AS reason
    FROM l
    """,
)
def _pattern_rejects(spark, sf_dir):
    # Five kinds of broken patterns; the other sources find their links all the same.
    index = _with_broken_patterns(page_sources(spark, sf_dir, "html"))
    return latest_links(check_pattern(index)).select("state", "latest", "reason")


@query(
    "source_rejects",
    f"""
    WITH {_SOURCES},
    s AS (SELECT *, {_BROKEN_SQL} AS p, type = 'IDX' AND page_id % 7 BETWEEN 1 AND 5 AS bad,
                 page_id % 5 = 0 AS gone, type = 'WEB' AND page_id % 3 = 0 AS bare FROM src),
    l AS (SELECT *, CASE WHEN NOT bad THEN list_filter({_LINKS}, lambda h: regexp_matches(h, pattern)) END AS hs FROM s)
    SELECT 'source' AS stage, state AS key,
           CASE WHEN bare THEN 'no address' WHEN bad THEN 'pattern does not compile: ' || p
                WHEN pattern IS NULL THEN 'no pattern' WHEN gone THEN 'no index page'
                ELSE 'no matching link' END AS reason
    FROM l
    WHERE bare OR type = 'IDX' AND (bad OR pattern IS NULL OR gone OR len(hs) = 0)
    """,
)
def _source_rejects(spark, sf_dir):
    # A fifth of the pages is missing, and a third of the documents has no address.
    sources = _with_broken_patterns(page_sources(spark, sf_dir))
    bare = (F.col("type") == "WEB") & (F.col("page_id") % 3 == 0)
    sources = sources.withColumn("url", F.when(~bare, F.col("url")))
    pages = table(spark, sf_dir, "pages").where(F.col("page_id") % 5 != 0)
    return source_rejects(resolve_sources(sources, pages))


def _spelt(url):
    """The same address in other words: case, port, dots, escapes and a fragment."""
    scheme = F.regexp_extract(url, "^(https?)://", 1)
    host = F.regexp_extract(url, "^https?://([^/?#]+)", 1)
    rest = F.regexp_extract(url, "^https?://[^/?#]+([^#]*)", 1)
    port = F.when(scheme == "https", ":443").otherwise(":80")
    return F.concat(
        F.upper(scheme), F.lit("://"), F.upper(host), port, F.lit("/x/.."),
        F.replace(rest, F.lit("e"), F.lit("%65")), F.lit("#top"),
    )


@query(
    "resolve_sources_forms",
    r"""
    WITH s AS (SELECT *, regexp_replace(url, '#.*$', '') AS bare FROM pages),
    k AS (SELECT *, CASE WHEN regexp_matches(bare, '^https?://[^/?#]+$') THEN bare || '/' ELSE bare END AS key FROM s),
    l AS (SELECT *, list_filter(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1),
                    lambda h: regexp_matches(h, 'en')) AS hs FROM k),
    n AS (SELECT key, max(CASE WHEN len(hs) > 0 THEN hs[-1] END) AS path FROM l GROUP BY key)
    SELECT 'S' || page_id AS state,
           CASE WHEN path IS NOT NULL THEN upper(regexp_extract(url, '^(https?)', 1)) || '://'
             || upper(regexp_extract(url, '^https?://([^/?#]+)', 1))
             || CASE WHEN url LIKE 'https%' THEN ':443' ELSE ':80' END || path END AS doc_url,
           CASE WHEN path IS NULL THEN 'no matching link' END AS reason
    FROM l JOIN n USING (key)
    """,
)
def _resolve_sources_forms(spark, sf_dir):
    # Every source spells its index page otherwise than the pages table does.
    sources = page_sources(spark, sf_dir).withColumns(
        {"url": _spelt(F.col("url")), "type": F.lit("IDX"), "pattern": F.lit("en"), "order": F.lit("fwd")}
    )
    resolved = resolve_sources(sources, table(spark, sf_dir, "pages"))
    return resolved.select("state", "doc_url", "reason")


@query(
    "url_keys",
    """
    WITH s AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS bare FROM pages),
    k AS (SELECT page_id, CASE WHEN regexp_matches(bare, '^https?://[^/?#]+$') THEN bare || '/' ELSE bare END AS key FROM s)
    SELECT page_id, key AS own, key AS spelt FROM k
    """,
)
def _url_keys(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", url_key(F.col("url")).alias("own"), url_key(_spelt(F.col("url"))).alias("spelt")
    )
