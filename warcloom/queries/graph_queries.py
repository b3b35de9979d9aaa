"""Chains of revisits, links between hosts, totals of harvests."""

from __future__ import annotations

from pyspark.sql import functions as F

from warcloom.functions.markup import absolute_links, clean
from warcloom.operators import graph
from warcloom.queries.catalog import query, table
from warcloom.queries.inputs import ORACLE_RECORDS, records

# Chains of three revisits, a cycle of two with one that leads into it, and pointers to records that are not there.
_POINTER = """CASE WHEN page_id % 10 IN (0, 1, 2, 5, 7) THEN CASE page_id % 10 WHEN 7 THEN page_id - 2 ELSE page_id + 1 END
  WHEN page_id % 10 = 6 THEN page_id - 1 WHEN page_id % 10 = 8 THEN page_id + 1000000 END"""


@query(
    f"""WITH RECURSIVE pointers AS (SELECT page_id, {_POINTER} AS target FROM pages), walk AS (
  SELECT page_id, target AS place, 1 AS hops FROM pointers WHERE target IS NOT NULL
  UNION ALL SELECT w.page_id, p.target, w.hops + 1 FROM walk w JOIN pointers p ON p.page_id = w.place
  WHERE p.target IS NOT NULL AND w.hops < 20
), ends AS (SELECT page_id, arg_max(place, hops) AS place, max(hops) AS hops FROM walk GROUP BY page_id)
SELECT CAST(e.page_id AS VARCHAR) AS id, CASE WHEN hops < 20 THEN CAST(e.place AS VARCHAR) END AS original,
  CASE WHEN hops < 20 THEN CAST(hops AS BIGINT) END AS hops,
  CASE WHEN hops = 20 THEN 'cycle' WHEN p.page_id IS NULL THEN 'missing' ELSE 'original' END AS status
FROM ends e LEFT JOIN pages p ON p.page_id = e.place"""
)
def revisit_originals(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id"), F.expr(f"CAST({_POINTER} AS string)").alias("refers_to"))
    return graph.originals(rows)


def _host_links(spark, sf_dir):
    # links of pages are relative, so each page also links to the page before it, whose host is often another one
    pages = table(spark, sf_dir, "pages")
    linked = pages.select("page_id", "url", absolute_links(clean(F.col("html")), F.col("url")).alias("own"))
    other = pages.select((F.col("page_id") + 1).alias("page_id"), F.col("url").alias("before"))
    return graph.host_links(
        linked.join(other, "page_id", "left").select("url", F.concat("own", F.array_compact(F.array("before", F.upper("before")))).alias("links"))
    )


_HOST = "lower(regexp_extract({}, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1))"


@query(
    f"""WITH hosts AS (SELECT page_id, {_HOST.format('url')} AS host FROM pages), links AS (
  SELECT a.host AS source, b.host AS target, 2 AS n, 1 AS pages FROM hosts a JOIN hosts b ON b.page_id = a.page_id - 1 WHERE a.host <> b.host
), pairs AS (SELECT source, target, sum(n) AS n_links, sum(pages) AS n_pages FROM links GROUP BY source, target
), ends AS (SELECT target AS host, 1 AS inward, n_links FROM pairs UNION ALL SELECT source, 0, n_links FROM pairs)
SELECT host, count(*) FILTER (WHERE inward = 1) AS in_hosts, CAST(coalesce(sum(n_links) FILTER (WHERE inward = 1), 0) AS BIGINT) AS in_links,
  count(*) FILTER (WHERE inward = 0) AS out_hosts, CAST(coalesce(sum(n_links) FILTER (WHERE inward = 0), 0) AS BIGINT) AS out_links
FROM ends GROUP BY host"""
)
def host_degrees(spark, sf_dir):
    return graph.host_degrees(_host_links(spark, sf_dir))


@query()
def host_ranks(spark, sf_dir):
    # an iteration with a stop; tests compare it with a plain one
    return graph.host_ranks(_host_links(spark, sf_dir)).select("host", F.round("rank", 6).alias("rank"))


@query(
    ORACLE_RECORDS
    + f""" SELECT harvest_id, mime_type, CAST((harvest_id IS NOT NULL)::INT + (grouping(mime_type) = 0)::INT AS INTEGER) AS level, count(*) AS n_records,
  CAST(coalesce(sum(warc_record_size), 0) AS BIGINT) AS n_bytes, count(DISTINCT {_HOST.format('url')}) AS n_hosts
FROM rec GROUP BY ROLLUP (harvest_id, mime_type)"""
)
def harvest_rollup(spark, sf_dir):
    return graph.harvest_rollup(records(spark, sf_dir), ["harvest_id", "mime_type"]).drop("hosts").withColumn("level", F.col("level").cast("int"))
