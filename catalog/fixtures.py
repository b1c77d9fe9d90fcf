"""Inputs derived from the driver tables.

One rule per column, by arithmetic on keys, written in SQL that Spark and DuckDB
both read, so that a query and its check start from the same rows.  Lists are
comma texts here and become arrays in each engine.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dirsync.functions import split_list
from dirsync.session import scratch_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "events", "pages")

FIXTURES: dict[str, str] = {
    "fx_base": """
SELECT c.c_custkey AS k, CAST(c.c_custkey AS STRING) AS ks, c.c_mktsegment AS seg, n.n_name AS n_name,
       r.r_name AS r_name, p.p_name AS p_name,
       translate(CAST(c.c_custkey AS STRING), '0123456789', 'abcdefghij') AS lk
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON p.p_partkey = c.c_custkey
""",
    # Raw roster of the main account and, by one rule, of the second.
    "fx_roster_a": """
SELECT k AS pos, ks AS id,
       CASE WHEN k % 97 = 0 THEN ''
            WHEN k % 37 = 5 THEN 'test' || ks || '@example.com'
            WHEN k % 74 = 7 THEN 'u' || ks || '@house.example.com'
            WHEN k % 19 = 0 THEN ' U' || ks || '@Example.com '
            ELSE 'u' || ks || '@example.com' END AS email,
       CASE WHEN k % 59 = 0 OR k % 211 = 0 THEN ''
            WHEN k % 37 = 7 THEN '007 - ' || p_name
            ELSE p_name END AS first_name,
       CASE WHEN k % 59 = 0 OR k % 211 = 0 THEN ' '
            WHEN k % 40 = 11 THEN 'dup'
            ELSE lk END AS last_name,
       CASE WHEN k % 211 = 0 THEN NULL
            WHEN k % 37 = 9 THEN '009 - full ' || lk
            ELSE 'full ' || lk END AS name,
       CASE WHEN k % 211 = 0 OR k % 59 = 0 THEN NULL
            WHEN k % 62 = 0 THEN '012 - Pat'
            WHEN k % 31 = 0 THEN ' Pat ' END AS preferred_name,
       CASE WHEN k % 29 = 0 THEN ''
            WHEN seg = 'MACHINERY' THEN 'Processor'
            WHEN k % 41 = 0 THEN 'Office Administrator'
            WHEN k % 5 = 1 THEN ' Team Leader'
            WHEN k % 5 = 3 THEN 'BROKER'
            ELSE 'Agent' END AS role,
       CASE WHEN k % 23 = 0 THEN false WHEN k % 23 = 1 THEN NULL ELSE true END AS active,
       CASE WHEN k % 17 = 0 OR k % 17 = 2 THEN ''
            WHEN k % 17 = 1 THEN r_name || ' , ,EXTRA'
            ELSE r_name END AS region,
       CASE WHEN k % 17 = 2 THEN r_name END AS region_alt,
       CASE WHEN k % 13 = 0 OR k % 8 = 3 OR k % 8 = 5 THEN ''
            WHEN k % 24 = 5 THEN ' TEAM 5 '
            ELSE 'Team ' || CAST(k % 12 AS STRING) END AS team,
       CASE WHEN k % 13 <> 0 AND k % 8 = 3 THEN 'Team ' || CAST(k % 12 AS STRING) END AS team_alt,
       CASE WHEN k % 13 <> 0 AND k % 8 = 5 THEN 'Team ' || CAST(k % 12 AS STRING) END AS team_name,
       CASE WHEN k % 34 = 0 OR k % 9 = 4 THEN '' ELSE n_name || ' office' END AS office,
       CASE WHEN k % 34 <> 0 AND k % 9 = 4 THEN n_name || ' branch' END AS office_name,
       CASE WHEN k % 7 = 1 THEN '1-555-' || lpad(ks, 7, '0')
            WHEN k % 7 = 2 THEN '12345'
            WHEN k % 7 IN (3, 5) THEN ''
            WHEN k % 7 = 4 THEN '(555) ' || lpad(ks, 7, '0')
            ELSE '555' || lpad(ks, 7, '0') END AS phone,
       CASE WHEN k % 7 = 5 THEN '555.' || lpad(ks, 7, '0') END AS phone_number,
       CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN 'realtor' WHEN 2 THEN 'Agent'
                  WHEN 3 THEN 'Broker / Agent' WHEN 4 THEN ' / Agent' ELSE 'Team Lead' END AS title,
       CASE WHEN k % 4 = 0 THEN 'https://uploads.example.com/avatars/' || ks || '.png'
            WHEN k % 4 = 1 THEN '/assets/' || ks || '.png'
            ELSE '' END AS profile_picture_url,
       CASE WHEN k % 4 = 1 THEN 'https://late.example.com/' || ks || '.png'
            WHEN k % 8 = 2 THEN 'http://photos.example.com/' || ks || '.png' END AS photo_url,
       CASE WHEN k % 8 = 6 THEN 'HTTPS://upper.example.com/' || ks END AS avatar_url,
       CASE WHEN k % 8 = 3 THEN 'https://images.example.com/' || ks END AS image_url,
       CASE WHEN k % 4 = 0 OR k % 8 = 2 THEN true WHEN k % 4 = 1 THEN NULL ELSE false END AS avatar_added,
       CASE WHEN k % 5 = 2 OR k % 75 = 28 THEN 'second' ELSE 'main' END AS account
FROM fx_base
WHERE k % 10 <> 3
""",
    # A second account, for the join of the two: same id, same e-mail, or new.
    "fx_roster_b": """
SELECT 1000000000000 + s_suppkey AS pos,
       CASE WHEN s_suppkey % 4 = 0 THEN CAST(s_suppkey AS STRING)
            WHEN s_suppkey % 4 = 3 THEN ''
            ELSE 'b' || CAST(s_suppkey AS STRING) END AS id,
       CASE WHEN s_suppkey % 4 = 1 THEN ' U' || CAST(s_suppkey AS STRING) || '@example.com'
            WHEN s_suppkey % 8 = 7 THEN ''
            ELSE 'b' || CAST(s_suppkey AS STRING) || '@example.com' END AS email,
       s_name AS name
FROM supplier
""",
    "fx_directory": """
SELECT k AS pos,
       CASE WHEN k % 5 = 0 OR k % 200 = 8 THEN 'old' || ks || '@example.com'
            ELSE 'u' || ks || '@example.com' END AS email,
       CASE WHEN k % 200 = 8 THEN 'former ' || lk
            WHEN k % 40 = 11 THEN p_name || ' dup'
            ELSE p_name || ' ' || lk END AS name,
       'old phone ' || ks AS phone, 'Old Title' AS title,
       CASE WHEN k % 13 = 1 THEN '' ELSE 'Team ' || CAST(k % 12 AS STRING) END AS team,
       CASE WHEN k % 4 = 0 THEN '' WHEN k % 4 = 1 THEN NULL
            ELSE 'https://logos.example.com/old-' || ks || '.png' END AS team_logo,
       CASE WHEN k % 17 = 3 THEN '' WHEN k % 17 = 4 THEN r_name || ',EXTRA' ELSE r_name END AS regions,
       CASE WHEN k % 9 = 0 THEN NULL ELSE 'Old office' END AS office,
       CASE k % 6 WHEN 0 THEN 'https://old.example.com/directory-data/photos/' || ks || '.jpg'
                  WHEN 1 THEN 'https://cdn.trusted.example/' || ks || '.jpg'
                  WHEN 2 THEN 'https://elsewhere.example.com/' || ks || '.jpg'
                  ELSE '' END AS photo,
       CASE WHEN k % 3 = 1 THEN '' ELSE 'https://pages.example.com/p/' || ks END AS page_url,
       CASE WHEN k % 3 = 0 OR k % 200 = 8 THEN '' ELSE ks END AS id,
       CASE WHEN k % 2 = 0 THEN 'L' || ks ELSE '' END AS second_id,
       CASE k % 25 WHEN 2 THEN 'second' WHEN 3 THEN 'both' WHEN 4 THEN 'joint' WHEN 5 THEN 'sheet'
                   ELSE 'main' END AS source,
       CASE WHEN k % 12 = 0 AND k % 7 <> 0 THEN 'source_a' WHEN k % 6 = 0 THEN 'source_b'
            ELSE '' END AS photo_source,
       CASE WHEN k % 6 = 0 THEN 'hash' || ks ELSE '' END AS photo_hash,
       CASE WHEN k % 20 = 6 OR k % 40 = 33 OR k % 53 = 0 THEN true
            WHEN k % 10 = 1 THEN NULL ELSE false END AS hidden,
       CASE WHEN k % 110 = 33 THEN 'soon'
            WHEN k % 20 = 6 THEN '2024-01-10T00:00:00Z'
            WHEN k % 40 = 13 THEN '2023-11-01T08:00:00+02:00'
            WHEN k % 40 = 33 THEN '2024-01-15T12:30:00.250000' END AS soft_deleted_at,
       CASE WHEN k % 25 = 2 THEN 'status ' || ks END AS extra_status
FROM fx_base
WHERE k % 10 <> 4
""",
    "fx_url_checks": """
SELECT replace(p_name, ' ', '-') || '-' || lk AS slug,
       CASE k % 5 WHEN 0 THEN 200 WHEN 1 THEN 218 WHEN 2 THEN 404 ELSE 503 END AS status,
       CASE WHEN k % 5 < 2 THEN 'https://pages.example.com/live-' || ks ELSE '' END AS url,
       CASE k % 5 WHEN 2 THEN '2024-01-30T23:30:00+00:00' WHEN 3 THEN '2024-01-30T22:00:00+00:00'
                  ELSE '2023-05-05T05:05:05' END AS checked_at
FROM fx_base
WHERE k % 5 <> 4
""",
    # Directory rows as the photo jobs meet them.
    "fx_asset_rows": """
SELECT k AS pos, p_name || ' ' || lk AS name,
       CASE WHEN k % 97 = 1 OR k % 9 = 0 THEN '' WHEN k % 40 = 39 THEN CAST(k - 1 AS STRING) ELSE ks END AS id,
       CASE WHEN k % 97 = 1 THEN '' ELSE ' U' || ks || '@Example.com' END AS email,
       CASE k % 25 WHEN 2 THEN 'second' WHEN 7 THEN 'second_sheet' ELSE 'main' END AS source,
       CASE k % 6 WHEN 0 THEN 'https://old.example.com/directory-data/photos/' ||
                              CASE WHEN k % 9 = 0 THEN 'email-' || @SHA{'u' || ks || '@example.com'} ELSE ks END || '.jpg'
                  WHEN 1 THEN 'https://cdn.trusted.example/' || ks || '.jpg'
                  WHEN 2 THEN 'https://elsewhere.example.com/' || ks || '.jpg'
                  WHEN 3 THEN 'https://uploads.example.com/avatars/' || ks || '.png'
                  ELSE '' END AS photo,
       CASE WHEN k % 12 = 0 AND k % 7 <> 0 THEN 'source_a' WHEN k % 6 = 0 THEN 'source_b' ELSE '' END AS photo_source,
       CASE WHEN k % 11 = 0 THEN 'stale'
            ELSE @SHA{'https://uploads.example.com/avatars/' || ks || '.png'} END AS photo_hash,
       CASE WHEN k % 14 = 3 THEN ''
            WHEN k % 20 = 19 THEN 'https://pages.example.com/p/' || CAST(k - 1 AS STRING)
            ELSE 'https://pages.example.com/p/' || ks END AS page_url,
       CASE WHEN k % 8 = 2 THEN '' WHEN k % 8 = 6 THEN 'ftp://uploads.example.com/' || ks
            WHEN k % 4 < 2 THEN 'https://uploads.example.com/avatars/' || ks || '.png' ELSE '' END AS incoming_photo,
       CASE WHEN k % 2 = 0 THEN true WHEN k % 4 = 1 THEN false END AS incoming_photo_real,
       CASE WHEN k % 53 = 0 THEN true WHEN k % 10 = 1 THEN NULL ELSE false END AS hidden,
       CASE WHEN k % 40 = 13 THEN '2023-11-01T00:00:00Z' END AS soft_deleted_at
FROM fx_base
""",
    "fx_assets": """
SELECT CASE WHEN k % 9 = 0 THEN 'email-' || @SHA{'u' || ks || '@example.com'} ELSE ks END AS key
FROM fx_base
WHERE k % 40 <> 39 AND ((k % 6 = 0 AND k % 5 <> 0) OR k % 12 = 3)
UNION ALL
SELECT 'ghost' || ks AS key FROM fx_base WHERE k % 50 = 7
""",
    "fx_attempts_a": """
SELECT CASE WHEN k % 9 = 0 THEN 'email-' || @SHA{'u' || ks || '@example.com'} ELSE ks END AS key,
       (k % 4 = 0 AND k % 13 < 6) AS ok,
       CASE WHEN k % 4 = 0 AND k % 13 < 6 THEN '' WHEN k % 2 = 0 THEN 'download_failed:timeout'
            ELSE 'response_too_small' END AS reason,
       'https://uploads.example.com/avatars/' || ks || '.png' AS source_url
FROM fx_base WHERE k % 13 <> 12 AND k % 40 <> 39
""",
    "fx_attempts_b": """
SELECT CASE WHEN k % 9 = 0 THEN 'email-' || @SHA{'u' || ks || '@example.com'} ELSE ks END AS key,
       (k % 13 BETWEEN 6 AND 8) AS ok,
       CASE WHEN k % 13 BETWEEN 6 AND 8 THEN '' ELSE 'parse:no_agent_card_div' END AS reason,
       'https://cdn.trusted.example/page-' || ks || '.jpg' AS source_url
FROM fx_base WHERE k % 13 <> 5 AND k % 40 <> 39
""",
    "fx_retries": """
SELECT CASE WHEN k % 9 = 0 THEN 'email-' || @SHA{'u' || ks || '@example.com'} ELSE ks END AS key,
       100 - (k % 7) AS last_run, '2024-01-29T00:00:00+00:00' AS last_at, 'A:earlier' AS last_reason,
       k % 4 + 1 AS failure_count
FROM fx_base WHERE k % 3 = 2 AND k % 40 <> 39
""",
    "fx_asset_cache": """
SELECT 'https://uploads.example.com/avatars/' || ks || '.png' AS source_url,
       CASE WHEN k % 8 = 3 THEN 'other' ELSE ks END AS id
FROM fx_base WHERE k % 4 <> 1
""",
    # Fetched profile pages of the photo rows: all orders, hosts and names.
    "fx_profile_pages": """
SELECT 'https://pages.example.com/p/' || ks AS url,
       CASE k % 8
         WHEN 0 THEN '<html><body><img src="https://cdn.trusted.example/logo.png" alt="logo"><DIV  class="agent-card" id="c"><!----><img class="h" src="https://cdn.trusted.example/' || ks || '.webp" data-x="1" alt="' || p_name || ' ' || lk || '"></div></body></html>'
         WHEN 1 THEN '<div class="agent-card"><IMG alt="' || upper(p_name) || ' Jr" width=5 src="https://cdn.legacy.example/' || ks || '.jpg"/>'
         WHEN 2 THEN '<div class="agent-card"><img src="https://evil.example.com/a-rather-long-path-that-goes-on-and-on-and-on/' || ks || '.jpg" alt="' || p_name || ' ' || lk || '">'
         WHEN 3 THEN '<div class="agent-card"><img src="https://cdn.trusted.example/' || ks || '.jpg" alt="Some O&#39;Body &amp; Co">'
         WHEN 4 THEN '<div class="card"><img src="https://cdn.trusted.example/' || ks || '.jpg" alt="x"></div>'
         WHEN 5 THEN '<div class="agent-card"><p>no image here</p><img src="/relative.jpg" alt="x"></div>'
         WHEN 6 THEN '<div class="agent-card"><img src="https://cdn.trusted.example/' || ks || '.jpg" alt="">'
         ELSE '' END AS html
FROM fx_base WHERE k % 9 <> 5
""",
    "fx_scrape_cache": """
SELECT 'https://pages.example.com/p/' || ks AS page_url,
       CASE WHEN k % 4 = 0 OR k % 8 = 2 THEN 'https://cdn.trusted.example/cached-' || ks || '.jpg' END AS photo_url,
       CASE k % 4 WHEN 0 THEN '2024-01-28T00:00:00Z' WHEN 1 THEN '2024-01-24T00:00:01+00:00'
                  ELSE '2024-01-24T00:00:00Z' END AS scraped_at,
       p_name AS agent_name,
       CASE WHEN k % 8 = 1 THEN 'no_img_in_agent_card' END AS reason
FROM fx_base WHERE k % 4 <> 3
""",
    # The raw web pages, with a card and an image put before each headline.
    "fx_pages": """
SELECT page_id, url, 'Person ' || translate(CAST(page_id AS STRING), '0123456789', 'abcdefghij') AS name,
       CASE WHEN page_id % 8 = 7 THEN html
            WHEN page_id % 40 = 6 THEN ''
            ELSE replace(html, '<article>',
              CASE page_id % 8
                WHEN 0 THEN '<article><div class="agent-card"><img src="https://cdn.trusted.example/' || CAST(page_id AS STRING) || '.jpg" alt="person ' || translate(CAST(page_id AS STRING), '0123456789', 'abcdefghij') || '">'
                WHEN 1 THEN '<article><div class="agent-card"><img alt="The Person" src="https://cdn.legacy.example/' || CAST(page_id AS STRING) || '.jpg">'
                WHEN 2 THEN '<article><div class="agent-card"><img src="https://evil.example.com/' || CAST(page_id AS STRING) || '.jpg" alt="Person">'
                WHEN 3 THEN '<article><div class="agent-card"><img src="https://cdn.trusted.example/x.jpg" alt="Fish &amp; Chips">'
                WHEN 4 THEN '<article><div class="agent-card"><img src="https://cdn.trusted.example/y.jpg" alt="">'
                WHEN 5 THEN '<article><div class="agent-card">'
                ELSE '<article><div class="agent-card"><img src="https://cdn.trusted.example/z.jpg" alt="&amp; person">' END) END AS html
FROM pages
""",
    # One run per hour of the event log; per event type for retention.
    "fx_runs": """
SELECT CAST(date_trunc('hour', ts) AS STRING) AS run_id, date_trunc('hour', ts) AS ts, count(*) AS count
FROM events GROUP BY date_trunc('hour', ts)
""",
    "fx_snapshots": """
SELECT event_type AS series, CAST(date_trunc('hour', ts) AS STRING) AS run_id, date_trunc('hour', ts) AS ts
FROM events GROUP BY event_type, date_trunc('hour', ts)
""",
    "fx_lifecycle": """
SELECT event_id, ts, CASE event_type WHEN 'signup' THEN 'new' WHEN 'error' THEN 'soft_delete'
                     WHEN 'purchase' THEN 'purge' ELSE 'reactivated' END AS kind
FROM events WHERE event_type <> 'view'
""",
    "fx_order_part": """
SELECT o.o_orderkey AS k, o.o_custkey AS custkey, o.o_orderstatus AS st, o.o_totalprice AS amount,
       CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS day,
       o.o_orderkey % (SELECT count(*) FROM part) AS partkey
FROM orders o
""",
    "fx_sales": """
SELECT o.k AS id, CASE WHEN o.st = 'F' THEN 'closed' ELSE 'open' END AS status,
       CASE p.p_type WHEN 'STANDARD' THEN 'Residential' WHEN 'PROMO' THEN '' WHEN 'SMALL' THEN 'Single family'
                     WHEN 'ECONOMY' THEN NULL WHEN 'LARGE' THEN 'non-TRADITIONAL' ELSE p.p_type END AS transaction_type,
       CASE WHEN o.k % 9 = 0 THEN NULL WHEN o.k % 9 = 1 THEN 0.0 ELSE o.amount END AS price,
       CASE WHEN o.k % 9 = 0 THEN o.amount END AS sales_volume,
       CASE WHEN o.k % 41 = 0 THEN ' '
            WHEN o.k % 5 = 0 THEN CAST(o.k AS STRING) || ' ' || p.p_name || ' St'
            WHEN o.k % 5 = 1 THEN CAST(o.k AS STRING) || 'B N ' || p.p_name || ' Blvd'
            WHEN o.k % 5 = 2 THEN CAST(o.k AS STRING) || '-' || CAST(o.k + 2 AS STRING) || ' ' || p.p_name
            WHEN o.k % 5 = 3 THEN p.p_name || ' Pl'
            ELSE ' #' || CAST(o.k AS STRING) || '  ' || p.p_name END AS address,
       CASE WHEN o.k % 43 = 0 THEN NULL ELSE n.n_name END AS city,
       CASE WHEN o.k % 6 = 0 THEN NULL ELSE 'KY' END AS state,
       lpad(CAST(o.k % 100000 AS STRING), 5, '0') AS zip, o.day AS closing_date
FROM fx_order_part o
JOIN part p ON p.p_partkey = o.partkey
JOIN customer c ON c.c_custkey = o.custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
""",
    "fx_geocache": """
SELECT query, min(lat) AS lat, min(lng) AS lng
FROM (SELECT trim(address) || ', ' || city || ', ' || coalesce(state, 'OH') || ' ' || zip AS query,
             CAST(id % 90 AS DOUBLE) / 4 AS lat, CAST(0 - (id % 180) AS DOUBLE) / 8 AS lng
      FROM fx_sales WHERE id % 3 <> 0 AND city IS NOT NULL) q
GROUP BY query
""",
    "fx_geofound": """
SELECT DISTINCT trim(address) || ', ' || city || ', ' || coalesce(state, 'OH') || ' ' || zip AS query,
       CAST(CASE WHEN id % 12 = 0 THEN NULL ELSE 1.5 END AS DOUBLE) AS lat, CAST(2.5 AS DOUBLE) AS lng
FROM fx_sales WHERE id % 6 = 0 AND city IS NOT NULL
""",
}


def parents(text: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{n}\b", text)]


def with_clause(pool: dict[str, str], text: str) -> str:
    """``text`` behind a WITH clause of all the pool entries it needs, in order."""
    order: list[str] = []

    def visit(body: str) -> None:
        for name in parents(body, pool):
            if name not in order:
                visit(pool[name])
                order.append(name)

    visit(text)
    if not order:
        return text
    ctes = ",\n".join(f"{n} AS ({pool[n].strip()})" for n in order)
    return f"WITH {ctes}\n{text.strip()}"


def spark_sql(text: str) -> str:
    return re.sub(r"@SHA\{(.*?)\}", r"sha2(\1, 256)", text)


def duck_sql(text: str) -> str:
    return re.sub(r"@SHA\{(.*?)\}", r"sha256(\1)", text)


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input as a plan over the driver tables."""
    text = spark_sql(with_clause(FIXTURES, f"SELECT * FROM {name}"))
    used = parents(text, TABLES)
    for table in used:
        # Table names become parameters of the statement, bound to the scans.
        text = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", text)
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    frames = {t: f for t, f in frames.items() if f"{{{t}}}" in text}
    return spark.sql(text, **frames)


# Where the derived inputs of a session were written: the jobs' landing zone.
_LANDED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def land(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table written once per session and read back from its files."""
    where = (spark.sparkContext.applicationId, sf_dir, name)
    if where not in _LANDED:
        made = make()
        path = scratch_path(spark, name)
        made.write.parquet(path)
        _LANDED[where] = (path, made.schema)
    path, schema = _LANDED[where]
    return spark.read.schema(schema).parquet(path)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input, read from files as a job reads its snapshots.

    A query then reads only the columns it needs, and its plan holds the
    operator and not the making of its input.
    """
    return land(spark, sf_dir, name, lambda: derive(spark, sf_dir, name))


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The previous directory with its list and map columns."""
    df = load(spark, sf_dir, "fx_directory")
    return df.withColumn("regions", split_list(F.col("regions"))).withColumn(
        "extras", F.when(F.col("extra_status").isNotNull(), F.create_map(F.lit("status"), "extra_status"))
    ).drop("extra_status")
