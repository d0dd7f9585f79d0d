"""Listings, history and pages derived from the supplied tables.

The texts are common SQL of Spark and DuckDB (``{TS}`` is the one difference:
the name of the zone-less timestamp type), so both sides of a check start from
the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farthing.session import pin_utc


#: Session option of a local bench: deal text tables over so many partitions.
PARTS_KEY = "farthing.fixtures.partitions"


def pick(expression: str, words: list[str]) -> str:
    """SQL that picks a word by an integer expression."""
    arms = " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(words))
    return f"CASE CAST(({expression}) % {len(words)} AS INT) {arms} END"


CATEGORIES = ["9mm", "223-556", "22lr", "380acp", "40sw", "308win", "762x39", "300blk", "38spl", "357mag", "45acp",
              "10mm", "30-06", "270win", "6.5cm", "223"]
TITLE_CATEGORIES = ["9mm Luger", ".223 Remington", "5.56 NATO", ".22 LR", ".380 ACP", ".40 S&W", ".308 Winchester",
                    "7.62x39", "300 Blackout", ".38 Special", ".357 Magnum", ".45 ACP", "10mm Auto",
                    ".30-06 Springfield", "270 Win", "6.5 Creedmoor", "45 Auto", "38 Spl/357 Mag"]
TITLE_BRANDS = ["Federal American Eagle", "Winchester", "CCI Blazer Brass", "Hornady Frontier", "PMC Bronze",
                "Sellier & Bellot", "Wolf", "Fiocchi", "Prvi Partizan (PPU)", "Speer Gold Dot", "Nosler", "Barnes",
                "Acme", "Red Army Steel Case", "Magtech"]
TITLE_TYPES = ["FMJ", "JHP", "Soft Point", "V-Max", "Full Metal Jacket", "Ballistic Tip", "TMJ", "Lead Round Nose",
               "HPBT Match", "Flat Nose", "Core", "Open Tip Match", "Polymer-Tip JHP"]
TITLE_PACKS = ["50 Rounds", "20rd Box", "1,000 Rounds Case", "500 Count", "20/Box", "Box of 100", "50rd Box x 10",
               "50/20", "25 ct", "200RDS", "250 per box", "pack"]
TITLE_NOTES = ["", "Limit 2", "Max Qty: 5", "Reman", "5 per customer", "Limit 0", "brass", "Nickel", "Aluminum",
               "Sold Out", "In stock"]

VIEWS = {
    "v_listings": f"""
SELECT p_partkey AS id, CAST(p_partkey % 10 AS INT) AS retailer_id,
       'k-' || CAST(p_partkey AS STRING) AS retailer_product_id,
       'https://www.shop' || CAST(p_partkey % 10 AS STRING) || '.example.com/' || lower(p_type) || '/' ||
       replace(p_name, ' ', '-') || '-' || replace(lower(p_brand), '#', '') || '-' || CAST(p_partkey AS STRING)
         || CASE WHEN p_partkey % 5 = 0 THEN '/' ELSE '' END AS product_url,
       p_type AS caliber, p_type AS caliber_normalized, p_size AS grain,
       CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE split_part(p_name, ' ', 1) END AS bullet_type,
       split_part(p_name, ' ', 2) AS case_material,
       CASE WHEN p_partkey % 10 = 0 THEN 'Remanufactured' ELSE 'New' END AS condition_type,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_brand END AS manufacturer,
       CASE p_partkey % 4 WHEN 0 THEN 20 WHEN 1 THEN 50 WHEN 2 THEN 100 ELSE 1000 END AS total_rounds,
       p_retailprice / 1000 * (1 + (p_partkey % 7) * 1.5) AS price_per_round,
       p_retailprice / 1000 * (1 + (p_partkey % 7) * 1.5)
         * CASE p_partkey % 4 WHEN 0 THEN 20 WHEN 1 THEN 50 WHEN 2 THEN 100 ELSE 1000 END
         * CASE WHEN p_partkey % 23 = 0 THEN 2 ELSE 1 END AS base_price,
       p_partkey % 3 <> 0 AS in_stock,
       p_partkey % 17 = 0 AS is_component,
       CAST('2024-01-31 00:00:00' AS {{TS}}) - INTERVAL '1' HOUR * CAST((p_partkey * 37) % 400 AS INT) AS last_updated
  FROM part""",
    "v_obs": """
SELECT event_id AS id, user_id AS listing_id, value * 50 AS price, value AS price_per_round,
       event_type <> 'error' AS in_stock, ts AS recorded_at
  FROM events""",
    "v_steps": """
SELECT event_id AS id, user_id % 20 AS listing_id, 10 + CAST(floor(value / 40) AS DOUBLE) * 0.003 AS price,
       CAST(floor(value / 150) AS DOUBLE) * 0.00004 AS price_per_round, event_id % 11 <> 0 AS in_stock,
       ts AS recorded_at
  FROM events""",
    "v_history": """
SELECT CAST(l_orderkey AS BIGINT) * 1000 + l_linenumber AS id, l_partkey AS listing_id,
       CAST(l_suppkey AS INT) AS retailer_id, l_shipdate AS recorded_at, l_extendedprice AS price,
       l_extendedprice / l_quantity AS price_per_round, l_returnflag <> 'R' AS in_stock
  FROM lineitem""",
    "v_retailers": """
SELECT CAST(s_suppkey AS INT) AS id, 'shop-' || CAST(s_suppkey AS STRING) AS slug, s_name AS name,
       s_suppkey % 9 <> 0 AS is_active,
       CASE WHEN s_suppkey % 11 = 0 THEN NULL
            ELSE CAST('2024-01-31 00:00:00' AS {TS}) - INTERVAL '1' HOUR * CAST((s_suppkey * 7) % 100 AS INT)
       END AS last_scraped_at,
       CASE WHEN s_suppkey % 8 = 0 THEN 0.0 ELSE s_acctbal / 20 END AS free_ship_threshold
  FROM supplier""",
    "v_gate": f"""
SELECT CAST(l_orderkey AS BIGINT) * 1000 + l_linenumber AS id, {pick('l_partkey', CATEGORIES)} AS caliber_normalized,
       l_extendedprice / 4000 * CASE WHEN l_partkey % 7 = 0 THEN 2 ELSE 1 END AS base_price,
       CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END AS total_rounds,
       CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE l_extendedprice / 4000 / l_quantity END AS price_per_round,
       CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_tax * 10 + 0.11 END AS display_ppr
  FROM lineitem""",
    "v_titles": f"""
SELECT id, retailer_id, source, page_category,
       brand || ' ' || cat || ' ' || CAST(weight AS STRING) || 'gr ' || kind || ' - ' || pack
         || CASE WHEN note = '' THEN '' ELSE ' ' || note END AS title,
       'https://www.shop' || CAST(retailer_id AS STRING) || '.example.com/' ||
       replace(replace(replace(lower(brand || ' ' || cat || ' ' || kind), ' ', '-'), '.', ''), '&', 'and') || '-' ||
       CAST(partkey AS STRING) AS product_url,
       partkey
  FROM (
    SELECT CAST(l_orderkey AS BIGINT) * 1000 + l_linenumber AS id, CAST(l_suppkey % 10 AS INT) AS retailer_id,
           {pick('l_suppkey', ['simple', 'wide', 'slash_bounded', 'case_first', 'other'])} AS source,
           {pick('l_partkey', CATEGORIES)} AS page_category,
           {pick('l_partkey + l_linenumber', TITLE_BRANDS)} AS brand,
           {pick('l_partkey * 3 + l_suppkey', TITLE_CATEGORIES)} AS cat,
           55 + l_partkey % 120 AS weight,
           {pick('l_orderkey + l_linenumber', TITLE_TYPES)} AS kind,
           {pick('l_orderkey * 5 + l_suppkey', TITLE_PACKS)} AS pack,
           {pick('l_orderkey + l_partkey', TITLE_NOTES)} AS note,
           l_partkey AS partkey
      FROM lineitem) t""",
    "v_rebates": f"""
SELECT b AS id, 'Brand#' || CAST(b AS STRING) AS brand, 'Offer ' || CAST(b AS STRING) AS title,
       CASE WHEN b % 5 = 0 THEN NULL ELSE CAST(b AS DOUBLE) END AS amount_max_per_unit,
       {pick('b', ['a', 'b', 'c'])} AS source, CASE WHEN b % 3 = 0 THEN 'small' WHEN b % 3 = 1 THEN 'big' END AS firearm_type,
       n AS listing_count
  FROM (SELECT CAST(replace(p_brand, 'Brand#', '') AS INT) AS b, count(*) AS n FROM part GROUP BY p_brand) t""",
    "v_eligible": """
SELECT b AS rebate_id, row_number() OVER (PARTITION BY b ORDER BY p_name) AS line_no, p_name AS product_line,
       CASE WHEN length(p_name) % 3 = 0 THEN split_part(p_name, ' ', 2) END AS match_pattern,
       CASE WHEN length(p_name) % 4 = 0 THEN CAST(length(p_name) AS DOUBLE) END AS amount_override
  FROM (SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS INT) AS b, p_name FROM part) t""",
    "v_spec": """
SELECT id, brand, caliber_normalized, grain, bullet_type, sku, product_line, muzzle_velocity_fps
  FROM (
    SELECT p_partkey AS id, p_brand AS brand, p_type AS caliber_normalized, p_size AS grain,
           upper(split_part(p_name, ' ', 1)) AS bullet_type,
           'SK ' || CAST(p_partkey AS STRING) || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'x' END AS sku,
           split_part(p_name, ' ', 2) || ' ' || CASE WHEN p_partkey % 3 = 0 THEN 'the pack' ELSE p_brand END AS product_line,
           CAST(900 + p_partkey % 5 * 50 AS INT) AS muzzle_velocity_fps
      FROM part
    UNION ALL
    SELECT p_partkey + 1000000 AS id, p_brand AS brand, p_type AS caliber_normalized, p_size AS grain,
           upper(split_part(p_name, ' ', 1)) AS bullet_type, 'NONE' || CAST(p_partkey AS STRING) AS sku,
           split_part(p_name, ' ', 2) || ' brand' || replace(p_brand, 'Brand#', '') || ' ' || CAST(p_partkey AS STRING) AS product_line,
           CAST(1200 + p_partkey % 3 * 50 AS INT) AS muzzle_velocity_fps
      FROM part) t""",
}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]
# Tables each view reads; a query registers only what it uses.
SOURCES = {"v_listings": "part", "v_obs": "events", "v_steps": "events", "v_history": "lineitem",
           "v_retailers": "supplier", "v_gate": "lineitem", "v_titles": "lineitem", "v_rebates": "part",
           "v_eligible": "part", "v_spec": "part"}


# Columns of the views whose rows feed long rule cascades.
TEXT_VIEWS = {"v_titles": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    frame = pin_utc(spark).read.parquet(f"{folder}/{name}.parquet")
    return _dealt(frame) if name in ("documents", "pages") else frame


def _dealt(frame: DataFrame) -> DataFrame:
    """The rows over as many partitions as a bench of small files asks for; no other session does."""
    parts = frame.sparkSession.conf.get(PARTS_KEY, None)
    return frame.repartition(int(parts)) if parts else frame


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A derived view as a DataFrame over the folder's tables."""
    source = SOURCES[name]
    frame = table(spark, folder, source)
    if name in TEXT_VIEWS:
        frame = _dealt(frame.select(*TEXT_VIEWS[name]))
    return spark.sql(VIEWS[name].format(TS="TIMESTAMP_NTZ").replace(f"FROM {source}", "FROM {base}"), base=frame)


def oracle_views(names: list[str]) -> str:
    """WITH items for DuckDB."""
    return ", ".join(f"{n} AS ({VIEWS[n].format(TS='TIMESTAMP')})" for n in names)
