"""SQL face of the floor analyses: table functions over session views.

``register_series`` puts the history, the listings, the capped catalogue and its caps per category into
views and defines ``segment_floors``, ``daily_floors`` and ``bucket_floors`` over them. Their
arguments are scalars; wrong ones raise. The functions are plain queries, which the optimizer
inlines and plans like any other. Day series take the filters of ``pool_listings``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farthing.operators import pool
from farthing.plans import sql_surface
from farthing.sources import scratch

#: Mean of the first ``n`` of an ascending array, added in that order.
_MEAN = "aggregate({0}, 0.0D, (a, x) -> a + x) / size({0})"
_MICROS = "unix_micros(CAST({0} AS TIMESTAMP))"
_HOUR = "3600000000"

SEGMENT_FLOORS = f"""(p_since TIMESTAMP_NTZ, p_condition STRING DEFAULT 'New', p_min_listings INT DEFAULT 5, p_full_n INT DEFAULT 10,
      p_small_n INT DEFAULT 3, p_full_threshold INT DEFAULT 20, p_default_floor DOUBLE DEFAULT 0.10D)
    RETURNS TABLE (caliber_normalized STRING, bullet_type STRING, case_material STRING, segment_floor DOUBLE, listing_count INT)
    RETURN WITH priced AS (
        SELECT DISTINCT listing_id, CAST(price_per_round AS DOUBLE) AS ppr FROM price_history
         WHERE recorded_at >= p_since AND price_per_round > 0),
      lows AS (
        SELECT l.caliber_normalized, l.bullet_type, l.case_material, l.id, min(h.ppr) AS low
          FROM priced h JOIN price_listings l ON l.id = h.listing_id LEFT JOIN category_floors f ON f.category = l.caliber_normalized
         WHERE NOT l.is_component AND coalesce(l.condition_type = p_condition, p_condition IS NULL) AND l.caliber_normalized IS NOT NULL
           AND l.bullet_type IS NOT NULL AND l.case_material IS NOT NULL AND h.ppr >= coalesce(f.floor, p_default_floor)
         GROUP BY ALL),
      sizes AS (SELECT caliber_normalized, bullet_type, case_material, CAST(count(*) AS INT) AS n FROM lows GROUP BY ALL),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY caliber_normalized, bullet_type, case_material ORDER BY low, id) AS place FROM lows),
      first AS (
        SELECT caliber_normalized, bullet_type, case_material, array_sort(collect_list(low)) AS least FROM ranked
         WHERE place <= greatest(p_full_n, p_small_n) GROUP BY ALL)
    SELECT s.caliber_normalized, s.bullet_type, s.case_material, {_MEAN.format('slice(f.least, 1, if(s.n >= p_full_threshold, p_full_n, p_small_n))')}, s.n
      FROM sizes s JOIN first f USING (caliber_normalized, bullet_type, case_material) WHERE s.n >= p_min_listings"""

DAILY_FLOORS = f"""(p_category STRING, p_from TIMESTAMP_NTZ, p_as_of TIMESTAMP_NTZ, p_price_floor DOUBLE, p_hard_ceiling DOUBLE,
      p_to TIMESTAMP_NTZ DEFAULT NULL, p_case STRING DEFAULT NULL, p_condition STRING DEFAULT NULL, p_type STRING DEFAULT NULL,
      p_retailer INT DEFAULT NULL, p_atoms ARRAY<STRUCT<op: STRING, v: DOUBLE>> DEFAULT NULL, p_negate BOOLEAN DEFAULT false,
      p_model_weight DOUBLE DEFAULT NULL, p_model_type STRING DEFAULT NULL, p_brand STRING DEFAULT NULL, p_own ARRAY<STRING> DEFAULT NULL,
      p_every ARRAY<STRING> DEFAULT NULL, p_brands ARRAY<STRING> DEFAULT NULL, p_price_mult DOUBLE DEFAULT 1.0D,
      p_split STRING DEFAULT 'none', p_thresholds ARRAY<STRUCT<rid: INT, thr: DOUBLE>> DEFAULT NULL, p_target INT DEFAULT 0)
    RETURNS TABLE (series_key STRING, day DATE, value DOUBLE, pool_size INT)
    RETURN WITH members AS (
        SELECT id, CASE p_split WHEN 'none' THEN '' WHEN 'retailer' THEN CAST(retailer_id AS STRING)
                   WHEN 'condition' THEN coalesce(nullif(condition_type, ''), 'Unknown')
                   ELSE raise_error(concat('p_split must be none, retailer or condition, got ', coalesce(p_split, 'NULL'))) END AS series_key
          FROM pool_listings(p_category, p_case, p_condition, p_type, p_retailer, p_atoms, p_negate, p_model_weight, p_model_type,
                             p_brand, p_own, p_every, p_brands, p_thresholds, p_target)),
      sizes AS (SELECT series_key, CAST(count(*) AS INT) AS pool_size FROM members GROUP BY series_key),
      seen AS (
        SELECT h.listing_id, date_diff(CAST(h.recorded_at AS DATE), DATE '1970-01-01') AS day_no,
               CAST(h.price_per_round AS DOUBLE) * if(p_price_mult > 0, p_price_mult, CAST(raise_error('p_price_mult must be above 0') AS DOUBLE)) AS price
          FROM price_history h JOIN category_caps c ON c.category = p_category
         WHERE h.in_stock AND h.recorded_at >= p_from AND coalesce(h.recorded_at <= p_to, p_to IS NULL)
           AND h.recorded_at < CAST(CAST(p_as_of AS DATE) AS TIMESTAMP_NTZ)
           AND h.price_per_round >= p_price_floor AND h.price_per_round <= least(c.cap, p_hard_ceiling)),
      lows AS (SELECT listing_id, day_no, min(price) AS low FROM seen WHERE price > 0 GROUP BY listing_id, day_no),
      placed AS (
        SELECT m.series_key, l.day_no, l.low, row_number() OVER (PARTITION BY m.series_key, l.day_no ORDER BY l.low, l.listing_id) AS place
          FROM lows l JOIN members m ON m.id = l.listing_id WHERE m.series_key IS NOT NULL),
      means AS (SELECT series_key, day_no, array_sort(collect_list(low)) AS least FROM placed WHERE place <= 3 GROUP BY series_key, day_no)
    SELECT m.series_key, date_add(DATE '1970-01-01', m.day_no), {_MEAN.format('m.least')}, coalesce(s.pool_size, 0)
      FROM means m LEFT JOIN sizes s ON s.series_key = m.series_key"""

BUCKET_FLOORS = f"""(p_category STRING, p_end TIMESTAMP_NTZ, p_case STRING DEFAULT NULL, p_days INT DEFAULT 30, p_condition STRING DEFAULT 'New',
      p_bucket_hours INT DEFAULT 6, p_min_alive_fraction DOUBLE DEFAULT 0.25D, p_fresh_hours INT DEFAULT 6, p_cheapest_n INT DEFAULT 3,
      p_price_floor DOUBLE DEFAULT 0.05D, p_min_pool INT DEFAULT 5, p_exclude_ids ARRAY<BIGINT> DEFAULT array())
    RETURNS TABLE (day_bucket TIMESTAMP_NTZ, floor_cpr DOUBLE, alive_count BIGINT, pool_size BIGINT)
    RETURN WITH grid AS (
        SELECT {_MICROS.format("date_trunc('hour', p_end)")} - p_days * 24 * {_HOUR} AS origin, p_days * 24 div p_bucket_hours AS last,
               if(p_fresh_hours = p_bucket_hours, p_bucket_hours, CAST(raise_error('p_fresh_hours must equal p_bucket_hours') AS INT)) * {_HOUR} AS step),
      members AS (
        SELECT id FROM price_listings
         WHERE caliber_normalized = p_category AND coalesce(case_material = p_case, p_case IS NULL)
           AND coalesce(condition_type = p_condition, p_condition IS NULL) AND in_stock AND NOT array_contains(p_exclude_ids, id)),
      size AS (SELECT count(*) AS n, greatest(3, ceil(count(*) * p_min_alive_fraction)) AS need FROM members),
      binned AS (
        SELECT h.listing_id, h.id, h.recorded_at, CAST(h.price_per_round AS DOUBLE) AS ppr,
               CAST(ceil(({_MICROS.format('h.recorded_at')} - g.origin) / g.step) AS BIGINT) AS bucket
          FROM price_history h CROSS JOIN grid g
         WHERE h.recorded_at > date_trunc('hour', p_end) - make_dt_interval(p_days, p_bucket_hours) AND h.recorded_at <= date_trunc('hour', p_end)
           AND h.price_per_round >= p_price_floor),
      latest AS (SELECT listing_id, bucket, max_by(ppr, struct(recorded_at, id)) AS ppr FROM binned GROUP BY listing_id, bucket),
      placed AS (
        SELECT l.bucket, l.ppr, row_number() OVER (PARTITION BY l.bucket ORDER BY l.ppr, l.listing_id) AS place
          FROM latest l JOIN members m ON m.id = l.listing_id),
      marked AS (SELECT bucket, if(place <= p_cheapest_n, ppr, NULL) AS low FROM placed),
      counts AS (SELECT bucket, count(*) AS alive, array_sort(collect_list(low)) AS least FROM marked GROUP BY bucket),
      gated AS (
        SELECT b.bucket, g.origin + b.bucket * g.step AS at, coalesce(c.alive, 0) AS alive, s.n,
               if(c.alive >= s.need, {_MEAN.format('c.least')}, NULL) AS floor
          FROM grid g CROSS JOIN size s CROSS JOIN LATERAL (SELECT explode(sequence(0L, CAST(g.last AS BIGINT))) AS bucket) b
          LEFT JOIN counts c ON c.bucket = b.bucket),
      carried AS (SELECT *, last_value(floor) IGNORE NULLS OVER (ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS filled FROM gated)
    SELECT CAST(timestamp_micros(at) AS TIMESTAMP_NTZ), filled, alive, n FROM carried WHERE filled IS NOT NULL AND n >= p_min_pool"""

FUNCTIONS = {"segment_floors": SEGMENT_FLOORS, "daily_floors": DAILY_FLOORS, "bucket_floors": BUCKET_FLOORS}


def register_series(spark: SparkSession, history: DataFrame, listings: DataFrame, floors: DataFrame, mult: float = 5.0, cap_mult: float = 5.0) -> None:
    """Views and functions for this session; ``floors`` are (category, floor)."""
    sql_surface.register(spark, listings, mult)
    history.createOrReplaceTempView("price_history")
    listings.createOrReplaceTempView("price_listings")
    floors.select(F.col(floors.columns[0]).alias("category"), F.col(floors.columns[1]).alias("floor")).createOrReplaceTempView("category_floors")
    # Every call reads the catalogue and its caps: they are worked out once.
    catalog = scratch.stored(spark.table("capped_catalog"), "catalog")
    catalog.createOrReplaceTempView("capped_catalog")
    caps = scratch.stored(pool.outlier_caps(catalog, mult=cap_mult), "caps")
    caps.select(F.col("caliber_normalized").alias("category"), "cap").createOrReplaceTempView("category_caps")
    for name, text in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{text}")
