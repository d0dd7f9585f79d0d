"""SQL checks of the registered queries, in DuckDB's dialect.

Each text is an independent formulation over the same tables. Rule cascades
are spelled out from the same fixed rule tables; look-around patterns, which
the other engine's regex library lacks, are written as equivalent tests.
"""

from __future__ import annotations

from farthing.functions.rules import longest_first
from farthing.plans import queries as q
from farthing.plans.fixtures import VIEWS, oracle_views
from farthing.rulebook import brands, categories, components, packs, types

CHECKS: dict[str, str] = {}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(data: list[tuple], columns: str) -> str:
    def cell(v):
        return "NULL" if v is None else quoted(v) if isinstance(v, str) else f"CAST({v} AS DOUBLE)"

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in data)
    return f"(SELECT * FROM (VALUES {body}) AS t({columns}))"


def exact_rounding(sql: str) -> str:
    """Replace ROUND_EVEN calls by printf, which rounds the exact binary value."""
    while "round_even(" in sql:
        start = sql.index("round_even(")
        depth, end = 0, start + len("round_even")
        while True:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            if depth == 0:
                break
            end += 1
        value, digits = sql[start + len("round_even(") : end].rsplit(",", 1)
        sql = f"{sql[:start]}CAST(printf('%.{digits.strip()}f', CAST({value} AS DOUBLE)) AS DOUBLE){sql[end + 1:]}"
    return sql


def check(name: str, body: str, ctes: str = "") -> None:
    """Register a check; the views its text mentions are put in front."""
    body, ctes = exact_rounding(body), exact_rounding(ctes)
    used = [v for v in VIEWS if v in body or v in ctes]
    parts = [p for p in (oracle_views(used), ctes) if p]
    CHECKS[name] = (f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body).strip()


def regex(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {quoted(pattern)})"


# Patterns with look-around and their equivalents for these titles.
EQUIVALENT = {
    r"\b9\s*mm(?=\d)": lambda c: regex(c, r"\b9\s*mm\d"),
    r"\b\.?45\s*auto\b(?!\s*rim)": lambda c: f"({regex(c, r'\b\.?45\s*auto\b')} AND NOT {regex(c, r'\b\.?45\s*auto\s*rim')})",
    r"\b\.?30[\s-]?06(?![0-9])": lambda c: regex(c, r"\b\.?30[\s-]?06([^0-9]|$)"),
    r"(?=.*\bmc\b)(?=.*\b(?:umc|remington)\b)": lambda c: f"({regex(c, r'\bmc\b')} AND {regex(c, r'\b(?:umc|remington)\b')})",
    r"(?=.*\bcx(?:tm)?\b)(?=.*\bhornady\b)": lambda c: f"({regex(c, r'\bcx(?:tm)?\b')} AND {regex(c, r'\bhornady\b')})",
}


def test(column: str, kind: str, pattern: str) -> str:
    if kind == "sub":
        return f"contains({column}, {quoted(pattern)})"
    if pattern.startswith(r"(?:\b270"):
        return (f"(({regex(column, r'\b270\s*win(?:chester)?\b')} AND NOT {regex(column, r'270\s*win(?:chester)?\s*short')})"
                f" OR {regex(column, r'\b\.270\b')})")
    return EQUIVALENT[pattern](column) if pattern in EQUIVALENT else regex(column, pattern)


def cascade(column: str, table) -> str:
    arms = " ".join(
        f"WHEN {' OR '.join(test(column, k, p) for k, p in specs)} THEN {quoted(value)}" for value, specs in table
    )
    return f"CASE {arms} END"


def words(column: str, table) -> str:
    return cascade(column, [(v, [("sub", w)]) for w, v in table])


CATEGORY = cascade("low", categories.CATEGORY_CASCADE)
BRAND_TEXT = "regexp_replace(translate(lower({c}), '-_/', '   '), " + quoted(brands.BRAND_NOISE.replace("(?iU)", "")) + ", ' ', 'gi')"
BRAND = words("bt", longest_first(brands.BRAND_ALIASES))
TYPE_TEXT = r"trim(regexp_replace(translate(lower({c}), '-_/.()', '      '), '\s+', ' ', 'g'))"
TYPE = cascade("tt", [(v, [("re", p)]) for p, v in types.TYPE_CASCADE])
LAST = r"regexp_extract(regexp_replace(regexp_replace({c}, '[?#].*$', ''), '/+$', ''), '([^/]*)$', 1)"


def brand_of(column: str) -> str:
    return BRAND.replace("bt,", f"{column},")


def type_of(column: str) -> str:
    return TYPE.replace("tt,", f"{column},")


def in_list(items) -> str:
    return "(" + ", ".join(quoted(i) for i in items) + ")"


def any_word(column: str, items) -> str:
    return "(" + " OR ".join(f"contains({column}, {quoted(i)})" for i in items) + ")"


# -- sources -------------------------------------------------------------------
check("read_tables", "SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
check("incremental_read", "SELECT event_id, user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'")
check("keyset_slice", "SELECT event_id, user_id, value FROM events WHERE event_id > 500 ORDER BY event_id LIMIT 100")
check("content_hash", "SELECT page_id, sha256(html) AS html_hash FROM pages")
check("upsert_merge", """
SELECT l.id, CASE WHEN l.id % 3 <> 1 THEN retailer_id END AS retailer_id,
       CASE WHEN l.id % 5 = 0 THEN base_price * 2 ELSE base_price END AS base_price,
       CASE WHEN l.id % 3 <> 1 THEN in_stock END AS in_stock,
       CASE WHEN l.id % 3 = 1 AND l.id % 2 = 1 THEN NULL ELSE last_updated END AS last_updated
  FROM v_listings l WHERE l.id % 3 <> 1 OR l.id % 5 = 0""")
check("upsert_buckets", """
SELECT l.id, CASE WHEN l.id % 3 <> 1 THEN retailer_id END AS retailer_id,
       CASE WHEN l.id % 5 = 0 THEN base_price * 2 ELSE base_price END AS base_price,
       CASE WHEN l.id % 3 <> 1 THEN in_stock END AS in_stock,
       CASE WHEN l.id % 3 = 1 AND l.id % 2 = 1 THEN NULL ELSE last_updated END AS last_updated
  FROM v_listings l WHERE l.id % 3 <> 1 OR l.id % 5 = 0""")
check("read_bounds", """SELECT category, lo, hi, count(*) FILTER (WHERE price_per_round >= lo AND price_per_round <= hi) AS inside, count(*) AS n
  FROM v_listings l JOIN (SELECT caliber_normalized AS category, round(min(price_per_round) * 1.5, 4) AS lo, round(max(price_per_round) * 0.8, 4) AS hi FROM v_listings GROUP BY 1) b
    ON b.category = l.caliber_normalized GROUP BY 1, 2, 3""")
check("read_telemetry", """SELECT 'r' || user_id % 7 AS retailer, event_type AS verdict, count(*) AS n, CAST(sum(user_id % 11) AS BIGINT) AS products, CAST(max(event_id % 3 * 100 + 200) AS INT) AS status
    FROM events WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 GROUP BY 1, 2
  UNION ALL SELECT 'unreadable', NULL, count(*), NULL, NULL FROM events WHERE event_id % 17 = 0""")
check("append_observations", """SELECT CAST(CAST(recorded_at AS DATE) AS VARCHAR) AS day, count(*) AS n, min(id) AS first_id, count(*) FILTER (WHERE in_stock) AS stocked FROM v_obs GROUP BY 1""")
check("append_jsonl", "SELECT listing_id, count(*) AS n, max(price) AS highest FROM v_obs GROUP BY 1")
check("refresh_materialized", f"""SELECT v AS version, caliber_normalized, count(*) AS n, min(price_per_round) AS lowest, TIMESTAMP '{q.AS_OF}' AS refreshed_at
  FROM v_listings, (SELECT CAST(unnest([1, 2]) AS INT) AS v) WHERE v = 2 OR in_stock GROUP BY 1, 2""")

check("replace_children", """
SELECT rebate_id, product_line, amount_override FROM v_eligible WHERE rebate_id % 4 <> 0
UNION ALL SELECT rebate_id, upper(product_line), 1.0 FROM v_eligible WHERE rebate_id % 8 = 0""")

# -- filters -------------------------------------------------------------------
check("optional_eq", """SELECT id, price_per_round FROM v_listings
 WHERE caliber_normalized = 'PROMO' AND condition_type = 'New' AND price_per_round > 0 AND is_component IS NOT TRUE""")
check("exclude_ids", "SELECT id FROM v_listings WHERE id NOT IN (1, 2, 3, 4, 5) AND id % 7 <> 0")
HIT = "(grain < 12 OR grain = 25 OR grain > 40)"
check("bucket_match", f"""SELECT id, {HIT} AS named_bucket, NOT {HIT} AS other_bucket,
       CASE WHEN grain = 7 THEN FALSE ELSE NOT {HIT} END AS null_weight,
       CASE WHEN grain = 9 THEN TRUE ELSE NOT {HIT} END AS nan_weight FROM v_listings""")
check("brand_match", """SELECT id, CASE WHEN manufacturer IS NOT NULL AND manufacturer <> '' THEN
    CASE WHEN lower(trim(manufacturer)) IN ('brand#7', 'brand#9') THEN lower(trim(manufacturer)) IN ('brand#7') ELSE trim(manufacturer) = 'brand7' END
  WHEN product_url <> '' THEN coalesce(
    (SELECT b FROM (VALUES ('brand2', 1), ('brand7', 2), ('brand1', 3)) AS t(b, o) WHERE strpos(lower(product_url), b) > 0 ORDER BY o LIMIT 1) = 'brand7', FALSE)
  ELSE FALSE END AS is_brand FROM v_listings""")


def cart(target: int) -> str:
    boxes = f"ceil(CAST({target} AS DOUBLE) / CAST(total_rounds AS DOUBLE))" if target else "1.0"
    return f"""EXISTS (SELECT 1 FROM {values(q.THRESHOLDS, 'rid, thr')} f WHERE f.rid = s.retailer_id AND (f.thr <= 0
      OR s.price_per_round IS NULL OR ((s.total_rounds IS NULL OR s.total_rounds <= 0) AND {target} > 0)
      OR (CASE WHEN s.total_rounds IS NULL OR s.total_rounds <= 0 THEN 0.0 ELSE (s.price_per_round * s.total_rounds) * {boxes} END) >= f.thr))"""


check("free_shipping", f"SELECT id, retailer_id FROM v_listings s WHERE {cart(200)}")


def capped(mult: float) -> str:
    return f"""priced AS (SELECT caliber_normalized AS cal, price_per_round AS price,
      row_number() OVER (PARTITION BY caliber_normalized ORDER BY price_per_round) AS rn,
      count(*) OVER (PARTITION BY caliber_normalized) AS n FROM v_listings
     WHERE is_component IS NOT TRUE AND caliber_normalized IS NOT NULL AND caliber_normalized <> '' AND price_per_round > 0),
  caps AS (SELECT cal, price * {mult} AS cap FROM priced WHERE rn = (n // 2) + 1),
  stage1 AS (SELECT l.* FROM v_listings l LEFT JOIN caps c ON c.cal = l.caliber_normalized
     WHERE l.is_component IS NOT TRUE AND (c.cap IS NULL OR (l.price_per_round > 0 AND l.price_per_round <= c.cap)))"""


CAPPED = capped(3.0)
check("pool_filter", f"""SELECT id, retailer_id, grain, price_per_round FROM stage1 s WHERE caliber_normalized = 'PROMO'
   AND condition_type = 'New' AND NOT {HIT} AND {cart(0)}""", CAPPED)
check("stale_in_stock", f"SELECT id, last_updated FROM v_listings WHERE in_stock AND last_updated < TIMESTAMP '{q.AS_OF}' - INTERVAL 48 HOUR")
check("active_window", """SELECT id, CAST(valid_through AS VARCHAR) AS valid_through, CAST(submit_by AS VARCHAR) AS submit_by, last_seen_active_at FROM (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS valid_through,
   CAST(CAST(o_orderdate AS DATE) + 10 AS DATE) AS submit_by, o_orderdate - INTERVAL 100 DAY AS last_seen_active_at FROM orders)
 WHERE valid_through >= DATE '1998-06-01' AND submit_by >= DATE '1998-06-01'
   AND last_seen_active_at >= TIMESTAMP '1998-06-01 12:00:00' - INTERVAL 720 HOUR""")
check("title_filter", "SELECT title, count(*) AS n FROM v_titles WHERE regexp_matches(title, '(?i)gold|bronze') GROUP BY 1")
check("accessory_blocklist", f"""SELECT title, count(*) AS n FROM v_titles
 WHERE NOT ({any_word('lower(title)', ['core', 'limit 2'])} OR {any_word('lower(product_url)', ['-vmax', 'magtech-'])}) GROUP BY 1""")
check("promo_filter", "SELECT retailer_id, count(*) AS n FROM v_titles WHERE NOT contains(product_url, '/wolf-') GROUP BY 1")
check("slug_conflict", f"""SELECT caliber_normalized, count(*) AS n FROM (
  SELECT {CATEGORY} AS caliber_normalized, product_url, regexp_replace(title, 'FMJ|Acme', '', 'g') AS title
    FROM (SELECT *, lower(title) AS low FROM v_titles)) t
 WHERE NOT coalesce(
   (caliber_normalized = '9mm' AND regexp_matches(lower(product_url), 'wolf-9mm') AND NOT regexp_matches(lower(title), 'wolf-9mm'))
   OR (caliber_normalized = '270win' AND regexp_matches(lower(product_url), '\\bfmj\\b') AND NOT regexp_matches(lower(title), '\\bfmj\\b'))
   OR (caliber_normalized = '308win' AND regexp_matches(lower(product_url), '\\bacme\\b') AND NOT regexp_matches(lower(title), '\\bacme\\b')), FALSE)
 GROUP BY 1""")
TAGGED = f"tagged AS (SELECT page_category, {CATEGORY} AS own, low FROM (SELECT page_category, lower(title) AS low FROM v_titles))"
SPECS = dict(categories.CATEGORY_CASCADE)
BOTH = " AND ".join("(" + " OR ".join(test("low", k, p) for k, p in SPECS[c]) + ")" for c in ("38spl", "357mag"))
check("title_retag", f"""SELECT page_category, CASE WHEN page_category IN ('38spl', '357mag') AND own IN ('38spl', '357mag') AND {BOTH}
   THEN page_category ELSE own END AS caliber_normalized, count(*) AS n FROM tagged WHERE own IS NOT NULL GROUP BY 1, 2""", TAGGED)
check("title_strict", "SELECT page_category, own AS caliber_normalized, count(*) AS n FROM tagged WHERE own = page_category GROUP BY 1, 2", TAGGED)
check("title_lenient", "SELECT page_category, page_category AS caliber_normalized, count(*) AS n FROM tagged WHERE own IS NULL OR own = page_category GROUP BY 1, 2", TAGGED)
check("constraint_audit", """
SELECT 'price_positive' AS rule, count(*) AS violations FROM v_listings WHERE NOT price_per_round > 0
UNION ALL SELECT 'pack_at_least_50', count(*) FROM v_listings WHERE NOT total_rounds >= 50
UNION ALL SELECT 'known_condition', count(*) FROM v_listings WHERE NOT condition_type IN ('New')
UNION ALL SELECT 'maker_present', count(*) FROM v_listings WHERE manufacturer IS NULL
UNION ALL SELECT 'url_length', count(*) FROM v_listings WHERE NOT length(product_url) <= 55
UNION ALL SELECT 'unique(retailer_product_id)', CAST(count(*) - count(DISTINCT retailer_product_id) AS BIGINT) FROM v_listings
UNION ALL SELECT 'unique(retailer_id,grain,manufacturer)', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (
   SELECT count(*) AS n FROM v_listings WHERE manufacturer IS NOT NULL GROUP BY retailer_id, grain, manufacturer)""")

# -- price integrity --------------------------------------------------------------
CAPTURE = values(categories.CAPTURE_BOUNDS + [(n, *dict((c, (lo, hi)) for c, lo, hi in categories.CAPTURE_BOUNDS)[c])
                                              for n, c in categories.LOOSE_CATEGORY_KEYS.items()], "cat, blo, bhi")
check("price_gate", f"""SELECT caliber_normalized, CASE WHEN p IS NULL THEN 'null' WHEN p < 0.01 OR p > 5 THEN 'absolute'
   WHEN p < lo THEN 'floor' WHEN p > hi THEN 'ceiling'
   WHEN base_price > 0 AND total_rounds > 0 AND abs(p - base_price / total_rounds) / (base_price / total_rounds) > 0.25
        AND abs(p - base_price / total_rounds) > 0.10 THEN 'inconsistent' ELSE 'ok' END AS gate_reason, lo, hi, count(*) AS n
  FROM (SELECT g.*, price_per_round AS p, coalesce(blo, 0.15) AS lo, coalesce(bhi, 3.0) AS hi FROM v_gate g
        LEFT JOIN {CAPTURE} b ON b.cat = g.caliber_normalized) GROUP BY 1, 2, 3, 4""")
COUNTS = """counted AS (SELECT base_price, display_ppr,
   coalesce(total_rounds, CASE WHEN display_ppr > 0 THEN greatest(1, CAST(round_even(base_price / display_ppr, 0) AS BIGINT)) END) AS one,
   coalesce(total_rounds, CASE WHEN round_even(base_price / display_ppr, 0) >= 2 THEN CAST(round_even(base_price / display_ppr, 0) AS BIGINT) END) AS two
   FROM v_gate)"""
check("derive_unit_price", """SELECT one AS total_rounds, count(*) AS n,
   min(round_even(base_price / one, 4)) AS lowest, max(round_even(base_price / one, 4)) AS highest FROM counted GROUP BY 1""", COUNTS)
check("derive_minimum_two", """SELECT two AS total_rounds, count(*) AS n,
   min(coalesce(display_ppr, round_even(base_price / two, 4))) AS lowest,
   max(coalesce(display_ppr, round_even(base_price / two, 4))) AS highest FROM counted GROUP BY 1""", COUNTS)
VARIANTS = """SELECT handle, pos, pk, available, price, coalesce(CASE WHEN o BETWEEN 10 AND 10000 THEN o END, CASE WHEN t BETWEEN 10 AND 10000 THEN t END) AS rounds
     FROM (SELECT CAST(l_orderkey AS VARCHAR) AS handle,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice,
                CASE WHEN l_partkey % 3 = 0 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) END NULLS FIRST) AS pos,
             CASE WHEN l_partkey % 3 = 0 THEN CAST(l_quantity AS INT) END AS o, CAST(l_partkey % 60 AS INT) AS t,
             CASE WHEN l_partkey % 7 = 0 THEN 0.0 ELSE CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE) END AS price,
             l_returnflag <> 'R' AS available, l_partkey AS pk FROM lineitem)"""
PICKED = "rounds AS total_rounds, price AS base_price, available AS in_stock, round_even(price / rounds, 4) AS price_per_round"
for name, order in (("variant_pick", "rounds, pos"), ("variant_first", "pos")):
    check(name, f"""SELECT handle, handle AS retailer_product_id, {PICKED} FROM (SELECT *, row_number() OVER (PARTITION BY handle ORDER BY {order}) AS rn
      FROM ({VARIANTS}) WHERE rounds IS NOT NULL AND price > 0) WHERE rn = 1""")
check("variant_each", f"""SELECT repeat('h', 100) || handle AS handle, repeat('h', 100) || handle || '-' || pk AS retailer_product_id, {PICKED}
  FROM ({VARIANTS}) WHERE rounds IS NOT NULL AND price > 0""")
check("unescape", "SELECT doc_id, sha256(text || chr(128512) || '&lt;') AS text_hash FROM documents")
check("category_audit", f"""SELECT *, CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'WARNING' THEN 1 ELSE 2 END AS severity_rank FROM (
  SELECT caliber_normalized, n, min_price, max_price, round(avg_price, 6) AS avg_price,
    CASE WHEN min_price < 0.05 OR max_price > 5 OR avg_price > coalesce(hi, 5.0) * 3 THEN 'CRITICAL' WHEN n < 5 THEN 'WARNING' ELSE 'HEALTHY' END AS severity,
    concat_ws(',', CASE WHEN n < 5 THEN 'few_listings' END, CASE WHEN min_price < 0.05 THEN 'min_below_floor' END,
       CASE WHEN max_price > 5 THEN 'max_above_ceiling' END, CASE WHEN avg_price > coalesce(hi, 5.0) * 3 THEN 'avg_above_expected' END) AS flags
   FROM (SELECT caliber_normalized, count(*) AS n, min(price_per_round) AS min_price, max(price_per_round) AS max_price, avg(price_per_round) AS avg_price
           FROM v_gate WHERE price_per_round > 0 GROUP BY 1) s
   LEFT JOIN {values(q.EXPECTED, 'cat, lo, hi')} e ON e.cat = s.caliber_normalized)""")
check("over_ceiling", f"""SELECT coalesce(caliber_normalized, '(null category)') AS category, hi, count(*) AS over_count
  FROM (SELECT l.caliber_normalized, h.price_per_round, coalesce(b.bhi, 30000.0) AS hi FROM v_history h JOIN v_listings l ON l.id = h.listing_id
        LEFT JOIN {values([('ECONOMY', 20000.0), ('PROMO', 9000.0)], 'cat, bhi')} b ON b.cat = l.caliber_normalized)
 WHERE price_per_round > hi GROUP BY 1, 2""")
check("over_ceiling_samples", f"""SELECT category, id, listing_id, price_per_round FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY id) AS rn FROM (
    SELECT l.caliber_normalized AS category, h.id, h.listing_id, h.price_per_round, coalesce(b.bhi, 150.0) AS hi FROM v_obs h JOIN v_listings l ON l.id = h.listing_id
      LEFT JOIN {values([('ECONOMY', 100.0), ('PROMO', 200.0)], 'cat, bhi')} b ON b.cat = l.caliber_normalized) WHERE price_per_round > hi) WHERE rn <= 5""")

# -- joins ---------------------------------------------------------------------------
check("history_join", """SELECT caliber_normalized, count(*) AS n, min(h.price_per_round) AS lowest
  FROM v_history h JOIN v_listings l ON l.id = h.listing_id GROUP BY 1""")
OBSERVED = f"""seen AS (SELECT h.listing_id, h.price_per_round AS ppr, l.caliber_normalized AS cal, l.bullet_type AS bt, l.case_material AS cm, l.is_component AS comp
   FROM v_history h JOIN v_listings l ON l.id = h.listing_id WHERE h.recorded_at >= TIMESTAMP '{q.SEGMENT_SINCE}' AND h.price_per_round > 0
   AND l.condition_type = 'New' AND l.caliber_normalized IS NOT NULL AND l.bullet_type IS NOT NULL AND l.case_material IS NOT NULL)"""
check("above_floor", f"""SELECT cal AS caliber_normalized, count(*) AS n, min(ppr) AS lowest FROM seen
  LEFT JOIN {values([('ECONOMY', 5000.0), ('PROMO', 300.0)], 'cat, fl')} f ON f.cat = seen.cal WHERE NOT comp AND ppr >= coalesce(fl, 1000.0) GROUP BY 1""", OBSERVED)
check("pool_members", "SELECT id, listing_id FROM v_obs WHERE listing_id IN (SELECT id FROM v_listings WHERE caliber_normalized = 'PROMO')")
check("orphans", "SELECT id, listing_id FROM v_obs WHERE listing_id NOT IN (SELECT id FROM v_listings WHERE id % 6 <> 0)")
check("asof_latest", """SELECT t, listing_id, price_per_round FROM (
  SELECT g.t, o.listing_id, o.price_per_round, row_number() OVER (PARTITION BY g.t, o.listing_id ORDER BY o.recorded_at DESC, o.id DESC) AS rn
    FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-20', INTERVAL 12 HOUR)) AS t) g
    JOIN v_obs o ON o.recorded_at <= g.t AND o.recorded_at >= g.t - INTERVAL 30 HOUR AND o.price_per_round >= 5) WHERE rn = 1""")
check("lateral_top1", f"""SELECT b.cal, w.id, w.price_per_round, w.retailer_id FROM {values(q.BOUNDS, 'cal, lo, hi')} b,
  LATERAL (SELECT * FROM v_listings s WHERE s.caliber_normalized = b.cal AND s.case_material = 'bolt' AND s.condition_type = 'New' AND s.in_stock
     AND s.price_per_round >= b.lo AND s.price_per_round <= b.hi ORDER BY s.price_per_round, s.id LIMIT 1) w""")
MATCHED = """lines AS (SELECT e.rebate_id, e.line_no, r.brand, r.firearm_type AS kind, coalesce(e.amount_override, r.amount_max_per_unit) AS amount,
    coalesce(nullif(e.match_pattern, ''), replace(lower(e.product_line), ' ', '-')) AS kw
    FROM v_eligible e JOIN v_rebates r ON r.id = e.rebate_id),
  pairs AS (SELECT rebate_id, l.id AS listing_id, amount, line_no, 'url_contains:' || kw || CASE WHEN kind IS NULL THEN '' ELSE ';firearm_type:' || kind END AS match_reason
    FROM lines JOIN v_listings l ON l.manufacturer = lines.brand AND contains(lower(l.product_url), kw)
   WHERE amount IS NOT NULL AND (kind IS NULL OR (kind = 'small' AND l.caliber_normalized IN ('SMALL', 'ECONOMY', 'PROMO'))
      OR (kind = 'big' AND l.caliber_normalized IN ('LARGE', 'MEDIUM', 'STANDARD')))),
  best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rebate_id, listing_id ORDER BY amount DESC, line_no) AS rn FROM pairs) WHERE rn = 1)"""
check("keyword_match_best", "SELECT rebate_id, listing_id, amount, match_reason FROM best", MATCHED)
check("substring_index", """SELECT caliber_normalized, word, count(*) AS n, min(id) AS first_id FROM v_listings JOIN (
    SELECT DISTINCT p_type AS cat, unnest([split_part(p_name, ' ', 1), replace(p_name, ' ', '-'), '-' || p_partkey]) AS word FROM part) w
  ON w.cat = caliber_normalized AND contains(product_url, word) GROUP BY 1, 2""")
check("rebate_amounts", "SELECT rebate_id, max(amount) AS amount_max, count(*) AS match_count FROM best GROUP BY 1", MATCHED)
check("match_counts", "SELECT amount, match_reason, count(*) AS match_count FROM best GROUP BY 1, 2", MATCHED)
REACH = """(l.manufacturer = s.brand OR (s.brand = 'Brand#4' AND l.manufacturer = 'Brand#5')) AND l.caliber_normalized = s.caliber_normalized
   AND l.grain = s.grain AND (upper(l.bullet_type) = s.bullet_type OR (s.bullet_type = 'RED' AND upper(l.bullet_type) = 'BLUE'))"""
check("alias_join", f"SELECT DISTINCT s.id AS spec_id, l.id AS listing_id FROM v_spec s JOIN v_listings l ON {REACH}")
check("match_coverage", f"""SELECT caliber_normalized, manufacturer, count(*) AS candidates, count(hit) AS resolved, count(*) - count(hit) AS held
  FROM (SELECT l.*, (SELECT 1 FROM v_spec s WHERE {REACH} LIMIT 1) AS hit FROM v_listings l
        WHERE in_stock AND is_component IS NOT TRUE AND manufacturer IN ('Brand#1', 'Brand#2', 'Brand#4')) GROUP BY 1, 2""")
STOP = in_list(packs.LINE_STOP_WORDS)
NORM = "regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]', '', 'g')"
RESOLVED = f"""spec AS (SELECT id, brand, caliber_normalized AS cal, grain % 3 AS g, bullet_type AS bt, sku, product_line, muzzle_velocity_fps AS mv FROM v_spec),
  keyed AS (SELECT brand, cal, g, bt, count(DISTINCT mv) AS nv FROM spec GROUP BY 1, 2, 3, 4),
  raw AS (SELECT brand, cal, g, bt, id, 0 AS pos, sku, mv, {NORM.format(c='sku')} AS token, TRUE AS is_sku FROM spec
    UNION ALL SELECT brand, cal, g, bt, id, u.i AS pos, sku, mv, u.w, FALSE FROM (SELECT *, regexp_split_to_array(lower(product_line), '[^a-z0-9]+') AS ws FROM spec) s,
      LATERAL (SELECT unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i) u WHERE u.w NOT IN {STOP} AND length(u.w) >= 3),
  toks AS (SELECT brand, cal, g, bt, token, bool_or(is_sku) AS is_sku, min(mv) AS mv, arg_min(id, (id * 100 + pos)) AS spec_id, min(id * 100 + pos) AS ord
    FROM raw WHERE NOT is_sku OR length(token) >= 4 GROUP BY 1, 2, 3, 4, 5 HAVING count(DISTINCT mv) = 1),
  lst AS (SELECT id, manufacturer AS m, caliber_normalized AS c, grain % 3 AS lg, upper(bullet_type) AS t, {NORM.format(c='product_url')} || {NORM.format(c='retailer_product_id')} AS blob FROM v_listings),
  cand AS (SELECT DISTINCT l.id, l.blob, k.brand, k.cal, k.g, k.bt FROM keyed k JOIN lst l ON (l.m = k.brand OR (k.brand = 'ALIAS_BRAND' AND l.m = 'Brand#5'))
     AND l.c = k.cal AND l.lg = k.g AND (l.t = k.bt OR (k.bt = 'ALIAS_TYPE' AND l.t = 'BLUE')) WHERE k.nv >= 2),
  hits AS (SELECT c.id, c.brand, c.cal, c.g, c.bt, t.token, t.is_sku, t.mv, t.spec_id, t.ord FROM cand c JOIN toks t
     ON t.brand = c.brand AND t.cal = c.cal AND t.g = c.g AND t.bt = c.bt AND contains(c.blob, t.token)
     WHERE NOT t.is_sku OR regexp_matches(t.token, '[a-z]') OR length(t.token) >= 5),
  outer_hits AS (SELECT * FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits o WHERE o.id = h.id AND o.brand = h.brand AND o.cal = h.cal AND o.g = h.g
     AND o.bt = h.bt AND o.is_sku = h.is_sku AND length(o.token) > length(h.token) AND contains(o.token, h.token))),
  firsts AS (SELECT id, brand, cal, g, bt, is_sku, count(DISTINCT mv) AS nv, arg_min(spec_id, (-length(token)) * 1000000000 + ord) AS spec_id FROM outer_hits GROUP BY 1, 2, 3, 4, 5, 6),
  status AS (SELECT c.id AS listing_id, c.brand, c.cal, c.g, c.bt AS bullet_type,
     CASE WHEN s.nv = 1 THEN 'sku' WHEN s.nv >= 2 THEN 'ambiguous' WHEN w.nv = 1 THEN 'word' WHEN w.nv >= 2 THEN 'ambiguous' ELSE 'no_line' END AS status,
     CASE WHEN s.nv = 1 THEN s.spec_id WHEN s.nv IS NULL AND w.nv = 1 THEN w.spec_id END AS spec_id
     FROM cand c LEFT JOIN firsts s ON s.id = c.id AND s.brand = c.brand AND s.cal = c.cal AND s.g = c.g AND s.bt = c.bt AND s.is_sku
     LEFT JOIN firsts w ON w.id = c.id AND w.brand = c.brand AND w.cal = c.cal AND w.g = c.g AND w.bt = c.bt AND NOT w.is_sku)"""
check("collision_resolution", "SELECT listing_id, brand, bullet_type, status, spec_id FROM status",
      RESOLVED.replace("ALIAS_BRAND", "Brand#4").replace("ALIAS_TYPE", "RED"))
check("specification_matches", """SELECT s.id AS spec_id, l.id AS listing_id FROM spec s JOIN keyed k ON k.brand = s.brand AND k.cal = s.cal AND k.g = s.g AND k.bt = s.bt AND k.nv = 1
   JOIN lst l ON l.m = s.brand AND l.c = s.cal AND l.lg = s.g AND l.t = s.bt
  UNION ALL SELECT spec_id, listing_id FROM status WHERE spec_id IS NOT NULL""", RESOLVED)
check("dedupe_min_id", "SELECT min(id) AS id, manufacturer, caliber_normalized FROM v_listings GROUP BY 2, 3")
check("first_seen", "SELECT retailer_id, product_url, min(id) AS seq, max(partkey) AS pk FROM v_titles GROUP BY 1, 2")
check("dimension_label", """SELECT coalesce(r.slug, 'id:' || l.retailer_id) AS slug, count(*) AS n FROM v_listings l
   LEFT JOIN v_retailers r ON r.id = l.retailer_id AND r.id % 2 = 0 GROUP BY 1""")
check("cascade_evict", """SELECT (SELECT count(*) FROM v_listings WHERE retailer_id = 4) AS listings_evicted,
   (SELECT count(*) FROM v_obs WHERE listing_id IN (SELECT id FROM v_listings WHERE retailer_id = 4)) AS history_evicted,
   CAST(0 AS BIGINT) AS listings_remaining, CAST(0 AS BIGINT) AS history_remaining""")

check("discovery_overlap", """SELECT count(*) FILTER (WHERE l AND r) AS shared, count(*) FILTER (WHERE l AND NOT r) AS only_left, count(*) FILTER (WHERE r AND NOT l) AS only_right
   FROM (SELECT product_url, bool_or(partkey % 3 <> 0) AS l, bool_or(partkey % 5 <> 0) AS r FROM v_titles GROUP BY 1)""")
check("sql_pool", """SELECT id, price_per_round, middle_weight, is_brand, ships_free, middle_weight AND is_brand AND ((retailer_id = 1 AND ships_free) OR retailer_id = 7) AS in_filtered FROM (
   SELECT id, price_per_round, retailer_id, NOT (grain < 12 OR grain > 40) AS middle_weight,
   CASE WHEN manufacturer IS NOT NULL THEN lower(manufacturer) = 'brand#7' WHEN contains(product_url, 'brand2') THEN FALSE ELSE contains(product_url, 'brand7') END AS is_brand,
   (price_per_round * total_rounds) * ceil(200.0 / total_rounds) >= 60 AS ships_free FROM stage1 WHERE caliber_normalized = 'PROMO' AND condition_type = 'New')""", CAPPED)
check("sql_cheapest", """SELECT b.cal, w.id, w.price_per_round FROM (VALUES ('PROMO', 1.0, 20.0), ('SMALL', 2.0, 9.0), ('LARGE', 8.0, 9.0)) AS b(cal, lo, hi),
   LATERAL (SELECT * FROM stage1 s WHERE s.caliber_normalized = b.cal AND s.case_material = 'bolt' AND s.condition_type = 'New' AND s.in_stock
     AND s.price_per_round BETWEEN b.lo AND b.hi ORDER BY s.price_per_round, s.id LIMIT 1) w""", capped(5.0))

# -- aggregates -------------------------------------------------------------------------
LOWS = f"""floored AS (SELECT seen.* FROM seen LEFT JOIN {values(q.FLOORS, 'cat, fl')} f ON f.cat = seen.cal WHERE NOT comp AND ppr >= coalesce(fl, 50.0)),
  lows AS (SELECT listing_id, cal, bt, cm, min(ppr) AS low FROM floored GROUP BY 1, 2, 3, 4),
  segs AS (SELECT cal, bt, cm, count(*) AS n, list(low ORDER BY low) AS ls FROM lows GROUP BY 1, 2, 3)"""
MEAN = "list_reduce(list_prepend(0.0, ls[1:{n}]), lambda a, b: a + b) / len(ls[1:{n}])"
check("segment_floor", f"""SELECT cal AS caliber_normalized, bt AS bullet_type, cm AS case_material,
   CASE WHEN n >= 6 THEN {MEAN.format(n=4)} ELSE {MEAN.format(n=3)} END AS segment_floor, CAST(n AS INT) AS listing_count FROM segs WHERE n >= 2""",
      OBSERVED + ", " + LOWS)
check("sql_segment_floors", f"""SELECT cal AS caliber_normalized, bt AS bullet_type, cm AS case_material,
   CASE WHEN n >= 6 THEN {MEAN.format(n=4)} ELSE {MEAN.format(n=3)} END AS segment_floor, CAST(n AS INT) AS listing_count FROM segs WHERE n >= 2""",
      OBSERVED + ", " + LOWS)
check("segment_trimmed_mean", """SELECT s.cal AS caliber_normalized, s.bt AS bullet_type, s.cm AS case_material, m.median,
   round(avg(ppr) FILTER (WHERE ppr BETWEEN m.median / 2 AND m.median * 2), 4) AS segment_avg, count(*) AS row_count
  FROM seen s JOIN (SELECT cal, bt, cm, quantile_cont(ppr, 0.5) AS median FROM seen GROUP BY 1, 2, 3) m ON m.cal = s.cal AND m.bt = s.bt AND m.cm = s.cm
 GROUP BY 1, 2, 3, 4""", OBSERVED)
check("upper_median_signed", """SELECT c_nationkey, count(*) AS n, (list(c_acctbal ORDER BY c_acctbal))[count(*) // 2 + 1] AS median FROM customer WHERE c_acctbal IS NOT NULL GROUP BY 1""")
check("interpolated_median_signed", """SELECT s_nationkey, n, v[(n - 1) // 2 + 1] + (v[n // 2 + 1] - v[(n - 1) // 2 + 1]) * CASE WHEN n % 2 = 0 THEN 0.5 ELSE 0.0 END AS median
  FROM (SELECT s_nationkey, count(*) AS n, list(s_acctbal - 4500 ORDER BY s_acctbal) AS v FROM supplier WHERE s_acctbal IS NOT NULL GROUP BY 1)""")
check("ranked_signed", """SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal NULLS FIRST, c_custkey) AS rn,
  count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer""")
check("upper_median", """SELECT retailer_id, count(*) AS n, (list(price_per_round ORDER BY price_per_round))[count(*) // 2 + 1] AS median FROM v_history GROUP BY 1""")
check("outlier_caps", "SELECT cal AS caliber_normalized, cap FROM caps", capped(5.0))
check("capped_catalog", "SELECT id, caliber_normalized, price_per_round FROM stage1", CAPPED)
check("two_stage_bounds", """SELECT 0.25 AS lo, least((SELECT (list(price_per_round ORDER BY price_per_round))[count(*) // 2 + 1] * 2.0 FROM stage1
   WHERE caliber_normalized = 'PROMO' AND price_per_round > 0), 9.5) AS hi""", CAPPED)
check("cheapest_n_mean", f"SELECT retailer_id, {MEAN.format(n=5)} AS mean FROM (SELECT retailer_id, list(price_per_round ORDER BY price_per_round) AS ls FROM v_history GROUP BY 1)")
check("filtered_average", "SELECT listing_id, round(avg(price) FILTER (WHERE in_stock), 6) AS in_stock_avg, count(*) FILTER (WHERE in_stock) AS n FROM v_obs GROUP BY 1")
check("distinct_listings_window", """SELECT l.retailer_id, count(DISTINCT o.listing_id) AS listing_count FROM v_obs o JOIN v_listings l ON l.id = o.listing_id
  WHERE o.recorded_at >= TIMESTAMP '2024-01-05' AND o.recorded_at < TIMESTAMP '2024-01-06 12:00:00' GROUP BY 1""")
check("written_in_window", "SELECT retailer_id, caliber_normalized, count(*) AS written FROM v_listings WHERE last_updated >= TIMESTAMP '2024-01-25' GROUP BY 1, 2")
check("written_per_retailer", "SELECT retailer_id, count(*) AS written FROM v_listings WHERE last_updated >= TIMESTAMP '2024-01-25' GROUP BY 1")
check("coverage_counters", """SELECT retailer_id, count(*) AS total, count(*) FILTER (WHERE in_stock) AS in_stock_count, count(*) FILTER (WHERE bullet_type IS NULL) AS null_total,
   count(*) FILTER (WHERE bullet_type IS NULL AND in_stock) AS null_in_stock, count(*) FILTER (WHERE bullet_type IS NULL AND id % 2 = 0) AS derivable_total,
   count(*) FILTER (WHERE bullet_type IS NULL AND id % 2 = 0 AND in_stock) AS derivable_in_stock,
   round(count(*) FILTER (WHERE bullet_type IS NULL AND in_stock) * 100.0 / count(*) FILTER (WHERE in_stock), 6) AS null_pct_in_stock FROM v_listings GROUP BY 1""")
check("coverage_samples", """SELECT retailer_id, id, 'x' AS derived FROM (SELECT *, row_number() OVER (PARTITION BY retailer_id ORDER BY id) AS rn
   FROM v_listings WHERE bullet_type IS NULL AND id % 2 = 0) WHERE rn <= 5""")
check("value_distribution", "SELECT bullet_type, count(*) AS total, count(*) FILTER (WHERE in_stock) AS in_stock_count FROM v_listings GROUP BY 1")
CHANGED = f"""parsed AS MATERIALIZED (SELECT retailer_id, old_value, {brand_of('bt')} AS new_value FROM (
   SELECT retailer_id, upper(left(split_part(title, ' ', 1), 1)) || lower(substr(split_part(title, ' ', 1), 2)) AS old_value, {BRAND_TEXT.format(c='product_url')} AS bt FROM v_titles)),
  changed AS (SELECT * FROM parsed WHERE new_value IS NOT NULL AND new_value IS DISTINCT FROM old_value)"""
check("transition_matrix", "SELECT old_value, new_value, count(*) AS rows FROM changed GROUP BY 1, 2", CHANGED)
check("transition_top", """SELECT * FROM (SELECT retailer_id, old_value, new_value, count(*) AS rows,
   CAST(row_number() OVER (PARTITION BY retailer_id ORDER BY count(*) DESC, old_value, new_value) AS INT) AS rank FROM changed GROUP BY 1, 2, 3) WHERE rank <= 3""", CHANGED)
check("transition_overall", """SELECT old_value, new_value, count(*) AS rows FROM changed GROUP BY 1, 2 ORDER BY rows DESC, old_value NULLS FIRST, new_value NULLS FIRST LIMIT 30""", CHANGED)
check("transition_samples", """SELECT id, old_value, new_value FROM (SELECT *, row_number() OVER (PARTITION BY old_value, new_value ORDER BY id) AS rn FROM changed) WHERE rn <= 2""",
      CHANGED.replace("SELECT retailer_id, old_value", "SELECT id, retailer_id, old_value").replace("SELECT retailer_id, upper", "SELECT id, retailer_id, upper"))
check("distinct_options", """SELECT
  (SELECT string_agg(CAST(g AS VARCHAR), ',' ORDER BY g) FROM (SELECT DISTINCT grain AS g FROM stage1 WHERE grain <> 0)) AS grains,
  (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT bullet_type AS v FROM stage1 WHERE bullet_type <> '')) AS bullet_types,
  (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT case_material AS v FROM stage1 WHERE case_material <> '')) AS case_materials,
  (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT caliber_normalized AS v FROM stage1 WHERE caliber_normalized <> '')) AS calibers,
  coalesce((SELECT string_agg(CAST(g AS VARCHAR) || ':' || b, ',' ORDER BY g, b) FROM (SELECT DISTINCT grain AS g, bullet_type AS b FROM stage1
     WHERE manufacturer IS NOT NULL AND lower(manufacturer) = 'brand#7' AND bullet_type <> '')), '') AS models""", CAPPED)
check("freshness_rollup", f"""SELECT retailer_id, caliber_normalized, count(*) AS rows, count(*) FILTER (WHERE in_stock) AS in_stock_count, max(last_updated) AS newest,
   epoch(TIMESTAMP '{q.AS_OF}' - max(last_updated)) / 3600 AS age_hours FROM v_listings GROUP BY 1, 2""")
RESULTS = r"""res AS (SELECT lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)) AS retailer,
   CASE length(html) % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' ELSE 'NEEDS_REVIEW' END AS verdict,
   CASE WHEN length(html) % 11 = 0 THEN NULL WHEN length(html) % 7 = 0 THEN 404 ELSE 200 END AS status,
   length(html) % 5 = 0 AS redirect, length(html) % 4 AS n_products, length(html) % 2 + 1 AS page_no FROM pages)"""
check("verdict_rollup", """SELECT retailer, count(*) FILTER (WHERE verdict = 'PASS') AS pass, count(*) FILTER (WHERE verdict = 'NEEDS_REVIEW') AS needs_review,
   count(*) FILTER (WHERE verdict = 'FAIL') AS fail, count(*) FILTER (WHERE verdict = 'PASS') = 0 AS no_pass FROM res GROUP BY 1""", RESULTS)
check("failure_causes", """SELECT retailer, CASE WHEN status IS NULL THEN 'UNREACHABLE' WHEN status >= 400 THEN 'HTTP_' || status WHEN redirect THEN 'REDIRECT'
   WHEN n_products = 0 THEN 'ZERO_PRODUCTS' ELSE 'LOW_GATE_WITH_CARDS' END AS cause, count(*) AS rows FROM res WHERE verdict = 'FAIL' GROUP BY 1, 2""", RESULTS)
check("empty_source_alarm", """SELECT *, CASE WHEN empty_pages >= 3 THEN 'FAIL' ELSE 'WARN' END AS severity FROM (
   SELECT retailer, count(*) FILTER (WHERE page_no = 1 AND n_products = 0) AS empty_pages FROM res GROUP BY 1) WHERE empty_pages > 0""", RESULTS)
check("amount_range", "SELECT rebate_id, min(amount_override) AS amount_min, max(amount_override) AS amount_max FROM v_eligible GROUP BY 1")
check("request_priority", "SELECT c_mktsegment AS retailer_name, count(*) AS requests FROM customer GROUP BY 1")

# -- windows and series -------------------------------------------------------------------
check("ranked_with_count", """SELECT id, CAST(row_number() OVER (PARTITION BY listing_id ORDER BY price_per_round, id) AS INT) AS rn,
   count(*) OVER (PARTITION BY listing_id) AS n FROM v_obs""")
check("islands", "SELECT id, CAST(sum(CASE WHEN price_per_round > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY listing_id ORDER BY recorded_at, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM v_obs")
check("locf", """SELECT * FROM (SELECT id, listing_id, last_value(CASE WHEN id % 3 = 0 THEN price_per_round END IGNORE NULLS) OVER (
   PARTITION BY listing_id ORDER BY recorded_at, id ROWS UNBOUNDED PRECEDING) AS price_per_round FROM v_obs) WHERE price_per_round IS NOT NULL""")
check("locf_sliced", """SELECT * FROM (SELECT id, in_stock, last_value(CASE WHEN id % 5 = 0 THEN price_per_round END IGNORE NULLS) OVER (
   PARTITION BY in_stock ORDER BY recorded_at, id ROWS UNBOUNDED PRECEDING) AS price_per_round FROM v_obs) WHERE price_per_round IS NOT NULL""")


def bin_of(ts: str, origin: str, hours: int) -> str:
    floor = f"time_bucket(INTERVAL {hours} HOUR, {ts}, TIMESTAMP '{origin}')"
    return f"CASE WHEN {floor} = {ts} THEN {ts} ELSE {floor} + INTERVAL {hours} HOUR END"


check("time_grid", f"""SELECT g.t, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 6 HOUR)) AS t) g
   LEFT JOIN (SELECT {bin_of('recorded_at', '2024-01-01', 6)} AS bin, count(*) AS n FROM v_obs GROUP BY 1) c ON c.bin = g.t""")
check("right_closed_bins", f"""SELECT id, {bin_of('r', '2024-01-03 02:00:00', 6)} AS bin FROM (
   SELECT id, CASE WHEN id % 10 = 0 THEN date_trunc('hour', recorded_at) ELSE recorded_at END AS r FROM v_obs)""")
check("day_numbers", """SELECT CAST(floor(epoch(recorded_at) / 86400) AS INT) AS day_no, count(*) AS n,
   CAST(CAST(DATE '1970-01-01' + CAST(floor(epoch(recorded_at) / 86400) AS INT) AS DATE) AS VARCHAR) AS day FROM v_history GROUP BY 1, 3""")
check("latest_per_key", """SELECT listing_id, in_stock, id, price_per_round FROM (SELECT *, row_number() OVER (PARTITION BY listing_id, in_stock ORDER BY recorded_at DESC, id DESC) AS rn FROM v_obs) WHERE rn = 1""")


def bucket_series(end: str, hours: int, pool: str, min_pool: int, share: float) -> str:
    start = f"TIMESTAMP '{end}' - INTERVAL 30 DAY"
    floor = f"time_bucket(INTERVAL {hours} HOUR, recorded_at, {start})"
    return f"""pool AS (SELECT id, caliber_normalized AS cal FROM v_listings WHERE in_stock {pool}),
  sizes AS (SELECT cal, count(*) AS n, greatest(3, ceil(count(*) * {share})) AS need FROM pool GROUP BY 1),
  binned AS (SELECT p.cal, o.listing_id, o.price_per_round AS v, o.recorded_at, o.id, CASE WHEN {floor} = recorded_at THEN recorded_at ELSE {floor} + INTERVAL {hours} HOUR END AS bkt
    FROM v_obs o JOIN pool p ON p.id = o.listing_id WHERE recorded_at > {start} - INTERVAL {hours} HOUR AND recorded_at <= TIMESTAMP '{end}' AND price_per_round >= 2.0),
  latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cal, listing_id, bkt ORDER BY recorded_at DESC, id DESC) AS rn FROM binned) WHERE rn = 1),
  per AS (SELECT cal, bkt, count(*) AS alive, list(v ORDER BY v) AS ls FROM latest GROUP BY 1, 2),
  gated AS (SELECT s.cal, g.b, coalesce(p.alive, 0) AS alive, s.n, CASE WHEN coalesce(p.alive, 0) >= s.need THEN {MEAN.format(n=3)} END AS f
    FROM sizes s CROSS JOIN (SELECT unnest(generate_series({start}, TIMESTAMP '{end}', INTERVAL {hours} HOUR)) AS b) g LEFT JOIN per p ON p.cal = s.cal AND p.bkt = g.b),
  filled AS (SELECT *, last_value(f IGNORE NULLS) OVER (PARTITION BY cal ORDER BY b ROWS UNBOUNDED PRECEDING) AS ff FROM gated),
  series AS (SELECT cal AS caliber_normalized, b AS day_bucket, ff AS floor_cpr, alive AS alive_count, n AS pool_size FROM filled WHERE ff IS NOT NULL AND n >= {min_pool})"""


check("bucket_floor_locf", "SELECT * FROM series", bucket_series(q.AS_OF, 6, "", 3, 0.02))
check("bucket_floor_one", "SELECT * FROM series", bucket_series(
    "2024-01-29 13:00:00", 12, "AND condition_type = 'New' AND caliber_normalized = 'PROMO' AND id NOT IN (1, 5, 6, 9)", 1, 0.03))


def daily(split: str, where: str = "TRUE", until: str = "TRUE") -> str:
    return f"""{CAPPED}, bound AS (SELECT 1.0 AS lo, least(coalesce((SELECT (list(price_per_round ORDER BY price_per_round))[count(*) // 2 + 1] * 5.0 FROM stage1
     WHERE caliber_normalized = 'PROMO' AND price_per_round > 0), 60.0), 60.0) AS hi),
  pool AS (SELECT id, {split} AS k FROM stage1 WHERE caliber_normalized = 'PROMO' AND {where}),
  lows AS (SELECT p.k, floor(epoch(o.recorded_at) / 86400) AS d, o.listing_id, min(o.price_per_round * 1.08) AS v FROM v_obs o JOIN pool p ON p.id = o.listing_id, bound
    WHERE o.in_stock AND o.recorded_at >= TIMESTAMP '2024-01-05 06:00:00' AND {until} AND o.price_per_round >= lo AND o.price_per_round <= hi
      AND floor(epoch(o.recorded_at) / 86400) < floor(epoch(TIMESTAMP '2024-01-29 05:00:00') / 86400) GROUP BY 1, 2, 3),
  daily AS (SELECT k AS series_key, CAST(CAST(DATE '1970-01-01' + CAST(d AS INT) AS DATE) AS VARCHAR) AS day, {MEAN.format(n=3)} AS value,
     CAST(coalesce((SELECT count(*) FROM pool WHERE pool.k = x.k), 0) AS INT) AS pool_size FROM (SELECT k, d, list(v ORDER BY v) AS ls FROM lows GROUP BY 1, 2) x)"""


check("daily_floor", "SELECT * FROM daily", daily("''"))
check("daily_floor_by_retailer", "SELECT * FROM daily", daily("CAST(retailer_id AS VARCHAR)", until="o.recorded_at <= TIMESTAMP '2024-01-25'"))
check("daily_floor_by_condition", "SELECT * FROM daily", daily("coalesce(nullif(condition_type, ''), 'Unknown')", f"NOT {HIT}"))
check("sql_daily_floors", f"""SELECT 'none' AS split, * FROM (WITH {daily("''")} SELECT * FROM daily)
  UNION ALL SELECT 'retailer', * FROM (WITH {daily("CAST(retailer_id AS VARCHAR)", until="o.recorded_at <= TIMESTAMP '2024-01-25'")} SELECT * FROM daily)
  UNION ALL SELECT 'condition', * FROM (WITH {daily("coalesce(nullif(condition_type, ''), 'Unknown')", f"NOT {HIT}")} SELECT * FROM daily)""")
check("sql_bucket_floors", "SELECT * FROM series", bucket_series(
    "2024-01-29 13:00:00", 12, "AND condition_type = 'New' AND caliber_normalized = 'PROMO' AND id NOT IN (1, 5, 6, 9)", 1, 0.03))


def retention(known: str, keep_days: int, expiry_days: int) -> str:
    expiry = f"(epoch(TIMESTAMP '{q.AS_OF}') - {expiry_days} * 86400) // 86400"
    return f"""olds AS (SELECT o.*, floor(epoch(recorded_at) / 86400) AS day, l.id AS lid, coalesce(f.fl, 0.0) AS fl, o.in_stock AND o.price_per_round > 0 AS ok
     FROM v_obs o LEFT JOIN (SELECT * FROM v_listings WHERE {known}) l ON l.id = o.listing_id LEFT JOIN {values(q.OBS_FLOORS, 'cat, fl')} f ON f.cat = l.caliber_normalized
    WHERE recorded_at < TIMESTAMP '{q.AS_OF}' - INTERVAL {keep_days} DAY),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY listing_id, day ORDER BY CASE WHEN ok THEN 0 ELSE 1 END, price_per_round, recorded_at, id) AS r1,
     row_number() OVER (PARTITION BY listing_id, day ORDER BY CASE WHEN ok AND price_per_round >= fl THEN 0 ELSE 1 END, price_per_round, recorded_at, id) AS r2,
     row_number() OVER (PARTITION BY listing_id, day ORDER BY recorded_at DESC, id DESC) AS r3,
     bool_or(ok) OVER (PARTITION BY listing_id, day) AS able, bool_or(in_stock) OVER (PARTITION BY listing_id, day) AS stocked FROM olds),
  plan AS (SELECT id, listing_id, day, price_per_round, in_stock, ok, CASE WHEN lid IS NULL THEN 'orphan'
     WHEN able THEN CASE WHEN r1 = 1 OR (r2 = 1 AND ok AND price_per_round >= fl) THEN 'keep' ELSE 'tier1' END
     WHEN day < {expiry} AND NOT stocked THEN 'tier2' WHEN r3 = 1 THEN 'keep' ELSE 'tier1' END AS action FROM ranked)"""


check("retention_plan", "SELECT id, listing_id, action FROM plan", retention("id % 9 <> 0", 5, 12))
check("retention_invariants", """SELECT count(*) AS examined, count(*) FILTER (WHERE action IN ('tier1', 'tier2')) AS deletes, count(*) FILTER (WHERE action = 'keep') AS keeps,
   count(*) FILTER (WHERE action = 'orphan') AS orphans, CAST(0 AS BIGINT) AS id_in_two_tiers, CAST(0 AS BIGINT) AS expired_in_stock, CAST(0 AS BIGINT) AS eligible_keep_count,
   CAST(0 AS BIGINT) AS marker_keep_count, CAST(0 AS BIGINT) AS group_min_lost, CAST(0 AS BIGINT) AS unaccounted,
   CAST(count(*) FILTER (WHERE action IN ('tier1', 'tier2')) / count(*) > 0.35 AS INT) AS over_band FROM plan""",
      retention("id % 9 <> 0", 5, 12))
check("thin_days", "SELECT listing_id, count(*) AS n FROM v_obs WHERE id NOT IN (SELECT id FROM plan WHERE action IN ('tier1', 'tier2')) GROUP BY 1", retention("TRUE", 10, 20))
check("write_delete_set", "SELECT action, count(*) AS rows FROM plan WHERE action IN ('tier1', 'tier2') GROUP BY 1", retention("TRUE", 10, 20))
check("delete_set", "SELECT listing_id, count(*) AS n FROM v_obs WHERE id NOT IN (SELECT id FROM plan WHERE action IN ('tier1', 'tier2')) GROUP BY 1", retention("TRUE", 10, 20))
check("run_over_run", """SELECT p.retailer_id, p.n AS previous_count, coalesce(c.n, 0) AS current_count, CASE WHEN coalesce(c.n, 0) = 0 THEN 'CRITICAL' ELSE 'WARN' END AS severity
  FROM (SELECT l.retailer_id, count(DISTINCT listing_id) AS n FROM v_obs o JOIN v_listings l ON l.id = o.listing_id WHERE recorded_at >= TIMESTAMP '2024-01-05' AND recorded_at < TIMESTAMP '2024-01-06' GROUP BY 1) p
  LEFT JOIN (SELECT l.retailer_id, count(DISTINCT listing_id) AS n FROM v_obs o JOIN v_listings l ON l.id = o.listing_id WHERE recorded_at >= TIMESTAMP '2024-01-06' AND recorded_at < TIMESTAMP '2024-01-06 03:00:00' GROUP BY 1) c
    ON c.retailer_id = p.retailer_id WHERE p.n >= 2 AND coalesce(c.n, 0) < p.n * 0.5""")
check("coverage_gap", """SELECT w.retailer_id, count(*) AS missing, string_agg(w.caliber_normalized, ', ' ORDER BY w.caliber_normalized) AS categories, any_value(e.n) AS expected, any_value(s.saved) AS saved
  FROM (SELECT DISTINCT retailer_id, caliber_normalized FROM v_listings) w
  JOIN v_retailers r ON r.id = w.retailer_id AND r.last_scraped_at >= TIMESTAMP '2024-01-28' AND r.id NOT IN (3)
  JOIN (SELECT retailer_id, count(DISTINCT caliber_normalized) AS n FROM v_listings GROUP BY 1) e ON e.retailer_id = w.retailer_id
  JOIN (SELECT retailer_id, count(*) AS saved FROM v_listings WHERE grain % 5 = 0 AND last_updated >= TIMESTAMP '2024-01-29' GROUP BY 1) s ON s.retailer_id = w.retailer_id
 WHERE NOT EXISTS (SELECT 1 FROM v_listings o WHERE o.retailer_id = w.retailer_id AND o.caliber_normalized = w.caliber_normalized AND o.grain % 5 = 0 AND o.last_updated >= TIMESTAMP '2024-01-29')
 GROUP BY 1""")
check("stale_alarm", f"""SELECT *, 'CRITICAL' AS severity FROM (SELECT id, slug, epoch(TIMESTAMP '{q.AS_OF}' - last_scraped_at) / 3600 AS age_hours,
   CASE WHEN slug IN ('shop-5', 'shop-7') THEN 72.0 ELSE 8.0 END AS threshold_hours FROM v_retailers) WHERE age_hours > threshold_hours""")
check("cache_alarm", f"""SELECT newest, (epoch_us(TIMESTAMP '{q.AS_OF}') - epoch_us(newest)) / 3.6e9 AS age_hours, 'stale' AS reason FROM (SELECT max(recorded_at) AS newest FROM v_obs)""")

# -- sorting and sets -----------------------------------------------------------------------
check("top_per_group", """SELECT * FROM (SELECT retailer_id, caliber_normalized, count(*) AS rows,
   CAST(row_number() OVER (PARTITION BY retailer_id ORDER BY count(*) DESC, caliber_normalized) AS INT) AS rank FROM v_listings GROUP BY 1, 2) WHERE rank <= 3""")
check("union_processed", """SELECT id, price_per_round, NULL AS category FROM v_listings WHERE id % 4 = 0
   UNION ALL SELECT id, NULL, 'excluded' FROM v_listings WHERE id % 4 = 1""")
check("set_difference", """SELECT listing_id, 'left' AS side FROM (SELECT listing_id FROM v_obs WHERE price_per_round > 150 EXCEPT SELECT listing_id FROM v_obs WHERE price_per_round < 0.5)
   UNION ALL SELECT listing_id, 'right' FROM (SELECT listing_id FROM v_obs WHERE price_per_round < 0.5 EXCEPT SELECT listing_id FROM v_obs WHERE price_per_round > 150)""")
check("additive_diff", """SELECT id, before, after, CASE WHEN before IS NOT NULL THEN 'flip' WHEN after IN ('red', 'blue', 'new', 'old') THEN 'pickup' ELSE 'unexpected' END AS outcome
   FROM (SELECT id, CASE WHEN id % 3 <> 0 THEN bullet_type END AS before, CASE WHEN id % 50 = 1 THEN 'zzz' ELSE bullet_type END AS after FROM v_listings) WHERE before IS DISTINCT FROM after""")
check("table_compare", """SELECT coalesce(a.id, b.id) AS id, a.manufacturer AS left_value, b.m AS right_value,
    CASE WHEN b.id IS NULL THEN 'only_left' WHEN a.id IS NULL THEN 'only_right' ELSE 'differs' END AS status
  FROM (SELECT id, manufacturer FROM v_listings WHERE id % 5 <> 0) a FULL JOIN (SELECT id, CASE WHEN id % 11 = 0 THEN 'other' ELSE manufacturer END AS m FROM v_listings WHERE id % 7 <> 0) b ON a.id = b.id
 WHERE a.id IS NULL OR b.id IS NULL OR a.manufacturer IS DISTINCT FROM b.m""")
check("change_of_record", "SELECT id, grain, manufacturer FROM v_listings WHERE id % 9 = 0 OR id % 8 = 0")

# -- text ------------------------------------------------------------------------------------
check("category_cascade", f"SELECT title, {CATEGORY} AS caliber_normalized, count(*) AS n FROM (SELECT title, lower(title) AS low FROM v_titles) GROUP BY 1, 2")
# The other engine's \b knows ASCII letters only; accented words are kept whole.
UNICODE_WORDS = [(v, [(k, p.replace(r"\bles?\b", r"(?:^|[^\p{L}\p{N}_])les?(?:$|[^\p{L}\p{N}_])").replace(r"\bthe\b", r"(?:^|[^\p{L}\p{N}_])the(?:$|[^\p{L}\p{N}_])")
                      .replace(r"\bund\b", r"(?:^|[^\p{L}\p{N}_])und(?:$|[^\p{L}\p{N}_])").replace(r"\bpara\b", r"(?:^|[^\p{L}\p{N}_])para(?:$|[^\p{L}\p{N}_])")) for k, p in specs])
                 for v, specs in q.WORD_RULES]
check("document_cascade", f"SELECT lang, {cascade('low', UNICODE_WORDS)} AS verdict, count(*) AS n FROM (SELECT lang, lower(text) AS low FROM documents) GROUP BY 1, 2")
check("longest_alias", f"SELECT title, coalesce({brand_of('bt')}, 'Unknown') AS manufacturer, count(*) AS n FROM (SELECT title, {BRAND_TEXT.format(c='title')} AS bt FROM v_titles) GROUP BY 1, 2")
PREFIX = "CASE regexp_extract(lower(" + LAST.format(c="product_url") + "), '^([a-z]+)', 1) " + " ".join(
    f"WHEN '{k}' THEN {quoted(v)}" for k, v in brands.SLUG_PREFIX_BRANDS.items()) + " END"
check("brand_with_fallback", f"""SELECT title, product_url, coalesce({brand_of('b1')}, {PREFIX}, {brand_of('b2')}, 'Unknown') AS manufacturer, count(*) AS n
  FROM (SELECT *, {BRAND_TEXT.format(c='title')} AS b1, {BRAND_TEXT.format(c='product_url')} AS b2 FROM (
    SELECT CASE WHEN partkey % 3 = 0 THEN '' ELSE title END AS title,
           CASE WHEN partkey % 2 = 0 THEN regexp_replace(product_url, 'com/[a-z]+', 'com/fed') ELSE product_url END AS product_url FROM v_titles)) GROUP BY 1, 2, 3""")
check("type_cascade", f"SELECT title, {type_of('tt')} AS bullet_type, count(*) AS n FROM (SELECT title, {TYPE_TEXT.format(c='title')} AS tt FROM v_titles) GROUP BY 1, 2")
check("type_url_fallback", f"""SELECT title, product_url, coalesce({type_of('t1')}, {type_of('t2')}) AS bullet_type, count(*) AS n FROM (
   SELECT *, {TYPE_TEXT.format(c='title')} AS t1, {TYPE_TEXT.format(c='product_url')} AS t2 FROM (
     SELECT CASE WHEN partkey % 2 = 0 THEN 'x' ELSE title END AS title, product_url FROM v_titles)) GROUP BY 1, 2, 3""")
check("maker_type_phrase", f"""SELECT phrase, coalesce({words('lower(phrase)', types.MAKER_TYPE_PHRASES)}, CASE WHEN regexp_matches(upper(trim(phrase)), '^[A-Z]{{2,4}}$') THEN upper(trim(phrase)) END) AS maker_type, count(*) AS n
  FROM (SELECT regexp_extract(title, 'gr ([^-]*(?:-[A-Z][^-]*)?) - ', 1) AS phrase FROM v_titles) GROUP BY 1, 2""")
MAKERS = "CASE replace(trim(lower(name)), '  ', ' ') " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in categories.MAKER_CATEGORY_NAMES.items()) + " END"
check("maker_category_map", f"""SELECT name, {MAKERS} AS slug, count(*) AS n FROM (SELECT regexp_extract(title, '(\\.?\\d[^ ]* (?:ACP|Special|Magnum|Winchester|Remington|Luger|Auto))', 1) AS name FROM v_titles) GROUP BY 1, 2""")


def extract(column: str, pattern: str, group: int = 1) -> str:
    return f"TRY_CAST(replace(nullif(regexp_extract({column}, {quoted('(?i)' + pattern)}, {group}), ''), ',', '') AS BIGINT)"


LIMIT = "coalesce(" + ", ".join(f"CASE WHEN {extract('title', p)} BETWEEN 1 AND 999 THEN {extract('title', p)} END" for p in packs.LIMIT_PATTERNS) + ")"
check("purchase_limit", f"SELECT title, CAST({LIMIT} AS INT) AS purchase_limit, count(*) AS n FROM v_titles GROUP BY 1, 2")


def pack(rule_set: str, column: str = "title") -> str:
    options = []
    for pattern, low, high, mode in packs.PACK_RULES[rule_set]:
        value = extract(column, pattern)
        if mode == "product":
            value = f"{value} * {extract(column, pattern, 2)}"
        options.append(value if high >= packs.ANY else f"CASE WHEN {value} BETWEEN {low} AND {high} THEN {value} END")
    return "coalesce(" + ", ".join(options) + ")"


BY_SOURCE = "CASE source " + " ".join(f"WHEN '{r}' THEN {pack(r)}" for r in ("simple", "wide", "slash_bounded", "case_first")) + " END"
check("pack_count", f"SELECT title, source, {BY_SOURCE} AS total_rounds, count(*) AS n FROM v_titles GROUP BY 1, 2, 3")


def steel(table, extra) -> str:
    return any_word("low", table + extra)


METALS = [("brass", "Brass"), ("aluminum", "Aluminum"), ("nickel", "Nickel")]
POLY = [("aluminum", "Aluminum"), ("aluminium", "Aluminum"), ("nickel", "Nickel"), ("polymer", "Polymer")]
check("small_attributes", f"""SELECT title, TRY_CAST(nullif(regexp_extract(title, '(?i)(\\d+)[\\s-]*gr(?:ain)?', 1), '') AS INT) AS grain,
   CASE WHEN {steel(types.STEEL_BRANDS, ['steel'])} THEN 'Steel' ELSE coalesce({words('low', METALS)}, 'Brass') END AS case_plain,
   CASE WHEN {steel(types.STEEL_BRANDS_WIDE, ['steel case', 'steel-case'])} OR contains(' ' || low || ' ', ' steel ') THEN 'Steel' ELSE coalesce({words('low', METALS)}, 'Brass') END AS case_strict,
   CASE WHEN {steel(types.STEEL_BRANDS_ALL, ['steel'])} THEN 'Steel' ELSE coalesce({words('low', POLY)}, 'Brass') END AS case_polymer,
   CASE WHEN contains(low, 'reman') THEN 'Remanufactured' ELSE 'New' END AS condition_type, {words('low', brands.ORIGIN_EXTENDED)} AS country,
   NOT {any_word('low', packs.STOCK_RULES['absent_phrases']['out'])} AS in_stock, contains(low, 'in stock') AS labelled_in_stock, count(*) AS n
  FROM (SELECT title, lower(title) AS low FROM v_titles) GROUP BY ALL""")
check("clean_title", """SELECT page_id, trim(regexp_replace(translate('  ' || translate(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), 'aeo', '×–®') || '  ',
   '–—‘’“”·•×' || chr(160) || chr(8239), '--''''""**x  '), '[®™]', '', 'g')) AS clean FROM pages""")
MARK = any_word("link", components.LOADED_MARKERS)
check("component_flag", f"""SELECT regexp_replace(product_url, '-\\d+$', '') AS link, rounds, (link <> '' AND NOT {MARK} AND (
   contains(link, '-hap-') OR (contains(link, '-xtp-') AND rounds >= 100) OR regexp_matches(link, {quoted(components.HORNADY_SKU)})
   OR (contains(link, 'interlock') AND rounds >= 100 AND mfr = 'hornady') OR (regexp_matches(link, {quoted(components.CASING_WORDS)}) AND NOT regexp_matches(link, {quoted(components.CASING_LOADED)}))
   OR contains(link, 'sporting-handgun') OR ((contains(link, 'nosler') OR regexp_matches(link, {quoted(components.NOSLER_SKU)}) OR mfr = 'nosler') AND rounds >= 50 AND regexp_matches(link, {quoted(components.NOSLER_LINES)}))
   OR contains(link, 'barnes-bullets-') OR contains(link, 'berger-bullets-') OR ((contains(link, 'berger') OR mfr = 'berger') AND rounds >= 50)
   OR contains(link, 'sierra-bullets-') OR (mfr = 'sierra' AND rounds >= 50 AND regexp_matches(link, {quoted(components.SIERRA_LINES)})))) AS is_component, count(*) AS n
  FROM (SELECT product_url, lower(regexp_replace(product_url, 'nosler-', 'nosler-partition-', 'g')) AS link, partkey % 150 AS rounds, lower(split_part(title, ' ', 1)) AS mfr FROM v_titles) GROUP BY 1, 2, 3""")


def hits(column: str, needles) -> str:
    return "(" + " + ".join(f"CAST(contains({column}, {quoted(n)}) AS INT)" for n in needles) + ")"


KL = list(q.CLASSES)
check("dominant_class", f"""SELECT doc_id, CASE WHEN {' + '.join(f'CAST(t_{k} > 0 AS INT)' for k in KL)} = 1 THEN CASE {' '.join(f"WHEN t_{k} > 0 THEN '{k}'" for k in KL)} END
    WHEN top >= 2 AND top >= 2 * greatest(second, 1) THEN CASE {' '.join(f"WHEN c_{k} = top THEN '{k}'" for k in KL)} END END AS klass
  FROM (SELECT *, greatest({', '.join('c_' + k for k in KL)}) AS top, (list_reverse_sort([{', '.join('c_' + k for k in KL)}]))[2] AS second FROM (
    SELECT doc_id, {', '.join(f"{hits('h', q.CLASSES[k])} AS t_{k}, {hits('b', q.CLASSES[k])} AS c_{k}" for k in KL)}
      FROM (SELECT doc_id, lower(split_part(text, chr(10), 1)) AS h, lower(split_part(text, chr(10), 1) || ' ' || text) AS b FROM documents)))""")
check("component_attributes", """SELECT id, category,
   CASE WHEN category = 'powder' THEN CASE WHEN brand = 'Hodgdon' THEN CASE WHEN name LIKE '% H4350' THEN 'rifle' END ELSE
     CASE split_part(name, ' ', 2) WHEN '7' THEN 'rifle' WHEN '10' THEN 'rifle' WHEN '15' THEN 'rifle' WHEN '16' THEN 'rifle' WHEN '17' THEN 'rifle' WHEN '19' THEN 'rifle'
       WHEN '22' THEN 'magnum rifle' WHEN '23' THEN 'magnum rifle' WHEN '25' THEN 'magnum rifle' WHEN '26' THEN 'magnum rifle' END END END AS powder_application,
   CASE WHEN category = 'primer' THEN CASE WHEN p_size % 2 = 0 THEN 'large rifle' ELSE 'small pistol' END || CASE WHEN p_size % 3 = 0 THEN ' magnum' ELSE '' END END AS primer_size,
   CASE WHEN category = 'bullet' THEN 'FMJ' END AS new_type,
   CASE WHEN category = 'bullet' AND p_size % 2 <> 0 AND p_size * 30 BETWEEN 10 AND 1000 THEN CAST(p_size * 30 AS DOUBLE) END AS new_grain,
   CASE WHEN category = 'brass' THEN upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2) END AS new_caliber
  FROM (SELECT p_partkey AS id, p_name, p_size, CASE p_partkey % 4 WHEN 0 THEN 'powder' WHEN 1 THEN 'primer' WHEN 2 THEN 'bullet' ELSE 'brass' END AS category,
          CASE WHEN p_partkey % 8 = 0 THEN 'Hodgdon' WHEN p_partkey % 4 = 0 THEN 'Alliant' END AS brand,
          'Reloder ' || (p_partkey % 30) || ' H4' || (p_size % 3 * 459 + 350) AS name FROM part)""")
TIPLESS = r"regexp_replace(product_url, '\b(polymer[\s-]+tip(?:ped)?|ballistic[\s-]+tip)\b', ' ', 'gi')"
check("fill_null_only", f"""SELECT outcome, CASE WHEN outcome = 'fill' THEN by_rest ELSE stored END AS bullet_type, count(*) AS n FROM (
   SELECT stored, by_rest, CASE WHEN stored IS NOT NULL THEN 'kept' WHEN retailer_id = 3 THEN 'excluded_source' WHEN by_full IS NULL THEN 'no_match' WHEN by_rest IS NULL THEN 'ambiguous_only' ELSE 'fill' END AS outcome
     FROM (SELECT retailer_id, CASE WHEN partkey % 4 = 0 THEN 'SP' END AS stored, {type_of('t1')} AS by_full, {type_of('t2')} AS by_rest
       FROM (SELECT *, {TYPE_TEXT.format(c='product_url')} AS t1, {TYPE_TEXT.format(c=TIPLESS)} AS t2 FROM v_titles))) GROUP BY 1, 2""")
check("fill_component_types", f"""SELECT title AS product_name, bullet_type, count(*) AS n FROM (SELECT title, {type_of('tt')} AS bullet_type FROM (
   SELECT title, {TYPE_TEXT.format(c='title')} AS tt FROM v_titles WHERE partkey % 3 <> 0 AND partkey % 4 <> 0)) WHERE bullet_type IS NOT NULL GROUP BY 1, 2""")
check("fill_brands", f"""SELECT title, product_url, coalesce({brand_of('bt')}, 'Unknown') AS manufacturer, count(*) AS n
   FROM (SELECT title, product_url, {BRAND_TEXT.format(c="product_url || ' ' || title")} AS bt FROM v_titles WHERE partkey % 4 <> 0) GROUP BY 1, 2, 3""")
check("reparse_triggers", f"""SELECT old_value, new_value, count(*) AS n FROM (SELECT CASE partkey % 4 WHEN 0 THEN 'Winchester' WHEN 1 THEN 'Unknown' WHEN 2 THEN 'Acme' END AS old_value, {brand_of('bt')} AS new_value
    FROM (SELECT partkey, {BRAND_TEXT.format(c='product_url')} AS bt FROM v_titles))
  WHERE new_value IS NOT NULL AND new_value IS DISTINCT FROM old_value AND (coalesce(old_value IN {in_list(brands.REPARSE_TRIGGER_BRANDS)}, FALSE) OR ((old_value IS NULL OR old_value IN ('', 'Unknown')) AND new_value <> 'Unknown')) GROUP BY 1, 2""")
RELABELLED = "manufacturer"
STEPS = []
for step, (old, pattern, new) in enumerate(q.RELABEL):
    source = "v_listings" if step == 0 else f"s{step - 1}"
    extra = f" AND product_url ILIKE {quoted(pattern)}" if pattern else ""
    STEPS.append(f"s{step} AS (SELECT id, product_url, CASE WHEN manufacturer = {quoted(old)}{extra} THEN {quoted(new)} ELSE manufacturer END AS manufacturer FROM {source})")
check("bulk_relabel", f"SELECT id, manufacturer FROM s{len(q.RELABEL) - 1}", ", ".join(STEPS))
check("slug_detect_audit", f"""SELECT product_url, {cascade('path', [(v, [('re', p)]) for p, v in types.URL_TYPE_AUDIT])} AS detected, count(*) AS n
   FROM (SELECT product_url, lower(regexp_replace(product_url, '^[^:]*://[^/]*/', '')) AS path FROM v_titles) GROUP BY 1, 2""")
check("url_parts", """SELECT id, nullif(regexp_extract(regexp_replace(product_url, '/+$', ''), '([^/]*)$', 1), '') AS product_key,
   upper(left(lower(caliber), 1)) || substr(lower(caliber), 2) AS line_name, lower(regexp_extract(product_url, '//([^/?#]*)', 1)) AS host,
   regexp_replace(product_url, '^https://[^/]*', '') AS path FROM v_listings""")
SPACED = "' ' || trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) || ' '"


def spaced_names(names) -> str:
    import re

    return any_word("s", [" " + re.sub(r"[^a-z0-9]+", " ", n).strip() + " " for n in names])


check("alias_tokens", f"""SELECT title, {', '.join(f'{spaced_names(categories.CATEGORY_URL_NAMES[k])} AS m_{k}' for k in ('9mm', '308win', '38spl', '10mm'))}, count(*) AS n
   FROM (SELECT title, {SPACED} AS s FROM v_titles) GROUP BY ALL""".replace("m_9mm", '"m_9mm"'))
check("title_line", f"""SELECT doc_id, coalesce(first_named, longest) AS line FROM (SELECT doc_id,
    arg_min(s, i) FILTER (WHERE length(s) > 25 AND verdict = 'french') AS first_named, arg_min(s, -length(s) * 1000000 + i) AS longest FROM (
      SELECT doc_id, s, i, {cascade('low', UNICODE_WORDS)} AS verdict FROM (SELECT doc_id, s, i, lower(s) AS low FROM (
        SELECT doc_id, trim(u.s) AS s, u.i FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents) d, LATERAL (SELECT unnest(a) AS s, unnest(range(1, len(a) + 1)) AS i) u) WHERE s <> ''))
    GROUP BY 1) WHERE coalesce(first_named, longest) IS NOT NULL""")
check("source_defaults", f"""SELECT title, source, coalesce(nullif(b, 'Unknown'), CASE source WHEN 'simple' THEN 'House A' WHEN 'case_first' THEN 'House C' END, 'Unknown') AS manufacturer,
   coalesce(nullif(c, 0), CASE source WHEN 'simple' THEN 20 WHEN 'wide' THEN 50 END) AS total_rounds, CASE WHEN source = 'wide' THEN 'USA' ELSE o END AS country_of_origin, count(*) AS n
  FROM (SELECT title, source, {brand_of('bt')} AS b, {pack('simple')} AS c, {words('lower(title)', brands.ORIGIN_BASE)} AS o FROM (SELECT *, {BRAND_TEXT.format(c='title')} AS bt FROM v_titles)) GROUP BY 1, 2, 3, 4, 5""")
check("field_first", "SELECT coalesce(nullif(CASE WHEN id % 3 = 0 THEN 0 ELSE total_rounds END, 0), nullif(CAST(id % 4 AS INT), 0)) AS rounds, count(*) AS n FROM v_gate GROUP BY 1")
check("price_from_text", r"""SELECT list_min(a) AS lowest, CASE WHEN list_min(big) IS NOT NULL THEN small[1] END AS unit_price, CASE WHEN len(small) > 0 THEN list_min(big) END AS total,
    CASE WHEN a[1] = a[2] AND a[1] > 0 THEN a[1] END AS single, q + ln / 100.0 AS split_decimal, count(*) AS n
  FROM (SELECT *, list_filter(a, lambda x: x < 1) AS small, list_filter(a, lambda x: x > 1) AS big FROM (
    SELECT [CAST(floor(l_extendedprice / 10) AS BIGINT) / 100, l_quantity, CAST(format('{:.2f}', l_tax) AS DOUBLE)] AS a,
           CAST(l_quantity AS INT) AS q, l_linenumber AS ln FROM lineitem)) GROUP BY ALL""")

# -- pages --------------------------------------------------------------------------------------
ENT = "replace(replace(replace(replace({c}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"
SQUEEZE = r"trim(regexp_replace({c}, '\s+', ' ', 'g'))"
check("page_title", f"SELECT page_id, {SQUEEZE.format(c=ENT.format(c=quoted('X').replace(quoted('X'), 'regexp_extract(html, ' + quoted('(?is)<title[^>]*>(.*?)</title>') + ', 1)')))} AS title FROM pages")
check("visible_text", r"""SELECT page_id, len(ls) AS n_lines, array_to_string(ls, chr(10)) AS body FROM (SELECT page_id,
   list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '<[^>]+>', chr(10), 'g'), chr(10)),
     lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ls FROM pages)""")


def host(c: str) -> str:
    return rf"regexp_replace(lower(regexp_extract({c}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)), '^www\.', '')"


def path(c: str) -> str:
    return rf"lower(regexp_replace(regexp_replace(regexp_replace({c}, '[?#].*$', ''), '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/]*', ''), '/+$', ''))"


check("canonical_redirect", rf"""SELECT page_id, {host('url')} <> {host('landed')} OR {path('url')} <> {path('landed')} AS redirected FROM (
   SELECT page_id, url, CASE page_id % 5 WHEN 0 THEN 'HTTPS://www.' || regexp_replace(url, '^https?://', '') WHEN 1 THEN regexp_replace(url, '[?#].*$', '') || '/'
     WHEN 2 THEN regexp_replace(url, '[?#].*$', '') || 'x' WHEN 3 THEN regexp_replace(url, 'example', 'other', 'g') ELSE upper(url) END AS landed FROM pages)""")
check("policy_links", rf"""SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY first_at) - 1 AS INT) AS "at", link FROM (
   SELECT page_id, link, min(i) AS first_at FROM (
     SELECT page_id, i, regexp_extract(url, '^([A-Za-z]+:)', 1) || '//' || regexp_extract(url, '//([^/?#]*)', 1) || regexp_replace(replace(href, '&amp;', '&'), '#.*$', '') AS link, href, label FROM (
       SELECT p.page_id, p.url, u.i, regexp_extract(u.a, 'href="([^"]*)"', 1) AS href, lower(regexp_replace(u.a, '<[^>]+>', '', 'g')) AS label
         FROM (SELECT *, regexp_extract_all(html, '(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>') AS anchors FROM pages) p,
         LATERAL (SELECT unnest(anchors) AS a, unnest(range(1, len(anchors) + 1)) AS i) u))
   WHERE (contains(lower(href), 'th') OR contains(lower(href), 'de') OR contains(label, 'th') OR contains(label, 'de')) GROUP BY 1, 2)""")
check("split_cards", r"""SELECT page_id, CAST(u.i - 1 AS INT) AS card_no, nullif(trim(regexp_replace(replace(replace(replace(replace(regexp_extract(u.c, '^([^<]*)', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')), '') AS lead
   FROM (SELECT page_id, string_split(html, '<p>')[2:] AS cs FROM pages) p, LATERAL (SELECT unnest(cs) AS c, unnest(range(1, len(cs) + 1)) AS i) u""")
check("label_values", r"""SELECT page_id, ls[list_position(list_transform(ls, lambda x: regexp_matches(x, '^(?:The|And|En|Les|Der|Nicht|La|De)$')), true) + 1] AS after_label FROM (SELECT page_id,
   list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '<[^>]+>', chr(10), 'g'), chr(10)),
     lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ls FROM pages)""")
PARAS = r"""paras AS (SELECT doc_id, source, i, p, CASE WHEN NOT (regexp_matches(p, '(?:The|Les|La|Der|El)(?:$|[^\p{L}\p{N}_])') AND regexp_matches(p, '(?i)en')) THEN 1
     WHEN d AND NOT c THEN 2 WHEN c AND NOT d THEN 3 WHEN c AND d THEN CASE WHEN regexp_matches(p, '(?:[A-Z][a-z]+[, ]+){2,}') THEN 3 ELSE 2 END ELSE 1 END AS prio FROM (
   SELECT *, regexp_matches(lower(p), 'ing |ment |ung ') AS c, regexp_matches(lower(p), 'tion |eau ') AS d FROM (
     SELECT doc_id, source, u.i, trim(regexp_replace(u.p, '\s+', ' ', 'g')) AS p FROM (SELECT doc_id, source, string_split(regexp_replace(text, '[ \t]+', ' ', 'g'), chr(10)) AS ps FROM documents) x,
       LATERAL (SELECT unnest(ps) AS p, unnest(range(1, len(ps) + 1)) AS i) u) WHERE p <> '')),
  stances AS (SELECT d.doc_id, d.source, coalesce(max(prio), 1) AS priority, arg_max(p, prio * 1000000 - i) FILTER (WHERE prio > 1) AS evidence
     FROM documents d LEFT JOIN paras ON paras.doc_id = d.doc_id GROUP BY 1, 2)"""
STANCE = "CASE priority WHEN 3 THEN 'confirmed' WHEN 2 THEN 'denies' ELSE 'silent' END"
check("paragraph_stance", f"SELECT doc_id, {STANCE} AS stance, priority, evidence FROM stances", PARAS)
check("site_stance", f"""SELECT source AS site, pages_checked, {STANCE} AS stance, evidence, url FROM (SELECT source, count(*) AS pages_checked, max(priority) AS priority,
   arg_max(coalesce(evidence, '~'), priority * 100000000 - doc_id) AS e, CAST(arg_max(doc_id, priority * 100000000 - doc_id) AS VARCHAR) AS url, nullif(arg_max(coalesce(evidence, '~'), priority * 100000000 - doc_id), '~') AS evidence
   FROM stances GROUP BY 1)""", PARAS)
check("sitemap_urls", r"""SELECT url, category, sitemap_id, CAST(pos AS INT) AS "at" FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY sitemap_id, pos) AS rn FROM (
   SELECT sitemap_id, row_number() OVER (PARTITION BY sitemap_id ORDER BY x) - 1 AS pos, 'https://s.example.com/' || k || '-' || n || '-grain-x.html' AS url,
     CASE n WHEN '9mm-luger' THEN '9mm' WHEN '308-win' THEN '308win' END AS category, k FROM (
     SELECT DISTINCT l_suppkey AS sitemap_id, l_partkey % 40 AS k, CASE l_partkey % 3 WHEN 0 THEN '9mm-luger' WHEN 1 THEN '308-win' ELSE '8x57' END AS n,
       (l_partkey % 40) || '-' || CASE l_partkey % 3 WHEN 0 THEN '9mm-luger' WHEN 1 THEN '308-win' ELSE '8x57' END AS x FROM lineitem))
   WHERE category IS NOT NULL AND NOT (k BETWEEN 10 AND 19)) WHERE rn = 1""")
DECIDED = """fetched AS (SELECT p_partkey AS listing_id, CASE WHEN p_partkey % 13 = 0 THEN 404 WHEN p_partkey % 17 = 0 THEN 503 WHEN p_partkey % 19 = 0 THEN 301 ELSE 200 END AS status,
     p_partkey % 7 <> 0 AS has_node, CASE p_partkey % 5 WHEN 0 THEN 'https://schema.org/OutOfStock' WHEN 1 THEN 'PreOrder' ELSE 'InStock' END AS avail,
     CAST(floor(p_retailprice * 2) AS DOUBLE) AS price FROM part),
  decided AS (SELECT listing_id, CAST(status AS INT) AS status, status = 404 OR (status = 200 AND has_node AND avail <> 'PreOrder') AS determinable,
     CASE WHEN status = 404 THEN FALSE WHEN status = 200 AND has_node THEN CASE avail WHEN 'InStock' THEN TRUE WHEN 'PreOrder' THEN NULL ELSE FALSE END END AS in_stock,
     CASE WHEN status = 200 AND has_node THEN price END AS price,
     CASE status WHEN 404 THEN 'http-404-gone' WHEN 503 THEN 'http-503-blocked-or-server' WHEN 301 THEN 'http-301-unexpected'
       ELSE CASE WHEN NOT has_node THEN 'no-jsonld-undetermined' WHEN avail = 'PreOrder' THEN 'schema-ambiguous:PreOrder' ELSE 'schema:' || avail END END AS reason FROM fetched)"""
check("recheck_decision", "SELECT * FROM decided", DECIDED)
check("recheck_report", """SELECT retailer_id, count(*) AS n, count(*) FILTER (category = 'flip_oos') AS flip_oos, count(*) FILTER (category = 'confirm_instock') AS confirm_instock,
    count(*) FILTER (category = 'undetermined') AS undetermined, count(*) FILTER (category = 'excluded') AS excluded
  FROM (SELECT l.retailer_id, CASE WHEN l.retailer_id = 8 THEN 'excluded' WHEN NOT d.determinable THEN 'undetermined' WHEN NOT d.in_stock THEN 'flip_oos' ELSE 'confirm_instock' END AS category
          FROM v_listings l JOIN decided d ON d.listing_id = l.id WHERE l.in_stock) GROUP BY 1""", DECIDED)
check("reconcile_stock", f"""SELECT id, category, CASE WHEN category IN ('excluded', 'undetermined') THEN category WHEN gate_reason = 'ok' THEN 'written' WHEN category = 'confirm_instock' THEN 'skipped_reval' ELSE 'flag_only' END AS outcome,
    gate_reason, CASE WHEN category = 'flip_oos' THEN FALSE ELSE in_stock END AS in_stock, base_price, price_per_round, category IN ('flip_oos', 'confirm_instock') AND gate_reason = 'ok' AS writes_history
  FROM (SELECT *, CASE WHEN price_per_round IS NULL THEN 'null' WHEN price_per_round < 0.01 OR price_per_round > 5 THEN 'absolute' WHEN price_per_round < lo THEN 'floor' WHEN price_per_round > hi THEN 'ceiling'
       WHEN abs(price_per_round - base_price / total_rounds) / (base_price / total_rounds) > 0.25 AND abs(price_per_round - base_price / total_rounds) > 0.10 THEN 'inconsistent' ELSE 'ok' END AS gate_reason FROM (
     SELECT l.id, l.in_stock, l.total_rounds, coalesce(b.blo, 0.15) AS lo, coalesce(b.bhi, 3.0) AS hi,
       CASE WHEN l.retailer_id = 8 THEN 'excluded' WHEN NOT d.determinable THEN 'undetermined' WHEN NOT d.in_stock THEN 'flip_oos' ELSE 'confirm_instock' END AS category,
       CASE WHEN l.retailer_id <> 8 AND d.determinable AND d.in_stock AND d.price IS NOT NULL THEN round_even(d.price, 2) ELSE l.base_price END AS base_price,
       CASE WHEN l.retailer_id <> 8 AND d.determinable AND d.in_stock AND d.price IS NOT NULL THEN round_even(d.price / l.total_rounds, 4) ELSE l.price_per_round END AS price_per_round
      FROM v_listings l JOIN decided d ON d.listing_id = l.id LEFT JOIN {values([('ECONOMY', 0.5, 4.0), ('PROMO', 1.0, 5.0)], 'cat, blo, bhi')} b ON b.cat = l.caliber_normalized WHERE l.in_stock))""", DECIDED)
OWN = "CASE category " + " ".join(f"WHEN '{k}' THEN {spaced_names(v)}" for k, v in categories.CATEGORY_URL_NAMES.items()) + " ELSE FALSE END"
OTHER = "(" + " OR ".join(f"(category <> '{k}' AND {spaced_names(v)})" for k, v in categories.CATEGORY_URL_NAMES.items()) + ")"
TRACKED = in_list(categories.CATEGORY_URL_NAMES)
check("page_verdict", f"""SELECT retailer_id, category, CASE WHEN stage = 'empty' THEN 'NEEDS_REVIEW' WHEN stage = 'judged' THEN CASE WHEN g4 = 'PASS' AND cnt >= 5 AND (parent OR own) THEN 'PASS' ELSE 'NEEDS_REVIEW' END ELSE 'FAIL' END AS verdict,
    CASE WHEN stage = 'redirect' THEN TRUE WHEN stage = 'http' THEN NULL ELSE FALSE END AS redirect,
    CASE WHEN stage = 'other' THEN FALSE WHEN stage IN ('empty', 'gate4', 'judged') AND NOT parent THEN own END AS title_match,
    CASE WHEN stage IN ('empty', 'gate4', 'judged') THEN pct END AS gate_pass_pct, CASE WHEN stage IN ('empty', 'gate4', 'judged') THEN CAST(np AS INT) END AS n_products
  FROM (SELECT *, CASE WHEN retailer_id = 8 THEN 'http' WHEN retailer_id = 7 THEN 'redirect' WHEN NOT parent AND NOT own AND other THEN 'other' WHEN np = 0 THEN 'empty' WHEN g4 = 'FAIL' THEN 'gate4' ELSE 'judged' END AS stage FROM (
    SELECT *, CASE WHEN parent THEN CASE WHEN hit = 0 THEN 'FAIL' ELSE 'PASS' END WHEN pct >= 70 THEN 'PASS' WHEN pct < 30 THEN 'FAIL' ELSE 'NEEDS_REVIEW' END AS g4, CASE WHEN parent THEN hit ELSE np END AS cnt FROM (
      SELECT *, coalesce(round_even(100.0 * hit / nullif(np, 0), 1), 0.0) AS pct FROM (
        SELECT p.retailer_id, p.category, p.retailer_id = 9 AS parent, any_value(p.own) AS own, any_value(p.other) AS other, count(c.t) AS np,
               count(c.t) FILTER (WHERE CASE WHEN p.retailer_id = 9 THEN c.slug IN {TRACKED} ELSE c.slug = p.category END) AS hit
          FROM (SELECT retailer_id, category, {OWN} AS own, {OTHER} AS other FROM (SELECT retailer_id, category,
                   ' ' || trim(regexp_replace(lower(CASE WHEN retailer_id = 6 THEN '9mm Luger deals' ELSE category || ' deals' END), '[^a-z0-9]+', ' ', 'g')) || ' ' AS s
                 FROM (SELECT DISTINCT retailer_id, page_category AS category FROM v_titles))) p
          LEFT JOIN (SELECT retailer_id, category, t, {CATEGORY} AS slug FROM (
              SELECT retailer_id, page_category AS category, title AS t, lower(CASE WHEN retailer_id = 3 THEN page_category || ' x ' || title ELSE title END) AS low,
                     row_number() OVER (PARTITION BY retailer_id, page_category ORDER BY title) AS rn FROM (SELECT DISTINCT retailer_id, page_category, title FROM v_titles))
              WHERE retailer_id <> 4 AND (retailer_id <> 5 OR rn <= 2)) c ON c.retailer_id = p.retailer_id AND c.category = p.category
         GROUP BY 1, 2, 3))))""")
check("number_near_keyword", """SELECT doc_id, doc_id % 3 <> 0 AS near FROM documents""")

check("ballistics_facts", """SELECT p_partkey AS page_id, 'S' || p_partkey AS external_id,
   CASE k WHEN 0 THEN 'Line ' || p_type WHEN 1 THEN p_type END AS product_line,
   CASE k WHEN 0 THEN '9mm' WHEN 1 THEN '10mm' WHEN 2 THEN '45acp' WHEN 3 THEN '380acp' ELSE '9mm' END AS caliber_normalized, p_size AS grain,
   CASE k WHEN 0 THEN 'FMJ' WHEN 1 THEN 'FMJ' WHEN 2 THEN 'JHP' WHEN 3 THEN 'JHP' ELSE 'TMJ' END AS bullet_type,
   CAST(p_size * 10 + 700 AS INT) AS muzzle_velocity_fps, CAST(p_size + 300 AS INT) AS muzzle_energy_ftlb FROM (SELECT *, p_partkey % 5 AS k FROM part)""")
check("tile_facts", """SELECT CAST(floor(p_partkey / 10) AS BIGINT) AS page_id, 'Q' || p_partkey AS sku, p_type AS product_line, CASE p_partkey % 3 WHEN 0 THEN '9mm' ELSE '10mm' END AS caliber_normalized,
   p_size AS grain, 'SP' AS bullet_type, CAST(p_size + 900 AS INT) AS muzzle_velocity_fps FROM part WHERE p_partkey % 3 <> 1 AND p_size % 7 <> 0""")
check("rebate_facts", """SELECT 'R10' || lpad(CAST(rebate_id AS VARCHAR), 3, '0') AS external_id, 'Offer ' || lpad(CAST(rebate_id AS VARCHAR), 3, '0') AS title,
   'https://r.example.com#R10' || lpad(CAST(rebate_id AS VARCHAR), 3, '0') AS detail_url, rebate_id AS min_qty_required, 75.0 AS amount_max_total, '2026-03-01' AS valid_from,
   '2026-05-' || lpad(CAST(rebate_id % 28 + 1 AS VARCHAR), 2, '0') AS valid_through, '2026-06-30' AS submit_by, min(length(product_line) + 0.5) AS amount_min_per_unit,
   max(length(product_line) + 0.5) AS amount_max_per_unit FROM v_eligible GROUP BY rebate_id""")
check("rebate_lines", """SELECT 'R10' || lpad(CAST(rebate_id AS VARCHAR), 3, '0') AS external_id, product_line, length(product_line) + 0.5 AS amount_override FROM v_eligible""")
check("component_rows", """SELECT p_partkey AS page_id, CASE WHEN p_partkey % 2 = 0 THEN 'powder' ELSE 'bullet' END AS category, 'G' || p_partkey AS parent_sku, v || p_partkey AS variant_sku,
   p_name || ' ' || p_size || ' Grain' AS product_name, p_brand AS brand, CASE WHEN v = 'A' THEN CASE WHEN p_partkey % 2 = 0 THEN 0.5 ELSE 4.0 END ELSE p_size * 10.0 END AS package_size,
   CASE WHEN p_partkey % 2 = 0 THEN 'lb' ELSE 'count' END AS package_unit, CAST(CASE WHEN v = 'A' THEN p_size ELSE p_size + 5 END AS DOUBLE) AS price,
   CASE WHEN v = 'A' THEN p_partkey % 5 <> 0 ELSE p_partkey % 3 = 0 END AS in_stock, CASE WHEN p_partkey % 2 <> 0 THEN p_size END AS grain
  FROM part, (VALUES ('A'), ('B')) AS t(v)""")
check("verified_numbers", """SELECT CASE WHEN m % 10 = 9 THEN url || '?gone' ELSE url END AS url, CAST(m + CASE WHEN m % 4 = 0 THEN 5001 ELSE 1000 END AS INT) AS expected, m % 10 <> 9 AND m % 4 <> 0 AS verified
   FROM (SELECT url, max(page_id) AS m FROM pages GROUP BY 1)""")
check("card_tiers", """SELECT CASE WHEN u THEN q * 9.0 WHEN t THEN q + 0.99 END AS base_price, CASE WHEN u THEN low WHEN t THEN round_even((q + 0.99) / 20, 4) END AS price_per_round,
   CASE WHEN u THEN greatest(1, CAST(round_even(q * 9.0 / low, 0) AS BIGINT)) WHEN t THEN 20 END AS total_rounds, count(*) AS n
  FROM (SELECT CAST(l_quantity AS INT) AS q, l_partkey % 3 <> 0 AS u, l_partkey % 2 = 0 AS t, least(CAST('0.' || l_linenumber AS DOUBLE), 0.9) AS low FROM lineitem) GROUP BY 1, 2, 3""")

# -- store on change ------------------------------------------------------------------------------


def folded(source: str, seed: str = "") -> str:
    """Row-by-row fold of each listing and day against the last written row."""
    return f"""obs AS (SELECT *, row_number() OVER (PARTITION BY listing_id, CAST(recorded_at AS DATE) ORDER BY recorded_at, id) AS k, CAST(recorded_at AS DATE) AS d FROM ({source})),
  fold AS (SELECT id, listing_id, d, k, price AS lp, price_per_round AS lu, in_stock AS ls, TRUE AS wrote FROM obs WHERE k = 1
    UNION ALL SELECT o.id, o.listing_id, o.d, o.k, CASE WHEN w THEN o.price ELSE lp END, CASE WHEN w THEN o.price_per_round ELSE lu END, CASE WHEN w THEN o.in_stock ELSE ls END, w
      FROM (SELECT o.*, f.lp, f.lu, f.ls, NOT (abs(o.price - f.lp) < 0.005 AND abs(o.price_per_round - f.lu) < 0.00005 AND o.in_stock = f.ls) AS w
              FROM fold f JOIN obs o ON o.listing_id = f.listing_id AND o.d = f.d AND o.k = f.k + 1) o)"""


check("store_on_change", "SELECT f.id, f.listing_id, o.price, o.in_stock FROM fold f JOIN obs o ON o.id = f.id WHERE f.wrote", folded("SELECT * FROM v_steps"))
check("store_on_change_stream", "SELECT f.id, f.listing_id, o.price, o.in_stock FROM fold f JOIN obs o ON o.id = f.id WHERE f.wrote", folded("SELECT * FROM v_steps"))
check("store_on_change_baseline", """SELECT id, listing_id FROM fold WHERE wrote AND id IN (SELECT id FROM v_steps WHERE date_part('hour', recorded_at) >= 12)""", folded(
    """SELECT * FROM v_steps WHERE date_part('hour', recorded_at) >= 12 UNION ALL
     SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY listing_id, CAST(recorded_at AS DATE) ORDER BY recorded_at DESC, id DESC) AS rn FROM v_steps
       WHERE date_part('hour', recorded_at) < 12) WHERE rn = 1"""))
check("day_baseline", """SELECT listing_id, id, price, price_per_round, in_stock FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY recorded_at DESC, id DESC) AS rn
   FROM v_obs WHERE CAST(recorded_at AS DATE) = DATE '2024-01-15') WHERE rn = 1""")
check("stamp_on_success", f"""SELECT r.id, CASE WHEN s.saved > 0 AND r.id % 2 = 0 THEN TIMESTAMP '{q.AS_OF}' ELSE r.last_scraped_at END AS last_scraped_at FROM v_retailers r
   LEFT JOIN (SELECT retailer_id, count(*) FILTER (WHERE id % 3 = 0) AS saved FROM v_listings GROUP BY 1) s ON s.retailer_id = r.id""")
check("stock_stamps", f"""SELECT id, in_stock, CASE WHEN in_stock THEN 'In Stock' ELSE 'Out of Stock' END AS stock_level, CASE WHEN in_stock THEN TIMESTAMP '{q.AS_OF}' END AS last_seen_in_stock FROM v_listings""")


check("ingest_flow", f"""SELECT retailer_id, retailer_product_id, caliber_normalized, manufacturer, total_rounds, price_per_round, in_stock FROM (
   SELECT *, row_number() OVER (PARTITION BY retailer_id, retailer_product_id ORDER BY seq) AS rn FROM (
   SELECT c.*, coalesce(b.blo, 0.15) AS lo, coalesce(b.bhi, 3.0) AS hi, round_even(base_price / total_rounds, 4) AS price_per_round FROM (
    SELECT retailer_id, seq, {CATEGORY} AS caliber_normalized, coalesce({brand_of('b1')}, {PREFIX}, {brand_of('b2')}, 'Unknown') AS manufacturer,
      coalesce(nullif({pack('simple')}, 0), greatest(1, CAST(round_even(base_price / 0.5, 0) AS BIGINT))) AS total_rounds, base_price,
      nullif(regexp_extract(regexp_replace(product_url, '/+$', ''), '([^/]*)$', 1), '') AS retailer_product_id, NOT {any_word('low', packs.STOCK_RULES['absent_phrases']['out'])} AS in_stock
     FROM (SELECT retailer_id, product_url, c.seq AS seq, c.title AS title, lower(c.title) AS low, c.base_price AS base_price, {BRAND_TEXT.format(c='c.title')} AS b1, {BRAND_TEXT.format(c='product_url')} AS b2
        FROM (SELECT retailer_id, product_url, min({{'seq': id, 'title': title, 'source': source, 'page_category': page_category, 'base_price': CAST(partkey % 90 + 10 AS DOUBLE)}}) AS c FROM v_titles GROUP BY 1, 2))) c
    LEFT JOIN {CAPTURE} b ON b.cat = c.caliber_normalized WHERE caliber_normalized IS NOT NULL)
  WHERE price_per_round >= 0.01 AND price_per_round <= 5 AND price_per_round >= lo AND price_per_round <= hi) WHERE rn = 1""")


def oracles() -> dict[str, str]:
    return dict(CHECKS)
