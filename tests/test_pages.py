import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from farthing.functions import clock, markup
from farthing.operators import enrich, pages
from farthing.rulebook import categories

LD = '<script type="application/ld+json">%s</script>'


def offers(spark, html):
    node = markup.product_offer(markup.jsonld_nodes(F.col("h")))
    df = spark.createDataFrame([(html,)], "h string").withColumn("o", node)
    return df.select(
        F.to_json("o").alias("offer"), markup.offer_price(F.col("o")).alias("price"),
        markup.availability_state(markup.node_text(F.col("o"), "$.availability")).alias("state"),
    ).first()


@pytest.mark.parametrize(
    "payload, price, state",
    [
        ('{"@type":"Product","offers":{"price":"$1,299.50","availability":"https://schema.org/InStock"}}', 1299.5, True),
        ('[{"@type":"Product","offers":[{"price":1}]},{"@type":"product","offers":[{"price":2},{"price":3}]}]', 2.0, None),
        ('{"@graph":[{"@type":"Product","offers":{"price":4}},{"@type":"X"}]}', 4.0, None),
        ('{"@type":["Thing","Product"],"offers":{"lowPrice":"x","highPrice":5,"availability":"SoldOut"}}', 5.0, False),
        ('{"@type":"AggregateOffer","lowPrice":6,"availability":"LimitedAvailability"}', 6.0, True),
        ('{"@type":"Product","offers":{"priceSpecification":[{"price":7},{"price":8}],"availability":"PreOrder"}}', 7.0, None),
        ('{"@type":"Product","offers":{"price":"","priceSpecification":{"lowPrice":9}}}', 9.0, None),
        ('{"@type":"Product","offers":[]}', None, None),
        ('{broken', None, None),
    ],
)
def test_offers(spark, payload, price, state):
    got = offers(spark, LD % payload)
    assert (got.price, got.state) == (price, state)


def test_visit_orders(spark):
    html = LD % '{"n":"w","@graph":[{"n":"a"},{"n":"b","@graph":[{"n":"b1"}]}]}' + LD % "{bad" + LD % '[{"n":"c"},[{"n":"d"}],5]'
    df = spark.createDataFrame([(html,)], "h string")
    names = lambda last: df.select(F.transform(markup.jsonld_nodes(F.col("h"), last), lambda n: markup.node_text(n, "$.n"))).first()[0]
    assert names(True)[:3] == ["w", "b", "b1"] or names(True)[:2] == ["w", "b"]
    assert names(False)[:2] == ["w", "a"]


def test_recheck_and_reconcile(spark):
    page = lambda avail, price: LD % ('{"@type":"Product","offers":{"price":%s,"availability":"%s"}}' % (price, avail))
    fetched = spark.createDataFrame(
        [(1, "u", 200, page("InStock", 15)), (2, "u", 200, page("OutOfStock", 15)), (3, "u", 404, None), (4, "u", 403, None),
         (5, "u", 200, "<html/>"), (6, "u", 200, page("InStock", 500)), (7, "u", None, None), (8, "", 200, None),
         (9, "u", 200, page("BackOrder", 1)), (10, "u", 302, None), (11, "u", 410, None)],
        "listing_id long, url string, status int, html string",
    )
    reasons = {r.listing_id: (r.determinable, r.in_stock, r.reason) for r in pages.recheck_decisions(fetched).collect()}
    assert reasons == {
        1: (True, True, "schema:InStock"), 2: (True, False, "schema:OutOfStock"), 3: (True, False, "http-404-gone"),
        4: (False, None, "http-403-blocked-or-server"), 5: (False, None, "no-jsonld-undetermined"),
        6: (True, True, "schema:InStock"), 7: (False, None, "fetch-error:unknown"), 8: (False, None, "no-url"),
        9: (False, None, "schema-ambiguous:BackOrder"), 10: (False, None, "http-302-unexpected"), 11: (True, False, "http-410-gone"),
    }
    listings = spark.createDataFrame(
        [(i, 7 if i == 4 else 1, "9mm", 20.0, 0.4 if i != 11 else 9.0, 50, True) for i in range(1, 12)],
        "id long, retailer_id int, caliber_normalized string, base_price double, price_per_round double, total_rounds int, in_stock boolean",
    )
    bounds = spark.createDataFrame(categories.CAPTURE_BOUNDS, "c string, lo double, hi double")
    now = clock.instant("2024-01-01 00:00:00")
    out = pages.reconcile_stock(listings, pages.recheck_decisions(fetched), now, bounds, excluded=[7])
    got = {r.id: (r.outcome, r.in_stock, r.price_per_round, r.writes_history) for r in out.collect()}
    assert got[1] == ("written", True, 0.3, True)
    assert got[2] == ("written", False, 0.4, True)
    assert got[4] == ("excluded", True, 0.4, False)
    assert got[6][0] == "skipped_reval" and got[6][1] is True
    assert got[11] == ("flag_only", False, 9.0, False)
    assert pages.recheck_history(out, now).count() == 3
    assert {(r.retailer_id, r.n, r.flip_oos) for r in pages.recheck_report(out).collect()} == {(1, 10, 3), (7, 1, 0)}


def verdict(spark, **change):
    row = dict(status=200, requested_url="/9mm/", landed_url="/9mm", title="9mm Luger Ammo", card_titles=["9mm FMJ"] * 7 + ["45 acp"],
               category="9mm", kind="caliber", title_filter=None)
    row.update(change)
    df = spark.createDataFrame(
        [tuple(row.values())],
        "status int, requested_url string, landed_url string, title string, card_titles array<string>, category string, kind string, title_filter string",
    )
    r = pages.page_verdicts(df).first()
    return r.verdict, r.gate_pass_pct, r.note


def test_page_verdicts(spark):
    assert verdict(spark) == ("PASS", 87.5, "ok")
    assert verdict(spark, status=404) == ("FAIL", None, "http(404)")
    assert verdict(spark, landed_url="/10mm")[0] == "FAIL"
    assert verdict(spark, card_titles=["9mm"] * 2 + ["10mm"] * 8)[:2] == ("FAIL", 20.0)
    assert verdict(spark, title="10mm Auto") == ("FAIL", None, "other_category_title")
    assert verdict(spark, card_titles=["9mm"] * 4 + ["10mm"] * 4)[:2] == ("NEEDS_REVIEW", 50.0)
    assert verdict(spark, card_titles=["9mm"] * 3)[0] == "NEEDS_REVIEW"
    assert verdict(spark, card_titles=[])[2] == "empty_page"
    assert verdict(spark, card_titles=None)[0] == "NEEDS_REVIEW"
    assert verdict(spark, status=None)[0] == "NEEDS_REVIEW"
    assert verdict(spark, title="Ammo Deals")[0] == "NEEDS_REVIEW"
    assert verdict(spark, kind="parent", title="Deals", card_titles=["9mm"] * 5 + ["x"] * 50)[0] == "PASS"
    assert verdict(spark, kind="parent", card_titles=["x"] * 5)[2] == "no_tracked_card"
    assert verdict(spark, category="762x39", title="7.62x39", card_titles=["7.62×39 FMJ"] * 6)[0] == "PASS"
    assert verdict(spark, title_filter="FMJ")[:2] == ("PASS", 100.0)


def test_stance(spark):
    texts = [
        "We collect sales tax in Texas.", "We do not collect tax in Texas.", "Texas is big.\n\nTX tax info.",
        "We do not collect tax except we collect in CA, NV, TX, NY, as tax.", "no sales tax in Texas\n\nWe are required to collect tax in TX", None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select(pages.page_stance(markup.paragraphs(F.col("t"))).alias("s")).select("s.stance", "s.evidence").collect()
    assert [r.stance for r in got] == ["confirmed", "denies", "silent", "confirmed", "confirmed", "silent"]
    assert got[4].evidence.startswith("We are required") and got[2].evidence is None
    pages_df = df.select(F.lit("s").alias("site"), F.col("i").alias("seq"), F.col("i").cast("string").alias("url"),
                         pages.page_stance(markup.paragraphs(F.col("t"))).alias("stance"))
    best = pages.site_stance(pages_df).first()
    assert (best.stance, best.url, best.pages_checked) == ("confirmed", "0", 6)
    long = "x" * 300 + " Texas tax " + "y" * 400
    cut = spark.createDataFrame([(long,)], "t string").select(pages.excerpt(F.col("t"))).first()[0]
    assert cut.startswith("...") and cut.endswith("...") and "Texas" in cut and len(cut) == 3 + 120 + 5 + 200 + 3


def test_verified_numbers(spark):
    got_pages = spark.createDataFrame(
        [("a", "<p>Muzzle velocity</p><td>1,150 fps</td>"), ("b", "<script>1150 fps</script>"), ("c", "velocity 11500 " + "z" * 300 + " 1150")],
        "url string, html string",
    )
    want = spark.createDataFrame([("a", 1150), ("b", 1150), ("c", 1150), ("d", 1)], "url string, expected int")
    got = {r.url: r.note for r in pages.verified_numbers(got_pages, want).collect()}
    assert got == {"a": "verified", "b": "empty page", "c": "1150 not near a keyword", "d": "fetch failed"}


def test_ballistics_templates(spark):
    schema = (
        "<title>Fed 124 Grain 1150 FPS</title>" + LD % '{"@type":"Product","sku":"AE9","name":"American Eagle, 9mm Luger, 115 Grain, Full Metal Jacket, 1180 fps"}'
        + "<table><tr><td>Muzzle Velocity</td><td>1180</td></tr></table>"
        + '<script id="chart-data-velocity">{"points":[[1175,1100,1050,1000,950]]}</script><script id="chart-data-energy">{"points":[[355,1,1,1,1]]}</script>'
    )
    bare = LD % '{"@type":"Product","sku":"53650","name":"Lawman 9mm"}' + "<table><tr><td>Caliber</td><td>9mm Luger</td></tr><tr><td>Grain Weight</td><td>115 gr</td></tr><tr><td>Bullet Style</td><td>Total Metal Jacket</td></tr></table>"
    labels = '<h1 class="itemtitle">9mm Luger 115 gr FTX® Critical Defense®</h1><span class="stats">Item #90250 | 25/Box</span><div data-label="Muzzle Velocity">1140 fps</div><div data-label="100 YD Velocity">956</div>'
    imperial = '<h1>9mm Luger 115GR FMJ</h1><span class="symbol">9A</span><table id="table-imperial"><tr><td>x</td></tr></table><table id="table-imperial"><tr><td>fps</td></tr><tr><td>Muzzle</td><td>1135</td><td>330</td></tr><tr><td>50 Yards</td><td>1027</td></tr></table>'
    lines = "<h1>9mm Luger +P</h1><b>ITEM NO:</b><i>9A</i><b>BULLET TYPE:</b><i>Full Metal Jacket</i><b>WEIGHT:</b><i>115 GR</i><p>VELOCITY</p><p>(FEET PER SECOND)</p><p>Muzzle:</p><p>1150</p><p>100 Yds:</p><p>930</p><p>ENERGY</p><p>Muzzle:</p><p>338</p>"
    heading = '<h1>9 mm LUGER FMJ 115 GRS SB9A</h1><table class="large"><tr><th>Velocity</th><th>ft/s</th><td>1,280</td><td>1</td><td>1080</td><td>990</td></tr><tr><th>Energy</th><th>x</th><td>418</td></tr></table>'
    rows = [(1, "https://m/a/b/1.html", "schema", schema), (2, "https://m/lawman-handgun-training/19-53650.html", "schema", bare), (3, "u/3", "labels", labels),
            (4, "u/4", "imperial", imperial), (5, "u/bronze-9a", "lines", lines), (6, "u/6", "heading", heading)]
    df = spark.createDataFrame(rows, "page_id int, url string, source string, html string")
    got = {r.page_id: r for r in pages.ballistics_facts(df).collect()}
    key = lambda r: (r.external_id, r.product_line, r.caliber_normalized, r.grain, r.bullet_type, r.muzzle_velocity_fps, r.velocity_50yd, r.velocity_100yd, r.muzzle_energy_ftlb)
    assert key(got[1]) == ("AE9", "American Eagle", "9mm", 115, "FMJ", 1180, 1050, 950, 355)
    assert key(got[2]) == ("53650", "Lawman Handgun Training", "9mm", 115, "TMJ", None, None, None, None)
    assert key(got[3]) == ("90250", "Critical Defense", "9mm", 115, "FTX", 1140, None, 956, None)
    assert key(got[4]) == ("9A", None, "9mm", 115, "FMJ", 1135, 1027, None, 330)
    assert key(got[5]) == ("9A", "Bronze", "9mm", 115, "FMJ", 1150, None, 930, 338)
    assert key(got[6]) == ("SB9A", None, "9mm", 115, "FMJ", 1280, 1080, 990, 418)


def test_rebates(spark):
    block = (
        '<div id="R10123"></div><h3>Spring Promo Promotion #: R10123</h3><p class="fine-print">Federal Strut-Shok®, Grand Slam or Heavyweight — $5.00 rebate per box<br/>'
        "Federal Premium TSS - $10 rebate per box<br>no amount rebate per box</p>"
        '<p class="minimum-copy">Minimum purchase two (2) boxes required. Maximum rebate $100.00 per person.</p>'
        '<p class="font-italic">Valid for purchases made 3/1/2026 through 5/31/2026. DEADLINE: 6/30/2026</p>'
    )
    df = spark.createDataFrame([(1, "https://r", block + block.replace("R10123", "R10999"))], "page_id int, url string, html string")
    found = pages.rebate_blocks(df).orderBy("external_id")
    r = found.first()
    assert (r.external_id, r.title, r.min_qty_required, r.amount_max_total) == ("R10123", "Spring Promo", 2, 100.0)
    assert (r.valid_from, r.valid_through, r.submit_by) == (date(2026, 3, 1), date(2026, 5, 31), date(2026, 6, 30))
    assert [(l.product_line, l.amount) for l in r.lines] == [("Strut-Shok", 5.0), ("Grand Slam", 5.0), ("Heavyweight", 5.0), ("TSS", 10.0)]
    assert (r.amount_min_per_unit, r.amount_max_per_unit) == (5.0, 10.0) and found.count() == 2
    assert pages.rebate_lines(found).count() == 8
    prose = (
        "<h1>16 GA Rebate</h1><p>Earn $2 back for each box. Maximum rebate amount is $40. Minimum two boxes.</p>"
        "<div>Eligible on Winchester® Super-X®, Double-X® and Long Beard turkey loads.</div><p>Purchases between March 6, 2026 – May 31, 2026, postmarked no later than June 30, 2026</p>"
    )
    d = pages.rebate_details(spark.createDataFrame([(1, "https://w/Rebates/x", prose)], "page_id int, url string, html string"), "Winchester").first()
    assert (d.external_id, d.title, d.amount_max_per_unit, d.amount_max_total, d.min_qty_required) == ("x", "16 GA Rebate", 2.0, 40.0, 2)
    assert [l.product_line for l in d.lines] == ["Super-X", "Double-X", "Long Beard"]
    assert (d.valid_from, d.valid_through, d.submit_by) == (date(2026, 3, 6), date(2026, 5, 31), date(2026, 6, 30))
    stored = spark.createDataFrame([("R10123", "rifle")], "external_id string, firearm_type string")
    kinds = {r.external_id: r.firearm_type for r in pages.classified_rebates(found.withColumn("title", F.lit("Pistol")), stored).collect()}
    assert kinds == {"R10123": "rifle", "R10999": "handgun"}


def test_component_rows(spark):
    group = LD % (
        '{"@graph":[{"@type":"ProductGroup","name":" Varget ","productGroupID":"G1","brand":{"name":"Hodgdon"},"hasVariant":['
        '{"sku":"A","size":"8","offers":{"priceSpecification":[{"price":"300"}]}},{"sku":"B","size":"14-oz","offers":{"price":40}},'
        '{"sku":"C","url":"u?attribute_pa_quantity=100","offers":[{"x":1},{"price":12}]},{"sku":"D","name":"x - 1000","offers":{"price":9}},'
        '{"sku":"E","offers":{"price":9}},{"sku":"F","size":"1"}]}]}'
    ) + '<p class="stock out-of-stock">x</p><form data-product_variations="[{&quot;sku&quot;:&quot;A&quot;,&quot;is_in_stock&quot;:true}]"></form>'
    single = LD % '{"@type":"Product","name":"Sierra 77 Grain Box of 50","sku":"S1","offers":{"price":30}}' + "<table><tr><th>Caliber</th><td>22 Caliber</td></tr></table><p class='stock in-stock'>In stock</p>"
    df = spark.createDataFrame([(1, "u1", "powder", group), (2, "u2", "bullet", single), (3, "u3", "brass", "<p/>")], "page_id int, url string, kind string, html string")
    got = {r.variant_sku: (float(r.package_size), r.price, r.in_stock, r.package_unit, r.caliber, r.grain) for r in pages.component_rows(df, {"powder": "lb", "bullet": "count", "brass": "count"}).collect()}
    assert got == {
        "A": (8.0, 300.0, True, "lb", None, None), "B": (0.88, 40.0, False, "lb", None, None), "C": (100.0, 12.0, False, "lb", None, None),
        "D": (1000.0, 9.0, False, "lb", None, None), "S1": (50.0, 30.0, True, "count", "22 Caliber", 77),
    }


def test_cards_tiles_and_sitemaps(spark):
    html = 'head<div class="c" data-pid="1"><a href="/x">A &amp; B</a> $5</div><div class="c" data-pid="2"><a href="/y">C</a></div>'
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    cards = pages.card_fields(pages.split_cards(df, '<div class="c"'), {"pid": 'data-pid="(\\d+)"', "name": "<a[^>]*>([^<]+)</a>"})
    assert [(r.card_no, r.pid, r.name) for r in cards.orderBy("card_no").collect()] == [(0, "1", "A & B"), (1, "2", "C")]
    tier = spark.createDataFrame([("$10.99|$109.99", "$.22/rd|$0.21", "x"), ("$10|$20", "", "50 rounds"), ("$10", "", "x")], "p string, u string, t string")
    got = [tuple(r[0]) if r[0] else None for r in tier.select(pages.tier_prices(F.col("p"), F.col("u"), F.col("t"))).collect()]
    assert got[1] == (10.0, 0.2, 50) and got[2] is None and got[0][0] == 109.99
    tile = ('<div class="b-producttile__info"><div class="b-producttile__info-item m-cartridge">9mm Luger</div><div class="b-producttile__info-item m-weight">115 gr</div>'
            '<div class="b-producttile__info-item m-type">Full Metal Jacket</div><div class="b-producttile__info-item m-muzzle-velocity">1190</div>'
            '<div class="b-producttile__info-item m-muzzle-energy">362</div><div class="b-producttile__info-item m-symbol"><a>Q4172</a></div><div class="b-producttile__info-item m-brand"><a>USA</a></div></div>')
    page = spark.createDataFrame([(1, "u", tile + tile.replace("9mm Luger", ".243 Win") + tile.replace("1190", "fast"))], "page_id int, url string, html string")
    assert [(r.sku, r.product_line, r.caliber_normalized, r.grain, r.bullet_type, r.muzzle_velocity_fps) for r in pages.tile_facts(page).collect()] == [("Q4172", "USA", "9mm", 115, "FMJ", 1190)]
    xml = "<loc> https://s/9mm-grain-a </loc><loc>https://s/b</loc><loc>https://s/9mm-grain-a</loc><loc>https://s/308-win-grain-c</loc>"
    maps = spark.createDataFrame([(1, xml)], "sitemap_id int, xml string")
    assert sorted((r.url, r.category) for r in pages.sitemap_urls(maps, "-grain-").collect()) == [("https://s/308-win-grain-c", "308win"), ("https://s/9mm-grain-a", "9mm")]


@pytest.mark.parametrize(
    "requested, landed, moved",
    [("https://www.a.com/x/", "http://a.com/X?p=1", False), ("https://a.com/x", "https://b.com/x", True), ("/x", "/y", True),
     ("https://a.com", "https://a.com/", False), ("https://shop.a.com/x", "https://a.com/x", True), ("/x", None, True)],
)
def test_redirect(spark, requested, landed, moved):
    df = spark.createDataFrame([(requested, landed)], "a string, b string")
    assert df.select(markup.redirected(F.col("a"), F.col("b"))).first()[0] is moved


def test_unescape(spark):
    df = spark.createDataFrame([("A&amp;lt;B &#39;q&#x27; &#8482; &# &lt;b&gt; &nbsp;&amp;#39;",)], "t string")
    want = "A&lt;B 'q' \u2122 &# <b> \u00a0&#39;"
    assert df.select(markup.unescape(F.col("t"))).first()[0] == want


def test_character_references(spark):
    import html

    cases = ["&#128512;", "&#x1F600;", "&pound;5 &auml;", "&#38;lt;", "&amp;lt;", "a&b", "&", "&notit;", "&notin;", "&#0;", "&#x80;", "&#xD800;",
             "&#99999999999;", "&copy 2", "&unknown;", "&#;", "&#x;", "&amp;&lt;p&gt;", "&#00065;", "AT&T", "&Aacute", "&hellip;y", "", None]
    rows = spark.createDataFrame([(c,) for c in cases], "t string").select("t", markup.unescape(F.col("t")).alias("u")).collect()
    assert [r.u for r in rows] == [None if c is None else html.unescape(c) for c in cases]


def test_graphs_of_any_depth(spark):
    product = '{"@type":"Product","offers":{"availability":"https://schema.org/InStock","price":"5"}}'
    blocks = ['{"@graph":[{"@graph":[%s]}]}', "[[%s]]", '{"@graph":[[{"@graph":[{"@graph":[%s]}]}]]}', "%s", "[[[[[[%s]]]]]]", '{"@graph":"%s']
    rows = [(i, "http://a", 200, f'<script type="application/ld+json">{b.replace("%s", product)}</script>') for i, b in enumerate(blocks)]
    rows += [(90, "", 404, ""), (91, None, 404, ""), (92, "http://a", 404, "")]
    df = spark.createDataFrame(rows, "listing_id long, url string, status int, html string")
    got = {r.listing_id: (r.determinable, r.in_stock) for r in pages.recheck_decisions(df).collect()}
    assert all(got[i] == (True, True) for i in range(5)) and got[5] == (False, None)
    assert got[90] == got[91] == (False, None) and got[92] == (True, False)
    order = '{"@type":"A","@graph":[{"@type":"B"},{"@type":"C","@graph":[{"@type":"D"}]}]}'
    html = F.lit(f'<script type="application/ld+json">[{order},{{"@type":"E"}}]</script>')
    nodes = F.transform(markup.jsonld_nodes(html), lambda n: markup.node_text(n, "$['@type']"))
    assert spark.range(1).select(nodes.alias("n")).first().n == ["E", "A", "C", "D", "B"]


def test_near_keyword(spark):
    texts = [("the price is 1,250 dollars", True), ("1250 x price", True), ("price" + " y" * 30 + " 1250", False), ("11250 price", False), ("price 12501", False), (None, False)]
    df = spark.createDataFrame([(t, 1250) for t, _ in texts], "t string, n long").select(markup.near_keyword(F.col("t"), F.col("n"), ["price"], 30).alias("h"))
    assert [r.h for r in df.collect()] == [w for _, w in texts]


def test_references_are_looked_up_once_a_text(spark):
    """Many references of a long text: each kind is searched in the whole table once."""
    import time

    df = spark.createDataFrame([("a&period;&eacute;b&#111;&nosuch;&uuml" * 100_000,)], "t string")
    started = time.monotonic()
    got = df.select(F.sha2(markup.unescape(F.col("t")), 256)).first()[0]
    assert time.monotonic() - started < 10
    assert got == hashlib.sha256(("a.ébo&nosuch;ü" * 100_000).encode()).hexdigest()


@pytest.mark.parametrize("name", ["component_rows", "ballistics_facts"])
def test_page_work_is_dealt(spark, tmp_path, name):
    """A small file of many parts is worked on by more tasks than the one that reads it."""
    from farthing.plans import queries

    rows = [(i, f"red bolt {i}", f"Brand#{i % 5}", "SMALL", i % 50 + 1, 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    df.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert queries.REGISTRY[name](spark, str(tmp_path)).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
