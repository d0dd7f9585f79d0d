import pytest
from pyspark.sql import functions as F

from farthing.functions import predicates, prices, rules, text
from farthing.operators import enrich, pool
from farthing.rulebook import packs


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    "title, slug",
    [
        ("Federal 5.56 NATO 55gr", "223-556"),
        ("Tula 5.45x39mm 60gr", None),
        ("PMC 9 mm Luger", "9mm"),
        ("Win .45 Auto Rim", None),
        ("Rem 45 auto", "45acp"),
        (".30-06 Sprg 150gr", "30-06"),
        (".270 WSM 130gr", None),
        ("270 Winchester Short Mag", None),
        ("270 Win 130gr", "270win"),
        ("38 special / 357 mag", "38spl"),
        (None, None),
        ("", None),
    ],
)
def test_category(spark, title, slug):
    assert one(spark, lambda c: text.category_of(F.lower(text.clean_title(c))), title) == slug


@pytest.mark.parametrize(
    "title, brand",
    [
        ("Federal American Eagle 9mm", "Federal"),
        ("Hornady Frontier .223 Remington 55gr FMJ", "Hornady"),
        ("CCI Blazer Brass 9mm", "Blazer"),
        ("sellier-bellot-9mm", "Sellier & Bellot"),
        ("Underwood .357 SIG Sauer 125gr", "Underwood"),
        ("acme 9mm", None),
    ],
)
def test_longest_alias(spark, title, brand):
    assert one(spark, lambda c: text.longest_alias(text.brand_text(c)), title) == brand


def test_brand_falls_back_to_url(spark):
    df = spark.createDataFrame(
        [("x", "https://a.com/p/spr-lawman-cci53651"), ("x", "https://a.com/p/pmc-bronze"), ("x", None), (None, "https://a.com/zzz/")],
        "title string, url string",
    )
    got = [r.manufacturer for r in enrich.enrich_brand(df, "title", "url").collect()]
    assert got == ["Speer", "PMC", "Unknown", "Unknown"]


@pytest.mark.parametrize(
    "title, kind",
    [
        ("Jacketed-Soft-Point", "SP"), ("FMJ Flat Nose", "FMJ"), ("V-Max", "HP"), ("Solid Hollow Point CX", "JHP"),
        ("Speer Lawman RHT", "Frangible"), ("UMC 9mm 115gr MC", "FMJ"), ("MC", None), ("Speer Sport", None),
        ("Hornady CX 165", "HP"), ("ttsx", "HP"),
    ],
)
def test_type(spark, title, kind):
    assert one(spark, lambda c: text.type_of(text.type_text(c)), title) == kind


@pytest.mark.parametrize(
    "rule_set, title, count",
    [
        ("simple", "1,000 rounds case", 1000), ("simple", "50rd", 50), ("wide", "Box of 20", 20),
        ("slash_bounded", "9MM 50/10", 50), ("slash_bounded", "2024/2025", None),
        ("case_first", "50rd Box 2000rd Case", 2000), ("case_first", "20 rounds box x 10", 200),
        ("case_first", "20/bx", 20), ("title_quantity", "Primers (1000)", 1000), ("simple", "none", None),
    ],
)
def test_pack_count(spark, rule_set, title, count):
    assert one(spark, lambda c: text.pack_count(c, rule_set), title) == count


@pytest.mark.parametrize(
    "value, limit", [("Limit 2", 2), ("limit of 5 per order", 5), ("Max Qty: 7", 7), ("Limit 0, max qty 3", 3),
                     ("4 per customer", 4), ("Limit 2000", None), (None, None)])
def test_purchase_limit(spark, value, limit):
    assert one(spark, text.purchase_limit, value) == limit


def test_case_material_modes(spark):
    df = spark.createDataFrame(
        [("Wolf 9mm",), ("Sterling brass",), ("stainless steel core",), ("steelhead",), ("Polymer",), (None,)], "t string"
    )
    t = F.col("t")
    got = df.select(text.case_material(t), text.case_material(t, "strict"), text.case_material(t, "polymer")).collect()
    assert [tuple(r) for r in got] == [
        ("Steel", "Steel", "Steel"), ("Brass", "Brass", "Steel"), ("Steel", "Steel", "Steel"),
        ("Steel", "Brass", "Steel"), ("Brass", "Brass", "Polymer"), ("Brass", "Brass", "Brass"),
    ]


@pytest.mark.parametrize(
    "url, rounds, maker, flag",
    [
        ("https://x/berger-30-cal", "100", None, True), ("https://x/berger-30-cal", "n/a", None, False),
        ("https://x/berger-30-cal-american-eagle", "100", None, False), ("https://x/9mm-casings", None, None, True),
        ("https://x/9mm-casing-fmj-x", None, None, False), ("https://x/interlock-a", "100", "Hornady", True),
        ("https://x/interlock-a", "100", None, False), ("https://x/hornady-35401", "1", None, True),
        ("", "100", "berger", False), (None, None, None, False),
    ],
)
def test_component_flag(spark, url, rounds, maker, flag):
    df = spark.createDataFrame([(url, rounds, maker)], "u string, r string, m string")
    assert df.select(text.component_flag(F.col("u"), F.col("r"), F.col("m"))).first()[0] is flag


@pytest.mark.parametrize(
    "title, terms, kind",
    [
        ("Federal Pistol Rebate", "rifle ammunition shotgun", "handgun"),
        ("Spring rebate", "turkey loads upland waterfowl pistol", "shotshell"),
        ("Spring rebate", "turkey pistol", None), ("Rifle and 9mm and 12ga", "", None), (None, None, None),
    ],
)
def test_dominant_class(spark, title, terms, kind):
    df = spark.createDataFrame([(title, terms)], "a string, b string")
    assert df.select(text.dominant_class(F.col("a"), F.col("b"))).first()[0] == kind


def test_clean_title_and_title_line(spark):
    assert one(spark, text.clean_title, " 7.62×39 – “FMJ”® 40 S&W ") == '7.62x39 - "FMJ" 40 S&W'
    blob = "short 9mm\nA long line that names nothing at all here\nAnother line with 9mm Luger inside"
    assert one(spark, lambda c: text.title_line(c, "9mm"), blob) == "Another line with 9mm Luger inside"
    assert one(spark, lambda c: text.title_line(c, "10mm"), blob) == "A long line that names nothing at all here"


def test_component_parsers(spark):
    df = spark.createDataFrame(
        [
            ("powder", "Hodgdon", "Hodgdon CFE 223 1lb", None), ("powder", "Alliant", "Reloder 220", None),
            ("primer", None, "Small Rifle Magnum Primers", None), ("primer", None, "209M Shotshell Small Pistol", None),
            ("bullet", "Sierra", "Sierra 77.5 Grain HPBT", None), ("bullet", "Sierra", "1000 Grain 5 Grain FMJ", 3.0),
            ("brass", "Starline", "Starline Brass 9mm Luger Box of 100", None),
        ],
        "category string, brand string, product_name string, grain double",
    )
    got = enrich.component_attributes(df).select("powder_application", "primer_size", "new_type", "new_grain", "new_caliber")
    assert [tuple(r) for r in got.collect()] == [
        ("rifle", None, None, None, None), (None, None, None, None, None), (None, "small rifle magnum", None, None, None),
        (None, "shotshell", None, None, None), (None, None, "HP", 77.5, None), (None, None, "FMJ", None, None),
        (None, None, None, None, "9mm Luger"),
    ]


def test_relabel_runs_in_statement_order(spark):
    df = spark.createDataFrame([("A", "u/x"), ("B", "u/y"), (None, "u/x")], "manufacturer string, product_url string")
    got = enrich.bulk_relabel(df, [("A", None, "B"), ("B", "%/X%", "C"), ("C", None, "D")])
    assert [r[0] for r in got.collect()] == ["D", "B", None]


def test_fill_null_only_outcomes(spark):
    df = spark.createDataFrame(
        [("SP", 1, "x/fmj"), (None, 9, "x/fmj"), (None, 1, None), (None, 1, "x/zzz"), (None, 1, "x/polymer-tip"),
         (None, 1, "x/polymer-tip-fmj")],
        "bullet_type string, retailer_id int, product_url string",
    )
    got = enrich.fill_null_only(df, skip_retailers=[9]).select("outcome", "bullet_type")
    assert [tuple(r) for r in got.collect()] == [
        ("kept", "SP"), ("excluded_source", None), ("no_text", None), ("no_match", None), ("ambiguous_only", None),
        ("fill", "FMJ"),
    ]


@pytest.mark.parametrize(
    "pattern, literal",
    [(r"\bv[\s-]?max\b", "max"), (r"\bpower\s*point\b", "power"), (r"\bround?s?\b", "roun"), (r"\ba\b|\bb\b", ""),
     (r"\b\.?223\b", "223"), (r"x(?:abc)?yz", "yz"), (r"\.22\s*lr", ".22")],
)
def test_required_literal(pattern, literal):
    assert rules.required_literal(pattern) == literal


def test_prefilter_never_changes_a_match(spark):
    """Every rule regex agrees with its prefiltered form on words of the rules."""
    from farthing.rulebook import types

    words = [p.replace(r"\b", "").replace(r"\s+", " ").replace(r"\s*", "").replace("?", "") for p, _ in types.TYPE_CASCADE]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    tests = [rules.regex_hit(F.col("t"), p).eqNullSafe(F.col("t").rlike("(?U)" + p)) for p, _ in types.TYPE_CASCADE]
    assert all(all(row) for row in df.select(*[t.alias(f"c{i}") for i, t in enumerate(tests)]).collect())


def test_bucket_match_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (5.0,), (20.0,)], "g double")
    atoms = [("lt", 10.0), ("eq", 20.0), ("gt", 30.0)]
    g = F.col("g")
    rows = df.select(predicates.bucket_match(g, atoms), predicates.bucket_match(g, atoms, True), predicates.bucket_match(g, None)).collect()
    assert [tuple(r) for r in rows] == [(False, False, True), (False, True, True), (True, False, True), (True, False, True)]


def test_cart_rules(spark):
    df = spark.createDataFrame(
        [(None, 50, 99.0), (0.3, None, 99.0), (0.3, 0, 5.0), (0.3, 50, 0.0), (0.3, 50, 31.0), (0.3, 50, 30.0)],
        "p double, n int, thr double",
    )
    with_target = [r[0] for r in df.select(predicates.cart_reaches(F.col("p"), F.col("n"), F.col("thr"), 100)).collect()]
    without = [r[0] for r in df.select(predicates.cart_reaches(F.col("p"), F.col("n"), F.col("thr"), 0)).collect()]
    assert with_target == [True, True, True, True, False, True]
    assert without == [True, False, False, True, False, False]


def test_title_modes(spark):
    df = spark.createDataFrame(
        [("9mm x", "9mm"), ("none", "9mm"), ("10mm", "9mm"), ("38 special/357 mag", "357mag")], "title string, page_category string"
    )
    tag = lambda mode, **k: [r.caliber_normalized for r in pool.title_over_category(df, mode, **k).collect()]
    assert tag("retag") == ["9mm", "10mm", "38spl"]
    assert tag("retag", dual=("38spl", "357mag")) == ["9mm", "10mm", "357mag"]
    assert tag("strict") == ["9mm"]
    assert tag("lenient") == ["9mm", "9mm"]
    with pytest.raises(ValueError):
        pool.title_over_category(df, "other")


def test_price_texts(spark):
    assert one(spark, prices.split_decimal_price, "$1,011 99") == 1011.99
    assert one(spark, prices.split_decimal_price, "now $11.99!") == 11.99
    assert one(spark, prices.single_price, "$10 - $20") is None
    assert one(spark, prices.single_price, "$1,010.50 $1,010.50") == 1010.5
    assert one(spark, prices.cents, "28.5¢ / rd") == 0.285
    assert one(spark, lambda c: prices.sale_or_regular(F.lit(None).cast("string"), F.lit(""), c), "$20 was $30") == 20.0
    assert tuple(one(spark, prices.split_by_size, "$15.50 ($0.31) $14")) == (0.31, 14.0)
    assert one(spark, prices.split_by_size, "$15.50") is None


def test_pack_signals(spark):
    df = spark.createDataFrame([(["500rd Box", "50 pk"], "x", "A-20"), ([], "40 rounds", "A-20"), ([], "x", "A365-20"), ([], "x", "A-3")], "l array<string>, t string, s string")
    got = df.select(enrich.pack_from_signals(F.col("l"), F.col("t"), F.col("s"))).collect()
    assert [r[0] for r in got] == [50, 40, 20, None]
    assert packs.PACK_RULES["label"]


def test_noise_words_stand_in_every_noise(spark):
    """Texts without a noise word skip the pattern; letters that count as s or i where case does not are known."""
    from farthing.rulebook import brands

    cases = ["9mm Colt", "357 sig", "45 long colt mag", "17 WIN rimfire", "22 rem mag", "9 wın", "357 ſig", "357 sıg-x", "5 ſıg", "308 WİN", "9 ring", "", None]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    plain = F.regexp_replace(F.translate(F.lower(F.col("t")), "-_/", "   "), brands.BRAND_NOISE, " ")
    got = df.select(text.brand_text(F.col("t")).alias("a"), plain.alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] and all(any(w in p for w in brands.NOISE_WORDS) for p in ("colt", "rem", "win", "sig"))


def odd_texts(spark):
    """Every character of the first plane around a word, and texts at the edges of the helpers."""
    plane = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    cases = [
        None, "", " ", "\n", "/", "//", "a/\n", "a/b\r\n", "x/y//", "x/y/\n/", "a ", "x/ ", "  x  ", "9mm \u2013\u00a050\u00d710 \u00ae\u2122 ", "a\u202fb\u2022",
        "a - b_(c).d", "a \t\n\x0b b", "a   b     c", "LİMİT 5", "lımıt of 7", "Limit 0, limit 12", "limit 1000 Max Qty: 5", "5 per cuſtomer", "9 PER HOUSEHOLD",
        "1,000 Rounds Case", "20 roundſ", "20 Rnds", "٥ rounds", "5,0 rd", "99999999999999999999 rounds 7 count", "50rd Box x 10", "50/20", "3/20", "pack of 5", "20/box", "box of 25",
        "20 PACK 9 PK", "Gr 5 grain", "5-GR", "(50) ", "-20", "5K",
    ]
    return spark.createDataFrame([(t,) for t in cases + [f"{c}x{c}" for c in plane] + [f"20{c}rd / 5{c}per order" for c in plane]], "t string")


def test_text_helpers_agree_with_their_patterns(spark):
    """What the helpers answer without a regex is what the regexes say."""
    t = F.col("t")
    glyphs = F.translate(
        text.filled(t), "\u2013\u2014\u2018\u2019\u201c\u201d\u00b7\u2022\u00d7\u00a0\u202f\u00ae\u2122", "--''\"\"**x  ")

    def number(pattern, group=1):
        return F.regexp_replace(text.captured(t, "(?iU)" + pattern, group), ",", "").try_cast("bigint")

    def counted(pattern, low, high, mode):
        value = number(pattern) * number(pattern, 2) if mode == "product" else number(pattern)
        return value if high >= packs.ANY else F.when(value.between(low, high), value)

    limits = [F.when(number(p).between(1, 999), number(p)) for p in packs.LIMIT_PATTERNS]
    pairs = [
        (text.clean_title(t), F.regexp_replace(glyphs, r"(?U)^\s+|\s+$", "")),
        (text.type_text(t), F.trim(F.regexp_replace(F.translate(F.lower(text.filled(t)), "-_/.()", "      "), r"\s+", " "))),
        (text.product_key(t), text.truthy(F.regexp_extract(F.regexp_replace(t, r"/+$", ""), r"([^/]*)$", 1))),
        (text.purchase_limit(t), F.coalesce(*limits).cast("int")),
        (text.weight_number(t), text.captured(t, r"(?iU)(\d+)[\s-]*gr(?:ain)?").try_cast("int")),
        *[(text.pack_count(t, name), F.coalesce(*[counted(*r) for r in rule])) for name, rule in packs.PACK_RULES.items()],
    ]
    wrong = [F.count_if(~a.eqNullSafe(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    assert set(odd_texts(spark).select(*wrong).first()) == {0}


def test_folded_shows_what_a_caseless_regex_finds(spark):
    t = F.col("t")
    low = text.folded(t)
    hidden = [F.count_if(t.rlike("(?iU)" + c) & ~rules.shows(low, c)).alias(c) for c in "abcdefghijklmnopqrstuvwxyz"]
    assert set(odd_texts(spark).select(*hidden).first()) == {0}


@pytest.mark.parametrize(
    "pattern, literals",
    [(r"\ba\b|\bbc\b", ["a", "bc"]), (r"(?=.*\bmc\b)(?=.*\b(?:umc|rem)\b)", ["mc"]), (r"(?:\b27\s*win\b(?!\s*(?:x|y)))|(?:\b\.27\b)", ["win", ".27"]),
     (r"(?:ab)?", []), (r"(?=ab)?c*", []), (r"a*|b", []), (r"[|]|ab", []), (r"\|x|yz", ["x", "yz"]), (r"(?!ab)", []), ("a|", []), (r"\bv[\s-]?max\b", ["max"])],
)
def test_required_literals(pattern, literals):
    assert rules.required_literals(pattern) == literals


def test_every_tabled_regex_has_a_literal():
    """A rule without one runs its regex on every text that reaches it."""
    from farthing.rulebook import categories, types

    patterns = [p for p, _ in types.TYPE_CASCADE] + [p for _, specs in categories.CATEGORY_CASCADE for kind, p in specs if kind == "re"]
    assert all(rules.required_literals(p) for p in patterns)


def test_guards_never_change_a_cascade(spark):
    """Rule sets behind shared literals and letters agree with the plain tests of all their specs."""
    from farthing.rulebook import brands, categories, types

    tables = [specs for _, specs in categories.CATEGORY_CASCADE] + [[("re", p)] for p, _ in types.TYPE_CASCADE[::3] + types.TYPE_CASCADE[-2:]] + [[("sub", w)] for w, _ in brands.BRAND_ALIASES[::12]]
    tables += [[("sub", "ab"), ("sub", "abc"), ("re", r"\bab\d"), ("re", r"x\s*c\b|q"), ("re", r"\d+")], [("sub", "")]]
    bare = [p.replace(r"\b", "").replace(r"\s+", " ").replace(r"\s*", "").replace("?", "") for specs in tables for _, p in specs]
    words = [None, "", "xc", "x  c", "q", "7", "umc 9 mc", "remington mc", "hornady cx", "270 win", "270 win short", ".270 wsm", ".270 x", "45 auto rim", "9 mm7"]
    df = spark.createDataFrame([(w,) for w in [*words, *bare, *["9 " + b + "é" for b in bare]]], "t string").withColumn("has", rules.letters(F.col("t")))
    t, wrong = F.col("t"), []
    for i, specs in enumerate(tables):
        plain = [t.contains(p) if kind == "sub" else t.rlike("(?U)" + p) for kind, p in specs]
        any_of = plain[0]
        for test in plain[1:]:
            any_of = any_of | test
        for k, got in enumerate((rules.spec_hit(t, specs), rules.spec_hit(t, specs, F.col("has")))):
            wrong.append(F.count_if(~got.eqNullSafe(any_of)).alias(f"c{i}_{k}"))
    assert set(df.select(*wrong).first()) == {0}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_regexes_of_a_card_run_once(spark):
    """A pattern stands once in the plan, and long cascades stand outside whole-stage code."""
    df = spark.createDataFrame([("Wolf 9mm 50 rounds limit 2", "a/b")], "title string, url string")
    t = F.col("title")
    assert plan_of(df.select(text.pack_count(t).alias("n"))).count("regexp_extract(") == len(packs.PACK_RULES["simple"])
    assert plan_of(df.select(text.purchase_limit(t).alias("n"))).count("regexp_extract(") == len(packs.LIMIT_PATTERNS)
    for frame in (enrich.enrich_type(df, "title", "url"), enrich.enrich_brand(df, "title", "url"), enrich.enrich_category(df)):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            lines = plan_of(frame).splitlines()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        long = [line for line in lines if len(line) > 5000]
        assert long and not any(line.lstrip(" :+-").startswith("*(") for line in long)
