"""Column expressions over catalogue text.

All functions take and return Columns, with the rule tables as parameters.
Callers that feed one text to a long cascade should first put its normalised
form into a column of its own (the ``enrich_*`` operators do), so that the
normalisation runs once per row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from farthing.functions import rules
from farthing.rulebook import brands, categories, components, packs, types

INT_MAX = 2_147_483_647
BLANKS = " \t\n\r\f\x0b"
#: What the regex class of blanks holds where it reads Unicode.
WIDE_BLANKS = BLANKS + "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Letters that count as an ASCII letter where a regex ignores case, without ``k``, whose twin ``lower`` knows.
CASE_TWINS = ("\u0130\u0131\u017f", "iis")
#: Line ends; a regex's end of text also stands before the last one.
LINE_ENDS = ["\n", "\r", "\x85", "\u2028", "\u2029"]


def filled(text: Column) -> Column:
    """Text with NULL read as empty."""
    return F.coalesce(text, F.lit(""))


def truthy(text: Column) -> Column:
    """NULL for NULL or empty text."""
    return F.nullif(text, F.lit(""))


def captured(text: Column, pattern: str, group: int = 1) -> Column:
    """Captured group of the first match, NULL without a match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def whole(text: Column) -> Column:
    """Integer of a digit string with optional thousands commas, else NULL."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("bigint")


def wide(text: Column) -> Column:
    """Whether the text has characters beyond ASCII."""
    return F.octet_length(text) != F.char_length(text)


def folded(text: Column, low: Column | None = None) -> Column:
    """Lower case in which a literal shows wherever a regex that ignores case finds it. ``low`` is the text in lower case, if at hand."""
    return F.when(wide(text), F.lower(F.translate(text, *CASE_TWINS))).otherwise(F.lower(text) if low is None else low)


def anycase_literal(pattern: str) -> str:
    """Literal that the folded text of every match has, or '' where none is certain."""
    if re.search(r"\\[xuUcNpPQE0-9k]|\(\?[a-zA-Z-]*x", pattern):
        return ""
    literal = rules.required_literal(pattern)
    return literal.lower() if literal.isascii() else ""


def behind_literal(low: Column, pattern: str, value: Column) -> Column:
    """``value`` of a match of the pattern, computed only where the folded text has the pattern's literal."""
    literal = anycase_literal(pattern)
    return F.when(rules.shows(low, literal), value) if literal else value


def bounded(value: Column, low: float, high: float) -> Column:
    """The value within its bounds, else NULL; computed once."""
    return F.get(F.filter(F.array(value), lambda v: v.between(low, high)), F.lit(0))


# -- categories ---------------------------------------------------------------

def category_of(text: Column, cascade_rules=None, has: Column | None = None) -> Column:
    """Slug of the first category in priority order that the text names. ``has``, here and below, is ``rules.letters`` of the text."""
    return rules.cascade(text, cascade_rules or categories.CATEGORY_CASCADE, has)


def spaced(text: Column) -> Column:
    """Lower case, every run of other characters one space, space-padded.

    Only ASCII letters and digits count, so an alias and a title compare as
    whole tokens.
    """
    core = F.trim(F.regexp_replace(F.lower(filled(text)), "[^a-z0-9]+", " "))
    return F.concat(F.lit(" "), core, F.lit(" "))


def names_category(spaced_text: Column, names: Sequence[str]) -> Column:
    """Whole-token mention of any name in text prepared by ``spaced``."""
    needles = dict.fromkeys(" " + re.sub(r"[^a-z0-9]+", " ", n.lower()).strip() + " " for n in names)
    return rules.any_word(spaced_text, list(needles))


# -- brands -------------------------------------------------------------------

def brand_text(text: Column) -> Column:
    """Normal form for alias search: separators to spaces, noise removed."""
    plain = F.regexp_replace(F.lower(text), "[-_/]", " ")
    return F.when(rules.any_word(plain, brands.NOISE_WORDS), F.regexp_replace(plain, brands.BRAND_NOISE, " ")).otherwise(plain)


def longest_alias(prepared: Column, aliases=None, has: Column | None = None) -> Column:
    """Canonical name of the longest alias contained in the prepared text."""
    return rules.ordered_words(prepared, rules.longest_first(aliases or brands.BRAND_ALIASES), has)


def url_path(url: Column) -> Column:
    """Path without scheme, host, query and fragment."""
    bare = F.regexp_replace(url, r"[?#].*$", "")
    return F.regexp_replace(bare, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/]*", "")


def url_host(url: Column) -> Column:
    """Lower-case host, empty when the url is relative."""
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))


def last_segment(url: Column) -> Column:
    """Last path segment, trailing slashes ignored."""
    return F.regexp_extract(F.regexp_replace(url_path(url), r"/+$", ""), r"([^/]*)$", 1)


def slug_prefix_brand(url: Column, table=None) -> Column:
    letters = F.regexp_extract(F.lower(last_segment(url)), r"^([a-z]+)", 1)
    return rules.lookup(letters, table or brands.SLUG_PREFIX_BRANDS)


# -- product types ------------------------------------------------------------

def type_text(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(filled(text)), r"[-_/.()\s]+", " "))


def type_of(prepared: Column, table=None, has: Column | None = None) -> Column:
    return rules.ordered_regex(prepared, table or types.TYPE_CASCADE, has)


def maker_type(text: Column) -> Column:
    """Type from a manufacturer page; short letter codes pass through."""
    code = F.upper(F.trim(text))
    phrase = rules.ordered_words(F.lower(text), types.MAKER_TYPE_PHRASES)
    return F.coalesce(phrase, F.when(code.rlike(r"^\p{L}{2,4}$"), code))


def maker_category(text: Column) -> Column:
    key = F.replace(F.trim(F.lower(text)), F.lit("  "), F.lit(" "))
    return rules.lookup(key, categories.MAKER_CATEGORY_NAMES)


def url_audit_type(url: Column) -> Column:
    """Type by the audit's own pattern list on the url after its host."""
    after_scheme = F.element_at(F.split(url, "://", 2), -1)
    path = F.lower(F.element_at(F.split(after_scheme, "/", 2), -1))
    return rules.ordered_regex(path, types.URL_TYPE_AUDIT)


# -- counts and numbers -------------------------------------------------------

def pack_count(text: Column, rule_set: str | Sequence[tuple] = "simple", low: Column | None = None) -> Column:
    """Pack size by an ordered pattern list; out-of-range falls through. ``low`` is the folded text, if at hand."""
    low_text = folded(text) if low is None else low
    table = packs.PACK_RULES[rule_set] if isinstance(rule_set, str) else rule_set
    options = []
    for pattern, least, most, mode in table:
        flagged = "(?iU)" + pattern
        value = whole(F.regexp_extract(text, flagged, 1))  # no match is no digits, and no number
        if mode == "product":
            value = value * whole(F.regexp_extract(text, flagged, 2))
        options.append(behind_literal(low_text, pattern, value if most >= packs.ANY else bounded(value, least, most)))
    return F.coalesce(*options)


def first_match_pack(text: Column, rule_set: str) -> Column:
    """Like ``pack_count`` but the first matching pattern decides alone."""
    chain = None
    for pattern, low, high, mode in packs.PACK_RULES[rule_set]:
        flagged = "(?iU)" + pattern
        value = whole(captured(text, flagged, 1))
        if mode == "product":
            value = value * whole(captured(text, flagged, 2))
        value = F.when(value.between(low, high), value)
        test = text.rlike(flagged)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain


def purchase_limit(text: Column, low: Column | None = None) -> Column:
    """Per-customer limit between 1 and 999, else NULL. ``low`` is the folded text, if at hand."""
    options = []
    for pattern in packs.LIMIT_PATTERNS:
        value = whole(F.regexp_extract(text, "(?iU)" + pattern, 1))
        options.append(behind_literal(folded(text) if low is None else low, pattern, bounded(value, 1, 999)))
    return F.coalesce(*options).cast("int")


def weight_number(text: Column, pattern: str = r"(\d+)[\s-]*gr(?:ain)?") -> Column:
    return F.regexp_extract(text, "(?iU)" + pattern, 1).try_cast("int")


def bounded_weight(text: Column, low: float = 10, high: float = 1000) -> Column:
    value = captured(text, r"(?iU)(\d+(?:\.\d+)?)\s*Grain\b").try_cast("double")
    return F.when(value.between(low, high), value)


# -- small attributes ---------------------------------------------------------

def case_material(
    text: Column, mode: str = "plain", field: Column | None = None, low: Column | None = None, has: Column | None = None
) -> Column:
    """Case material with 'Brass' as the default.

    ``plain``   steel brand or the word steel, then brass, aluminum, nickel.
    ``strict``  steel only as "steel case" or a word of its own.
    ``polymer`` wide steel list, then aluminum, nickel, polymer.
    A structured ``field`` wins over the text when it names a material. ``low`` is the
    text in lower case, if at hand.
    """
    low = F.lower(filled(text)) if low is None else low
    brass = [("brass", "Brass"), ("aluminum", "Aluminum"), ("nickel", "Nickel")]
    if mode == "strict":
        steel = rules.any_word(low, types.STEEL_BRANDS_WIDE) | rules.any_word(low, ["steel case", "steel-case"])
        steel = steel | F.concat(F.lit(" "), low, F.lit(" ")).contains(" steel ")
        later = brass
    elif mode == "polymer":
        steel = rules.any_word(low, types.STEEL_BRANDS_ALL + ["steel"])
        later = [("aluminum", "Aluminum"), ("aluminium", "Aluminum"), ("nickel", "Nickel"), ("polymer", "Polymer")]
    else:
        steel = rules.any_word(low, types.STEEL_BRANDS + ["steel"], has)
        later = brass
    parsed = F.coalesce(F.when(steel, F.lit("Steel")), rules.ordered_words(low, later, has), F.lit("Brass"))
    if field is None:
        return parsed
    words = [("brass", "Brass"), ("steel", "Steel"), ("aluminum", "Aluminum"), ("nickel", "Nickel")]
    return F.coalesce(rules.ordered_words(F.lower(field), words), parsed)


def condition(text: Column) -> Column:
    return F.when(F.lower(filled(text)).contains("reman"), F.lit("Remanufactured")).otherwise(F.lit("New"))


def origin_country(text: Column, table=None, low: Column | None = None, has: Column | None = None) -> Column:
    return rules.ordered_words(F.lower(text) if low is None else low, table or brands.ORIGIN_BASE, has)


def clean_title(text: Column) -> Column:
    """Typographic glyphs to ASCII, exotic spaces to spaces, trimmed."""
    plain = filled(text)
    glyphs = F.translate(
        plain,
        "\u2013\u2014\u2018\u2019\u201c\u201d\u00b7\u2022\u00d7\u00a0\u202f\u00ae\u2122",
        "--''\"\"**x  ",
    )
    return F.btrim(F.when(wide(plain), glyphs).otherwise(plain), F.lit(WIDE_BLANKS))


def stock_from_text(text: Column, rule: str, fallback: Column | None = None, low: Column | None = None) -> Column:
    """Stock flag by a named phrase rule; an empty field reads the fallback. ``low`` is the text in lower case, if at hand."""
    spec = packs.STOCK_RULES[rule]
    low = F.lower(filled(text)) if low is None else low
    flag = rules.any_word(low, spec["need"]) if spec["need"] else ~rules.any_word(low, spec["out"])
    if fallback is None:
        return flag
    return F.when(F.trim(low) == "", stock_from_text(fallback, "body_text")).otherwise(flag)


def component_flag(url: Column, rounds: Column, maker: Column) -> Column:
    """True when a listing is a reloading component, never NULL."""
    link = F.lower(filled(url))
    count = F.coalesce(rounds.try_cast("double"), F.lit(float("-inf")))
    count = F.when(F.isnan(count), F.lit(float("-inf"))).otherwise(count)
    name = F.lower(filled(maker))

    def has(word):
        return link.contains(word)

    nosler = has("nosler") | link.rlike(components.NOSLER_SKU) | (name == "nosler")
    part = (
        has("-hap-")
        | (has("-xtp-") & (count >= 100))
        | link.rlike(components.HORNADY_SKU)
        | (has("interlock") & (count >= 100) & (name == "hornady"))
        | (link.rlike(components.CASING_WORDS) & ~link.rlike(components.CASING_LOADED))
        | has("sporting-handgun")
        | (nosler & (count >= 50) & link.rlike(components.NOSLER_LINES))
        | has("barnes-bullets-")
        | has("berger-bullets-")
        | ((has("berger") | (name == "berger")) & (count >= 50))
        | has("sierra-bullets-")
        | ((name == "sierra") & (count >= 50) & link.rlike(components.SIERRA_LINES))
    )
    return (link != "") & ~rules.any_word(link, components.LOADED_MARKERS) & part


def dominant_class(title: Column, terms: Column, table=None) -> Column:
    """Class of a text: a title with one class wins, else a clear majority.

    The majority needs two hits and twice the runner-up (counted as at least
    one). Order among equals is table order.
    """
    words = table or types.CLASS_WORDS

    def scores(text):
        entries = []
        for rank, (name, needles) in enumerate(words.items()):
            hits = sum((text.contains(w).cast("int") for w in needles), F.lit(0))
            entries.append(F.struct((-hits).alias("neg"), F.lit(rank).alias("rank"), F.lit(name).alias("name")))
        return F.array(*entries)

    own = F.filter(scores(F.lower(filled(title))), lambda s: s["neg"] < 0)
    both = F.array_sort(scores(F.lower(F.concat(filled(title), F.lit(" "), filled(terms)))))
    top, runner = both[0], both[1]
    clear = (-top["neg"] >= 2) & (-top["neg"] >= 2 * F.greatest(-runner["neg"], F.lit(1)))
    return F.when(F.size(own) == 1, own[0]["name"]).when(clear, top["name"])


def product_key(url: Column, strip: str | None = None) -> Column:
    """Last url segment without trailing slash; the retailer's product key.

    ``strip`` is a regex removed from its end, an extension such as
    ``\\.(html|asp)`` or a query.
    """
    odd = F.right(url, F.lit(1)).isin(LINE_ENDS)  # a regex's end may stand before these
    by_regex = F.regexp_extract(F.regexp_replace(url, r"/+$", ""), r"([^/]*)$", 1)
    key = F.when(odd, by_regex).otherwise(F.substring_index(F.rtrim(url, F.lit("/")), "/", -1))
    return truthy(key if strip is None else F.regexp_replace(key, f"(?:{strip})$", ""))


def line_name(url: Column) -> Column:
    """Title-cased slug of the segment before the last one."""
    slug = F.regexp_extract(F.regexp_replace(url, r"/+$", ""), r"([^/]+)/[^/]*$", 1)
    return truthy(F.initcap(F.trim(F.regexp_replace(slug, "-+", " "))))


def title_line(blob: Column, wanted: Column | str, min_length: int = 25, cascade_rules=None) -> Column:
    """First line longer than ``min_length`` naming the wanted category, else
    the longest line (the earliest of equals)."""
    lines = F.filter(F.transform(F.split(blob, "\n"), lambda s: F.trim(s)), lambda s: s != "")
    want = F.lit(wanted) if isinstance(wanted, str) else wanted
    naming = F.filter(
        lines,
        lambda s: (F.length(s) > min_length) & (category_of(F.lower(s), cascade_rules) == want),
    )
    ranked = F.array_sort(
        F.transform(lines, lambda s, i: F.struct((-F.length(s)).alias("n"), i.alias("i"), s.alias("s")))
    )
    return F.coalesce(F.get(naming, F.lit(0)), F.get(ranked, F.lit(0))["s"])


def field_first(structured: Column, parsed: Column) -> Column:
    """Structured value unless missing or zero, else the parsed one."""
    return F.coalesce(F.nullif(structured, F.lit(0)), F.nullif(parsed, F.lit(0)))


# -- component attributes -----------------------------------------------------

def powder_use(brand: Column, name: Column) -> Column:
    """Use of a powder: longest known fragment of the brand found as a word."""
    low = F.lower(filled(name))
    chain = None
    for maker in dict.fromkeys(brand for brand, _, _ in components.POWDER_USE):
        pairs = [(fragment, use) for own, fragment, use in components.POWDER_USE if own == maker]
        table = [(r"(?<!\w)" + re.escape(f) + r"(?!\w)", use) for f, use in rules.longest_first(pairs)]
        found = rules.ordered_regex(low, table)
        test = F.lower(brand) == maker
        chain = F.when(test, found) if chain is None else chain.when(test, found)
    return chain


def primer_size(name: Column) -> Column:
    low = F.lower(filled(name))
    magnum = F.when(low.rlike(r"(?U)\bmagnum\b"), F.lit(" magnum")).otherwise(F.lit(""))
    pair = r"(?U)\b(small|large)\s+(pistol|rifle)\b"
    base = (
        F.when(low.contains("shotshell"), F.lit("shotshell"))
        .when(low.contains("percussion"), F.lit("percussion cap"))
        .when(~low.contains("muzzleloader") & low.rlike(pair),
              F.concat(F.regexp_extract(low, pair, 1), F.lit(" "), F.regexp_extract(low, pair, 2)))
    )
    sized = F.concat(base, magnum)
    early = low.contains("shotshell") | low.contains("percussion")
    return F.when(~early & low.contains("muzzleloader"), F.lit("muzzleloader")).otherwise(sized)


def brass_category(name: Column, brand: Column) -> Column:
    """What remains of a brass title without brand, 'brass' and counts."""
    starts = F.startswith(F.lower(name), F.lower(brand)) & (brand != "")
    cut = F.when(starts, F.ltrim(F.substr(name, F.length(brand) + F.lit(1)))).otherwise(name)
    for pattern in (r"(?iU)\bbrass\b", r"(?iU)\bbox\s+of\s+\d+\b", r"(?iU)\b\d+\s+count\b"):
        cut = F.regexp_replace(cut, pattern, "")
    return truthy(F.trim(F.regexp_replace(cut, r"(?U)\s+", " ")))
