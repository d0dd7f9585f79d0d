"""Column expressions over fetched html and embedded JSON.

Each works inside one row (a page), so none of them shuffles. Html is read with
regular expressions and embedded JSON as VARIANT.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from farthing.functions import rules, text
from farthing.rulebook import packs

#: Named character references by the HTML standard's table; names with a semicolon first.
NAMED = dict(html5)
#: Names that count without a semicolon, the longest first.
BARE_NAMES = sorted((n for n in NAMED if not n.endswith(";")), key=lambda n: (-len(n), n))
#: Numbers 128 to 159 stand for the bytes of Windows-1252 where it has them.
_WINDOWS = {n: c for n in range(128, 160) if (c := bytes([n]).decode("cp1252", "ignore"))}


#: Names that most pages use; they are looked up before the whole table.
_USUAL = {n: NAMED[n] for n in ("amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;")}


def _named(names: Column, table: dict[str, str] = NAMED) -> Column:
    """The characters of a name, from a table that is one constant in the plan."""
    packed = "\x02".join(f"{n}\x01{c}" for n, c in table.items())
    return F.try_element_at(F.str_to_map(F.lit(packed), F.lit("\x02"), F.lit("\x01")), names)


def _numbered(digits: Column, base: int) -> Column:
    """The character of a number of any length; U+FFFD for what is none."""
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    number = F.when(F.length(short) <= 8, F.conv(short, base, 10).cast("bigint")).otherwise(F.lit(1 << 40))
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    wrong = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    known = F.element_at(F.create_map(*[F.lit(x) for n, c in _WINDOWS.items() for x in (n, c)]), number.cast("int"))
    return F.when(wrong, F.lit("\ufffd")).when(number.between(128, 159), F.coalesce(known, char)).otherwise(char)


#: What may follow an ampersand in a reference.
_HEAD = "#[xX][0-9a-fA-F]+;?|#[0-9]+;?|[A-Za-z][A-Za-z0-9]*;?"


def _once(value: Column, made: Callable[[Column], Column]) -> Column:
    """``made(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), made), F.lit(0))


def unescape(value: Column) -> Column:
    """Character references decoded in one pass, so nothing decodes twice.

    Each different reference of a text is decoded once and looked up where it stands. Named
    ones by the whole HTML table (some also without semicolon, the longest such name first),
    decimal and hexadecimal ones of any length.
    """
    bare = "^(" + "|".join(BARE_NAMES) + ")"

    def decoded(head):
        hexed = F.regexp_extract(head, "^#[xX]([0-9a-fA-F]+);?", 1)
        plain = F.regexp_extract(head, "^#([0-9]+);?", 1)
        full = F.regexp_extract(head, "^([A-Za-z][A-Za-z0-9]*;)", 1)
        short = F.regexp_extract(head, bare, 1)
        return (
            F.when(hexed != "", _numbered(hexed, 16))
            .when(plain != "", _numbered(plain, 10))
            .when(_named(full, _USUAL).isNotNull(), _named(full, _USUAL))
            .when(_named(full).isNotNull(), _named(full))
            .when(short != "", F.concat(_named(short), F.substr(head, F.length(short) + 1)))
            .otherwise(F.concat(F.lit("&"), head))
        )

    def whole(text_):
        heads = F.regexp_extract_all(text_, F.lit(f"&({_HEAD})?"), F.lit(1))
        rests = F.split(text_, f"&(?:{_HEAD})?")

        def joined(heads, known):
            chars = F.concat(F.array(F.lit("")), F.transform(heads, lambda h: F.try_element_at(known, h)))
            return F.array_join(F.zip_with(chars, rests, lambda c, r: F.concat(c, r)), "")

        def looked_up(heads):
            entries = F.transform(F.array_distinct(heads), lambda h: F.struct(h.alias("head"), decoded(h).alias("char")))
            return _once(F.map_from_entries(entries), lambda known: joined(heads, known))

        return F.when(F.contains(text_, F.lit("&")), _once(heads, looked_up)).otherwise(text_)

    return _once(value, whole)


def collapse(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, r"(?U)\s+", " "))


def page_title(html: Column) -> Column:
    return collapse(unescape(F.regexp_extract(text.filled(html), r"(?is)<title[^>]*>(.*?)</title>", 1)))


def inner_text(fragment: Column, joiner: str = "") -> Column:
    return collapse(unescape(F.regexp_replace(fragment, r"<[^>]+>", joiner)))


def visible_lines(html: Column, dropped: str = "script|style") -> Column:
    """Visible text as an array of non-empty lines in display order."""
    body = F.regexp_replace(text.filled(html), rf"(?is)<({dropped})[^>]*>.*?</\1>", "")
    flat = F.regexp_replace(body, r"<[^>]+>", "\n")
    return F.filter(F.transform(F.split(flat, "\n+"), lambda s: F.regexp_replace(s, r"(?U)^\s+|\s+$", "")),
                    lambda s: s != "")


def value_after(lines: Column, label: str) -> Column:
    """Line right after the first line that fully matches the label regex."""
    at = F.array_position(F.transform(lines, lambda s: s.rlike(f"^(?:{label})$")), F.lit(True))
    return F.when(at > 0, F.get(lines, at.cast("int")))


def integer_in_section(lines: Column, header: str, label: str, heading: str = "[A-Z][A-Z ]{2,30}") -> Column:
    """Integer after ``label`` inside the section opened by ``header``.

    The section ends at the next line in capitals, except right after its
    header, where such a line is a unit.
    """
    start = F.array_position(F.transform(lines, lambda s: s.rlike(f"^(?:{header})$")), F.lit(True)).cast("int")
    size = F.size(lines)
    # Elements are (0-based position, line) pairs beyond the header.
    marked = F.transform(lines, lambda s, i: F.struct(i.alias("i"), s.alias("s")))
    stops = F.filter(marked, lambda e: (e["i"] > start) & e["s"].rlike(f"^(?:{heading})$"))
    end = F.coalesce(F.get(stops, F.lit(0))["i"], size)
    hits = F.filter(
        marked,
        lambda e: (e["i"] >= start) & (e["i"] < end) & (e["s"] == label) & (e["i"] + 1 < end)
        & F.get(lines, e["i"] + 1).rlike(r"\d"),
    )
    found = F.get(lines, F.get(hits, F.lit(0))["i"] + 1)
    return F.when(start > 0, F.regexp_extract(found, r"(\d+)", 1).try_cast("int"))


def table_rows(html: Column) -> Column:
    """Cells of every table row as array<array<string>>."""
    rows = F.regexp_extract_all(text.filled(html), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    return F.transform(
        rows,
        lambda r: F.transform(
            F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda c: inner_text(c)
        ),
    )


def cell_of(rows: Column, label: str, col: int = 1, width: int | None = 2) -> Column:
    """Cell ``col`` of the first of the ``table_rows`` whose first cell is the label."""
    found = F.filter(
        rows,
        lambda cells: (F.size(cells) == width if width else F.size(cells) > col)
        & (F.lower(F.get(cells, F.lit(0))) == label.lower()),
    )
    return text.truthy(F.get(F.get(found, F.lit(0)), F.lit(col)))


def table_cell(html: Column, label: str, col: int = 1, width: int | None = 2) -> Column:
    """Cell ``col`` of the first row whose first cell is the label."""
    return cell_of(table_rows(html), label, col, width)


def labelled_field(html: Column, label: str) -> Column:
    """Value of ``<strong>Label:</strong> <span class="info">value</span>``."""
    pattern = rf"(?is)<strong[^>]*>\s*{label}\s*:?\s*</strong>\s*<span[^>]*class=[\"'][^\"']*info[^\"']*[\"'][^>]*>(.*?)</span>"
    return text.truthy(inner_text(F.regexp_extract(html, pattern, 1)))


def list_spec(html: Column, label: str) -> Column:
    """Value of a ``<li>Label: value</li>`` list specification."""
    return text.truthy(inner_text(F.regexp_extract(html, rf"(?is)<li[^>]*>\s*(?:<[^>]+>\s*)*{label}\s*:\s*(.*?)</li>", 1)))


def chunks(html: Column, marker: str) -> Column:
    """Pieces that start at the marker regex; what precedes the first is dropped.

    A leading space keeps an opening marker from being the split's start,
    which would swallow the empty piece before it.
    """
    pieces = F.split(F.concat(F.lit(" "), html), f"(?i)(?={marker})")
    return F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))


# -- embedded JSON -------------------------------------------------------------

JSONLD = r"(?is)<script[^>]*type=['\"]application/ld\+json['\"][^>]*>(.*?)</script>"


def node_text(node: Column, path: str) -> Column:
    return F.try_variant_get(node, path, "string")


def is_object(node: Column) -> Column:
    return F.schema_of_variant(node).startswith("OBJECT")


def _elements(node: Column) -> Column:
    return F.try_variant_get(node, "$", "array<variant>")


def _graph(node: Column) -> Column:
    return F.try_variant_get(node, "$['@graph']", "array<variant>")


def jsonld_nodes(html: Column, last_first: bool = True) -> Column:
    """Every object of the page's ld+json blocks as array<variant>.

    Lists and ``@graph`` arrays are opened to any depth, a wrapper standing before
    its graph. ``last_first`` visits the last element of each list first. Malformed
    blocks are skipped.
    """
    blocks = F.regexp_extract_all(text.filled(html), F.lit(JSONLD), F.lit(1))
    none = F.array().cast("array<variant>")
    turned = F.reverse if last_first else (lambda a: a)

    def entries(nodes, fresh: bool):
        return F.transform(nodes, lambda n: F.struct(n.alias("node"), F.lit(fresh).alias("fresh")))

    def opened(entry):
        node = entry["node"]
        listed = turned(_elements(node))
        inside = F.concat(entries(F.array(node), False), entries(F.coalesce(turned(_graph(node)), none), True))
        return F.when(~entry["fresh"], F.array(entry)).when(listed.isNotNull(), entries(listed, True)).otherwise(inside)

    def flat(block):
        # One round per level; a level costs a graph or a bracket inside a list.
        levels = F.regexp_count(block, F.lit(r"\"@graph\"|[\[,](?=\s*\[)")) + 2
        start = entries(F.array(F.try_parse_json(F.trim(block))), True)
        rounds = F.sequence(F.lit(1), levels)
        return F.aggregate(rounds, start, lambda held, _: F.flatten(F.transform(held, opened)), lambda held: F.transform(held, lambda e: e["node"]))

    good = F.filter(blocks, lambda b: F.try_parse_json(F.trim(b)).isNotNull())
    return F.filter(F.flatten(F.transform(good, flat)), lambda n: is_object(n))


def _type_is(node: Column, names: Sequence[str]) -> Column:
    one = F.lower(node_text(node, "$['@type']"))
    many = F.try_variant_get(node, "$['@type']", "array<string>")
    in_list = F.exists(F.coalesce(many, F.array().cast("array<string>")), lambda t: F.lower(t).isin(list(names)))
    return F.coalesce(one.isin(list(names)), F.lit(False)) | in_list


def product_offer(nodes: Column) -> Column:
    """First offer of a Product; else a standalone (aggregate) offer."""
    def offer_of(node):
        listed = F.try_variant_get(node, "$.offers", "array<variant>")
        single = F.try_variant_get(node, "$.offers", "variant")
        return F.coalesce(F.get(listed, F.lit(0)), F.when(is_object(single), single))

    products = F.filter(nodes, lambda n: _type_is(n, ["product"]))
    offers = F.filter(F.transform(products, offer_of), lambda o: o.isNotNull())
    alone = F.filter(nodes, lambda n: F.coalesce(F.lower(node_text(n, "$['@type']")).isin("offer", "aggregateoffer"),
                                                 F.lit(False)))
    return F.coalesce(F.get(offers, F.lit(0)), F.get(alone, F.lit(0)))


def availability_state(value: Column) -> Column:
    """False, true or NULL; the out-of-stock words are tested first."""
    low = F.lower(value)
    return (
        F.when(rules.any_word(low, ["outofstock", "soldout", "discontinued"]), F.lit(False))
        .when(rules.any_word(low, ["instock", "limitedavailability"]), F.lit(True))
    )


def _money(node: Column, path: str) -> Column:
    return F.regexp_replace(node_text(node, path), "[,$]", "").try_cast("double")


def offer_price(offer: Column, mode: str = "product") -> Column:
    """Price of an offer, falling back to its price specification.

    ``component`` mode knows no highPrice and scans every listed element.
    """
    keys = ["price", "lowPrice", "highPrice"] if mode == "product" else ["price", "lowPrice"]
    direct = [_money(offer, f"$.{k}") for k in keys]
    if mode == "product":
        for base in ("$.priceSpecification", "$.priceSpecification[0]"):
            direct += [_money(offer, f"{base}.{k}") for k in keys]
        return F.coalesce(*direct)
    direct.append(_money(offer, "$.priceSpecification.price"))
    listed = F.try_variant_get(offer, "$.priceSpecification", "array<variant>")
    each = F.filter(F.transform(listed, lambda s: _money(s, "$.price")), lambda v: v.isNotNull())
    return F.coalesce(*direct, F.get(each, F.lit(0)))


def component_price(offers: Column) -> Column:
    """First priced offer of an offer list, or of the single offer."""
    listed = F.try_variant_get(offers, "$", "array<variant>")
    each = F.filter(F.transform(listed, lambda o: offer_price(o, "component")), lambda v: v.isNotNull())
    return F.coalesce(F.get(each, F.lit(0)), offer_price(offers, "component"))


def chart_points(html: Column, chart_id: str) -> Column:
    """First series of the chart JSON embedded under a script id."""
    raw = F.regexp_extract(html, rf"(?is)<script[^>]*id=[\"']{chart_id}[\"'][^>]*>(.*?)</script>", 1)
    return F.try_variant_get(F.try_parse_json(F.trim(raw)), "$.points[0]", "array<double>")


# -- urls ----------------------------------------------------------------------

def canonical_host(url: Column) -> Column:
    return F.regexp_replace(text.url_host(text.filled(url)), r"^www\.", "")


def canonical_path(url: Column) -> Column:
    return F.lower(F.regexp_replace(text.url_path(text.filled(url)), r"/+$", ""))


def redirected(requested: Column, landed: Column) -> Column:
    """Landed on another page: host or path differ.

    Scheme, ``www.``, case, query and a trailing slash do not count.
    """
    return (canonical_host(requested) != canonical_host(landed)) | (
        canonical_path(requested) != canonical_path(landed)
    )


def policy_links(html: Column, url: Column, keywords: Sequence[str] = packs.POLICY_WORDS) -> Column:
    """Same-host links whose text or target names a keyword, no fragment.

    First occurrence order, without repeats.
    """
    anchors = F.regexp_extract_all(text.filled(html), F.lit(r"(?is)(<a\s[^>]*href=[\"'][^\"']*[\"'][^>]*>.*?</a>)"), F.lit(1))
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*:)//", 1)
    host = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    folder = F.regexp_replace(text.url_path(url), r"[^/]*$", "")

    def absolute(href):
        bare = F.regexp_replace(href, r"#.*$", "")
        root = F.concat(scheme, F.lit("//"), host)
        return (
            F.when(bare.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), bare)
            .when(bare.startswith("//"), F.concat(scheme, bare))
            .when(bare.startswith("/"), F.concat(root, bare))
            .when(bare == "", F.regexp_replace(url, r"#.*$", ""))
            .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), bare))
        )

    def entry(a):
        href = F.regexp_extract(a, r"(?is)href=[\"']([^\"']*)[\"']", 1)
        label = F.lower(inner_text(a))
        named = rules.any_word(F.lower(href), keywords) | rules.any_word(label, keywords)
        link = absolute(unescape(href))
        return F.when(named & (text.url_host(link) == F.lower(host)), link)

    return F.array_distinct(F.filter(F.transform(anchors, entry), lambda x: x.isNotNull()))


# -- paragraphs ----------------------------------------------------------------

def paragraphs(value: Column, splitter: str = r"\n{2,}") -> Column:
    tidy = F.regexp_replace(text.filled(value), r"[ \t]+", " ")
    return F.filter(F.transform(F.split(tidy, splitter), collapse), lambda p: p != "")


def near_keyword(value: Column, number: Column, words: Sequence[str], window: int) -> Column:
    """Is a number, plain or with thousands commas, near one of the words?

    The number must not touch other digits; both orders count. The window is
    ``window`` characters before a word's start and as many from it on. One pattern
    per number and word looks no further than the window from each occurrence.
    """
    low = collapse(F.lower(text.filled(value)))
    hit = F.lit(False)
    for form in (number.cast("string"), F.format_number(number, 0)):
        needle = F.concat(F.lit(r"(?<!\d)"), form, F.lit(r"(?!\d)"))
        for word in words:
            quoted = F.lit("\\Q" + word + "\\E")
            for first, then, room in (
                (needle, quoted, window - F.length(form)),
                (quoted, needle, window - len(word) - F.length(form)),
            ):
                gap = F.concat(F.lit("(?=.{0,"), F.greatest(room, F.lit(0)).cast("string"), F.lit("}?"))
                hit = hit | ((room >= 0) & F.regexp_like(low, F.concat(F.lit("(?s)"), first, gap, then, F.lit(")"))))
    return hit
