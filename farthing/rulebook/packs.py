"""Pack-count patterns, stock phrases and source profiles.

A pack rule is (regex, low, high, mode). ``first`` takes group 1, ``product``
multiplies groups 1 and 2. A value outside [low, high] means "next rule".
"""

ANY = 2_000_000_000

# --- fixed values: pack-count patterns by rule set, in order -----------------
PACK_RULES = {
    "simple": [
        (r"(\d[\d,]*)\s*rounds?\s*(?:case|box|pack)?", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*rd", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*count", 0, ANY, "first"),
    ],
    "wide": [
        (r"(\d[\d,]*)\s*rounds?", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*rd[s]?\b", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*rnd[s]?\b", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*/\s*ct\b", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*ct\b", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*/\s*box\b", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*/\s*bx\b", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*per\s*box", 0, ANY, "first"),
        (r"\bbox\s+of\s+(\d[\d,]*)\b", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*-\s*count\b", 0, ANY, "first"),
        (r"\b(\d{2,4})/\d{1,4}\b", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*count", 0, ANY, "first"),
    ],
    "slash_bounded": [
        (r"(\d[\d,]*)\s*round?s?\b", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*rds?\b", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*[- ]?\s*rd\s*(?:box|case|pack)", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*per\s*box", 0, ANY, "first"),
        (r"(\d[\d,]*)\s*[- ]?\s*ct\b", 0, ANY, "first"),
        (r"\b(\d{1,4})\s*/\s*\d{1,4}\b", 5, 1000, "first"),
    ],
    "case_first": [
        (r"([\d,]+)\s*(?:rd|rds|rounds?)[\s-]*(?:case|bulk\s*pack|pack\b)", 0, ANY, "first"),
        (r"(\d+)\s*(?:rd|rds|rounds?)\s*(?:box|loose)?\s*x\s*(\d+)", 0, ANY, "product"),
        (r"([\d,]+)\s*(?:rd|rds|rounds?)[\s-]*box", 0, ANY, "first"),
        (r"(\d+)\s*/\s*(?:bx|box)\b", 0, ANY, "first"),
        (r"([\d,]+)\s*rounds?\b", 0, ANY, "first"),
        (r"([\d,]+)\s*rds?\b", 0, ANY, "first"),
    ],
    "title_quantity": [
        (r"box of (\d+)", 0, ANY, "first"),
        (r"pack of (\d+)", 0, ANY, "first"),
        (r"\((\d+)\)\s*$", 0, ANY, "first"),
        (r"(\d+)\s*count\b", 0, ANY, "first"),
        (r"(\d+)\s*ct\b", 0, ANY, "first"),
    ],
    "variant_product": [
        (r"(\d+)\s*rounds?\s*of\b", 0, ANY, "first"),
        (r"(\d+)\s*(?:rd|rds)\s*box", 0, ANY, "first"),
    ],
    "label": [
        (r"(\d[\d,]*)\s*pk\b", 5, 10000, "first"),
        (r"(\d[\d,]*)\s*rd[s]?\b", 5, 10000, "first"),
        (r"(\d[\d,]*)\s*rounds?\b", 5, 10000, "first"),
        (r"\bbox\s+of\s+(\d[\d,]*)\b", 5, 10000, "first"),
    ],
    "sku_tail": [(r"-(\d{2,4})\s*$", 5, 5000, "first")],
    "plain_rounds": [(r"(\d[\d,]*)\s*rounds?\b", 0, ANY, "first")],
    "first_number": [(r"(\d+)", 0, ANY, "first")],
}

# --- fixed values: purchase-limit patterns, accepted range 1..999 ------------
LIMIT_PATTERNS = [
    r"limit\s*(?:of\s*)?(\d+)",
    r"max(?:imum)?\s*(?:qty|quantity)\s*[:=]?\s*(\d+)",
    r"(\d+)\s*per\s*(?:customer|order|household)",
    r"qty\s*limit\s*[:=]?\s*(\d+)",
]

# --- fixed values: stock phrases ---------------------------------------------
# absent: any phrase means out of stock; present: one phrase is required;
# empty_is_out: an empty text means out of stock.
STOCK_RULES = {
    "absent_phrases": {"out": ["out of stock", "sold out", "backordered"], "need": []},
    "positive_phrase": {"out": [], "need": ["+", "in stock"]},
    "status_field": {"out": ["out of stock", "sold out", "unavailable", "discontinued"], "need": []},
    "body_text": {"out": ["out of stock", "sold out"], "need": []},
    "stock_label": {"out": [], "need": ["in stock"]},
}

# --- fixed values: tax-collection wording ------------------------------------
CLAIM_PATTERNS = [
    r"\b(?:we |are )?required to (?:collect|charge)",
    r"\bwe (?:must |will |currently )?(?:collect|charge|apply|add)\b",
    r"\bsales tax (?:is|are|will|may|must|shall) (?:be )?(?:applied|charged|collected|added)\b",
    r"\b(?:are|will be|is|may be) (?:charged|collected|subject to)\b",
    r"\bcollects? (?:applicable )?(?:sales |state |local )?tax",
    r"\bcharge(?:s|d)? (?:applicable )?(?:sales |state )?tax",
    r"\b(?:applicable )?sales tax (?:will be |is |are )?added",
]
DENIAL_PATTERNS = [
    r"\bdo (?:not|n't)\s+(?:collect|charge|apply)",
    r"\bdoes (?:not|n't)\s+(?:collect|charge|apply)",
    r"\b(?:are|is) not required to (?:collect|charge)",
    r"\bno sales tax\b",
    r"\btax[- ]free\b",
    r"\bexempt from (?:sales )?tax",
]
STANCE_PLACE = r"\b(?:Texas|TX)\b"
STANCE_TOPIC = r"(?i)\btax"
STANCE_CODE_LIST = r"(?:[A-Z]{2}[, ]+){3,}"
POLICY_WORDS = ["tax", "shipping", "sales-tax", "sales tax", "policy", "faq"]

# --- fixed values: words that never identify a product line ------------------
LINE_STOP_WORDS = [
    "usa", "series", "handgun", "ammo", "ammunition", "the", "grain", "gr", "rounds", "round", "box", "bx",
    "rd", "rds", "new", "reman", "luger", "auto", "pistol", "rifle", "centerfire", "rimfire", "fps", "free",
    "shipping", "per", "case", "value", "pack", "bulk", "best", "count", "ct", "p", "pp",
]
LINE_TYPE_ALIASES = {"JHP": ["JHP", "HP"]}
LINE_BRAND_ALIASES = {"CCI": ["CCI", "Blazer"]}
VELOCITY_WORDS = ["velocity", "fps", "muzzle"]
NEAR_WINDOW = 220

# --- fixed values: sources with their own fallbacks --------------------------
# (source, house_brand, default_pack, country, pack_rules, stock_rules)
SOURCE_PROFILES = [
    ("default", None, None, None, "simple", "absent_phrases"),
    ("house", "Underwood", 20, "USA", "wide", "absent_phrases"),
]
