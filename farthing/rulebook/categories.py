"""The tracked product categories.

Everything in this module is data that the operators take as parameters.
"""

# --- fixed values: detection cascade, first category with a hit wins ---------
CATEGORY_CASCADE = [
    ("223-556", [("sub", "5.56"), ("sub", "5.56x45"), ("sub", "5.56nato"), ("sub", "5.56 nato"),
                 ("re", r"\b\.?223\b"), ("sub", "223 rem"), ("sub", ".223 rem"), ("re", r"223\s*rem"),
                 ("re", r"\b556\b"), ("re", r"\b556\s*nato")]),
    ("22lr", [("re", r"\b22\s*lr\b"), ("sub", "22 long rifle"), ("sub", ".22lr"), ("re", r"\b\.22\s*lr\b")]),
    ("380acp", [("sub", "380 acp"), ("sub", ".380 acp"), ("sub", "380auto"), ("sub", "380 auto"),
                ("re", r"\b\.?380\s*acp\b"), ("re", r"\b\.?380\b")]),
    ("40sw", [("sub", "40 s&w"), ("sub", "40s&w"), ("sub", ".40 s&w"), ("sub", ".40sw"), ("sub", "40 smith"),
              ("re", r"\b\.?40\s*sw\b"), ("re", r"\b\.?40\s*s\s*&?\s*w\b")]),
    ("308win", [("sub", "308 win"), ("sub", ".308 win"), ("sub", "7.62x51"), ("sub", "7.62 x 51"),
                ("re", r"\b\.?308\s*win\b"), ("re", r"\b7\.?62\s*nato\b"), ("re", r"\b\.?308\b"),
                ("sub", "762x51"), ("re", r"\b762\s*x?\s*51\b"), ("re", r"\b\.?308\s*win")]),
    ("762x39", [("sub", "7.62x39"), ("sub", "7.62 x 39"), ("sub", "762x39")]),
    ("300blk", [("sub", "300 blackout"), ("sub", ".300 blackout"), ("sub", "300 blk"), ("sub", ".300 blk"),
                ("sub", "300 aac"), ("sub", ".300 aac"), ("re", r"300\s*(?:aac|blk|blackout)"),
                ("re", r"\.300\s*(?:aac|blk|blackout)")]),
    ("38spl", [("sub", "38 special"), ("sub", ".38 special"), ("sub", "38 spl"), ("sub", ".38 spl"),
               ("sub", "38special"), ("re", r"\b\.?38\s*spl\b"), ("re", r"\b\.?38\s*sp(?:c|cl)?\b")]),
    ("357mag", [("sub", "357 mag"), ("sub", ".357 mag"), ("sub", "357 magnum"), ("sub", ".357 magnum"),
                ("sub", "357mag"), ("re", r"\b\.?357\s*(?:rem(?:ington)?\.?\s*)?mag")]),
    ("9mm", [("re", r"\b9mm\b"), ("sub", "9 mm"), ("sub", "9x19"), ("sub", "9 x 19"), ("sub", "9 luger"),
             ("re", r"\b9\s*mm\s*luger"), ("re", r"\b9\s*mm(?=\d)")]),
    ("45acp", [("sub", "45 acp"), ("sub", ".45 acp"), ("re", r"\b\.?45\s*auto\b(?!\s*rim)"),
               ("re", r"\b\.?45\s*acp\b")]),
    ("10mm", [("sub", "10mm auto"), ("sub", "10 mm auto"), ("sub", "10mmauto"), ("re", r"\b10\s*mm\b")]),
    ("30-06", [("sub", "30-06 springfield"), ("sub", "30-06 sprg"), ("re", r"\b\.?30[\s-]?06(?![0-9])")]),
    ("270win", [("re", r"(?:\b270\s*win(?:chester)?\b(?!\s*short))"
                       r"|(?:\b\.270\b(?!\s*(?:wsm|win(?:chester)?\s+short)))")]),
]

# --- fixed values: capture-time price bounds (category, low, high) -----------
# A None means the default applies.
CAPTURE_BOUNDS = [
    ("9mm", 0.15, 1.50),
    ("223-556", 0.20, 2.50),
    ("22lr", 0.04, 0.75),
    ("380acp", 0.18, 2.00),
    ("40sw", 0.20, 2.00),
    ("308win", 0.40, 4.00),
    ("762x39", 0.15, 2.00),
    ("300blk", 0.35, 4.00),
    ("38spl", 0.20, 2.50),
    ("357mag", 0.25, 3.00),
    ("45acp", 0.25, 2.50),
    ("10mm", 0.20, 3.50),
    ("30-06", 0.40, 4.00),
    ("270win", 0.40, 4.00),
]
# Loose names some feeds use for a category.
LOOSE_CATEGORY_KEYS = {"223": "223-556", "556": "223-556", "380": "380acp", "308": "308win"}
DEFAULT_LOW = 0.15
DEFAULT_HIGH = 3.00
ABSOLUTE_LOW = 0.01
ABSOLUTE_HIGH = 5.00
INCONSISTENT_RELATIVE = 0.25
INCONSISTENT_ABSOLUTE = 0.10

# --- fixed values: chart floors of the segment query -------------------------
SEGMENT_FLOORS = [
    ("9mm", 0.10), ("22lr", 0.03), ("380acp", 0.15), ("38spl", 0.20), ("357mag", 0.20),
    ("40sw", 0.15), ("45acp", 0.15), ("223-556", 0.20), ("300blk", 0.25), ("308win", 0.20),
    ("6.5cm", 0.40), ("762x39", 0.25), ("762x54r", 0.25), ("12ga", 0.15), ("10mm", 0.20),
    ("30-06", 0.20), ("270win", 0.20),
]

# --- fixed values: expected unit-price range of the category audit -----------
EXPECTED_RANGES = [
    ("9mm", 0.15, 0.80), ("223-556", 0.25, 1.50), ("22lr", 0.05, 0.30), ("380acp", 0.20, 1.00),
    ("40sw", 0.20, 0.90), ("308win", 0.50, 3.00), ("762x39", 0.20, 1.00), ("300blk", 0.50, 2.50),
    ("38spl", 0.25, 1.50), ("357mag", 0.30, 1.50), ("45acp", 0.25, 1.20), ("10mm", 0.30, 2.50),
    ("30-06", 0.50, 3.00), ("270win", 0.50, 3.00),
]
DEFAULT_EXPECTED_RANGE = (0.10, 5.00)

# --- fixed values: names that identify a category in a url or page title -----
CATEGORY_URL_NAMES = {
    "9mm": ["9mm", "9mm-luger", "9-mm"],
    "223-556": ["223-rem", "223rem", "223-remington", "223", "223-556", "223-556mm", "223-5-56", "223-5.56",
                "223-rem-5-56-nato", "5-56", "556-nato", "556mm-nato", "556x45-nato", "5.56x45",
                "5-56x45mm", "5-56x45mm-nato"],
    "22lr": ["22-lr", "22lr", "22-long-rifle", "22lr-long-rifle"],
    "380acp": ["380-acp", "380-auto", "380"],
    "40sw": ["40-sw", "40-s-w", "40sw", "40-cal", "40-cal-sw"],
    "308win": ["308-win", "308-winchester", "308", "308-762x51", "308-win-762x51", "308-7-62-nato",
               "308-7-62x51", "308-7-62x51mm", "308-win-7-62x51", "762x51-nato", "762x51mm-nato", "7-62x51"],
    "762x39": ["7-62x39", "762x39", "7.62x39", "7-62x39mm", "762x39mm", "7.62x39mm", "7-62-x39",
               "7-62-x-39", "7-62-x-39mm"],
    "300blk": ["300-blackout", "300-aac-blackout", "300-aac", "300blk"],
    "38spl": ["38-special", "38-specials", "38-spl"],
    "357mag": ["357-magnum", "357-mag", "357"],
    "45acp": ["45-acp", "45-auto", "45acp", "45-acp-auto"],
    "10mm": ["10mm", "10mm-auto", "10mm-ammo", "10mm-auto-ammo", "10-mm", "10mm-ammunition"],
    "30-06": ["30-06", "30-06-springfield", "30-06-sprg", "3006", "30-06-ammo", "30-06-springfield-ammo",
              "30-06-sprg-ammo", "3006-springfield", "30-06-spring", "30-06-ammunition"],
    "270win": ["270-win", "270-winchester", "270-win-ammo", "270-winchester-ammo", "270", "270-ammo", "270win"],
}

# --- fixed values: manufacturer-page category names -> slug ------------------
MAKER_CATEGORY_NAMES = {
    "9mm luger": "9mm", "9mm": "9mm", "9mm luger +p": "9mm", "9mm nato": "9mm", "9x19mm nato": "9mm",
    "9x19": "9mm", "9x19mm": "9mm", "9 mm luger": "9mm",
    "223 rem": "223-556", ".223 rem": "223-556", "223 remington": "223-556", ".223 remington": "223-556",
    "5.56 nato": "223-556", "5.56x45 nato": "223-556", "5.56x45mm nato": "223-556", "5.56": "223-556",
    "5.56mm": "223-556",
    "22 lr": "22lr", ".22 lr": "22lr", ".22 long rifle": "22lr", "22 long rifle": "22lr",
    "380 auto": "380acp", ".380 auto": "380acp", "380 acp": "380acp", ".380 acp": "380acp",
    "380 automatic": "380acp",
    "40 s&w": "40sw", ".40 s&w": "40sw", ".40 smith & wesson": "40sw", "40 smith & wesson": "40sw",
    "308 win": "308win", ".308 win": "308win", "308 winchester": "308win", ".308 winchester": "308win",
    "7.62x39": "762x39", "7.62x39mm": "762x39", "7.62 x 39mm": "762x39",
    "300 blk": "300blk", ".300 blk": "300blk", "300 blackout": "300blk", ".300 blackout": "300blk",
    "300 aac blackout": "300blk",
    "38 special": "38spl", ".38 special": "38spl", "38 spl": "38spl", "38 special +p": "38spl",
    "357 magnum": "357mag", ".357 magnum": "357mag", "357 mag": "357mag", ".357 mag": "357mag",
    "45 auto": "45acp", ".45 auto": "45acp", "45 acp": "45acp",
    "44 magnum": "44mag", ".44 magnum": "44mag", "44 mag": "44mag",
    "10mm auto": "10mm", "10mm": "10mm", "10 mm auto": "10mm",
    "30-06": "30-06", "30-06 springfield": "30-06", ".30-06 springfield": "30-06", "30-06 sprg": "30-06",
    "270 win": "270win", "270 winchester": "270win", ".270 winchester": "270win", ".270 win": "270win",
}

# --- fixed values: rebate class gates ----------------------------------------
REBATE_CLASS_CATEGORIES = {
    "handgun": ["9mm", "380acp", "40sw", "38spl", "357mag", "45acp", "10mm"],
    "rifle": ["223-556", "308win", "762x39", "300blk", "30-06", "270win"],
    "rimfire": ["22lr"],
}
SHOTSHELL_CATEGORY_PREFIXES = ["12ga", "16ga", "20ga"]
SHOTSHELL_TYPES = ["Slug", "Buckshot", "Birdshot"]

# --- fixed values: tokens in a url that contradict a title's category --------
SLUG_CONFLICTS = [
    ("270win", r"270[\s\-]*wsm"),
    ("270win", r"\bwsm\b"),
    ("270win", r"short[\s\-]*mag"),
]
