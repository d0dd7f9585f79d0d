"""Projectile types, case materials and related word lists."""

PRODUCT_TYPES = ["FMJ", "TMJ", "JHP", "HP", "OTM", "SP", "JSP", "FP", "FN", "LRN", "RN", "WC", "Solid",
                 "Frangible", "Blank", "Incendiary"]

# --- fixed values: (regex on normalised text, type); first match wins --------
TYPE_CASCADE = [
    (r"\bjacketed\s+hollow\s+point\b", "JHP"),
    (r"\bsemi[\s-]?jacketed\s+hollow\s+point\b", "JHP"),
    (r"\bjacketed\s+soft\s+point\b", "SP"),
    (r"\bsemi[\s-]?jacketed\s+soft\s+point\b", "SP"),
    (r"\bfull\s+metal\s+jacket\b", "FMJ"),
    (r"\btotal\s+metal\s+jacket\b", "TMJ"),
    (r"\bfmj\s+flat(?:\s+nose|\s+point)?\b", "FMJ"),
    (r"\bfmjtc\b", "FMJ"),
    (r"\bfmc\b", "FMJ"),
    (r"\bmetal\s+case\b", "FMJ"),
    (r"\bl40sw[34]", "FMJ"),
    (r"\bassured\s+stopping\s+power\b", "JHP"),
    (r"\bopen\s+tip\s+match\b", "OTM"),
    (r"\blead\s+round\s+nose\b", "LRN"),
    (r"\broundn?\s*nose\s+flat\s+point\b", "FP"),
    (r"\bsoft\s+point\b", "SP"),
    (r"\bhollow\s+point\b", "JHP"),
    (r"\bflat\s+point\b", "FP"),
    (r"\bpower\s*point\b", "SP"),
    (r"\bpolymer\s+tip(?:ped)?\b", "HP"),
    (r"\bballistic\s+tip\b", "HP"),
    (r"\bwadcutter\b", "WC"),
    (r"\bfrangible\b", "Frangible"),
    (r"\bblank\b", "Blank"),
    (r"\bbanded\s+solid\b", "Solid"),
    (r"\bmonolithic\s+solid\b", "Solid"),
    (r"\bsolid\s+dgs\b", "Solid"),
    (r"\bsolid\s+copper\s+fluted\b", "Solid"),
    (r"\bsemi[\s-]?wad\s*cutter\b", "WC"),
    (r"\bhollow\s+base\s+wadcutter\b", "WC"),
    (r"\bspire\s+point\b", "SP"),
    (r"\bspitzer\b", "SP"),
    (r"\bround\s+nose\b", "RN"),
    (r"\bflat\s+nose\b", "FN"),
    (r"\bv[\s-]?max\b", "HP"),
    (r"\ba[\s-]?max\b", "HP"),
    (r"\beld[\s-]?x\b", "HP"),
    (r"\beld[\s-]?m(?:atch)?\b", "HP"),
    (r"\beldx\b", "HP"),
    (r"\bxtp\b", "JHP"),
    (r"\bfxp\b", "HP"),
    (r"\bcphp\b", "HP"),
    (r"\bcpfp\b", "FP"),
    (r"\bftx\b", "JHP"),
    (r"\bflexlock\b", "JHP"),
    (r"\bhoneybadger\b", "JHP"),
    (r"\bbjhp\b", "JHP"),
    (r"\bincendiary\b", "Incendiary"),
    (r"\bgold\s*dot\b", "JHP"),
    (r"\bgdhp\b", "JHP"),
    (r"\baccu[\s-]?tip\b", "HP"),
    (r"\bsst\b", "HP"),
    (r"\bmatchking\b", "HP"),
    (r"\bvld\b", "HP"),
    (r"\bttsx\b", "HP"),
    (r"\btsx\b", "HP"),
    (r"\blrx\b", "HP"),
    (r"\bhst\b", "JHP"),
    (r"\bcritical\s+duty\b", "JHP"),
    (r"\btac[\s-]?tx\b", "HP"),
    (r"\bdpx\b", "HP"),
    (r"\bsinterfire\b", "Frangible"),
    (r"\bbthp\b|\bhpbt\b", "HP"),
    (r"\bhpfb\b", "HP"),
    (r"\botfb\b", "OTM"),
    (r"\bthp\b", "HP"),
    (r"\bfmjbt\b|\bfmjfn\b|\bfmjfb\b", "FMJ"),
    (r"\bsjsp\b", "SP"),
    (r"\bsjhp\b", "JHP"),
    (r"\brnfp\b", "FP"),
    (r"\blswc\b", "WC"),
    (r"\bswc\b", "WC"),
    (r"\bhbwc\b", "WC"),
    (r"\blrn\b", "LRN"),
    (r"\bjhp\b", "JHP"),
    (r"\bjsp\b", "SP"),
    (r"\bfmj\b", "FMJ"),
    (r"\btmj\b", "TMJ"),
    (r"\botm\b", "OTM"),
    (r"\bhp\b", "HP"),
    (r"\bsp\b", "SP"),
    (r"\bfp\b", "FP"),
    (r"\bwc\b", "WC"),
    (r"\brht\b", "Frangible"),
    (r"\blawman\b", "TMJ"),
    (r"\bxtreme\s+(?:defense|defender|penetrator)\b", "Solid"),
    (r"\bbarnes\s+expander\b", "HP"),
    (r"\bcritical\s+defense\b", "JHP"),
    (r"\bcrit\s+def(?:ense)?\b", "JHP"),
    (r"\bcrt\s+dfnse\b", "JHP"),
    (r"\bcrit\s+duty\b", "JHP"),
    (r"\bbrass\s+enclosed\b", "FMJ"),
    (r"\bwinclean\b", "FMJ"),
    (r"\bpspbt\b", "SP"),
    (r"\bbtsp\b", "SP"),
    (r"\bpsp\b", "SP"),
    (r"\bsbt\b", "SP"),
    (r"\bcprn\b", "RN"),
    (r"\bhshk\b", "JHP"),
    (r"\blhp\b", "HP"),
    (r"\blfn\b", "FN"),
    (r"\blwc\b", "WC"),
    (r"\bblanks\b", "Blank"),
    (r"(?=.*\bmc\b)(?=.*\b(?:umc|remington)\b)", "FMJ"),
    (r"(?=.*\bcx(?:tm)?\b)(?=.*\bhornady\b)", "HP"),
]

# --- fixed values: phrase that alone does not decide a type ------------------
AMBIGUOUS_TIP = r"(?iU)\b(polymer[\s-]+tip(?:ped)?|ballistic[\s-]+tip)\b"

# --- fixed values: independent url patterns of the type audit ----------------
URL_TYPE_AUDIT = [
    (r"\bfullmetaljacket\b|\bfull[-_]metal[-_]jacket\b", "FMJ"),
    (r"\bhollowpoint\b|\bhollow[-_]point\b", "HP-family"),
    (r"\bsoftpoint\b|\bsoft[-_]point\b", "SP"),
    (r"\bfmjbt\b|\bfmj[-_]bt\b", "FMJ"),
    (r"\bbthp\b|\bhpbt\b", "HP-family"),
    (r"\bjhp\b", "JHP"), (r"\bfmj\b", "FMJ"), (r"\btmj\b", "TMJ"),
    (r"\botm\b|\botsm\b", "OTM"),
    (r"\bvmax\b|\bv[-_]max\b", "HP-family"), (r"\bamax\b|\ba[-_]max\b", "HP-family"),
    (r"\beldx\b|\beld[-_]x\b|\beld[-_]m\b", "HP-family"),
    (r"\bsjhp\b", "JHP"), (r"\bsjsp\b", "SP"), (r"\brnfp\b", "FP"), (r"\blrn\b", "FP"),
    (r"\b(?:hp)\b", "HP"), (r"\b(?:sp)\b", "SP"), (r"\b(?:fp)\b", "FP"),
]

# --- fixed values: manufacturer phrases, first phrase found wins -------------
MAKER_TYPE_PHRASES = [
    ("jacketed hollow point", "JHP"), ("total metal jacket", "TMJ"), ("full metal jacket", "FMJ"),
    ("open tip match", "OTM"), ("hollow point", "JHP"), ("soft point", "SP"), ("round nose", "LRN"),
    ("flat point", "FP"),
]

# --- fixed values: case materials --------------------------------------------
STEEL_BRANDS = ["wolf", "tula", "tulammo", "brown bear", "silver bear", "golden bear"]
STEEL_BRANDS_WIDE = STEEL_BRANDS + ["barnaul"]
STEEL_BRANDS_ALL = STEEL_BRANDS_WIDE + ["red army", "sterling"]

# --- fixed values: words of each product class for rebate texts --------------
CLASS_WORDS = {
    "shotshell": ["shotshell", "shot shell", "shotgun", "turkey", "waterfowl", "upland", "clays",
                  "sporting clays", "slug", "birdshot", "buckshot", "12 ga", "12ga", "12 gauge", "20 ga",
                  "20ga", "20 gauge", "16 ga", "16ga", "16 gauge", "28 ga", "28ga", "28 gauge", "410 bore",
                  ".410", "long beard"],
    "rifle": ["rifle ammunition", "centerfire rifle", ".223", "5.56", ".308", "7.62x", "7.62 x", "30-06",
              "30 06", "6.5 creedmoor", "creedmoor", ".243", ".270", ".300 win mag", ".338", ".50 bmg",
              "ar-15", "ar15", "ar-10", "precision rifle", "msr"],
    "handgun": ["handgun", "pistol", "9mm", ".45 acp", "45 acp", "45acp", ".40 s&w", "40 s&w", ".380",
                "380 acp", ".357 sig", ".357 mag", "38 special", "38spl", ".38 spl", ".44 mag",
                ".44 special", ".44 magnum", "10mm"],
    "rimfire": ["rimfire", ".22 lr", "22 lr", "22lr", ".22lr", ".22 long rifle", "22 long rifle", ".22 wmr",
                "22 wmr", "17 hmr", "17hmr", ".17 hmr", ".17hmr"],
}
