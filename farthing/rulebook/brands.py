"""Brand names as they occur in titles and urls."""

# --- fixed values: (text in a title, brand); the longest text found wins -----
BRAND_ALIASES = [
    ("federal american eagle", "Federal"), ("american eagle", "Federal"), ("federal champion", "Federal"),
    ("federal personal defense", "Federal"), ("federal premium", "Federal"), ("federal hst", "Federal"),
    ("federal", "Federal"),
    ("winchester usa forged", "Winchester"), ("winchester supreme elite", "Winchester"),
    ("winchester white box", "Winchester"), ("winchester", "Winchester"),
    ("remington golden saber", "Remington"), ("remington htp", "Remington"), ("remington umc", "Remington"),
    ("remington", "Remington"),
    ("hornady critical duty", "Hornady"), ("hornady critical defense", "Hornady"), ("hornady", "Hornady"),
    ("cci", "CCI"),
    ("speer gold dot", "Speer"), ("speer lawman", "Speer"), ("speer", "Speer"),
    ("blazer brass", "Blazer"), ("blazer", "Blazer"),
    ("magtech", "Magtech"),
    ("pmc bronze", "PMC"), ("pmc", "PMC"),
    ("fiocchi", "Fiocchi"),
    ("sellier and bellot", "Sellier & Bellot"), ("sellier & bellot", "Sellier & Bellot"),
    ("seller & bellot", "Sellier & Bellot"), ("s&b", "Sellier & Bellot"),
    ("tulammo", "Tula"), ("tula", "Tula"), ("wolf", "Wolf"),
    ("prvi partizan (ppu)", "Prvi Partizan"), ("prvi partizan", "Prvi Partizan"), ("ppu ", "Prvi Partizan"),
    ("norma", "Norma"), ("lapua", "Lapua"), ("black hills", "Black Hills"), ("underwood", "Underwood"),
    ("sig sauer", "Sig Sauer"), ("liberty ammunition", "Liberty"), ("liberty", "Liberty"),
    ("maxxtech", "Maxxtech"), ("igman", "Igman"), ("armscor", "Armscor"), ("aguila", "Aguila"),
    ("browning", "Browning"), ("barnes", "Barnes"), ("sierra", "Sierra"), ("atomic", "Atomic"),
    ("sterling steel", "Sterling"), ("sterling", "Sterling"), ("belom", "Belom"), ("bvac", "BVAC"),
    ("veteran", "Veteran"), ("hyperion", "Hyperion"), ("staccato", "Staccato"), ("corbon", "Corbon"),
    ("precision one", "Precision One"), ("freedom munitions", "Freedom Munitions"), ("turan", "Turan"),
    ("stv", "STV"), ("silver bear", "Silver Bear"), ("brown bear", "Brown Bear"), ("barnaul", "Barnaul"),
    ("red army", "Red Army"), ("new republic", "New Republic"), ("paraklese", "Paraklese"),
    ("excalibur", "Excalibur"), ("colt", "Colt"), ("cbc", "Magtech"), ("geco", "Geco"),
    ("monarch", "Monarch"), ("sgammo", "SGAmmo"),
    ("nosler asp", "Nosler"), ("nosler", "Nosler"), ("g2 research", "G2 Research"),
    ("g2 telos", "G2 Research"), ("winusa", "Winchester"),
    ("american quality ammunition", "American Quality"), ("us cartridge", "US Cartridge"),
    ("sinterfire", "Sinterfire"), ("patriot sports", "Patriot Sports"), ("rangemaster", "Prvi Partizan"),
    ("privi", "Prvi Partizan"), ("seller bellot", "Sellier & Bellot"), ("sellier bellot", "Sellier & Bellot"),
    ("v crown", "Sig Sauer"), ("sig sauer ep", "Sig Sauer"), ("sig sauer match elite", "Sig Sauer"),
    ("elite v crown", "Sig Sauer"), ("xie9mm", "Sig Sauer"), ("xi51", "Sig Sauer"),
    ("ammo incorporated", "Ammo Inc"), ("ammo inc", "Ammo Inc"),
    ("hsm ammunition", "HSM"), ("hsm ", "HSM"),
    ("buffalo bore ammunition", "Buffalo Bore"), ("buffalo bore ammo", "Buffalo Bore"),
    ("buffalo bore", "Buffalo Bore"),
    ("fort scott munitions", "Fort Scott Munitions"), ("fort scott", "Fort Scott Munitions"),
    ("fsm ", "Fort Scott Munitions"),
    ("doubletap ammunition", "DoubleTap"), ("doubletap", "DoubleTap"), ("double tap", "DoubleTap"),
    ("dbltap ", "DoubleTap"),
    ("frontier cartridge", "Hornady"), ("frontier ammo", "Hornady"),
    ("grizzly cartridge", "Grizzly Cartridge"), ("grizzly ammo", "Grizzly Cartridge"),
    ("grizzly", "Grizzly Cartridge"),
    ("eley", "Eley"), ("cor bon", "Corbon"), ("novx", "NovX"),
    ("lehigh defense", "Lehigh Defense"), ("lehigh", "Lehigh Defense"),
    ("berger bullets", "Berger"), ("berger", "Berger"), ("wilson combat", "Wilson Combat"),
    ("glaser silver", "Glaser"), ("glaser blue", "Glaser"), ("glaser", "Glaser"),
    ("supernova", "Supernova"),
    ("wyoming cartridge company", "Wyoming Cartridge"), ("wyoming cartridge co", "Wyoming Cartridge"),
    ("wyoming cartridge", "Wyoming Cartridge"), ("wyoming ", "Wyoming Cartridge"),
    ("atlanta arms", "Atlanta Arms"), ("piney mountain", "Piney Mountain"),
    ("maxim defense", "Maxim Defense"), ("global ordnance", "Global Ordnance"), ("rws ", "RWS"),
    ("century arms", "Century Arms"),
    ("sk ", "SK"), ("gorilla", "Gorilla"), ("american munitions", "American Munitions"),
    ("american sniper", "American Sniper"), ("scorpion", "Scorpion"), ("frontier ", "Hornady"),
    ("black sheep", "Black Sheep"), ("streak", "Ammo Inc"), ("zsr", "ZSR"),
    ("ventura tactical", "Ventura Tactical"), ("super vel", "Super Vel"), ("ten ring", "Ten Ring"),
    ("saltech", "Saltech"), ("sako", "Sako"), ("ggg", "GGG"), ("telaammo", "Tela Ammo"),
    ("bitterroot valley", "Bitterroot Valley"), ("badlands", "Badlands"), ("bps", "BPS"), ("drt", "DRT"),
]

# --- fixed values: brand words inside a category name, removed before matching
BRAND_NOISE = (
    r"(?iU)\b\d+(?:\.\d+)?[\s.-]+"
    r"(?:sig\s+sauer|long\s+colt|remington|winchester|colt|sig|rem|win)"
    r"(?:\s+(?:magnum|mag|rimfire|rim\s*fire))*"
)

# One of these is in every match of the noise; "\u017f" and "\u0131" count as s and i where case does not.
NOISE_WORDS = ["colt", "rem", "win", "w\u0131n", "sig", "s\u0131g", "\u017fig", "\u017f\u0131g"]

# --- fixed values: leading letters of a url's last segment -> brand ----------
SLUG_PREFIX_BRANDS = {
    "win": "Winchester", "fed": "Federal", "fio": "Fiocchi", "rem": "Remington",
    "cent": "Century Arms", "spr": "Speer",
}

# --- fixed values: brands whose re-parse marks a known historic mistake ------
REPARSE_TRIGGER_BRANDS = ["Remington", "Winchester", "Colt", "Sig Sauer"]

UNKNOWN_BRAND = "Unknown"

# --- fixed values: country of origin keywords, first hit wins ----------------
ORIGIN_BASE = [
    ("federal", "USA"), ("winchester", "USA"), ("remington", "USA"), ("cci", "USA"), ("speer", "USA"),
    ("hornady", "USA"), ("blazer", "USA"), ("fiocchi", "USA"), ("american eagle", "USA"),
    ("magtech", "Brazil"), ("cbc", "Brazil"), ("ppu", "Serbia"), ("prvi partizan", "Serbia"),
    ("sellier", "Czech Republic"), ("tula", "Russia"), ("wolf", "Russia"), ("aguila", "Mexico"),
]
ORIGIN_EXTENDED = ORIGIN_BASE + [
    ("pmc", "South Korea"), ("geco", "Germany"), ("lapua", "Finland"), ("norma", "Sweden"),
]
