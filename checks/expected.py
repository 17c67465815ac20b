"""Fixed values the checks expect, stated apart from the library's own.

Word lists, patterns and character classes that decide the features: a word
changed in the library alone makes a check fail.
"""

# --- units, one flag each -------------------------------------------------
UNITS_FAST = ["oz", "ounce", "lb", "pound", "count", "pack", "ml", "liter"]
UNITS_BASE = ["oz", "ounce", "lb", "pound", "kg", "gram", "ml", "liter", "count", "pack"]

# --- unit groups ----------------------------------------------------------
WEIGHT = ["oz", "ounce", "lb", "pound", "kg", "gram", "g"]
VOLUME = ["ml", "liter", "l", "fl oz", "gallon"]
VOLUME_OPT = ["ml", "liter", "l", "fl oz", "gallon", "quart"]
COUNT = ["count", "pack", "piece", "ct", "pcs"]
COUNT_BOX = ["count", "pack", "piece", "ct", "pcs", "box"]
SIZE = ["inch", "cm", "mm", "ft"]
SIZE_OPT = ["inch", "cm", "mm", "ft", "meter"]

# --- quality --------------------------------------------------------------
PREMIUM = ["premium", "gourmet", "luxury", "deluxe", "professional"]
NATURAL = ["organic", "natural", "pure", "fresh", "raw"]
BRAND = ["brand", "authentic", "original", "genuine"]
QUALITY = ["quality", "grade", "finest", "best", "top"]
QUALITY_FLAGS_FAST = ["premium", "organic", "natural", "gourmet", "fresh"]
BRAND_FLAGS_BASE = ["brand", "premium", "organic", "natural", "gourmet"]
QUALITY_SCORE = ["premium", "organic", "natural", "gourmet", "fresh", "luxury"]
BRAND_WORDS = ["premium", "luxury", "professional", "authentic", "original", "genuine"]

# --- categories -----------------------------------------------------------
FOOD_COMPACT = ["food", "snack", "candy", "chocolate", "sauce"]
FOOD_FAST = ["food", "snack", "candy", "chocolate", "sauce", "spice"]
FOOD_BASE = ["food", "snack", "candy", "chocolate", "sauce", "spice", "oil"]
FOOD = ["food", "snack", "candy", "chocolate", "sauce", "spice", "oil", "drink"]
FOOD_OPT = ["food", "snack", "candy", "chocolate", "sauce", "spice", "oil", "drink", "beverage"]
BEAUTY_BASE = ["cosmetic", "beauty", "lip", "skin", "hair"]
BEAUTY = ["cosmetic", "beauty", "lip", "skin", "hair", "makeup", "lotion"]
BEAUTY_OPT = ["cosmetic", "beauty", "lip", "skin", "hair", "makeup", "lotion", "cream"]
BEAUTY_FAST = ["cosmetic", "beauty", "lip", "lotion", "cream"]
CLEANING = ["cleaning", "detergent", "soap", "wash", "cleaner"]
HEALTH_COMPACT = ["vitamin", "supplement", "medicine"]
HEALTH = ["vitamin", "supplement", "medicine", "health"]
HEALTH_OPT = ["vitamin", "supplement", "medicine", "health", "wellness"]
ELECTRONICS = ["electronic", "digital", "battery", "charger"]
ELECTRONICS_OPT = ["electronic", "digital", "battery", "charger", "device"]

# --- exclusive category label, first match wins ---------------------------
LABEL_FOOD = ["food", "snack", "candy", "sauce", "spice"]
LABEL_BEAUTY = ["cosmetic", "beauty", "lip", "lotion"]
LABEL_CLEANING = ["cleaning", "dish", "soap"]

# --- price words ----------------------------------------------------------
PRICE_WORDS = ["cheap", "expensive", "affordable", "budget", "value", "deal", "sale"]
PRICE_WORDS_OPT = ["cheap", "expensive", "affordable", "budget", "value", "deal", "sale", "discount"]

# --- patterns -------------------------------------------------------------
PRICE_PATTERNS = {
    "dollar_sign": r"\$[0-9]+\.?[0-9]*",
    "dollar_word": r"[0-9]+\.[0-9]+\s*dollars?",
    "worth": r"worth\s*\$?[0-9]+",
}
SIZE_PATTERN = r"([0-9]+\.?[0-9]*)\s*(oz|ounce|lb|pound|kg|gram|ml|liter)"
PACK_PATTERN = r"([0-9]+)\s*(pack|count|piece|ct)"

# --- character classes ----------------------------------------------------
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UPPER = r"\p{Lu}\x{2160}-\x{216f}\x{24b6}-\x{24cf}\x{1f130}-\x{1f149}\x{1f150}-\x{1f169}\x{1f170}-\x{1f189}"
WORD = r"\p{L}\p{N}_"
#: decimal digits, superscripts, subscripts and circled digits
DIGIT = r"\p{Nd}\x{b2}-\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"


def word_pattern(terms: list[str]) -> str:
    """A pattern that finds any of the terms between word boundaries."""
    return f"(?:^|[^{WORD}])(?:{'|'.join(terms)})(?:$|[^{WORD}])"
