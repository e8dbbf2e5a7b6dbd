"""Default rule tables. Every operator takes its table as an argument."""

# Labels of the rule labeller, sorted.
TAGS = ["B-PRODUCT", "I-LOC", "I-PHONE", "I-PRICE", "I-PRODUCT", "O"]

# Marks that make a token a price (case-sensitive).
PRICE_MARKS = ["ETB", "$", "birr", "ብር", "ዋጋ"]

# Place words, each once. Entries with a space never match a single token.
LOCATIONS = [
    "Addis Ababa", "ቦሌ", "ሜክሲኮ", "ብስራተ", "ገብርኤል", "ገርጂ",
    "ኢምፔሪያል", "ህንፃ", "ፕላዛ", "4ኪሎ", "ፎቅ", "ላፍቶ", "ሞል", "ስላሴ",
    "መገናኛ", "ለቡ", "ለቡ መዳህኒዓለም", "ዘፍመሽ", "ኬኬር", "አዲስ አበባ",
    "ባልቻ", "ሆስፒታል", "ልደታ", "ኮሜርስ", "ራሀ", "ጉርድሾላ", "ከሴንቸሪ",
    "አልፎዝ", "ቅድስት", "አህመድ ህንፃ", "መዚድ ፕላዛ",
]

# Emoji code-point ranges that are deleted.
EMOJI_RANGES = [
    (0x1F600, 0x1F64F), (0x1F300, 0x1F5FF), (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF), (0x2600, 0x26FF), (0x2700, 0x27BF),
]

# Model output names and the tags they stand for.
LABEL_NAMES = {"LABEL_0": "O", "LABEL_1": "B-PRODUCT", "LABEL_2": "I-PRODUCT"}

# Report formats and limits.
PRODUCT_COLOR = "#FFD700"
OTHER_COLOR = "#87CEEB"
SPAN_OPEN = '<span style="background-color:{color};padding:2px;border-radius:4px;">'
SPAN_CLOSE = "</span>"
LOW_CONFIDENCE = 0.7
IGNORED_LABEL = -100
MAX_PIECES = 128
LABELLED_MESSAGES = 50
PREVIEW_ROWS = 5
HIGHLIGHTED_TEXTS = 3

# NA words that a pandas CSV read turns into a missing value.
NA_WORDS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


# ---- Amharic normalisation -------------------------------------------------------
# Syllables of one consonant sit in eight consecutive code points (orders 1 to 8), so
# the pairs below are derived from the first code point of each consonant.

_SECOND_ORDER, _LABIAL_ORDER = 1, 7

# Consonants whose labialised "-wa" syllable is the eighth of their own block.
_REGULAR_BLOCKS = [
    0x1208, 0x1218, 0x1228, 0x1230, 0x1238, 0x1260, 0x1270, 0x1278, 0x1290, 0x1298,
    0x12D8, 0x12F0, 0x1320, 0x1328, 0x1338, 0x1348,
]
# Consonants whose labialised syllable sits in a block of its own: u-syllable, wa-syllable.
_VELAR_PAIRS = [(0x1201, 0x128B), (0x1241, 0x124B), (0x12A9, 0x12B3), (0x1309, 0x1313)]


def labialized_pairs() -> list[tuple[str, str]]:
    """(two-letter spelling, labialised letter), e.g. u-syllable + wa/a -> wa-syllable."""
    bases = [(b + _SECOND_ORDER, b + _LABIAL_ORDER) for b in _REGULAR_BLOCKS] + _VELAR_PAIRS
    return [(chr(u) + vowel, chr(wa)) for u, wa in sorted(bases) for vowel in "ዋአ"]


# Rare labialised "-wu" letters are written with the plain u-syllable.
LABIAL_U_LETTERS = {"ቊ": "ቁ", "ኍ": "ሁ", "ኵ": "ኩ", "ጕ": "ጉ"}


def homophone_map() -> dict[str, str]:
    """Letters with the same sound -> one letter."""
    out: dict[str, str] = {}
    for source, target, orders in (
        (0x1210, 0x1200, 7),  # three h-series fold into the first one
        (0x1280, 0x1200, 7),
        (0x12B8, 0x1200, 7),
        (0x1220, 0x1230, 7),  # two s-series
        (0x12D0, 0x12A0, 7),  # glottal series
        (0x1338, 0x1340, 7),  # two ts-series
    ):
        for order in range(orders):
            out[chr(source + order)] = chr(target + order)
    # In the h and glottal series the first and fourth orders sound alike.
    for fourth, first in ((0x1203, 0x1200), (0x1213, 0x1200), (0x1283, 0x1200),
                          (0x12BB, 0x1200), (0x12A3, 0x12A0), (0x12D3, 0x12A0)):
        out[chr(fourth)] = chr(first)
    return out


# Common written abbreviations and their full words.
SHORT_FORMS = {
    "ዶ/ር": "ዶክተር", "ፕ/ር": "ፕሮፌሰር", "ኢ/ር": "ኢንጂነር", "ወ/ሮ": "ወይዘሮ", "ወ/ሪት": "ወይዘሪት",
    "ት/ቤት": "ትምህርት ቤት", "መ/ቤት": "መስሪያ ቤት", "ጽ/ቤት": "ጽህፈት ቤት", "ም/ቤት": "ምክር ቤት",
    "ክ/ከተማ": "ክፍለ ከተማ", "ክ/ሀገር": "ክፍለ ሀገር", "አ/አ": "አዲስ አበባ", "ጠ/ሚ": "ጠቅላይ ሚኒስትር",
    "ሚ/ር": "ሚኒስትር", "ኮ/ል": "ኮሎኔል", "ጄ/ል": "ጄኔራል", "ዓ/ም": "ዓመተ ምህረት", "ዓ.ም": "ዓመተ ምህረት",
    "ዓ.ም.": "ዓመተ ምህረት", "ስ/ቁ": "ስልክ ቁጥር", "ቤ/ቁ": "ቤት ቁጥር",
}

# Punctuation spellings of several characters, replaced in this order, then single ones.
PUNCT_SEQUENCES = [("፡፡", "።"), ("::", "።"), ("፡-", "፦"), ("...", "…")]
PUNCT_LETTERS = {
    "«": '"', "»": '"', "“": '"', "”": '"', "„": '"', "‹": "'", "›": "'",
    "‘": "'", "’": "'", "`": "'", "´": "'", "–": "-", "—": "-", "－": "-",
    "，": "፣", "；": "፤", "？": "?", "！": "!",
}

# Letters kept by the word tokenizer.
SCRIPTS = {
    # Ethiopic syllables and marks; no Ethiopic digits or punctuation.
    "ethiopic": r"\x{1200}-\x{135F}\x{1380}-\x{138F}\x{2D80}-\x{2DDE}\x{AB01}-\x{AB2E}",
    "letters": r"\p{L}\p{M}",
}
