"""Fixed values.

These values must equal the original pipeline's configuration for the same
results, so they are stated here verbatim, in their original order.  Nothing
else in the package hard-codes data.
"""

# --- fixed values: keyword list used for the extraction keyword flag -------
COVID_KEYWORDS = [
    "COVID", "covid", "新冠", "新型冠状病毒", "コロナ", "corona", "Corona",
    "CORONA", "코로나", "코로나바이러스", "โควิด", "SARS-CoV-2", "коронавирусной",
]

# --- fixed values: keyword list of the sample keyword filter ----------------
SAMPLE_FILTER_KEYWORDS = ["COVID", "covid", "肺炎", "コロナ", "corona", "Corona", "코로나"]

# --- fixed values: crawl regions, in processing order -----------------------
REGIONS = [
    "jp", "cn", "br", "kr", "mx", "eu", "us", "my", "int", "in", "de", "au",
    "za", "np", "sg", "gb", "id", "fr", "ru", "af", "it", "th", "es", "pt", "ca",
]

# --- fixed values: region (or guessed language) -> source language ----------
REGION_LANG = {
    "jp": "ja", "cn": "zh", "zh-cn": "zh", "pt": "pt", "br": "pt", "kr": "ko",
    "es": "es", "mx": "es", "my": "id", "de": "de", "id": "id", "fr": "fr",
    "ru": "ru", "it": "it", "th": "th", "en": "en", "ca": "en", "us": "en",
    "eu": "en", "int": "en", "in": "en", "au": "en", "za": "en", "np": "en",
    "sg": "en", "af": "en", "gb": "en",
}

# --- fixed values: source languages with a translation route, per target ----
# The target language itself is listed too: it means "same language, pass through".
ROUTE_SOURCES = {
    "ja": ["ja", "en", "zh", "ko", "fr", "es", "de", "pt", "id", "ru", "it", "th"],
    "en": ["en", "ja", "zh", "ko", "fr", "es", "de", "pt", "id", "ru", "it", "th"],
}

# --- fixed values: limits of the translate stage -----------------------------
PART_LIMIT = 300          # a part holds fewer than this many characters
MAX_LINES = 500           # longer documents get status 7
DENSITY_LIMIT = 0.2       # (content+1)/(content+links+1) below this -> status 2
DENSITY_EXEMPT_REGION = "my"
EXTRACT_SITE_QUOTA = 20
TRANSLATE_SITE_QUOTA = 10
EXTRACT_DAY_WINDOW = 7
TWEET_HEAD_TAIL = 1000

# --- fixed values: the one site whose first <h1> is put before its text -----
H1_PREPEND_SITES = ["zusammengegencorona"]

# --- fixed values: site suffixes removed by the Japanese cleaner ------------
JA_SITE_SUFFIXES = ["-丹波市ホームページ", "｜尼崎市公式ホームページ", "/むかわ町-北海道むかわ町公式ウェブサイト"]

# --- fixed values: status codes of the translate stage ----------------------
STATUS_OK = 0
STATUS_NO_KEYWORD = 1
STATUS_TOO_MANY_LINKS = 2
STATUS_SHORT = 3
STATUS_MISSING_FILES = 4
STATUS_EXISTS = 5
STATUS_NO_FOLDER = 6
STATUS_TOO_LONG = 7
STATUS_INDEX = 8
STATUS_NO_ROUTE = 9

# --- fixed values: text rules ------------------------------------------------
# Date mention (F10); \d of the original is any Unicode digit (\p{Nd}).
DATE_PATTERN = r"[0-9]月|20\p{Nd}\p{Nd}|199\p{Nd}|平成|昭和|H[2-3][0-9]"
LINK_WORD = "リンク"                       # F11
TITLE_CUT_MARKERS = ["−", "ーY", "|"]      # X10: cut from the marker to the end
LATIN_HEAD = 200                           # F9: look at the first 200 chars ...
LATIN_SHARE = 0.6                          # ... which must be more than 60 % ASCII letters
LINK_LIST_MAX_P = 30                       # F12: at most 30 chars of non-link <p> text
LINK_LIST_SHARE = 0.8                      # F12: more than 80 % of <li> hold a link
LINK_DOMINATED_FACTOR = 2                  # F13: anchor text more than 2x the <p>/<strong> text

# --- fixed values: block document (S12) ---------------------------------------
CONTENT_BLOCK_TYPES = ["maintext", "unknown_block"]

# --- fixed values: short posts ----------------------------------------------
POST_PATH_PREFIX = "/mnt"                  # S4: manifest lines kept by the post extractor
