"""Table contents and thresholds that results depend on.

Everything in this module is data, not logic. Results only match when these
values are exactly the published ones, so they are stated once, here.
"""

# --- fixed values: the two corpora -----------------------------------------
WEB_KEY = "fineweb"
WEB_DATASET = "HuggingFaceFW/fineweb-2"
WEB_CONFIG = "jpn_Jpan"
WEB_TOTAL_ROWS = 380_000_000

ARTICLE_KEY = "wikipedia"
ARTICLE_DATASET = "wikimedia/wikipedia"
ARTICLE_CONFIG = "20231101.ja"
ARTICLE_TOTAL_ROWS = 10_000_000

SOURCE_TABLE = "airflow_pipeline"

# --- fixed values: fields kept from a corpus record ------------------------
CORPUS_FIELDS = ("text", "url", "id", "title")

# --- fixed values: execution presets ---------------------------------------
DEFAULT_PRESET = "balanced"
PRESETS = {
    "test": {
        "web_chunk_size": 10_000,
        "article_chunk_size": 10_000,
        "batch_size": 50,
        "max_chunks": 1,
        "max_records": 10_000,
    },
    "memory_optimized": {
        "web_chunk_size": 100_000,
        "article_chunk_size": 50_000,
        "batch_size": 100,
        "max_chunks": 2,
        "max_records": 10_000,
    },
    "conservative": {
        "web_chunk_size": 500_000,
        "article_chunk_size": 100_000,
        "batch_size": 250,
        "max_chunks": 3,
        "max_records": 25_000,
    },
    "balanced": {
        "web_chunk_size": 1_000_000,
        "article_chunk_size": 250_000,
        "batch_size": 500,
        "max_chunks": 5,
        "max_records": 50_000,
    },
    "aggressive": {
        "web_chunk_size": 2_000_000,
        "article_chunk_size": 500_000,
        "batch_size": 1_000,
        "max_chunks": 10,
        "max_records": 100_000,
    },
}

# --- fixed values: script detection ----------------------------------------
# "narrow" is a literal character class: it holds only the characters and the
# three ranges written in it. "full" covers the whole scripts.
SCRIPTS = {
    "narrow": "ひらがな-んカタカナ-ヶ一-龯",
    "full": r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}",
}

# --- fixed values: length thresholds (characters) --------------------------
TOO_SHORT = 10
TOO_LONG = 50_000
WEB_MEDIUM = 100
WEB_LONG = 1_000
ARTICLE_MIN = 50
ARTICLE_STANDARD = 500
ARTICLE_DETAILED = 2_000
ARTICLE_COMPREHENSIVE = 10_000
MAX_LENGTH = 1_000_000

# --- fixed values: words and labels ----------------------------------------
NAV_WORDS = ("ホーム", "HOME", "トップ", "TOP", "メニュー", "MENU", "ログイン", "LOGIN")
REDIRECT_WORDS = ("redirect", "リダイレクト")
LENGTH_CATEGORIES = ("short", "medium", "long")
ARTICLE_SIZES = ("stub", "standard", "detailed", "comprehensive")
ARTICLE_TYPES = ("article", "disambiguation", "list", "category")
QUALITY_CLASSES = ("poor", "low", "medium", "high")
CONTENT_TYPES = ("content", "navigation", "ui_element", "date_only", "punctuation_only")
QUALITY_TIERS = ("high", "medium", "low", "poor")
ASSESSMENTS = ("Excellent", "Good", "Fair", "Poor")

# --- fixed values: fallback rows of an empty corpus ------------------------
WEB_FALLBACK = {
    "text": "No real data processed yet",
    "url": "https://example.com/fallback",
}
ARTICLE_FALLBACK = {
    "id": "wp_fallback",
    "title": "No real data processed yet",
    "text": "No real Wikipedia data was processed in this run",
}

# --- fixed values: constant ratios of the simple quality model -------------
WEB_RATIOS = {"script": (0.8, 0.1), "ascii": (0.2, 0.8)}
ARTICLE_RATIOS = {"script": (0.9, 0.1), "ascii": (0.1, 0.9)}


def preset(name):
    """Settings of an execution preset; an unknown name means the default."""
    return PRESETS.get((name or "").lower(), PRESETS[DEFAULT_PRESET])
