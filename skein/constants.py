"""Fixed values that results depend on. They must equal the values the original
application uses; they are stated here plainly, in their natural order."""

# --- fixed values: article category vocabulary (index = position) ---------------
CATEGORY_NAMES = [
    "others", "sports", "cricket", "entertainment", "auto", "technology", "lifestyle",
    "health", "business", "world", "politics", "education", "national",
]

# --- fixed values: category-with-city vocabulary (name -> index, length 3) -------
CITY_CATEGORY_INDEX = {"zzz": 0, "hhh": 2}

# --- fixed values: custom-category vocabulary (unknown names -> index 0) --------
CUSTOM_CATEGORY_INDEX = {
    "youtubes": 1, "sports": 2, "cricket": 3, "entertainment": 4, "auto": 5,
    "technology": 6, "lifestyle": 7, "health": 8, "business": 9, "world": 10,
    "politics": 11, "education": 12, "national": 13, "local": 14,
}
CUSTOM_CATEGORY_OTHERS = 0

# --- fixed values: event filters ---------------------------------------------
READ_SOURCES = ["main", "hot", "trending"]
REFRESH_ARTICLE_TYPE = "article"
REFRESH_REQ_MODE = "online"

# --- fixed values: windows and sizing constants -------------------------------
DAY_MS = 24 * 60 * 60 * 1000
PROFILE_WINDOW_MS = 3 * DAY_MS
SPARSE_WEIGHT_ROWS_PER_FILE = 4_000_000
STATE_BYTES_PER_FILE = 80_000_000
BATCH_DIR_PATTERN = "yyyy-MM-dd/HH_mm_ss"
HOUR_SECONDS = 60 * 60

CATEGORY_LENGTH = len(CATEGORY_NAMES)
