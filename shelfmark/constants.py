"""Fixed values of the catalog rules. Every operator takes them as overridable parameters."""

# --- fixed values: maintenance ---
PRUNE_MAX_STALE_SHARE = 0.5        # prune is skipped when stale > share * scanned
BULK_UPDATE_CHUNK = 100
APPROVAL_DELETE_CAP = 500
APPROVAL_TTL_DAYS = 7
SCAN_PAGE = 1000

# --- fixed values: scanning ---
MAX_DEPTH = 8
SIDECAR_PREFIX = "._"

# --- fixed values: decisions ---
CONFIDENCE_MIN = 0.7
AUTO_APPLY_CONFIDENCE_MIN = 0.85
AUTO_APPLY_PLACE_MAX_LEN = 12
DETECTION_SCORE_MIN = 0.4
DETECTION_AREA_MIN = 0.005
NULL_STREAK_LIMIT = 3
SHORT_SECONDS = 3.0
RATE_MIN_SAMPLE = 50

# --- fixed values: search ---
VOTE_ROWS_PER_KEY = 20
MIN_SEARCH_KEY_LEN = 2
MIN_NORMALIZED_LEN = 3
FUZZY_THRESHOLD = 0.03
FUZZY_LIMIT = 50
NAME_OVERLAP_SHARE = 0.6
VICINITY_CHARS = 300

# --- fixed values: feeds ---
NEW_ITEM_HOURS = 6

# --- fixed values: text caps ---
JOURNAL_TEXT_CAP = 500
TRUNCATED_MARK = "...<truncated>"
TAG_MAX_LEN = 30

# --- fixed values: health thresholds (warn, critical) ---
DISK_PERCENT = (80, 90)
BACKUP_AGE_HOURS = (26, 30)
BACKLOG_WARN = 200
SNAPSHOT_AGE_HOURS = 3

# --- fixed values: white space of Unicode text ---
WHITE = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BLANKS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"

# --- fixed values: patterns and formats ---
ORDERED_NAME = r"^(\d+)_?\s*(.+)$"
DATED_NAME = r"^(\d{4})(.+)$"
VERSION_MARK = BLANKS + r"V(\p{Nd}+)(?![\p{L}\p{N}_])"           # any letter case
DATE_CELL = r"^\p{Nd}{1,2}/\p{Nd}{1,2}"
DATE_CELL_MAX_LEN = 10
EDITOR_PAREN = r"[（(]([^）)\n]+)[）)]"
EDITOR_PAREN_END = r"\s*[（(][^）)\n]+[）)]\s*$"
TITLE_PAREN = r"\s*[（(][^）)]+[）)]\s*"
TITLE_DATE = r"^\s*\p{Nd}{1,2}\s*[/／]\s*\p{Nd}{1,2}\s*"
TITLE_NUMBER = r"^\s*\p{Nd}{3,4}\s*"
TITLE_TIMES = r"\s*\*\s*\d+\s*$"
TITLE_JOINTS = " 、_-"
TAIL_SPLIT = r"[_\s)）]+"
KEY_HEAD_STOP = r"_\-－"
BUILDING_NOISE = r"[\s\-_（）()【】［］\[\]]"
CASE_PART = r"\s*\(\s*\d+\s*[-/].*$"
NOISE_URL_NUMBER = r"^\d+%3A\d+\s*"
NOISE_MMDD = r"^\d{4}\s*"
NOISE_PAREN = r"[（(].*?[)）]"
NOISE_TAIL_NUMBER = r"\s*\d+$"
ENTRY_EDITOR = r"\(([^)]+)\)$"
ENTRY_DATE = r"^\d+/\d+\s*"
UNSAFE_TAG_CHARS = r'[\\/:*?"<>|]'
PLACE_CHARS = r"^[\p{L}\p{N}_\-()（）]+$"
PERIOD_TITLE = r"^(\d{4})年(?:(\d{1,2})月)?$"
FENCED_JSON = r"(?s)```(?:json)?\s*(\{.*?\})\s*```"
LOOSE_JSON = r"(?s)(\{.*\})"
WEEKDAY_FORMAT = "%d/%d（%s）"
