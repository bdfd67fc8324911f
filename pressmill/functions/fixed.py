"""Fixed values of the dump format, the labels and the file conventions.

They are data, not logic: results depend on every one of them being exactly this.
"""

# Keys of an article's header, as they stand in the dumps (case-sensitive).
HEADER_KEYS = (
    "NOVINA",
    "PORTAL",
    "DATUM",
    "RUBRIKA",
    "NADNASLOV",
    "NASLOV",
    "PODNASLOV",
    "STRANA",
    "AUTOR(I)",
    "AUTORI",
    "AUTOR",
    "LINK",
)

# Header values that mean "nothing".
NOT_AVAILABLE = ("", "N/A", "NA", "-", "n/a")

# Agencies whose trailing byline is removed.
AGENCIES = ("FENA", "SRNA", "HINA", "Beta", "Tanjug", "AP", "Reuters", "AFP", "Avaz")

# Latin letters with a diacritic and the plain ones used in a source slug.
DIACRITICS = "čćžšđ"
DIACRITICS_PLAIN = "cczsd"

# Slug of a source without a name.
UNKNOWN_SOURCE = "unknown"

# Category left out unless the caller says otherwise (cartoons are no prose).
DEFAULT_EXCLUDED_CATEGORIES = ("Karikature i stripovi",)

# Class names of predictions and of the per-class report.
HUMAN, AI = 0, 1
PREDICTION_NAMES = {HUMAN: "Human-written", AI: "AI-generated/rewritten"}
REPORT_NAMES = {HUMAN: "Human-written", AI: "AI-generated"}

# First year in which text of the human class is no longer beyond doubt.
AI_ERA_START = 2023

# Length window in characters and split shares of a prepared corpus.
MIN_LENGTH, MAX_LENGTH = 200, 50_000
TRAIN_SHARE, VAL_SHARE = 0.80, 0.10
SEED = 42

# Rows per model call and words a model sees.
SCORE_BATCH = 16
HEAD_WORDS = 512

# Cells that the usual CSV readers of this data take for null.
CSV_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
