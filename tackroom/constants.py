"""Fixed values that must equal the behaviour being reproduced.

These are stated once, as plain text, and imported everywhere else.
"""

# --- fixed values ----------------------------------------------------------
# Shard file names accepted by the merge step, and the glob used to prune the
# listing before the exact regex runs.
SHARD_NAME_PATTERN = r"^horse_data_\d+_to_\d+_.*\.ndjson$"
SHARD_NAME_GLOB = "horse_data_*_to_*_*.ndjson"
SHARD_PREFIX = "horse_data"
# Suffix given to the cleaned output of a master file.
CLEANED_SUFFIX = "_cleaned_deduped_"
# Separator used when prizes of null-year career rows are folded together.
PRIZE_SEPARATOR = " + "
# Class labels of the multiclass model, in score order.
CLASS_LABELS = ["1", "2", "3", "4", "5", "6", "7", "other"]
# Feature columns the model wants as text, and those it wants as numbers.
STRING_FIELDS = ["horse_id", "birth_year", "total_races", "total_wins",
                 "total_prize_count", "trainer_freq", "jockey_weight_missing"]
NUMERIC_FIELDS = ["career_prize", "career_win_rate", "trainer_win_rate",
                  "temperature", "track_distance", "jockey_weight"]
# Default number of predicted finishers.
DEFAULT_TOP_K = 7
# Relative rank scale and the value given when all probabilities are equal.
RANK_MIN, RANK_MAX, RANK_ALL_EQUAL = 1, 100, 100
# Label name and outcome of a finish place outside 1..7.
POSITION_LABEL = "position_class"
POSITION_OTHER = "other"
# Status meaning a landed response is usable.
STATUS_OK = 200
# Characters JavaScript's String.prototype.trim removes (ECMAScript
# WhiteSpace and LineTerminator), as a regex class body.
JS_WHITESPACE_CLASS = (r"\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}"
                       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}")
# --- end fixed values ------------------------------------------------------

# Line classes produced by the clean step.
KEPT, DUPE, MALFORMED, BLANK, MISSING_ID = "kept", "dupe", "malformed", "blank", "missing_id"
# Further classes of a quarantine table: lines that the parser cannot judge, and records with a value of another type.
BEYOND_LIMITS, MISFIT = "beyond_limits", "misfit"
