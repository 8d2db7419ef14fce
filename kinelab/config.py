"""Run parameters.

The values in the first block are fixed: they must equal the reference
pipeline's settings for the results to match.
"""

from __future__ import annotations

# --- fixed values (must equal the reference's settings) -------------------
WINDOW_SECONDS = 10
KEY_PATTERN = r"([A-Z]{2}\d{4})"
LABEL_FILE_SUFFIX = "_clean_TAC.csv"
LABEL_THRESHOLD = 0.08
SAMPLE_RATE = 1.0
SEED = 42
NUM_FOLDS = 5
NUM_TREES = 100
MAX_DEPTH = 10
LIVE_ROWS = 3
PSI_EPSILON = 1e-100
DRIFT_TARGETS = ("is_intoxicated",)
LATENCY_BUCKETS = (0.1, 0.5, 1, 2.5, 5, 10)
FEATURE_ORDER = ("time", "x", "y", "z", "energy", "magnitude")
SCORE_METRICS = ("precision", "recall", "f1", "accuracy")
METRICS_TO_LOG = (
    "test_precision", "train_precision", "test_recall", "train_recall",
    "test_f1", "train_f1", "test_accuracy", "train_accuracy",
)
APP_NAME = "kinelab"
# ---------------------------------------------------------------------------

# Column names used across the library.
KEY = "pid"
TIME_MS = "time_ms"
WINDOW_START = "window_start_s"
READING_TIME = "timestamp"
READING = "TAC_Reading"
LABEL = "is_intoxicated"

# Scale knobs (ours, not the reference's).
# As-of join: readings at or below this many rows are broadcast (Plan A);
# above it the bucketed shuffle plan (Plan C) is used.
ASOF_BROADCAST_MAX_ROWS = 2_000_000
# ... and this many bytes of keys, times and values.
ASOF_BROADCAST_MAX_BYTES = 256 << 20
# As-of join: coarse time bucket used as a second equi-join key, so a key
# with very many readings is split by time instead of landing in one task.
ASOF_BUCKET_SECONDS = 86_400
# Bounds of the automatic bucket width. The upper bound caps how much of
# a hot key one task of Plan C holds; the lower bound caps the number of
# buckets per key.
ASOF_MIN_BUCKET_SECONDS = 3_600
ASOF_MAX_BUCKET_SECONDS = 86_400
# Plan A: an interval is exploded over fewer than this many buckets; longer
# ones use wider buckets (bounds the broadcast to ASOF_MAX_EXPLODE x the
# reading count).
ASOF_MAX_EXPLODE = 8
# Fold ranking: rows are ranked inside (label, key, time bucket) groups.
FOLD_BUCKET_SECONDS = 86_400
# Largest number of rows per column-oriented JSON log document.
LOG_DOC_ROWS = 1_000
# CSV: a record with quoted line feeds is put together up to this size.
RECORD_BYTES = 64 << 20
# Column-oriented JSON: files above this size are cut into splits (one task each) instead of read line by line.
LOG_FILE_BYTES = 64 << 20
