"""Fixed values and defaults that results depend on.

Fixed values (must equal the behaviour being reproduced):
  Bloom filter: 100000 bits, 3 hash seeds (0, 1, 2), bit = md5("<seed><text>") as a big-endian
    integer mod size.
  Near-duplicate band: 5 rows, one band (band id 0), token vector dimension 5 * 3 = 15.
  Label codes: complaint = 0, praise = 1, inquiry = 2.
  Reply threshold: confidence > 0.8 and a known label gets the label's template.
  Low-confidence counter: confidence < 0.8.
  Spike view: last 20 processed rows; alert threshold 5 complaints.
  Dashboard alert: all-time complaints >= 5.
  Noisy report: epsilon 1.0, seed 42, Laplace scale 1 / epsilon.
  Generator seed 22842.
"""

BLOOM_SIZE = 100_000
BLOOM_HASHES = 3
LSH_ROWS = 5
LSH_BAND_ID = 0
LSH_DIM = LSH_ROWS * 3

LABELS = ("complaint", "praise", "inquiry")
LABEL_CODES = {"complaint": 0, "praise": 1, "inquiry": 2}

REPLY_THRESHOLD = 0.8
LOW_CONFIDENCE = 0.8

SPIKE_WINDOW = 20
SPIKE_THRESHOLD = 5
DASHBOARD_ALERT = 5
RECENT_ROWS = 20
STATUS_ROWS = 10
SAMPLE_ROWS = 10

DP_EPSILON = 1.0
DP_SEED = 42

SPLIT_SEED = 42
TRAIN_PERCENT = 80
TFIDF_TERMS = 100
TREE_DEPTH = 10

SYNTH_SEED = 22842

# A Bloom bit table is broadcast only while the configured bit count is at most this
# (the table has at most `size` rows of two longs); beyond it the probe is a shuffle join.
BLOOM_BROADCAST_MAX_BITS = 8_000_000
