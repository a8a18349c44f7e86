"""Parameters of the registered queries, shared by the Spark side and the
oracle SQL so both ask the same question."""

# one bucket for the single-bucket log queries
ONE_BUCKET = "bkt-error-0"
# bucket allow-list of the log queries
LOG_BUCKETS = ("bkt-error-0", "bkt-error-1", "bkt-view-2")
# bucket allow-list for the inventory filter
SOME_BUCKETS = ("src1", "src2")
# bucket and key prefix for the prefix listing and the classification
PREFIX_BUCKET = "src3"
PREFIX = "docs/en/"
# n of the top-n queries
TOP_BUCKETS = 5
TOP_OBJECTS = 3
TOP_IPS = 5
# piece and block sizes of the checksums by pieces (small, as documents are)
PIECE_BYTES = 512
BLOCK_BYTES = 64
# names sent to the tasks before a list is filtered on the scan instead
ALLOW_BROADCAST = 100
