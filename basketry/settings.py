"""Thresholds, list sizes, formats and table names that decide results."""

# Similarity thresholds (strictly greater than).
MIN_SIMILARITY = 0.4
ONLINE_MIN_SIMILARITY = 0.6

# A rating above this raises a candidate's online score, any other lowers it.
POSITIVE_ABOVE = 3

# List sizes.
ITEMCF_TOP = 10
USER_TOP = 20
N_CANDIDATES = 20
N_RECENT = 21  # positions 0..20 of the queue, both ends included
QUEUE_SIZE = 40

# Hashed term features and ALS training.
NUM_FEATURES = 800
ALS_RANK = 5
ALS_ITERATIONS = 10
ALS_REG = 0.01
GRID_RANKS = (5, 10, 20, 50)
GRID_REGS = (1.0, 0.1, 0.01)
TRAIN_FRACTION = 0.8
FITS_AT_ONCE = 4

# Text formats.
PRODUCT_SEPARATOR = "^"
RATING_SEPARATOR = ","
MULTI_VALUE_SEPARATOR = "|"
EVENT_SEPARATOR = "|"
QUEUE_ITEM_SEPARATOR = ":"
LOG_PREFIX = "PRODUCT_RATING_PREFIX:"
LOG_LINE_PATTERN = ".+PRODUCT_RATING_PREFIX.+"

# Stored tables.
PRODUCT = "Product"
RATING = "Rating"
RATE_MORE = "RateMoreProducts"
RATE_MORE_RECENTLY = "RateMoreRecentlyProducts"
AVERAGE = "AverageProducts"
USER_RECS = "UserRecs"
PRODUCT_RECS = "ProductRecs"
CONTENT_RECS = "ContentBasedProductRecs"
ITEMCF_RECS = "ItemCFProductRecs"
STREAM_RECS = "StreamRecs"
MONTHLY = "MonthlyProfile"
MONTHLY_UPDATES = "MonthlyProfileUpdates"
TRENDING = "TrendingProducts"
LOGGED_EVENTS = "LoggedEvents"
HALF_LINES = "HalfWrittenLines"
TRIPLES = "ProductNameTriples"
TRIPLE_COUNTS = "ProductNameTripleCounts"

# Streaming.
TRIGGER_INTERVAL = "5 seconds"
LOG_MAX_AGE = "7d"  # a rotated log older than the newest by more is left alone
TREND_WINDOW = "2 days"
TREND_SLIDE = "12 hours"
TREND_DELAY = "6 hours"
TREND_TOP = 10
FOLD_EVERY = 20  # batches after which what earlier ones wrote is put together

# Execution sizes of our own; they change cost, never results.
HEAVY_BASKET = 1000  # users with more distinct products go through tiles
HOT_PRODUCT = 100_000  # ratings of a product from which its partners are dealt to several tasks
TURN_PAIRS = 400_000_000  # pairs in a basket that are sent at once where only the best are kept, about
TASK_PAIRS = 2_000_000  # pairs of products in a basket that one task sums, about
TILE_PRODUCTS = 2048  # products on one side of a co-occurrence tile
TILE_VECTORS = 1024  # vectors on one side of a dense tile, at least ...
TILE_NUMBERS = 4_000_000  # ... and at most so many numbers in them
TILE_PROFILES = 1024  # profiles on one side of a content tile ...
TILE_TERMS = 1_000_000  # ... and at most so many terms in them
MEMBERS = 1000  # products of a profile that travel in one row, about
PAGE_SIZE = 1000  # recommendations in one page of an unbounded list
CELL_ROWS = 20_000_000  # rows in a cell of the rating table, at most, about
FILE_ROWS = 5_000_000  # rows in one of its files
ALS_CHECKPOINT = 2  # iterations after which the files of those before go
ALS_BLOCK = 5_000_000  # ratings of a block of users or products in training, at most, about
ALS_EXCHANGED = 2_000_000_000  # bytes that models trained beside each other exchange before files go, at most, about
PIVOTS = 512  # vectors that dense groups form around, at most
LENGTH_RANGES = 16  # ranges of item length in top-k inner products
SEARCH_TRIPLES = 3  # rarest letter triples of a pattern that are looked up
PRUNE_FROM = 8  # blocks of dense vectors from which it pays to look for what can be skipped
LIVE_SHARDS = 1024  # groups of users in the state of the live path; fixed as long as a checkpoint lives
