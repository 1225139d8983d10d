"""Parameter values the reference uses, so that default runs compute what it
computes. Everything else in the package takes these as overridable
arguments.
"""

# Batch model and evaluation (main job, sweeps, detector).
BATCH_SAMPLE = 0.01          # share of records used for training
SPLIT_SEED = 11
BATCH_K = 130
BATCH_RUNS = 10
BATCH_EPSILON = 1.0e-6
DEFAULT_K = 2                # k-means with library defaults
DETECTOR_K = 150             # detector that fits its own model
ANOMALY_TOP_N = 100          # threshold = distance of the 100th farthest record
SWEEP_RAW_KS = tuple(range(30, 101, 10))        # 30, 40, ..., 100
SWEEP_ZSCORE_KS = tuple(range(60, 121, 20))     # 60, 80, 100, 120
SWEEP_MIXED_KS = tuple(range(30, 161, 10))      # 30, 40, ..., 160
SWEEP_ENTROPY_KS = tuple(range(30, 161, 10))    # 30, 40, ..., 160

# Streaming k-means.
STREAM_INITIAL_WEIGHT = 100.0
STREAM_DECAY = 1.0
STREAM_BATCH_SECONDS = 10

# Dashboard report preparation.
REPORT_SORT_ORDER = "value-asc"
GROUP_SMALL_PERCENT = 1.0
GROUP_SMALL_LABEL = "Other clusters less than 1%"
HIDE_BELOW_PERCENT = 2.0
PERCENT_DECIMALS = 1
TRUNCATE_LENGTH = 10
CAPTION_TEMPLATE = "{label}, Count: {value}, {percentage}%"
MAKEUP_LINE_FORMAT = "%1s%18s%8s"   # cluster, label, count
