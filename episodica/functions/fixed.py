"""Names, enumerations and message texts that results must carry as they are."""

from pyspark.sql import types as T

# --- columns -----------------------------------------------------------------------------
SOURCE_COLUMNS = [
    "action",
    "observation.state",
    "episode_index",
    "frame_index",
    "next.done",
    "timestamp",
    "index",
    "task_index",
]
QUALITY_COLUMNS = ["episode_index", "frame_index", "next.done"]
PER_STEP_COLUMNS = [
    "pixels",
    "action",
    "proprio",
    "state",
    "episode_idx",
    "step_idx",
    "done",
    "timestamp",
    "index",
    "task_index",
]
EPISODE_COLUMNS = ["ep_len", "ep_offset"]
REPLAY_COLUMNS = ["pixels", "action", "state", "done", "episode_idx", "step_idx", "ep_len", "ep_offset"]

# --- options -----------------------------------------------------------------------------
DIRTY_POLICIES = ("fail", "drop", "warn")
POLICY_ACTIONS = {"fail": "fail", "drop": "drop_invalid", "warn": "warn_only"}
NO_ACTION = "kept_all"
COMPRESSIONS = ("none", "lzf", "gzip")
STORE_MODES = ("inspect", "validate")
UNKNOWN = "unknown"
# Mean and standard deviation of the channels (red, green, blue) of ImageNet, at values 0..1.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)

# --- source quality messages, in the order they appear inside one run -----------------------
NOT_CONTIGUOUS = "Episode rows are not contiguous."
STARTS_AT = "step_idx starts at %d, expected 0."
STEP_GAP = "step_idx is not contiguous within the episode."
NOT_TERMINATED = "Last step has next.done=False (episode not terminated cleanly)."
EARLY_DONE = "Found next.done=True before the episode terminal step."

# --- store validation messages, in check order ----------------------------------------------
MISSING_KEYS = "Missing required keys: %s"
LENGTH_MISMATCH = "Per-step dataset lengths mismatch against episode_idx: {%s}"
PIXELS_RANK = "'pixels' must be rank-4, got rank-%d."
PIXELS_CHANNELS = "'pixels' last dimension must be 1 or 3, got %d."
INDEX_RANK = "'ep_len' and 'ep_offset' must be rank-1 arrays."
INDEX_LENGTHS = "'ep_len' and 'ep_offset' length mismatch: %d vs %d."
FIRST_OFFSET = "First ep_offset must be 0, got %d."
NON_POSITIVE_LEN = "All ep_len values must be > 0."
OFFSETS_DECREASE = "ep_offset must be non-decreasing."
TOTAL_ROWS = "Total rows mismatch: sum(ep_len)=%d, rows=%d."
SLICE_BOUNDS = "Episode %d has invalid bounds [%d, %d) for %d rows."
SLICE_ROWS = "Episode %d expected %d rows, found %d."
SLICE_STEPS = "Episode %d step_idx is not contiguous from 0 to %d."
SLICE_MIXED = "Episode slice %d mixes multiple episode_idx values."
SLICE_TERMINAL = "Episode %d terminal step has done=False (not cleanly terminated)."
SLICE_EARLY = "Episode %d has done=True before terminal step."

# --- schemas -----------------------------------------------------------------------------
PIXELS = T.StructType(
    [
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("channels", T.IntegerType()),
        T.StructField("data", T.BinaryType()),
    ]
)
STEPS_SCHEMA = T.StructType(
    [
        T.StructField("episode_index", T.LongType()),
        T.StructField("frame_index", T.LongType()),
        T.StructField("done", T.BooleanType()),
        T.StructField("timestamp", T.FloatType()),
        T.StructField("index", T.LongType()),
        T.StructField("task_index", T.LongType()),
        T.StructField("action", T.ArrayType(T.FloatType())),
        T.StructField("state", T.ArrayType(T.FloatType())),
    ]
)
STORE_SCHEMA = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("pixels", PIXELS),
        T.StructField("action", T.ArrayType(T.FloatType())),
        T.StructField("proprio", T.ArrayType(T.FloatType())),
        T.StructField("state", T.ArrayType(T.FloatType())),
        T.StructField("episode_idx", T.LongType()),
        T.StructField("step_idx", T.LongType()),
        T.StructField("done", T.BooleanType()),
        T.StructField("timestamp", T.FloatType()),
        T.StructField("index", T.LongType()),
        T.StructField("task_index", T.LongType()),
        T.StructField("split", T.StringType()),
        T.StructField("camera", T.StringType()),
    ]
)
EPISODE_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("ep_pos", T.LongType()),
        T.StructField("episode_index", T.LongType()),
        T.StructField("ep_len", T.LongType()),
        T.StructField("ep_offset", T.LongType()),
        T.StructField("split", T.StringType()),
        T.StructField("camera", T.StringType()),
    ]
)
ATTRIBUTES_SCHEMA = T.StructType(
    [
        T.StructField("source_repo_id", T.StringType()),
        T.StructField("source_split", T.StringType()),
        T.StructField("source_camera_key", T.StringType()),
        T.StructField("fps", T.IntegerType()),
        T.StructField("generated_by", T.StringType()),
        T.StructField("complete", T.BooleanType()),
        T.StructField("split", T.StringType()),
        T.StructField("camera", T.StringType()),
    ]
)
