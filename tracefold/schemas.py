"""Column layouts shared by the operators."""

from pyspark.sql import types as T

# A process model is three tables; many models share them, told apart by model_id.
PLACES = T.StructType([
    T.StructField("model_id", T.StringType()),
    T.StructField("model_file", T.StringType()),
    T.StructField("place_ord", T.IntegerType()),
    T.StructField("place_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("init_tokens", T.IntegerType()),
])

TRANSITIONS = T.StructType([
    T.StructField("model_id", T.StringType()),
    T.StructField("trans_ord", T.IntegerType()),
    T.StructField("transition_id", T.StringType()),
    T.StructField("name", T.StringType()),
])

ARCS = T.StructType([
    T.StructField("model_id", T.StringType()),
    T.StructField("arc_ord", T.IntegerType()),
    T.StructField("source", T.StringType()),
    T.StructField("target", T.StringType()),
])

RESULT_COLUMNS = [
    "model_id", "case_id", "status", "error_detail", "missing_tokens",
    "missing_indices", "unconsumed_tokens", "session_length",
]

COUNT_COLUMNS = [
    "model_id", "case_id", "status", "error_detail", "missing_count", "unconsumed_count", "session_length",
]

REPORT_COLUMNS = [
    "case_id", "area", "report_date", "model_file", "missing_tokens",
    "unconsumed_tokens", "missing_count", "unconsumed_count", "session_length",
]

STATUS_OK = "ok"
STATUS_UNKNOWN_EVENT = "unknown_event"
STATUS_PATH_EXPLOSION = "path_explosion"
