"""Explicit schemas; nothing is inferred."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _TS, _L = T.StringType(), T.TimestampType(), T.LongType()

# As read from text files: everything that may be malformed stays a string.
REVIEWS_TEXT = _struct(
    ("review_id", _S), ("app_name", _S), ("review_text", _S), ("rating", _S),
    ("platform", _S), ("app_version", _S), ("date", _S), ("user_name", _S),
)
EMAILS_TEXT = _struct(
    ("email_id", _S), ("subject", _S), ("body", _S), ("sender_email", _S),
    ("timestamp", _S), ("priority", _S),
)
LABELS = _struct(
    ("source_id", _S), ("source_type", _S), ("category", _S), ("priority", _S),
    ("technical_details", _S), ("suggested_title", _S),
)
METADATA = _struct(
    ("platform", _S), ("rating", T.IntegerType()), ("user_name", _S), ("date", _TS),
    ("app_version", _S), ("subject", _S), ("sender_email", _S), ("timestamp", _TS),
    ("priority", _S),
)
TICKETS = _struct(
    ("ticket_id", _S), ("source_id", _S), ("source_type", _S), ("title", _S),
    ("description", _S), ("category", _S), ("priority", _S),
    ("technical_details", _S), ("created_at", _TS),
)
LOG = _struct(
    ("source_id", _S), ("source_type", _S), ("agent", _S), ("decision", _S),
    ("confidence", T.DoubleType()), ("timestamp", _TS),
)
METRICS = _struct(
    ("run_id", _S), ("run_at", _TS), ("total_processed", _L), ("tickets_created", _L),
    ("skipped", _L), ("failed", _L), ("bug_count", _L), ("feature_request_count", _L),
    ("praise_count", _L), ("complaint_count", _L), ("spam_count", _L),
)
RUN_KEY = _struct(("run_id", _S))
EDITS = _struct(
    ("ticket_id", _S), ("category", _S), ("priority", _S), ("title", _S),
    ("technical_details", _S),
)
RESPONSES = _struct(
    ("source_id", _S), ("stage", _S), ("attempt", T.IntegerType()), ("raw", _S),
)

# Union of all fields a response may carry; every field is read as text and
# converted per stage, so that one bad field cannot spoil the others.
RESPONSE_FIELDS = _struct(
    ("category", _S), ("confidence", _S),
    ("platform", _S), ("os_version", _S), ("steps_to_reproduce", _S), ("severity", _S),
    ("feature_description", _S), ("user_impact", _S), ("demand_score", _S),
    ("title", _S), ("description", _S),
    ("passed", _S), ("issues", _S),
    ("malformed", _S),
)
