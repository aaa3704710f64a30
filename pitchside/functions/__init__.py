"""Column-expression helpers: built-in Spark SQL expressions only, no Python UDFs."""

from pitchside.functions.casts import percent_fraction, try_cast_as
from pitchside.functions.match import match_points, match_result
from pitchside.functions.payload import payload_error_text, payload_is_ok, payload_result_count

__all__ = [
    "percent_fraction", "try_cast_as", "match_points", "match_result",
    "payload_error_text", "payload_is_ok", "payload_result_count",
]
