"""Generic DataFrame operators. Each is a pure ``DataFrame -> DataFrame`` function over built-in
Spark SQL expressions, so Catalyst sees the whole plan (pushdown, pruning, partial aggregation)."""

from pitchside.operators.counts import duplicate_keys, partition_count
from pitchside.operators.dedupe import fetch_rows, latest_per_key, latest_pointers
from pitchside.operators.merge import flag_matches, insert_missing, upsert_counted
from pitchside.operators.nested import (explode_path, parse_json_column, parsed_sent_as,
                                        project_paths)
from pitchside.operators.reshape import pivot_long, two_sided
from pitchside.operators.topk import take_ordered

__all__ = [
    "duplicate_keys", "partition_count", "latest_per_key", "latest_pointers", "fetch_rows", "insert_missing", "upsert_counted", "flag_matches",
    "explode_path", "parse_json_column", "parsed_sent_as", "project_paths", "pivot_long", "two_sided",
    "take_ordered",
]
