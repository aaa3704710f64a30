"""Row-level upserts expressed as joins (Parquet tables have no MERGE).

Both operators are set-wise: the whole source goes through one join, so there is no per-row or
per-chunk statement and no size limit on the source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_T, _S = "__t", "__s"


def _to_buckets(batch: DataFrame, keys: Sequence[str], buckets: int | None) -> DataFrame:
    """The batch dealt like a target that is bucketed by ``keys``: their join leaves the target where
    it is, whatever the session's number of shuffle partitions."""
    return batch.repartition(buckets, *keys) if buckets else batch


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   defaults: Mapping[str, Column], buckets: int | None = None) -> DataFrame:
    """``MERGE ... WHEN NOT MATCHED THEN INSERT``: add source keys absent from target, filling the
    other target columns from ``defaults``; existing rows are untouched. Source keys are deduped
    first, so a key offered twice is inserted once. Running it twice equals running it once.

    ``buckets``: the target is bucketed by ``keys`` into that many, and only the batch is shuffled."""
    keys = list(keys)
    # Not a left_anti join: the optimizer would push it below the step to the buckets.
    new_keys = (_to_buckets(source.select(*keys).dropDuplicates(keys), keys, buckets)
                .join(target.select(*keys, F.lit(True).alias(_T)), keys, "left")
                .filter(F.col(_T).isNull()))
    fields = {f.name: f.dataType for f in target.schema.fields}
    new_rows = new_keys.select(*[
        (F.col(c) if c in keys else defaults[c]).cast(fields[c]).alias(c) for c in target.columns
    ])
    return target.unionByName(new_rows)


def upsert_counted(target: DataFrame, outcomes: DataFrame, keys: Sequence[str],
                   status_col: str, at_col: str, count_col: str, last_at_col: str,
                   buckets: int | None = None) -> DataFrame:
    """``MERGE`` of a batch of attempt outcomes into a counted-status table.

    Outcomes are first reduced per key (``n`` attempts, the status of the latest attempt, the latest
    time), which is what applying them one by one would leave. Then one full outer join:
    matched -> status replaced, count + n, time = latest; unmatched outcome -> inserted with
    count n; untouched target rows pass through. Outcomes with a NULL key are refused.

    ``buckets``: the target is bucketed by ``keys`` into that many, and only the batch is shuffled.
    """
    keys = list(keys)
    for k in keys:                          # a NULL key matches nothing: it would insert each time
        outcomes = outcomes.filter(F.col(k).isNotNull())
    reduced = (outcomes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.max_by(F.col(status_col), F.struct(F.col(at_col), F.col(status_col))).alias("__status"),
        F.max(F.col(at_col)).alias("__at"),
    ).withColumn(_S, F.lit(True)))
    reduced = _to_buckets(reduced, keys, buckets)
    t = target.withColumn(_T, F.lit(True)).alias("t")
    s = reduced.alias("s")
    cond = None
    for k in keys:
        term = F.col(f"t.{k}") == F.col(f"s.{k}")
        cond = term if cond is None else cond & term
    joined = t.join(s, cond, "full_outer")
    in_t = F.col(f"t.{_T}").isNotNull()
    in_s = F.col(f"s.{_S}").isNotNull()
    fields = {f.name: f.dataType for f in target.schema.fields}
    out = []
    for c in target.columns:
        if c in keys:
            expr = F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        elif c == status_col:
            expr = F.when(in_s, F.col("s.__status")).otherwise(F.col(f"t.{c}"))
        elif c == count_col:
            expr = (F.when(in_s & in_t, F.col(f"t.{c}") + F.col("s.__n"))
                     .when(in_s, F.col("s.__n"))
                     .otherwise(F.col(f"t.{c}")))
        elif c == last_at_col:
            expr = F.when(in_s, F.col("s.__at")).otherwise(F.col(f"t.{c}"))
        else:
            expr = F.col(f"t.{c}")
        out.append(expr.cast(fields[c]).alias(c))
    return joined.select(*out)


def flag_matches(target: DataFrame, batch: DataFrame, keys: Sequence[str], flag: str,
                 buckets: int | None = None) -> DataFrame:
    """The target with a boolean ``flag``: whether the row's key occurs in ``batch``. ``buckets`` as
    above."""
    keys = list(keys)
    seen = batch.select(*keys).dropDuplicates(keys).withColumn(flag, F.lit(True))
    return (target.join(_to_buckets(seen, keys, buckets), keys, "left")
            .select(*target.columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag)))
