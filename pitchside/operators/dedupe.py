"""Latest row per key: in one pass, or by choosing the winners on narrow columns and fetching only
their wide ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str | Column],
                   tiebreak_desc: Sequence[str | Column] = ()) -> DataFrame:
    """Keep exactly one row per ``keys``: the greatest by ``order_desc`` then ``tiebreak_desc``.

    Written as ``row_number() = 1`` so Catalyst plans a ``WindowGroupLimit``: a partial top-1 runs
    in each map task before the exchange, so a hot key (even one holding a third of the rows)
    reaches the shuffle as at most one row per map partition, and the final top-1 after it.
    NULL keys form one group, as in SQL.
    """
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last()
             for c in list(order_desc) + list(tiebreak_desc)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(_RN, F.row_number().over(w))
              .filter(F.col(_RN) == 1)
              .drop(_RN))


def row_pointer() -> Column:
    """A number for the place of a row in the files it was read from."""
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def latest_pointers(rows: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                    carry: Sequence[str] = ()) -> DataFrame:
    """Per key the place (``__ptr``) of its greatest row by ``order_desc``, chosen on narrow columns:
    ``rows`` must come from files, and no other column of them is read."""
    narrow = rows.select(*keys, *order_desc, *carry, row_pointer().alias("__ptr"))
    return latest_per_key(narrow, keys, list(order_desc), ["__ptr"])


def fetch_rows(rows: DataFrame, pointers: DataFrame, keys: Sequence[str],
               order_desc: Sequence[str], columns: Sequence[str],
               n_pointers: int | None = None, broadcast_rows: int = 500_000) -> DataFrame:
    """``columns`` of the rows that ``pointers`` (of ``latest_pointers``) point at.

    Without ``n_pointers`` the table must be bucketed by the single key: both sides are in its
    buckets, the pointers become a hash map per bucket (one narrow row per key) and the wide rows are
    streamed past it, neither shuffled nor sorted. With ``n_pointers``, their counted number, the rows
    are read in ordinary splits and the pointers are broadcast if they are few, else joined by
    shuffle. A pointer is a 64-bit hash, so key and order columns are compared besides."""
    rename = {c: f"__w_{c}" for c in dict.fromkeys([*keys, *order_desc])}
    chosen = pointers.select(*[F.col(c).alias(w) for c, w in rename.items()],
                             F.col("__ptr").alias("__w_ptr"))
    wide = rows.select("*", row_pointer().alias("__ptr"))
    if n_pointers is None:
        (key,) = keys
        same = wide["__ptr"].bitwiseXOR(chosen["__w_ptr"]) == 0    # no join key: buckets are by key
        joined = wide.join(chosen.hint("shuffle_hash"),
                           (wide[key] == chosen[rename[key]]) & same)
    else:
        same = wide["__ptr"] == chosen["__w_ptr"]
        for c, w in rename.items():
            same = same & wide[c].eqNullSafe(chosen[w])
        joined = wide.join(F.broadcast(chosen) if n_pointers <= broadcast_rows else chosen, same)
    return joined.select(*columns)
