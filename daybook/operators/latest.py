"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``order`` values for each combination of ``keys``.

    Equal ``order`` values are decided by ``tiebreak``, then by the columns named in neither,
    so the winner never depends on input order. NULLs rank below any value. NULL keys form
    one group.

    The greatest row is a ``max`` over a struct. Each task keeps one row per key before the
    shuffle, so a key holding a large share of all rows sends at most one row per task, and
    the result stays hash-partitioned by ``keys`` for the joins that follow.
    """
    ranked = list(dict.fromkeys([*order, *(tiebreak or []), *df.columns]))
    ranked = [c for c in ranked if c not in set(keys)]
    newest = F.max(F.struct(ranked)).alias("newest")
    columns = [c if c in keys else f"newest.`{c}`" for c in df.columns]
    return df.groupBy(*keys).agg(newest).select(columns)
