"""Plan-shape helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def materialized(df: DataFrame) -> DataFrame:
    """Evaluate ``df``'s columns once, below any later filter.

    Catalyst pushes a filter on a derived column down through the projection
    by substituting the column's expression; for regex chains or higher-order
    lambdas that duplicates (or, inside a lambda, multiplies) the work.  A
    filter on the output of a generator is not pushed below it, so routing
    the row through ``inline(array(struct(...)))`` keeps one evaluation.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
