"""Bucket numbers for a numeric column, as a plain expression."""

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The three delay rules.  Reports ask for more than 40 minutes;
# bucket 1 of the report and of the training label starts at exactly 40, and the
# training table's own class column starts at 41.
DELAY_MINUTES = 40
REPORT_SPLITS = (0.0, 40.0, math.inf)
LABEL_SPLITS = (0.0, 40.0, math.inf)
CLASS_SPLITS = (0.0, 41.0, math.inf)


def bucketize(
    column: str | Column,
    splits: Sequence[float],
    keep_nan: bool = False,
    strict: bool = False,
) -> Column:
    """Number of the half-open interval ``[splits[i], splits[i+1])`` holding the value.

    The last interval is closed on the right.  Null stays null.  NaN is null, or one
    bucket past the last with ``keep_nan``.  A value outside the splits is null; with
    ``strict`` it (and NaN, unless kept) raises, as the ``pyspark.ml`` stage does.
    Unlike that stage the result stays inside whole-stage codegen.
    """
    if len(splits) < 3 or any(a >= b for a, b in zip(splits, splits[1:])):
        raise ValueError("splits must be at least three increasing numbers")
    x = F.col(column) if isinstance(column, str) else column
    x = x.cast("double")
    last = len(splits) - 2

    if keep_nan:
        nan_value = F.lit(float(last + 1))
    elif strict:
        nan_value = F.raise_error("NaN in bucketed column").cast("double")
    else:
        nan_value = F.lit(None).cast("double")

    # NaN sorts above every number, so it is taken out first.
    chain = F.when(F.isnan(x), nan_value)
    for i in range(last + 1):
        lower, upper = F.lit(splits[i]), F.lit(splits[i + 1])
        inside = (x >= lower) & ((x <= upper) if i == last else (x < upper))
        chain = chain.when(inside, F.lit(float(i)))
    if strict:
        outside = F.raise_error(F.concat(F.lit("outside the splits: "), x.cast("string")))
        chain = chain.when(x.isNotNull(), outside.cast("double"))
    return chain
