"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1, splits a double into two 26-bit halves
_WHOLE_CENTS = float(2**46)  # from here on neighbouring doubles are further apart than a cent


def round_cents(x: Column) -> Column:
    """Round a double to two decimals the way IEEE-exact rounding does.

    Spark's ``round``/``bround`` look at the shortest decimal text of the double, so 2.675 (stored
    as 2.67499...) becomes 2.68. Here the exact value decides: 2.675 -> 2.67, 0.125 -> 0.12. Only a
    product that lands on .5 can be wrong, and the exact error of that product (Dekker's two-product)
    tells on which side of the tie the stored value lies.
    """
    scaled = x * F.lit(100.0)
    head = x * F.lit(_SPLIT) - (x * F.lit(_SPLIT) - x)
    error = (head * F.lit(100.0) - scaled) + (x - head) * F.lit(100.0)
    nearest = F.rint(scaled)
    cents = F.when(
        F.abs(scaled - nearest) == 0.5,
        F.when(error > 0, scaled + 0.5).when(error < 0, scaled - 0.5).otherwise(nearest),
    ).otherwise(nearest)
    return F.when(F.abs(x) < _WHOLE_CENTS, cents / F.lit(100.0)).otherwise(x)
