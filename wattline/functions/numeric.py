from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_double(text: Column) -> Column:
    """Trimmed text as double; unparsable text is null."""
    return F.trim(text).try_cast("double")


def half_up(x: Column, digits: int) -> Column:
    """Round half away from zero, where a value within 1e-9 below a tie counts as the tie.

    Decimal ties such as 32.0425 are mostly not exact as doubles; the nudge makes 32.043 of it in every
    engine that rounds. Infinite values and NaN pass through.
    """
    return F.round(x + F.signum(x) * 1e-9, digits)


def milli(x: Column) -> Column:
    """A non-negative value of at most three fractional digits as a whole number of thousandths.

    Sums of these are exact, so they do not depend on the order in which tasks finish.
    """
    return F.floor(x * 1000.0 + 0.5)
