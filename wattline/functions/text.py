from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_id(raw: Column) -> Column:
    """Trimmed id without the leading zeros of an all-digit prefix, so both join sides agree.

    The regular expression runs only on ids that start with a zero.
    """
    text = F.trim(raw.cast("string"))
    return F.when(text.startswith("0"), F.regexp_replace(text, r"^0+(?=[0-9])", "")).otherwise(text)


def row_hash(meter_id: Column, time_text: Column) -> Column:
    """64-bit key of meter and time text; all rows lacking either share one constant key."""
    return F.pmod(F.xxhash64(F.concat(meter_id, time_text)), F.lit(2**63 - 1))
