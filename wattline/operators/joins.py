"""Joins of a large fact frame with a per-key frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 64 << 20
SALTS = 16
FILTER_BITS = 24


def join_per_key(
    facts: DataFrame,
    per_key: DataFrame,
    on: list[str],
    how: str,
    spread: Column,
    *,
    rows: int | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``facts`` with a frame that has few rows per key.

    ``rows`` is an upper bound of the right side's row count (counted here when not given). While these rows
    take at most ``max_broadcast_bytes`` (see ``row_bytes``) the right side is broadcast and the facts are not
    shuffled. Beyond that both sides are shuffled on the key plus a salt: a key holding a large share of all facts
    is spread over ``salts`` tasks by ``spread`` (a column that varies within a key), while the
    right side is repeated once per salt. Salting is explicit because the runtime skew split is
    skipped when the next step groups by the join key.
    """
    bound = per_key.count() if rows is None else rows
    if bound * row_bytes(per_key) <= max_broadcast_bytes:
        return facts.join(F.broadcast(per_key), on, how)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # the hint keeps Spark from broadcasting the copies by its own limit
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")


def row_bytes(df: DataFrame) -> int:
    """A generous size of one row in memory: 64 bytes per text, 16 per other value, and the row itself."""
    return 32 + sum(64 if f.dataType.simpleString() == "string" else 16 for f in df.schema.fields)


def possible_matches(facts: DataFrame, keys: DataFrame, on: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``facts`` whose key may be among ``keys``: all that are, and of the others a share of at most the number of
    keys over 2 to the power ``bits``. The facts are not shuffled.

    The keys become a bitmap of hashes, kept as one row per 64 bits, which is broadcast: never more than 2 to the power ``bits`` - 6
    rows (262,144 as a rule), however many keys there are. Nulls in a key are equal.
    """
    spot = F.pmod(F.xxhash64(*on), F.lit(1 << bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(spot, F.lit(64)).cast("int"))
    words = keys.groupBy(F.shiftright(spot, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    marked = facts.withColumn("_word", F.shiftright(spot, 6))
    return marked.join(F.broadcast(words), "_word").where(F.col("_bits").bitwiseAND(bit) != 0).select(*facts.columns)
