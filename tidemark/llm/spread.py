"""Join many rows with one row per key, where a key may hold any share of the many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts into which the rows of every key are dealt; a key's largest share of one task is 1 / PIECES.
PIECES = 256


def spread_join(many: DataFrame, one: DataFrame, key: str | list[str], by: Column, how: str = "inner", pieces: int = PIECES) -> DataFrame:
    """`many` joined with `one` (unique on `key`, one column or several) without bringing a key's rows together.

    `by` tells the rows of a key apart. Rows are dealt by (key, piece of `by`);
    the pieces that occur, at most `pieces` a key and counted by a combined
    aggregation, take their row of `one`, and each piece meets its own copy.
    Nothing is broadcast and no key is looked for first, so hot keys need no
    threshold and cold ones make one piece each. Rows with a null key meet
    nothing.
    """
    keys = [key] if isinstance(key, str) else list(key)
    dealt = many.withColumn("_piece", F.pmod(F.xxhash64(by), F.lit(pieces)).cast("int"))
    found = dealt.select(*keys, "_piece").dropna(subset=keys).distinct().join(one, keys)
    return dealt.join(found, [*keys, "_piece"], how).drop("_piece")
