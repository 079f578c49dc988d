"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ways a key of the large side is split; the small side is repeated as often.
SALTS = 16


def salted_join(
    many: DataFrame, few: DataFrame, key: str | list[str], row_key: list[str], salts: int = SALTS
) -> DataFrame:
    """Inner join of many rows per key with one row per key.

    The salt spreads a hot key over several tasks.  It also keeps the join from being clustered
    by the bare key, so a later grouping by that key pre-aggregates and shuffles anew, and
    adaptive execution may split what is still too large.
    """
    spread = many.withColumn("_salt", F.pmod(F.xxhash64(*row_key), F.lit(salts)))
    numbers = F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")
    repeated = few.withColumn("_salt", F.explode(numbers))
    keys = [key] if isinstance(key, str) else key
    return spread.join(repeated, [*keys, "_salt"]).drop("_salt")
