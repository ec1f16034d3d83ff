"""Repeatable row selection and exact-size sampling.

Selection always depends on a key, never on row order or `rand()`, so a retried
task or another engine picks the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators import cutoff
from orderlens.operators.durable import Scratch

_SHARE_STEPS = 1_000_000


def every(key: Column, step: int, offset: int = 0) -> Column:
    """True for keys that leave `offset` when divided by `step`."""
    return F.pmod(key, F.lit(step)) == offset


def share(key: Column, rate: float, seed: str) -> Column:
    """True for about `rate` of all keys; seeds give independent choices."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(_SHARE_STEPS)) < round(rate * _SHARE_STEPS)


def sample_rows(
    df: DataFrame, n: int, key: Column, seed: str, split: bool = False,
    held: Scratch | None = None, few: int = cutoff.FEW_ROWS, slots: int = cutoff.SLOTS,
) -> DataFrame:
    """Exactly `n` rows (or all, if fewer), without replacement.

    A top-n by hashed key: each task keeps n candidates, nothing is sorted whole.
    `split` is for an n too large for one task: jobs search the hash below which n rows
    lie (`cutoff`), and the same rows are taken where they are.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    if not split:
        return df.orderBy(digest, key).limit(n)
    names = ["_digest", "_key", "_high", "_low"]
    high, low = (F.conv(F.substring("_digest", at, 15), 16, 10).cast("bigint") for at in (1, 16))
    hashed = df.withColumns({"_digest": digest, "_key": key}).withColumns({"_high": high, "_low": low})
    order = [("_high", False), ("_low", False)]
    first = cutoff.first_rows(hashed, n, order, [F.col("_digest"), F.col("_key")], held, few, slots)
    return first.drop(*names)


def repeat_rows(df: DataFrame, hit: Column) -> DataFrame:
    """Rows where `hit` holds appear twice, in a single scan."""
    times = F.when(hit, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("_times", F.explode(times)).drop("_times")
