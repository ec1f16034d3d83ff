"""The first n rows of a sorted table without gathering them, for a large n.

`orderBy().limit(n)` brings n rows into one task.  Here a cut-off is searched instead: a
percentile sketch cuts the open rows into slots along the sort value, as in `ranking`,
the slots are counted, and the one in which the n-th row lies is the next round's open
range.  Each round shrinks it by the number of slots, whatever the distribution, since
boundaries are values of the open rows and have slots of their own.  A slot of one value
goes on with the next sort column.  The result is a filter on the stored table, plus a
last slot of few rows that is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from orderlens.operators.durable import Scratch
from orderlens.operators.ranking import _boundaries, _literals, _with_slot

#: Rows of the last slot, which one task sorts, and slots per round.
FEW_ROWS = 100_000
SLOTS = 1_000

_SORTABLE = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp")


def first_rows(
    df: DataFrame, n: int, order: list[tuple[str, bool]], final: list[Column] | None = None,
    held: Scratch | None = None, few: int = FEW_ROWS, slots: int = SLOTS,
) -> DataFrame:
    """The `n` first rows (or all, if fewer) by `order`: pairs of a column and whether it falls.

    Nulls are less than any value.  The columns are numbers, dates or timestamps; `final`
    sorts the last slot and may refine `order` by others.  Rows that tie in all of `order`
    are taken at random, by one task, so it should end in a key.  The result is not sorted.

    Runs jobs: `df` is stored, then two per round and one or two rounds per column.  The
    stored rows go with `held`, or when the application ends.
    """
    for name, _ in order:
        if not df.schema[name].dataType.simpleString().startswith(_SORTABLE):
            raise ValueError(f"no cut-off can be searched along {name}: not a number, date or timestamp")
    rows, size = (held or Scratch()).counted(df)
    if size <= n:
        return rows
    kept, open_, left = F.lit(False), F.lit(True), n
    final = final or [F.desc(name) if falls else F.asc(name) for name, falls in order]
    for name, falls in order:
        single = False
        while left and size > max(few, left) and not single:
            before, inside, left, size, single = _round(rows, open_, name, falls, left, slots)
            kept, open_ = kept | (open_ & before), open_ & inside
        if left and size > max(few, left) and single:
            continue
        break
    if not left:
        return rows.filter(kept)
    if size == left:
        return rows.filter(kept | open_)
    last = rows.filter(open_).orderBy(*final).limit(left)
    return rows.filter(kept).unionByName(last)


def _round(
    rows: DataFrame, open_: Column, name: str, falls: bool, left: int, slots: int
) -> tuple[Column, Column, int, int, bool]:
    """(rows before the slot of the `left`-th open row, that slot, its number there, its
    size, whether it holds one value)."""
    candidates = rows.filter(open_)
    kind = rows.schema[name].dataType.simpleString()
    cuts = candidates.agg(_boundaries(name, slots).alias("cuts")).first().cuts or []
    slotted = _with_slot(candidates, name, _literals(cuts, kind), slots)
    # At most twice as many rows as boundaries: the null slot is -1.
    counted: list[Row] = (
        slotted.groupBy(F.when(F.col(name).isNull(), -1).otherwise(F.col("_slot")).alias("slot"))
        .agg(F.count(F.lit(1)).alias("rows")).collect()
    )
    above = 0
    for slot, size in sorted(counted, reverse=falls):
        if above + size >= left:
            break
        above += size
    below, inside, beyond = _ranges(F.col(name), slot, [F.lit(cut).cast(kind) for cut in cuts])
    return beyond if falls else below, inside, left - above, size, slot % 2 == 1


def _ranges(value: Column, slot: int, cuts: list[Column]) -> tuple[Column, Column, Column]:
    """Tests, never null, for values below a slot, in it, and above it."""
    there = value.isNotNull()
    if slot < 0:
        return F.lit(False), ~there, there
    low = cuts[slot // 2 - 1] if slot > 1 else None
    if slot % 2:
        at = cuts[slot // 2]
        return ~there | (value < at), there & (value == at), there & (value > at)
    high = cuts[slot // 2] if slot // 2 < len(cuts) else None
    over = F.lit(False) if high is None else there & (value >= high)
    under = ~there if low is None else ~there | (value <= low)
    return under, ~under & ~over, over
