"""Latest version per key, and merging a batch into a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Side = Callable[[str], Column]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark limits each key to one row inside every map task before it shuffles (WindowGroupLimit),
    so a key that holds a large share of all rows costs one row per task, not its whole group.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(newest_first)).filter("_place = 1").drop("_place")


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_when: Callable[[Side, Side], Column] | None = None,
) -> DataFrame:
    """The table after ``batch`` was merged into it: matched rows are replaced, others inserted.

    ``update_when(target, batch)`` restricts the replacement, e.g.
    ``lambda t, b: t("spend") != b("spend")``; where it is false or NULL the target row stays.
    Columns that only the batch has are NULL in the target's rows. Keys must be unique in the batch. A NULL key matches nothing, as in SQL MERGE. The batch is read
    up to three times, so store it first when it is costly to compute.

    Written as anti joins, which can broadcast a batch that Spark has found to be small and then
    never shuffle the table; a full outer join always shuffles every column of both sides.
    """
    t: Side = lambda name: F.col(f"t.{name}")
    b: Side = lambda name: F.col(f"b.{name}")
    added = {f.name: F.lit(None).cast(f.dataType) for f in batch.schema if f.name not in target.columns}
    old, new = (target.withColumns(added) if added else target).alias("t"), batch.alias("b")
    matched = reduce(Column.__and__, [t(k) == b(k) for k in keys])

    if update_when is None:
        return old.join(new, matched, "left_anti").unionByName(batch)

    replaces = F.coalesce(update_when(t, b), F.lit(False))
    untouched = old.join(new, matched & replaces, "left_anti")
    # Keys the batch loses, found from the table's side so that only the batch needs to be small.
    held = old.join(new, matched & ~replaces, "left_semi").select(*keys).alias("h")
    lost = reduce(Column.__and__, [b(k) == F.col(f"h.{k}") for k in keys])
    return untouched.unionByName(new.join(held, lost, "left_anti"))


def is_keyed(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether no two rows share their keys. Only keys are shuffled, counted in the tasks first."""
    return df.groupBy(*keys).count().filter("count > 1").isEmpty()
