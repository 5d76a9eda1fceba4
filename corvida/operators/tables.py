"""Row-level operators on keyed tables: fill, overlay, upsert, first and last wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvida.functions.text import is_blank
from corvida.session import checkpointed


def wins(df: DataFrame, key: list[str], order: list, last: bool = True) -> DataFrame:
    """One row for each key: the last (or first) in order. A combining aggregate, no window over whole groups."""
    rest = [c for c in df.columns if c not in key]
    pick = F.max_by if last else F.min_by
    chosen = df.groupBy(*key).agg(pick(F.struct(*rest), F.struct(*order)).alias("row"))
    return chosen.select(*key, *(F.col("row")[c].alias(c) for c in rest))


def fill(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Left outer join: the fields of a matched row are replaced, by null too; others keep theirs."""
    other = right.select(F.col(key), F.lit(True).alias("_matched"), *(F.col(f).alias(f"_{f}") for f in fields))
    joined = left.join(other, key, "left")
    keep = [c for c in left.columns if c not in fields]
    return joined.select(*keep, *(F.when(F.col("_matched"), F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in fields))


def extend(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Left outer join that fills only blank fields, so that earlier joins have priority."""
    other = right.select(F.col(key), *(F.col(f).alias(f"_{f}") for f in fields))
    keep = [c for c in left.columns if c not in fields]
    return left.join(other, key, "left").select(*keep, *(F.when(is_blank(F.col(f).cast("string")), F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in fields))


def overlay(base: DataFrame, edits: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Edits win where they are not blank; keys unknown to the base are ignored. Adds `touched`."""
    other = edits.select(F.col(key), *(F.col(f).alias(f"_{f}") for f in fields))
    given = {f: ~is_blank(F.col(f"_{f}")) for f in fields}
    touched: Column = F.lit(False)
    for g in given.values():
        touched = touched | g
    keep = [c for c in base.columns if c not in fields]
    joined = base.join(other, key, "left")
    return joined.select(*keep, *(F.when(given[f], F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in fields), touched.alias("touched"))


def upsert(old: DataFrame, new: DataFrame, key: str, replaced: list[str], protected: list[str]) -> DataFrame:
    """MERGE with deletion of orphans: rows of new, the protected columns kept from old; `change` says what happened.

    Orphans come out as 'deleted', so that a caller can warn of reviewed ones before dropping them.
    """
    a = old.select(F.col(key), F.lit(True).alias("_old"), *(F.col(c).alias(f"_o_{c}") for c in [*replaced, *protected]))
    b = new.select(F.col(key), F.lit(True).alias("_new"), *(F.col(c).alias(f"_n_{c}") for c in replaced))
    joined = a.join(b, key, "full")
    change = F.when(F.col("_new").isNull(), "deleted").when(F.col("_old").isNull(), "inserted").otherwise("updated")
    return joined.select(
        key, *(F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c) for c in replaced), *(F.col(f"_o_{c}").alias(c) for c in protected), change.alias("change")
    )


def first_of(*candidates: Column) -> Column:
    """The first candidate that is not blank."""
    return F.coalesce(*(F.when(~is_blank(c), c) for c in candidates))


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """The rows with their number from 0 in the given order.

    Rows are range-sorted over all tasks, numbered within each range, and moved on by the rows of the ranges before:
    only one row a range meets in one task. The sorted rows are kept in the checkpoint folder, so both looks at them
    see the same ranges.
    """
    row_bits = 33  # of monotonically_increasing_id; the bits above are the range's
    ranged = checkpointed(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_range", F.shiftright("_at", row_bits))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_at") - F.shiftleft(F.col("_range"), row_bits)
    return ranged.join(offsets, "_range").withColumn(name, number).drop("_at", "_range", "_before")
