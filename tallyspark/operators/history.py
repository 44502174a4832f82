"""Type-2 history with half-open validity intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .conform import eligible
from .purchases import latest


def _hashed(changes: DataFrame, attributes: list[str]) -> DataFrame:
    return changes.withColumn("attribute_hash", F.sha2(F.to_json(F.struct(*attributes)), 256))


def build_history(changes: DataFrame, keys: list[str], attributes: list[str], effective: str, ties: list[str]) -> DataFrame:
    """One row per run of equal attributes of a key: valid from its first change to the next row's.

    Of changes at one instant the one with the greatest tie breakers counts (nulls lowest).
    """
    once = latest(_hashed(changes, attributes), [*keys, effective], [F.col(c) for c in ties])
    # One change per instant is left, so the instant alone orders a key's changes.
    w = Window.partitionBy(*keys).orderBy(effective)
    runs = once.withColumn("_before", F.lag("attribute_hash").over(w)).where("_before is null or _before <> attribute_hash").drop("_before")
    return runs.withColumn("valid_to", F.lead(effective).over(w)).withColumn("is_current", F.col("valid_to").isNull())


def splice(kept: DataFrame | None, changes: DataFrame, keys: list[str], attributes: list[str], effective: str, ties: list[str]) -> DataFrame:
    """The rows of a kept history that changes alter or add, in any order of arrival; (keys, effective) name a row.

    A kept history has the winning change of every instant, with ``starts`` (it begins a run of equal attributes) and, for
    those that do, ``valid_to``; so a late change finds the equal changes that its neighbours repeat. A new instant alters
    three rows at most: itself, the run it falls into, and the next instant. Of a key are read, besides its runs'
    beginnings, the instants from the run before its first change to the run after its last. Changes without an instant
    take no part; one that is there already alters nothing; without a kept history all rows are new.
    """
    new = _hashed(changes.where(F.col(effective).isNotNull()), attributes)
    columns, at = new.columns, F.col(effective)
    new = latest(new, [*keys, effective], [F.col(c) for c in ties]).withColumns({"_was": F.lit(None).cast("struct<starts: boolean, valid_to: timestamp>"), "_end": F.lit(None).cast("timestamp")})
    if kept is not None:
        named = [F.col(k).alias(f"_key_{k}") for k in keys]
        spans = new.groupBy(*named).agg(F.min(effective).alias("_low"), F.max(effective).alias("_high"))
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
        after = F.min(F.when(at > F.col("_high"), F.struct(at.alias("at"), F.col("valid_to").alias("end"))))
        ends = kept.where("starts").join(spans, same).groupBy(*[f"_key_{k}" for k in keys]).agg(F.max(F.when(at < F.col("_low"), at)).alias("_from"), after.alias("_next"))
        near = kept.join(ends, same).where((at >= F.coalesce("_from", at)) & (at <= F.coalesce("_next.at", at)))
        held = near.select(*columns, F.struct("starts", "valid_to").alias("_was"), F.when(at == F.col("_next.at"), F.col("_next.end")).alias("_end"))
        new = held.unionByName(new)
    row = F.struct(*columns, F.col("_was").isNull().alias("_new"))
    rank = F.struct(*ties, F.col("_was").isNotNull())
    once = new.groupBy(*[F.col(c).alias(f"_by_{c}") for c in (*keys, effective)]).agg(
        F.max_by(row, rank).alias("_row"), F.first("_was", ignorenulls=True).alias("_was"), F.first("_end", ignorenulls=True).alias("_end")
    )
    w = Window.partitionBy(*keys)
    before = F.lag("attribute_hash").over(w.orderBy(effective))
    marked = once.select("_row.*", "_was", "_end").withColumn("starts", before.isNull() | (before != F.col("attribute_hash")))
    # From the last instant back, the next beginning is a running minimum; past the slice the old end of its last row holds.
    back = w.orderBy(at.desc())
    following = F.min(F.when(F.col("starts"), at)).over(back.rowsBetween(Window.unboundedPreceding, -1))
    end = F.first("_end").over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = marked.withColumn("valid_to", F.when(F.col("starts"), F.coalesce(following, end)))
    altered = F.col("_new") | ~F.struct("starts", "valid_to").eqNullSafe(F.col("_was"))
    return marked.where(altered).select(*columns, "starts", "valid_to")


def runs(kept: DataFrame) -> DataFrame:
    """The history rows of a kept history, as ``build_history`` gives them."""
    return kept.where("starts").drop("starts").withColumn("is_current", F.col("valid_to").isNull())


def customer_changes(bronze: DataFrame) -> DataFrame:
    """Typed change events of customers."""
    p = F.col("payload")
    return eligible(bronze, ["customer.changed"]).select(
        *[p[n].alias(n) for n in ("customer_id", "email_token", "country", "customer_tier")],
        (p["op"] == "d").alias("is_deleted"),
        F.col("occurred_at").alias("valid_from"),
        F.col("event_id").alias("source_event_id"),
        p["source_lsn"].try_cast("long").alias("source_lsn"),
        "source_partition",
        "source_offset",
    )


#: Keys, attributes, instant and tie breakers of customer history; a deletion is an attribute like others.
CUSTOMERS = (["customer_id"], ["email_token", "country", "customer_tier", "is_deleted"], "valid_from", ["source_lsn", "source_partition", "source_offset"])


def customer_history(bronze: DataFrame) -> DataFrame:
    """Customer history from change events."""
    return build_history(customer_changes(bronze), *CUSTOMERS).drop("source_partition", "source_offset")


def overlaps(history: DataFrame, key: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Rows that begin before an earlier row of the key has ended (an open row never ends).

    The greatest end among strictly earlier rows decides, so a hot key is read once, not joined with itself.
    """
    far = F.lit("9999-12-31").cast("timestamp")
    earlier = Window.partitionBy(key).orderBy(F.unix_micros(F.col(start).cast("timestamp"))).rangeBetween(Window.unboundedPreceding, -1)
    latest_end = F.max(F.coalesce(F.col(end).cast("timestamp"), far)).over(earlier)
    return history.withColumn("_end", latest_end).where(F.col("_end") > F.col(start).cast("timestamp")).drop("_end")
