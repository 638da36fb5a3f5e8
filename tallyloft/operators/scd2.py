"""Type-2 history: one row per key and period of unchanged attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloft.operators.joins import attach

VALID_FROM, VALID_TO, CURRENT = "valid_from", "valid_to", "is_current"


def opening(snapshot: DataFrame, as_of: str) -> DataFrame:
    return snapshot.select(
        "*", F.lit(as_of).cast("date").alias(VALID_FROM), F.lit(None).cast("date").alias(VALID_TO),
        F.lit(True).alias(CURRENT))


def apply_snapshot(history: DataFrame, snapshot: DataFrame, key: str, tracked: list[str], as_of: str) -> DataFrame:
    """Fold a snapshot taken on ``as_of`` into the history.

    A change in a tracked column closes the open version and opens a new one; other columns are overwritten in the
    open version. A repeated or late snapshot row changes nothing; a key missing from the snapshot stays as it is; NULL is a key
    like others. One join; the key is unique on both sides of it, so it cannot be skewed.
    """
    day = F.lit(as_of).cast("date")
    columns = history.columns
    attributes = [c for c in columns if c not in (VALID_FROM, VALID_TO, CURRENT)]
    closed = history.where(~F.col(CURRENT))
    current = history.where(F.col(CURRENT)).select(F.col(key).alias("_key"), F.struct(*columns).alias("_old"))
    incoming = snapshot.select(F.col(key).alias("_in_key"), F.struct(*attributes).alias("_in"))
    both = current.join(incoming, F.col("_key").eqNullSafe(F.col("_in_key")), "full_outer")

    changed = reduce(
        lambda a, b: a | b, [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_in.{c}")) for c in tracked])
    is_new = F.col("_old").isNull()
    seen = ~is_new & F.col("_in").isNotNull()
    replaces = seen & changed & (day > F.col(f"_old.{VALID_FROM}"))
    overwrites = seen & ~changed & (day >= F.col(f"_old.{VALID_FROM}"))

    def attribute(c: str) -> Column:
        return F.col(f"_old.{c}") if c in tracked else F.when(overwrites, F.col(f"_in.{c}")).otherwise(F.col(f"_old.{c}"))

    kept = F.struct(
        *[attribute(c).alias(c) for c in attributes],
        F.col(f"_old.{VALID_FROM}").alias(VALID_FROM),
        F.when(replaces, day).alias(VALID_TO),
        (~replaces).alias(CURRENT))
    opened = F.struct(
        *[F.col(f"_in.{c}").alias(c) for c in attributes],
        day.alias(VALID_FROM), F.lit(None).cast("date").alias(VALID_TO), F.lit(True).alias(CURRENT))
    versions = F.when(is_new, F.array(opened)).when(replaces, F.array(kept, opened)).otherwise(F.array(kept))
    return both.select(F.inline(versions)).select(*columns).unionByName(closed)


# Days on which a version was seen, with what else was seen then: a late snapshot needs them to know what it splits.
SEEN = "seen_on"


def merged(snapshots: DataFrame, key: str, tracked: list[str], day: str, history: DataFrame | None = None) -> DataFrame:
    """History of any number of snapshots, taken on ``day`` (a column), in any order and in one pass.

    Gaps and islands: per key the snapshot rows are put in order of their day, and neighbours with equal tracked columns are one
    version. ``history``, a result of this function, goes in as the days on which its versions were seen, so a late snapshot splits a
    version or shifts its start, and the result is that of all snapshots at once. Other columns come from the version's last day. Of several rows
    of a key and day the greatest counts. Rows without a day are left out; a key missing from a snapshot stays as it is; NULL is a key like others.
    """
    plain = [c for c in snapshots.columns if c != day]
    others = [c for c in plain if c != key]
    untracked = [c for c in others if c not in tracked]
    rows = snapshots.select(*plain, F.col(day).cast("date").alias("_day")).where("_day IS NOT NULL")
    if history is not None:
        # Keys that no new snapshot names keep their versions as they are.
        touched = rows.select(F.col(key).alias("_key")).distinct()
        met = F.col(key).eqNullSafe(F.col("_key"))
        seen = history.join(touched, met, "left_semi").select(key, *tracked, F.inline(SEEN))
        rows = rows.unionByName(seen)
    # An aggregate first: a key and day that comes many times, NULL among them, collapses before the shuffle.
    once = rows.groupBy(key, "_day").agg(F.max(F.struct(*others)).alias("_row"))
    in_order = Window.partitionBy(key).orderBy("_day")
    state = F.struct(*[F.col(f"_row.{c}").alias(c) for c in tracked])
    opens = F.coalesce((~state.eqNullSafe(F.lag(state).over(in_order))), F.lit(True))
    first = F.row_number().over(in_order) == 1
    islands = once.withColumn("_opens", F.when(first | opens, 1).otherwise(0)).withColumn("_island", F.sum("_opens").over(in_order))
    versions = islands.groupBy(key, "_island").agg(
        F.min("_day").alias(VALID_FROM), F.max_by("_row", "_day").alias("_row"),
        F.array_sort(F.collect_list(F.struct("_day", *[F.col(f"_row.{c}").alias(c) for c in untracked]))).alias(SEEN))
    following = F.lead(VALID_FROM).over(Window.partitionBy(key).orderBy(VALID_FROM))
    done = versions.withColumn(VALID_TO, following).select(
        *[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in plain], VALID_FROM, VALID_TO, F.col(VALID_TO).isNull().alias(CURRENT), SEEN)
    if history is None:
        return done
    return done.unionByName(history.join(touched, met, "left_anti").select(*done.columns))


def valid_on(
    facts: DataFrame, history: DataFrame, key: str, day: str, attributes: list[str], rows: int | None = None, **sizes
) -> DataFrame:
    """``facts`` with the attributes of the version valid on their ``day``, NULL where there was none yet.

    The versions of a key are packed into one row, so the interval join is a join on the key alone (broadcast, shuffled or salted as
    its size asks for) and the day picks the version inside the row: no fact meets more than its own key's versions, of which there are
    at most as many as snapshots.
    """
    packed = history.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(VALID_FROM, VALID_TO, *attributes))).alias("_versions"))
    met = attach(facts, packed, key, "left", rows=rows, **sizes)
    on = F.col(day)
    valid = F.filter("_versions", lambda v: (v[VALID_FROM] <= on) & (v[VALID_TO].isNull() | (on < v[VALID_TO])))
    return met.withColumn("_version", F.get(valid, 0)).select(*facts.columns, "_version.*").drop(VALID_TO)
