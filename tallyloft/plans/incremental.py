"""Facts loaded month by month: only months whose inputs changed are computed and written, and keys once given stay.

A load compares digests of its inputs per order month (one narrow scan, one row per month) with those of the load before, and the members
of the dimensions with those it wrote: a month with a line of a member that came, went or changed differs too. The months that differ replace their folders by dynamic partition overwrite. Known rows keep their key; new ones continue from the greatest key given so
far. The months' digests are written last, one file a load, and the newest one tells readers which months exist, so a month that
lost all its orders disappears although its folder stays. A load that broke off has written no digests: the next one does its months again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloft.operators.joins import attach
from tallyloft.operators.keys import dense_key
from tallyloft.session import STORED, stage

MONTH = ["year", "month"]
_STATE = "load int, year int, month int, row_count bigint, hash_sum decimal(38,0), hash_xor bigint, top_key bigint"

Months = list[tuple[int, int]]
# Rows of a dimension, the columns of its key, and those of the inputs that refer to it.
Member = tuple[DataFrame, list[str], list[str]]


def with_month(df: DataFrame, day: str = "order_date") -> DataFrame:
    return df.withColumns({"year": F.year(day), "month": F.month(day)})


def in_months(months: Months, year: Column | None = None, month: Column | None = None) -> Column:
    """Months are few, some twelve a year, so the list of them is a filter that prunes folders."""
    number = (F.col("year") if year is None else year) * 100 + (F.col("month") if month is None else month)
    return number.isin([y * 100 + m for y, m in months])


def _nulls(columns: list[str]) -> Column:
    """Where the NULLs are: they leave a hash as it is."""
    return F.concat(*[F.col(c).isNull().cast("int") for c in columns])


def month_digests(inputs: DataFrame, day: str = "order_date") -> DataFrame:
    """Per month of ``day``: rows, and sum and exclusive or of the hashes of all columns. The order of rows does not matter."""
    hashed = with_month(inputs, day).select(*MONTH, F.xxhash64(*inputs.columns).alias("h"))
    return hashed.groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("h").cast("decimal(38,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("h").alias("hash_xor"))


def same_row(names: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in names])


def continued_keys(df: DataFrame, known: DataFrame, identity: list[str], name: str, top: int) -> DataFrame:
    """``df`` with key ``name``: that of the ``known`` row of the same ``identity`` (unique on both sides), else the next ones after ``top``."""
    rows = stage(df, f"unkeyed-{name}")
    kept = known.select(*identity, name)
    met = rows.alias("n").join(kept.alias("k"), same_row(identity, "n", "k"), "left").select("n.*", f"k.{name}")
    new = dense_key(met.where(F.col(name).isNull()).drop(name), identity, name)
    return met.where(F.col(name).isNotNull()).unionByName(new.withColumn(name, F.col(name) + top))


def with_key_state(after: DataFrame, before: DataFrame, identity: list[str], key: str, first: str) -> DataFrame:
    """``after`` with ``key_state``: by the rows of ``before`` of the same identity, whose key ``first`` names, 'kept', 'lost' or, without one, 'new'.

    A left join on the identity, of which only its first column, a 64-bit hash of the others and the keys travel. Each other state is then
    looked up by the row's own ``key``, which must be unique in ``after``, as ``first`` in ``before``.
    """
    head, *rest = identity
    code = F.xxhash64(*rest, _nulls(rest)).alias("_code")
    met = after.select(head, code, key).alias("a").join(
        before.select(head, code, first).alias("b"), same_row([head, "_code"], "a", "b"), "left")
    state = F.when(F.col(first).isNull(), "new").when(F.col(first) == F.col(key), "kept").otherwise("lost")
    states = stage(met.select(key, state.alias("key_state")), f"states-{key}")
    other = stage(states.where("key_state <> 'kept'").select(key).distinct(), f"other-{key}")
    found = attach(states, other, key).groupBy(key).agg(F.collect_list("key_state").alias("_states"))
    told = attach(after, found, key, "left")
    return told.withColumn("key_state", F.explode(F.coalesce("_states", F.array(F.lit("kept"))))).drop("_states")


def _code(number: int, columns: list[str]) -> Column:
    """One number per key, as texts, so that columns of other integer types agree."""
    return F.xxhash64(F.lit(number), *[F.col(c).cast("string") for c in columns])


def member_digests(members: list[Member]) -> DataFrame:
    """Per key of each dimension: rows, and the sum of the hashes of what its rows hold."""
    hashed = [rows.select(_code(n, key).alias("code"), F.xxhash64(*rows.columns, _nulls(rows.columns)).alias("h"))
              for n, (rows, key, _) in enumerate(members)]
    return reduce(DataFrame.unionByName, hashed).groupBy("code").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("h").cast("decimal(38,0)")).cast("decimal(38,0)").alias("hash_sum"))


def months_of(inputs: DataFrame, members: list[Member], codes: DataFrame) -> set[tuple[int, int]]:
    """The months of the lines that meet a member of these ``codes``."""
    if codes.isEmpty():
        return set()
    lines, met = with_month(inputs), set()
    for n, (_, _, names) in enumerate(members):
        found = attach(lines.select(*MONTH, _code(n, names).alias("code")), codes, "code").select(*MONTH).distinct()
        met.update((r.year, r.month) for r in found.collect())
    return met


class MonthlyFact:
    """A fact in folders per order month, with the state of its last load."""

    def __init__(self, spark: SparkSession, path: str, key: str, identity: list[str]):
        self.spark, self.path, self.key, self.identity = spark, path.rstrip("/"), key, identity

    def state(self) -> list:
        """The months of the newest load."""
        try:
            all_loads = self.spark.read.schema(_STATE).parquet(f"{self.path}/loads")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        newest = all_loads.agg(F.max("load")).first()[0]
        return all_loads.where(F.col("load") == newest).collect() if newest else []

    def read(self, months: Months | None = None) -> DataFrame:
        live = [(r.year, r.month) for r in self.state() if r.year is not None]
        shown = live if months is None else [m for m in live if m in months]
        return self.spark.read.parquet(f"{self.path}/months").where(in_months(shown))

    def _touched(self, inputs: DataFrame, members: list[Member], load: int) -> set[tuple[int, int]]:
        """Writes the members' digests of this load; the months of the lines whose members differ from those of the load before."""
        path = f"{self.path}/members/load="
        member_digests(members).write.mode("overwrite").parquet(f"{path}{load}")
        now = self.spark.read.parquet(f"{path}{load}")
        try:
            then = self.spark.read.schema(now.schema).parquet(f"{path}{load - 1}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            then = now.limit(0)  # the first load, or one before members were kept
        measured = [c for c in now.columns if c != "code"]
        differ = now.alias("n").join(then.alias("t"), "code", "full").where(~same_row(measured, "n", "t")).select("code")
        return months_of(inputs, members, stage(differ, f"differ-{self.key}")) if load > 1 else set()

    def load(self, inputs: DataFrame, rows_of: Callable[[Months], DataFrame], check: Callable[[DataFrame], None] | None = None,
             finish: Callable[[DataFrame], DataFrame] = lambda df: df, ranged: Callable[[], bool] = lambda: False,
             members: list[Member] = ()) -> Months:
        """Bring the fact up to date and return the months written.

        ``inputs`` and ``members`` hold all that the fact is made from, the inputs with ``order_date``. ``rows_of`` makes the fact's rows of some months, with year
        and month and without key; ``check`` sees them with their keys before they are written, and raises to stop the load. ``finish`` adds
        columns that follow from a row's others, in the tasks that write it; the identity and the key stay. ``ranged`` says that the rows lie in
        ranges of the identity's first column, as ``dense_key`` takes them.
        """
        before = self.state()
        old = {(r.year, r.month): (r.row_count, r.hash_sum, r.hash_xor) for r in before if r.year is not None}
        found = month_digests(inputs).where("year IS NOT NULL").collect()
        now = {(r.year, r.month): (r.row_count, r.hash_sum, r.hash_xor) for r in found}
        load = max([r.load for r in before], default=0) + 1
        touched = self._touched(inputs, members, load) if members else set()
        changed = sorted(m for m, digest in now.items() if old.get(m) != digest or m in touched)
        gone = sorted(set(old) - set(now))
        top = max([r.top_key for r in before], default=0)
        if changed:
            rows = rows_of(changed)
            if before:
                known = stage(self.read([*changed, *gone]).select(*self.identity, self.key), f"known-{self.key}")
                keyed = stage(continued_keys(rows, known, self.identity, self.key, top), f"keyed-{self.key}")
            else:
                # Written rows and a count per part of them: read again rather than written again.
                keyed = dense_key(rows, self.identity, self.key, ranged=ranged())
            if check:
                check(keyed)
            top = max(top, keyed.agg(F.max(self.key)).first()[0] or 0)
            # Keys given by a load that broke off are met again, as its months still differ.
            (finish(keyed.hint("rebalance", *MONTH))
             .write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression=STORED).partitionBy(*MONTH).parquet(f"{self.path}/months"))
        if changed or gone:
            rows = [(load, *m, *digest, top) for m, digest in now.items()] or [(load, None, None, 0, None, 0, top)]
            self.spark.createDataFrame(rows, _STATE).coalesce(1).write.mode("append").parquet(f"{self.path}/loads")
        return changed
