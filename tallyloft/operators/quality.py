"""Data-quality checks. Each returns its findings as rows; none of them collects data."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.schemas import DICTIONARY

NULL_LIMIT = 0.02
CHECK_COLUMNS = ["model", "check", "detail", "violations", "status"]


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, row_count, null_count), all columns in one pass."""
    columns = columns or df.columns
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    return one.select(F.col("_rows").alias("row_count"), F.inline(pairs)).select("column_name", "row_count", "null_count")


def null_rates(df: DataFrame, limit: float = NULL_LIMIT, columns: list[str] | None = None) -> DataFrame:
    rate = F.try_divide(F.col("null_count").cast("double"), F.col("row_count").cast("double"))
    return null_counts(df, columns).withColumn("null_rate", F.coalesce(rate, F.lit(0.0))).withColumn(
        "passed", (F.col("null_rate") < limit).cast("int"))


def measures(df: DataFrame) -> list[Column]:
    """Rows and NULLs per column, for ``DataFrame.observe``: counted by the job that writes the table, without a read of their own."""
    return [F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]]


def broken_limits(model: str, measured: dict[str, int], required: list[str], nullable: list[str], limit: float = NULL_LIMIT) -> list[str]:
    """What measured NULLs break: any in a required column, ``limit`` of the rows or more in others that are not ``nullable``."""
    rows, found = measured["_rows"], []
    for column, nulls in measured.items():
        if column == "_rows" or not nulls:
            continue
        if column in required:
            found.append(f"{model}.not_null({column}): {nulls}")
        elif column not in nullable and nulls >= limit * rows:
            found.append(f"{model}.null_rate({column}): {nulls} of {rows}")
    return found


def orphans(fact: DataFrame, fk: str, dim: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a row in the dimension, with the number of fact rows behind each.

    The keys are counted first, so the anti join sees each of them once however often it occurs.
    """
    used = fact.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("key_value")).agg(F.count(F.lit(1)).alias("row_count"))
    return used.join(dim.select(F.col(key).alias("key_value")), "key_value", "left_anti")


def missing_rates(sales: DataFrame, rates: DataFrame) -> DataFrame:
    used = sales.groupBy("currency_code", F.col("order_date").alias("date_key")).agg(F.count(F.lit(1)).alias("row_count"))
    return used.join(rates.select("currency_code", "date_key"), ["currency_code", "date_key"], "left_anti")


def lost_rows(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Business keys whose row counts differ between two layers (copies count)."""
    a = before.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_before"))
    b = after.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_after"))
    counted = a.join(b, keys, "full_outer").fillna(0, ["rows_before", "rows_after"])
    return counted.where("rows_before <> rows_after")


def lost_row_contents(before: DataFrame, after: DataFrame) -> DataFrame:
    """Whole rows of ``before`` that ``after`` lacks, copies counted."""
    return before.exceptAll(after.select(*before.columns))


def domain_reason(
    domains: dict[str, list[str]], required: list[str], field: Callable[[str], Column] = F.col
) -> Column:
    """First reason a row breaks its contract, NULL for a sound row."""
    checks = [F.when(field(c).isNull(), F.lit(f"{c} missing")) for c in required]
    checks += [F.when(~field(c).isin(values), F.lit(f"{c} not allowed")) for c, values in domains.items()]
    return F.coalesce(*checks)


def split_by_domain(df: DataFrame, domains: dict[str, list[str]], required: list[str]) -> tuple[DataFrame, DataFrame]:
    judged = df.withColumn("reason", domain_reason(domains, required))
    return judged.where("reason IS NULL").drop("reason"), judged.where("reason IS NOT NULL")


def _plain(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", ""))


def dictionary_coverage(
    tables: dict[str, DataFrame], dictionary: DataFrame | None = None, with_values: bool = False
) -> DataFrame:
    """Documented fields against real columns, from the schemas alone.

    Names are compared without case, blanks and underscores. ``with_values`` adds how many values each column
    holds, which reads the tables.
    """
    any_df = next(iter(tables.values()))
    if dictionary is None:
        pairs = [(t, f) for t, fields in DICTIONARY.items() for f in fields]
        dictionary = any_df.sparkSession.createDataFrame(pairs, "table_name string, field_name string")
    documented = dictionary.select(_plain(F.col("table_name")).alias("t"), _plain(F.col("field_name")).alias("f"),
                                   F.lit(1).alias("documented"))
    if with_values:
        columns = reduce(DataFrame.unionByName, [null_counts(df).select(
            F.lit(name).alias("table"), "column_name", (F.col("row_count") - F.col("null_count")).alias("values")) for name, df in tables.items()])
    else:
        columns = any_df.sparkSession.createDataFrame(
            [(name, c) for name, df in tables.items() for c in df.columns], "table string, column_name string")
    real = columns.select(
        _plain(F.col("table")).alias("t"), _plain(F.col("column_name")).alias("f"), F.lit(1).alias("present"),
        *(["values"] if with_values else []))
    return documented.join(real, ["t", "f"], "full_outer").select(
        F.col("t").alias("table_name"), F.col("f").alias("field_name"),
        F.coalesce("documented", F.lit(0)).alias("documented"),
        F.coalesce("present", F.lit(0)).alias("present"),
        *(["values"] if with_values else []))


def finding(model: str, check: str, detail: str, violations: DataFrame) -> DataFrame:
    """A check's findings folded into one result row."""
    return violations.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(model).alias("model"), F.lit(check).alias("check"), F.lit(detail).alias("detail"), "violations",
        F.when(F.col("violations") == 0, "passed").otherwise("failed").alias("status"))


def results(findings: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, findings).select(*CHECK_COLUMNS)


def run_summary(checked: DataFrame) -> DataFrame:
    """Totals by status over all checks, and the names of the failed ones."""
    name = F.concat_ws(".", "model", "check", "detail")
    failed = F.col("status") == "failed"
    return checked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~failed).alias("passed"),
        F.count_if(failed).alias("failed"),
        F.array_join(F.array_sort(F.collect_set(F.when(failed, name))), ", ").alias("failed_checks"))


class GateFailed(Exception):
    pass


def gate(checked: DataFrame) -> None:
    """Stop the run when a check failed; one row per failed check reaches the driver."""
    failed = checked.where("status = 'failed'").collect()
    if failed:
        raise GateFailed("; ".join(f"{r.model}.{r.check}({r.detail}): {r.violations}" for r in failed))
