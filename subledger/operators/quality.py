"""Column policy audit: may a column be NULL, may it repeat, and does the data obey?

Rules by column name, whatever its case: known datetime columns may repeat but not be NULL; the
shop key may do neither; everything else may do both. The audit counts rows
and NULLs of all columns in one aggregate, and distinct values only where a rule
forbids repeats. On request it counts them in every column: the table is
unpivoted to (column, value) and counted with map-side partial aggregation, so
a hot value collapses before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S


def allow_null(column: Column) -> Column:
    name = F.lower(column)
    return ~(name.isin(*S.DATETIME_COLUMNS) | (name == S.UNIQUE_KEY_COLUMN))


def allow_duplicated(column: Column) -> Column:
    return F.lower(column) != S.UNIQUE_KEY_COLUMN


def column_policy(columns) -> list[tuple[str, str, str]]:
    """(column, Allow_null, Allow_duplicated) as yes/no tags, from names only."""
    out = []
    for c in columns:
        if c.lower() in S.DATETIME_COLUMNS:
            out.append((c, "no", "yes"))
        elif c.lower() == S.UNIQUE_KEY_COLUMN:
            out.append((c, "no", "no"))
        else:
            out.append((c, "yes", "yes"))
    return out


def policy_audit(df: DataFrame, columns=None, distinct: str = "rules") -> DataFrame:
    """Per column: rule flags, rows, NULLs, repeated non-NULL rows, distinct values, violation.

    ``distinct`` says where repeats are counted: ``rules`` only where the rule
    forbids them (elsewhere ``duplicate_count`` and ``distinct_values`` are
    NULL), ``exact`` and ``approx`` in every column.
    """
    cols = list(columns or [c for c in df.columns if c != "dt"])
    if distinct == "rules":
        per_col = _by_rules(df, cols)
    elif distinct in ("exact", "approx"):
        per_col = _by_values(df, cols, distinct == "exact")
    else:
        raise ValueError(f"no way to count distinct values called {distinct!r}")
    return verdicts(per_col)


def verdicts(per_col: DataFrame) -> DataFrame:
    """The audit's rows from (column, rows, null_count, distinct_values)."""
    c = F.col("column")
    dup = F.col("rows") - F.col("null_count") - F.col("distinct_values")
    return per_col.select(
        "column",
        allow_null(c).alias("allow_null"),
        allow_duplicated(c).alias("allow_duplicated"),
        F.col("rows").cast("bigint").alias("rows"),
        F.col("null_count").cast("bigint").alias("null_count"),
        dup.cast("bigint").alias("duplicate_count"),
        F.col("distinct_values").cast("bigint").alias("distinct_values"),
        ((~allow_null(c) & (F.col("null_count") > 0))
         | (~allow_duplicated(c) & F.coalesce(dup > 0, F.lit(False)))).alias("violated"),
    )


def _by_rules(df: DataFrame, cols: list[str]) -> DataFrame:
    """One aggregate over the table: no row is multiplied, only values of columns without repeats are shuffled."""
    def counts(i: int, c: str) -> list[Column]:
        unique = c.lower() == S.UNIQUE_KEY_COLUMN
        return [F.count_if(F.col(c).isNull()).alias(f"n{i}"),
                (F.count_distinct(F.col(c).cast("string")) if unique else F.lit(None).cast("bigint")).alias(f"d{i}")]
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[x for i, c in enumerate(cols) for x in counts(i, c)])
    per = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("null_count"),
                             F.col(f"d{i}").alias("distinct_values")) for i, c in enumerate(cols)])
    return one.select("rows", F.explode(per).alias("c")).select("rows", "c.*")


def _by_values(df: DataFrame, cols: list[str], exact: bool) -> DataFrame:
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    long = as_text.unpivot([], cols, "column", "value")
    if exact:
        counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        return counts.groupBy("column").agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.count("value").alias("distinct_values"),
        )
    return long.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.approx_count_distinct("value").alias("distinct_values"),
    )
