"""Gates in front of a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """The input breaks a declared rule; nothing was written."""


def not_null_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column with its number of NULLs, from one pass over the input."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in required])
    return counts.unpivot([], list(required), "column_name", "null_rows")


def null_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Columns that hold NULLs, with their number."""
    if not columns:
        return {}
    return {r["column_name"]: r["null_rows"] for r in not_null_report(df, columns).collect() if r["null_rows"]}


def require_not_null(df: DataFrame, required: Sequence[str]) -> None:
    """Stop with the offending columns and counts. Nothing declared, nothing to do."""
    failed = null_counts(df, required)
    if failed:
        raise QualityError(f"NULL found in required columns: {failed}")


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_column: str = "key_rows") -> DataFrame:
    """Keys that occur more than once. Counts are combined before the shuffle, so a hot key costs no more."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_column)).where(F.col(count_column) > 1)


def load_summary(df: DataFrame, keys: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """One row with what a load must know of its input: repeated keys, rows without a key, NULLs per column.

    A single pass: rows are counted per key (combined in every task first) and the counts are summed up.
    """
    rows, keyless = "__rows", F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys))
    nulls = {f"null_{i}": F.count_if(F.col(f"`{c}`").isNull()) for i, c in enumerate(required)}
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows), *[v.alias(n) for n, v in nulls.items()])
    return per_key.agg(
        F.count_if(~keyless & (F.col(rows) > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(keyless, F.col(rows))), F.lit(0)).alias("keyless_rows"),
        F.struct(
            F.lit(0).alias("__none"), *[F.coalesce(F.sum(n), F.lit(0)).alias(c) for n, c in zip(nulls, required)]
        ).alias("nulls"),
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Stop when a key repeats; the error names a few of the repeated keys."""
    repeated = duplicate_keys(df, keys).limit(5).collect()
    if repeated:
        raise QualityError(f"keys {list(keys)} are not unique, for example {[r.asDict() for r in repeated]}")


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()
