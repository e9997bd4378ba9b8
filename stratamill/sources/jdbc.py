"""Database reads and appends."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

DEFAULT_FETCH_SIZE = 10_000
DEFAULT_SLICES = 16


def _source_options(conn: Mapping[str, str], query: str) -> dict[str, str]:
    """The query is pushed to the database as a derived table (alias without AS, which some databases refuse)."""
    return {**conn, "dbtable": f"({query}) tmp"}


def bounds_query(query: str, column: str) -> str:
    return f"SELECT MIN({column}) AS min_val, MAX({column}) AS max_val FROM ({query}) src"


def bound_text(value: object) -> str:
    """A bound in the form the reader parses. Numbers keep their full width."""
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (decimal.Decimal, float)):
        return str(int(value))
    return str(value)


def read_jdbc(
    spark: SparkSession,
    conn: Mapping[str, str],
    query: str,
    fetch_size: int = DEFAULT_FETCH_SIZE,
    partition_column: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Read a SELECT. With ``partition_column`` the read runs in parallel slices between its MIN and MAX.

    ``conn`` holds the reader's options: url, user, password, driver. The bounds only place the cuts: rows
    outside them, NULLs included, are still read.
    """
    reader = spark.read.format("jdbc").options(**_source_options(conn, query)).option("fetchsize", fetch_size)
    if partition_column:
        bounds_source = _source_options(conn, bounds_query(query, partition_column))
        low, high = spark.read.format("jdbc").options(**bounds_source).load().first()
        if low is not None:
            reader = reader.options(
                partitionColumn=partition_column,
                lowerBound=bound_text(low),
                upperBound=bound_text(high),
                numPartitions=num_partitions or DEFAULT_SLICES,
            )
    return reader.load()


#: Quantiles asked for each wanted slice: more make the slices more even.
FINENESS = 8


def quantile_query(query: str, column: str, slices: int, function: str = "percentile_disc") -> str:
    """One row with the column's quantiles, ``FINENESS`` a slice; ``function`` may be the database's approximate form.

    The exact ones are taken from the count of each different value: rows are counted where they lie, and one running sum
    serves all quantiles, where every ``percentile_disc`` would gather the column on its own.
    """
    n = FINENESS * slices
    if function != "percentile_disc":
        cuts = ", ".join(f"{function}({i / n!r}) WITHIN GROUP (ORDER BY {column}) AS q{i}" for i in range(1, n))
        return f"SELECT {cuts} FROM ({query}) src WHERE {column} IS NOT NULL"
    counted = f"SELECT {column} AS v, COUNT(*) AS n FROM ({query}) src WHERE {column} IS NOT NULL GROUP BY {column}"
    placed = f"SELECT v, SUM(n) OVER (ORDER BY v) AS upto, SUM(n) OVER () AS total FROM ({counted}) counted"
    cuts = ", ".join(f"MIN(CASE WHEN upto * {n} >= total * {i} THEN v END) AS q{i}" for i in range(1, n))
    return f"SELECT {cuts} FROM ({placed}) placed"


def literal(value: object) -> str:
    """A value as an SQL literal."""
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def _prime(least: int) -> int:
    """The smallest prime number from ``least`` and 5 on."""
    n = max(least, 5)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def slice_predicates(column: str, quantiles: Sequence[object], spread: str | None = None) -> list[str]:
    """Conditions that deal every row to exactly one slice of about ``FINENESS`` quantiles' worth of rows.

    Cuts lie between different values. A value that fills a slice or more gets slices of its own, divided by the
    remainder of the whole-number column ``spread`` if there is one (for a prime number of slices, as the value may hang
    together with small divisors of ``spread``). NULLs have a slice of their own.
    """
    runs: list[list] = []  # different values with the number of quantiles that fall on them
    for value in quantiles:
        if value is None:
            continue
        if runs and runs[-1][0] == value:
            runs[-1][1] += 1
        else:
            runs.append([value, 1])
    out = [f"{column} IS NULL"]
    if not runs:
        return [*out, f"{column} IS NOT NULL"]
    # The open slice's lower condition and the quantiles it has passed; rows below the first quantile are one quantile's worth.
    lower, passed = None, 1

    def close(upper: str) -> None:
        out.append(f"{lower} AND {upper}" if lower else upper)

    for value, count in runs:
        if count >= FINENESS:
            close(f"{column} < {literal(value)}")
            parts = _prime(-(-(count + 1) // FINENESS)) if spread and count > FINENESS else 1
            equal = f"{column} = {literal(value)}"
            remainder = f"ABS(MOD(COALESCE({spread}, 0), {parts}))"
            out += [f"{equal} AND {remainder} = {i}" for i in range(parts)] if parts > 1 else [equal]
            lower, passed = f"{column} > {literal(value)}", 1
        elif passed + count > FINENESS:
            close(f"{column} < {literal(value)}")
            lower, passed = f"{column} >= {literal(value)}", count
        else:
            passed += count
    close(f"{column} IS NOT NULL" if lower is None else "1 = 1")
    return out


def read_jdbc_evenly(
    spark: SparkSession,
    conn: Mapping[str, str],
    query: str,
    column: str,
    num_partitions: int = DEFAULT_SLICES,
    fetch_size: int = DEFAULT_FETCH_SIZE,
    spread: str | None = None,
    function: str = "percentile_disc",
) -> DataFrame:
    """Read a SELECT in parallel slices of nearly equal numbers of rows, however skewed ``column`` is.

    The database computes the quantiles; each slice is one pushed condition.
    """
    cuts = spark.read.format("jdbc").options(**_source_options(conn, quantile_query(query, column, num_partitions, function))).load().first()
    predicates = slice_predicates(column, list(cuts) if cuts else [], spread)
    rest = {k: str(v) for k, v in conn.items() if k != "url"}
    return spark.read.jdbc(
        conn["url"], _source_options(conn, query)["dbtable"], predicates=predicates, properties={**rest, "fetchsize": str(fetch_size)})


def write_jdbc(df: DataFrame, conn: Mapping[str, str], table: str, connections: int | None = None) -> None:
    """Append to a database table over at most ``connections`` connections (the writer's own default if unset)."""
    writer = df.write.format("jdbc").options(**conn).option("dbtable", table)
    if connections:
        writer = writer.option("numPartitions", connections)
    writer.mode("append").save()
