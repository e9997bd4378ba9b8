"""Versions of a whole range of dates at once, and the version that is valid on each row's own date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratamill.functions.calendar import as_day
from stratamill.functions.lending import surrogate_key
from stratamill.operators.align import align
from stratamill.operators.changes import ALL, OPEN_END, compared_columns

_DAY, _OLD, _BEFORE, _LEVEL, _BLOCK = "__day", "__old", "__before", "__level", "__block"


def versions_from_range(
    dimension: DataFrame,
    slices: DataFrame,
    keys: Sequence[str],
    first: str | dt.date,
    last: str | dt.date,
    date_column: str = "cob_dt",
    compare: Sequence[str] | str = ALL,
    ignore: Iterable[str] = ("cob_dt",),
    version_key: str = "sr_key",
    start: str = "eff_strt_dt",
    end: str = "eff_end_dt",
    flag: str = "is_cur",
    identifier: str | None = None,
) -> DataFrame:
    """The versioned dimension after the daily slices from ``first`` to ``last`` (both included), as if loaded day by day.

    Gaps and islands: a key's rows stand in order of their dates behind its open version, and a row opens a version where a
    compared column differs from the row before; the version ends where the key's next one starts. So one shuffle by key does
    the work of all days, and a key has at most one row a day (they have to be unique by key and date). A day without
    a row for a key leaves its version open. What earlier runs did from ``first`` on is taken back first; a version that
    starts after ``last`` stops the job. Rows without a key match nothing: each is a version of its own.
    """
    if identifier is None and len(keys) > 1:
        raise ValueError("a compound key needs the column that identifies its versions")
    begin, until = as_day(first), as_day(last)
    columns = dimension.columns
    late = F.raise_error(F.concat(F.lit("a version starts after the range: "), F.col(start).cast("string")))
    kept = dimension.where(F.when(F.col(start) > until, late.cast("boolean")).otherwise(~F.coalesce(F.col(start) >= begin, F.lit(False))))
    is_open = F.coalesce((F.col(flag) == 1) | (F.col(end) >= begin), F.lit(False))
    settled = kept.where(~is_open)
    keyed = F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    old = kept.where(is_open).withColumns({flag: F.lit(1), end: F.lit(OPEN_END), _DAY: F.col(start), _OLD: F.lit(True)})
    day = F.col(date_column).cast("date")
    dated = slices.where(day.between(begin, until)).withColumns({_DAY: day, _OLD: F.lit(False)})
    validity = {
        version_key: surrogate_key(F.col(_DAY), F.col(identifier or keys[0])), start: F.col(_DAY), end: F.lit(OPEN_END), flag: F.lit(1)}
    shape = dimension.select(*columns, F.lit(None).cast("date").alias(_DAY), F.lit(None).cast("boolean").alias(_OLD)).schema
    rows = old.select(*columns, _DAY, _OLD).unionByName(align(dated.withColumns(validity), shape))
    watched = compared_columns(dimension, slices, keys, compare, {*ignore, version_key, start, end, flag})
    order = Window.partitionBy(*keys).orderBy(_DAY, F.desc(_OLD))
    content = F.struct(*[F.col(f"`{c}`") for c in watched]) if watched else F.struct(F.lit(0))
    first_or_other = F.col(_BEFORE).isNull() | ~F.col(_BEFORE).eqNullSafe(content)
    islands = rows.where(keyed).withColumn(_BEFORE, F.lag(content).over(order)).where(F.col(_OLD) | first_or_other).drop(_BEFORE)
    following = F.lead(_DAY).over(order)
    ended = islands.withColumn("__next", following).withColumns({
        end: F.coalesce("__next", F.lit(OPEN_END)), flag: F.col("__next").isNull().cast("int")})
    return settled.unionByName(ended.select(*columns)).unionByName(rows.where(~keyed).select(*columns))


def covering_blocks(start: Column, stop: Column, bits: int, levels: int) -> Column:
    """The blocks that make up the whole numbers from ``start`` up to ``stop`` (not included), coarse ones inside.

    A block of level l has ``2 ** (bits * l)`` numbers. Each level gives fewer than ``2 ** bits`` blocks at either end,
    so the number of blocks grows with the logarithm of the length. Returns an array of structs ``level``, ``block``.
    """
    parts = []
    for level in range(levels):
        size, coarser = 1 << bits * level, 1 << bits * (level + 1)
        low, high = F.ceil(start / size).cast("long"), F.floor(stop / size).cast("long")
        up, down = F.ceil(start / coarser).cast("long"), F.floor(stop / coarser).cast("long")

        def run(a: Column, b: Column, level: int = level) -> Column:
            some = F.transform(F.sequence(a, b - 1), lambda x: F.struct(F.lit(level).alias("level"), x.alias("block")))
            return F.when(a < b, some).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))

        if level == levels - 1:
            parts.append(run(low, high))
        else:
            inside = F.concat(run(low, up * (1 << bits)), run(down * (1 << bits), high))
            parts.append(F.when(up < down, inside).otherwise(run(low, high)))
    return F.concat(*parts)


def rows_with_versions(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    day: str,
    start: str = "eff_strt_dt",
    end: str = "eff_end_dt",
    bits: int = 4,
) -> DataFrame:
    """Each row with the version of its key that is valid on the row's own date (``start <= day < end``).

    An equality join: a version's validity, cut to the dates that the rows have, is made of a few blocks of days of
    several sizes, and a row looks in the one block of each size that holds its date. So a key with many versions and many
    dates needs no comparison of all with all, its work is dealt out by key and block, and a validity of many years is a
    few blocks, too. Rows without a valid version, without a key or a date drop out. Columns that both sides have, other
    than the keys, come from the rows.
    """
    low, high = rows.agg(F.min(F.col(day).cast("date")), F.max(F.col(day).cast("date"))).first()
    if low is None:
        low = high = dt.date(1970, 1, 1)
    days = (high - low).days + 1
    levels = 1
    while 1 << bits * levels < days:
        levels += 1
    number = F.datediff(F.col(day).cast("date"), F.lit(low)).cast("long")
    looked = F.array(*[
        F.struct(F.lit(level).alias("level"), F.floor(number / (1 << bits * level)).cast("long").alias("block")) for level in range(levels)])
    probes = rows.where(number.isNotNull()).withColumn(_BLOCK, F.explode(looked)).withColumns({
        _LEVEL: F.col(f"{_BLOCK}.level"), _BLOCK: F.col(f"{_BLOCK}.block")})
    begin = F.greatest(F.datediff(F.col(start), F.lit(low)), F.lit(0)).cast("long")
    stop = F.least(F.datediff(F.coalesce(F.col(end), F.lit(OPEN_END)), F.lit(low)), F.lit(days)).cast("long")
    mine = [c for c in versions.columns if c in {*keys} or c not in {*rows.columns}]
    blocks = versions.where(F.col(start).isNotNull() & (begin < stop)).select(
        *mine, F.explode(covering_blocks(begin, stop, bits, levels)).alias(_BLOCK))
    blocks = blocks.withColumns({_LEVEL: F.col(f"{_BLOCK}.level"), _BLOCK: F.col(f"{_BLOCK}.block")})
    return probes.join(blocks, [*keys, _LEVEL, _BLOCK]).drop(_LEVEL, _BLOCK)
