"""Change detection and slowly changing dimensions.

Every comparison is one full outer join of the current and the new picture on the business key. Keys are
expected to be unique on both sides (``quality.duplicate_keys`` tests it before a load), so no key can be hot.
Rows without a key match nothing. An outer join would still bring all of them to one task, so a second join column
spreads them; ``keys_not_null`` says that there are none. A ``bucketed`` side must stay where its buckets are: there such
rows go around the join, at the price of a second look at both inputs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratamill.functions.calendar import as_day
from stratamill.functions.lending import surrogate_key
from stratamill.operators.align import align

INSERT, UPDATE, SAME, GONE = "I", "U", "N", "G"
OPEN_END = dt.date(9999, 12, 31)
ALL = "all"

_CLASS = "__class"
_PRESENT = "__present"
_SPREAD = "__spread"
_REOPENED = "__reopened"


def _counters(kind: Column) -> list[Column]:
    return [F.count_if(kind == INSERT).alias("inserted"), F.count_if(kind == UPDATE).alias("updated")]


def compared_columns(
    current: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str] | str, ignore: Iterable[str]
) -> list[str]:
    """Columns whose difference makes a row changed; only columns that both sides have can be compared."""
    offered = new.columns
    wanted = offered if compare == ALL else list(compare)
    shared = {*current.columns} & {*offered}
    return [c for c in wanted if c in shared and c not in {*keys, *ignore}]


def _same_key(columns: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"old.`{c}` = new.`{c}`" for c in columns))


def _differs(columns: Sequence[str]) -> Column:
    """True when any column differs; NULL equals NULL and nothing else."""
    return F.expr(" OR ".join(f"NOT (old.`{c}` <=> new.`{c}`)" for c in columns) or "false")


def _has_key(keys: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))


def _present(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(_PRESENT, F.lit(True)).alias(name)


def _spread(df: DataFrame, keys: Sequence[str], compared: Sequence[str], name: str) -> DataFrame:
    """With a second join column that is 0 where the key is there. Rows without a key match nothing; the hash of what is read of
    them in any case deals them over all tasks."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in (*keys, *compared)])
    return _present(df.withColumn(_SPREAD, F.when(_has_key(keys), F.lit(0).cast("long")).otherwise(row)), name)


def _paired(
    current: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | str,
    ignore: Iterable[str],
    keys_not_null: bool,
    bucketed: bool = False,
) -> DataFrame:
    """Both pictures side by side, as the structs ``old`` and ``new``, with the class of each pair."""
    columns = compared_columns(current, new, keys, compare, ignore)
    kind = (
        F.when(F.col(f"old.{_PRESENT}").isNull(), INSERT)
        .when(F.col(f"new.{_PRESENT}").isNull(), GONE)
        .when(_differs(columns), UPDATE)
        .otherwise(SAME)
    )
    around = bucketed and not keys_not_null
    sides = {"old": current, "new": new}
    keyed = {name: df.where(_has_key(keys)) for name, df in sides.items()} if around else sides
    same = _same_key(keys)
    if keys_not_null or bucketed:
        old, fresh = (_present(df, name) for name, df in keyed.items())
    else:
        old, fresh = (_spread(df, keys, columns, name) for name, df in sides.items())
        same = same & F.expr(f"old.{_SPREAD} = new.{_SPREAD}")

    def struct(df: DataFrame, name: str) -> Column:
        return F.struct(*[F.col(f"{name}.`{c}`") for c in df.columns]).alias(name)

    pairs = old.join(fresh, same, "full_outer").select(struct(current, "old"), struct(new, "new"), kind.alias(_CLASS))
    if not around:
        return pairs
    types = {f.name: f.dataType for f in pairs.schema.fields}
    for name, kind_of_side in (("old", GONE), ("new", INSERT)):
        df = sides[name].where(~_has_key(keys))
        parts = {
            side: F.struct(*[F.col(f"`{c}`") for c in df.columns]) if side == name else F.lit(None).cast(types[side])
            for side in sides
        }
        alone = df.select(*[part.alias(side) for side, part in parts.items()], F.lit(kind_of_side).alias(_CLASS))
        pairs = pairs.unionByName(alone)
    return pairs


def classify(
    current: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | str = ALL,
    ignore: Iterable[str] = ("cob_dt",),
    keys_not_null: bool = False,
) -> DataFrame:
    """Keys with their class: I new, U changed, N same, G no longer in the source."""
    pairs = _paired(current, new, keys, compare, ignore, keys_not_null)
    chosen = [F.coalesce(F.col(f"new.{k}"), F.col(f"old.{k}")).alias(k) for k in keys]
    return pairs.select(*chosen, F.col(_CLASS).alias("change"))


def scd1(
    current: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | str = ALL,
    ignore: Iterable[str] = ("cob_dt",),
    mark: str = "change_type",
    keys_not_null: bool = False,
    counts: Observation | None = None,
    bucketed: bool = False,
) -> DataFrame:
    """The master after a load: changed rows overwritten and marked U, new rows added and marked I.

    Unchanged rows keep their date and mark, and so do rows whose key left the source. Columns follow the
    current master. ``counts`` is filled while the result is written.
    """
    pairs = _paired(current, new, keys, compare, ignore, keys_not_null, bucketed)
    if counts is not None:
        pairs = pairs.observe(counts, *_counters(F.col(_CLASS)))
    offered = {*new.columns}

    def value(name: str, kind: str) -> str:
        if name == mark:
            fresh = _CLASS
        elif name in offered:
            fresh = f"CAST(new.`{name}` AS {kind})"
        else:
            fresh = "NULL"
        return f"CASE WHEN {_CLASS} IN ('{INSERT}', '{UPDATE}') THEN {fresh} ELSE old.`{name}` END AS `{name}`"

    return pairs.selectExpr(*[value(f.name, f.dataType.simpleString()) for f in current.schema.fields])


def scd1_changes(
    current: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | str = ALL,
    ignore: Iterable[str] = ("cob_dt",),
    mark: str = "change_type",
    counts: Observation | None = None,
) -> DataFrame:
    """Only the rows a load writes (I and U), shaped like ``new`` plus the mark: the source of a MERGE.

    Keys that only the current master has cannot produce a row, so this is a left join, whose left side AQE
    can split when one partition grows too large.
    """
    columns = compared_columns(current, new, keys, compare, ignore)
    old = _present(current.select(*dict.fromkeys([*keys, *columns])), "old")
    fresh = _present(new, "new")
    added = F.col(f"old.{_PRESENT}").isNull()
    touched = (
        fresh.join(old, _same_key(keys), "left")
        .where(added | _differs(columns))
        .select(*[F.col(f"new.{c}") for c in new.columns], F.when(added, INSERT).otherwise(UPDATE).alias(mark))
    )
    return touched if counts is None else touched.observe(counts, *_counters(F.col(mark)))


def first_load(new: DataFrame, mark: str = "change_type") -> DataFrame:
    """A master loaded for the first time: every row is new."""
    return new.withColumn(mark, F.lit(INSERT))


def change_history(master: DataFrame, as_of: str | dt.date, date_column: str = "cob_dt") -> DataFrame:
    """The rows a load touched on one business date: a daily change set, not a full picture."""
    return master.where(F.col(date_column) == as_day(as_of))


def with_validity(
    new: DataFrame,
    as_of: str | dt.date,
    identifier: str,
    version_key: str = "sr_key",
    start: str = "eff_strt_dt",
    end: str = "eff_end_dt",
    flag: str = "is_cur",
) -> DataFrame:
    """New rows as open versions that start on the business date."""
    return new.withColumns(
        {
            version_key: surrogate_key(as_of, F.col(identifier)),
            start: as_day(as_of),
            end: F.lit(OPEN_END),
            flag: F.lit(1),
        }
    )


def scd2(
    dimension: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    as_of: str | dt.date,
    compare: Sequence[str] | str = ALL,
    ignore: Iterable[str] = ("cob_dt",),
    version_key: str = "sr_key",
    start: str = "eff_strt_dt",
    end: str = "eff_end_dt",
    flag: str = "is_cur",
    keys_not_null: bool = False,
    identifier: str | None = None,
    touched_only: bool = False,
    bucketed: bool = False,
) -> DataFrame:
    """The versioned dimension after a load.

    A changed key gets a new version from ``as_of`` on, and its old version ends there (half-open). New keys get
    a first version; keys that left the source stay open. A rerun for the same date first takes back what the
    earlier run of that date did. Versions that start after ``as_of`` stop the job. The version key is made of
    ``identifier``, which a compound key has to name. ``touched_only`` gives the rows to merge instead: versions
    opened, closed, or opened again because the earlier run had closed them.
    """
    if identifier is None and len(keys) > 1:
        raise ValueError("a compound key needs the column that identifies its versions")
    day = as_day(as_of)
    validity = {version_key, start, end, flag}
    late = F.raise_error(F.concat(F.lit("a version starts after the load date: "), F.col(start).cast("string")))
    before = dimension.where(~F.col(start).eqNullSafe(day))
    is_open = (F.col(flag) == 1) | F.col(end).eqNullSafe(day)
    settled = before.where(~F.coalesce(is_open, F.lit(False)))
    current = before.where(is_open).withColumns(
        {
            _REOPENED: F.col(end).eqNullSafe(day),
            flag: F.when(F.col(start) > day, late.cast("int")).otherwise(F.lit(1)),
            end: F.lit(OPEN_END),
        }
    )
    fresh = align(with_validity(new, as_of, identifier or keys[0], version_key, start, end, flag), dimension.schema)
    pairs = _paired(current, fresh, keys, compare, {*ignore, *validity}, keys_not_null, bucketed)

    def version(side: str, **changed: Column) -> Column:
        return F.struct(*[changed.get(c, F.col(f"{side}.{c}")).alias(c) for c in dimension.columns])

    kept = version("old")
    closed = version("old", **{flag: F.lit(0), end: day})
    opened = version("new")
    versions = (
        F.when(F.col(_CLASS) == UPDATE, F.array(closed, opened))
        .when(F.col(_CLASS) == INSERT, F.array(opened))
        .otherwise(F.array(kept))
    )
    if touched_only:
        pairs = pairs.where(F.col(_CLASS).isin(INSERT, UPDATE) | F.col(f"old.{_REOPENED}"))
    moved = pairs.select(F.explode(versions).alias("v")).select("v.*")
    return moved if touched_only else settled.unionByName(moved)


def current_versions(dimension: DataFrame, flag: str = "is_cur") -> DataFrame:
    return dimension.where(F.col(flag) == 1)


def versions_as_of(
    dimension: DataFrame, day: str | dt.date, start: str = "eff_strt_dt", end: str = "eff_end_dt"
) -> DataFrame:
    """The version of each key that was valid on ``day``."""
    at = as_day(day)
    return dimension.where((F.col(start) <= at) & (at < F.col(end)))


def upsert(current: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace rows of the same key; all others stay. Nothing is compared.

    Only the keys of ``new`` are shuffled. The current rows are the left side of an anti join, which AQE can
    split when many of them share a key or have none.
    """
    incoming = align(new, current.schema)
    untouched = current.join(incoming.select(*keys), list(keys), "left_anti")
    return untouched.select(*current.columns).unionByName(incoming)
