"""Loads: stage and audit the input, compute the change, write it once, log it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratamill.functions.calendar import as_day
from stratamill.operators import changes, ranges, status
from stratamill.operators.align import empty_text_to_null
from stratamill.plans import audit, fingerprint
from stratamill.plans.spec import BUCKET, TableSpec
from stratamill.session import compiled_methods, observed, scratch_space
from stratamill.sources import tables

Query = str | Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Step:
    """One write of a staged build.

    ``query`` is SQL with the parameter ``:cob_dt``, or a function of the session and the date. ``before`` is a
    statement run first, such as a TRUNCATE; leave it out when there is none. ``date_column`` (``cob_dt`` if the target
    has it) and ``date`` (the date of the run if not given) say which rows of the target the status row counts.
    """

    table: str
    query: Query
    before: str | None = None
    mode: str = "overwrite"
    files: int | None = None
    date_column: str | None = None
    date: str | None = None

    def frame(self, spark: SparkSession, as_of: str) -> DataFrame:
        if callable(self.query):
            return self.query(spark, as_of)
        return tables.run_sql(spark, self.query, cob_dt=as_of)


def run_steps(
    spark: SparkSession,
    steps: Sequence[Step],
    as_of: str,
    log: str | None = None,
    resume: bool = False,
    fingerprints: str | None = None,
) -> list[str]:
    """Run a staged build in order and return the tables it wrote.

    Later steps read what earlier ones wrote. With ``log`` every finished step gets a success row in that
    status table; with ``resume`` steps that already have one for the date are skipped. With ``fingerprints`` (a table of
    ``fingerprint.log_spec``) a step is skipped only if its query and the files it reads are those of the last time, so a
    changed step runs again, and with it the steps that read what it wrote. An error stops the run.
    """
    done: set[str] = set()
    if resume:
        if log is None:
            raise ValueError("resume needs the status log")
        done = status.finished_tables(spark.table(log), [s.table for s in steps], as_of)
    written = []
    with compiled_methods(spark):
        for step in steps:
            if step.table in done and fingerprints is None:
                continue
            frame = step.frame(spark, as_of)
            print_ = fingerprint.fingerprint(frame) if fingerprints else None
            if step.table in done and print_ == fingerprint.last_recorded(spark, fingerprints, step.table, as_of):
                continue
            if step.before:
                spark.sql(step.before)
                frame = step.frame(spark, as_of)
            if step.files:
                frame = tables.repartition_for_write(frame, step.files)
            if step.mode == "overwrite":
                tables.overwrite_partitions(frame, step.table, balance=not step.files)
            else:
                tables.append(frame, step.table, balance=not step.files)
            if log is not None:
                target = spark.table(step.table)
                column = step.date_column or ("cob_dt" if "cob_dt" in target.columns else None)
                if column is not None:
                    target = target.where(F.col(column).try_cast("date") == as_day(step.date or as_of))
                tables.append(status.load_status(target, step.table, None, as_of), log)
            if fingerprints is not None:
                fingerprint.record(spark, fingerprints, step.table, as_of, print_)
            written.append(step.table)
    return written


def load_snapshot(df: DataFrame, table: str, as_of: str | dt.date | None = None, date_column: str = "cob_dt") -> None:
    """A balance snapshot: the day's slice is replaced, so a rerun leaves one copy.

    With ``as_of`` a day that has become empty is emptied in the table too.
    """
    if as_of is not None and df.where(F.col(date_column).try_cast("date") == as_day(as_of)).isEmpty():
        tables.drop_partition(df.sparkSession, table, date_column, as_of)
    tables.overwrite_partitions(df, table)


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """A change set written to the run's scratch folder, so that what is merged is computed once."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyless(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that lack a key; on stored tables the files' own null counts answer this almost alone."""
    return df.where(" OR ".join(f"`{k}` IS NULL" for k in spec.keys))


def buckets_of(df: DataFrame) -> list[int]:
    """The buckets that ``df`` has rows in: at most as many numbers as the table has buckets."""
    return sorted(r[BUCKET] for r in df.select(BUCKET).distinct().collect())


def in_buckets(df: DataFrame, buckets: Sequence[int]) -> DataFrame:
    """Only those buckets; on a stored table the others are not read."""
    return df.where(F.col(BUCKET).isin(*buckets) if buckets else F.lit(False))


def only_day(df: DataFrame, column: str, as_of: str | dt.date) -> DataFrame:
    """The frame itself; a row of another day stops the job, as it would replace that day's partition."""
    same = F.col(column).eqNullSafe(as_day(as_of))
    other = F.raise_error(F.lit(f"a row of another day than {as_of} in {column}"))
    return df.withColumn(column, F.when(same, F.col(column)).otherwise(other.cast("date")))


def load_master(
    new: DataFrame, spec: TableSpec, as_of: str | dt.date, history: str | None = None, keep: int = 1
) -> dict[str, int]:
    """Type 1 load of a master and, if asked for, its change history. Returns the counts of the rows written.

    The input is staged and audited, compared with the master once, and the change set is stored: it feeds the day's slice of
    the history first and then the master, so that a load that dies in between is mended by running it again. Row-level
    tables merge it. A table with ``hash_buckets`` has only those buckets read again and replaced that a change falls
    into, a plain table whose partition date is part of the key only the partition of the day. Any other plain table has to
    be unpartitioned and gets a complete new version, of which the last ``keep`` old ones stay; without changes none
    is written.
    """
    spark = new.sparkSession
    current = spark.table(spec.name)
    row_level = tables.supports_row_level(spark, spec.name)
    by_day = not spec.hash_buckets and len(spec.partition_by) == 1 and spec.partition_by[0] in spec.keys
    if not (row_level or spec.hash_buckets or by_day):
        tables.require_unpartitioned(spark, spec.name)
    if by_day and not row_level:
        current = changes.change_history(current, as_of, spec.partition_by[0])
        new = only_day(new, spec.partition_by[0], as_of)
    counts = Observation(f"{spec.name} {as_of}")
    with compiled_methods(spark), scratch_space(spark, "load") as folder:
        staged = audit.stage(new, spec, folder)
        known = current
        if spec.hash_buckets and not row_level:
            known = in_buckets(current, buckets_of(staged.rows))
        first = known.isEmpty()
        if first:
            # Nothing to compare with: what is staged is the change set.
            changed = changes.first_load(staged.rows)
        else:
            changed = _stored(
                changes.scd1_changes(known, staged.rows, spec.keys, spec.compared, spec.ignore, counts=counts), folder, "changes")
        if history:
            day = changes.change_history(spark.table(history), as_of)
            written = changes.upsert(day, changes.change_history(changed, as_of), spec.keys)
            tables.overwrite_partitions(written, history)
        found = {"inserted": staged.total} if first else observed(counts)
        written = {name: int(found.get(name, 0)) for name in ("inserted", "updated")}
        if not any(written.values()):
            return written
        if row_level:
            tables.merge_rows(changed, spec.name, spec.keys)
        elif spec.hash_buckets:
            touched = in_buckets(current, buckets_of(changed))
            tables.overwrite_partitions(changes.upsert(touched, changed, spec.keys), spec.name)
        elif by_day:
            tables.overwrite_partitions(changes.upsert(current, changed, spec.keys), spec.name)
        else:
            if spec.buckets:
                changed = tables.dealt_to_buckets(changed, spec, sum(written.values()))
            master = changes.upsert(current, changed, spec.keys)
            tables.swap_table(master, spec.name)
            tables.remove_old_versions(spark, spec.name, keep)
    return written


def _open_and_closed(dimension: DataFrame, keys: Sequence[str], as_of: str | dt.date, start: str, end: str) -> DataFrame:
    """The open versions and those that end on ``as_of``. A rerun that died between its two commits leaves reopened versions
    closed as well: the open copy counts."""
    closed = dimension.where(F.col(end) == as_day(as_of))
    open_ = dimension.where(F.col(end) == F.lit(changes.OPEN_END))
    if closed.isEmpty():
        return open_
    version = [*keys, start]
    twice = open_.select(*version).join(closed.select(*version), version, "left_semi")
    return open_.unionByName(closed.join(twice, version, "left_anti").select(*dimension.columns))


def load_versions(
    new: DataFrame, spec: TableSpec, as_of: str | dt.date, version_key: str, start: str = "eff_strt_dt",
    end: str = "eff_end_dt", identifier: str | None = None,
) -> None:
    """Type 2 load of a versioned dimension from a staged and audited input.

    On row-level tables the versions that the day opened before are deleted and the changed ones merged, from a written
    change set. A plain dimension partitioned by the end date is read and rewritten in two partitions only, that of the
    open versions and that of the versions the day closes; versions closed earlier are never touched again. With
    ``hash_buckets`` as well, only those buckets of these two are rewritten in which a version opens, closes, or was opened
    or closed by an earlier run for the day. Either way a load that dies half way is mended by running it again. Any
    other plain dimension has to be unpartitioned.
    """
    spark = new.sparkSession
    dimension = spark.table(spec.name)
    by_end = tuple(spec.partition_by) == (end,)
    if spec.hash_buckets and not by_end:
        raise ValueError(f"{spec.name} has hash buckets: partition it by {end} too")
    row_level = tables.supports_row_level(spark, spec.name)
    if not (row_level or by_end):
        tables.require_unpartitioned(spark, spec.name)
    rules = dict(
        keys=spec.keys, as_of=as_of, compare=spec.compared, ignore=spec.ignore, version_key=version_key, start=start, end=end,
        identifier=identifier, bucketed=bool(spec.buckets))
    with compiled_methods(spark), scratch_space(spark, "load") as folder:
        staged = audit.stage(new, spec, folder)
        rows, complete = staged.rows, staged.keys_not_null
        if row_level:
            complete = complete and keyless(dimension, spec).isEmpty()
            moved = _stored(changes.scd2(dimension, rows, keys_not_null=complete, touched_only=True, **rules), folder, "versions")
            tables.drop_partition(spark, spec.name, start, as_of)
            tables.merge_rows(moved, spec.name, [*spec.keys, start])
            return
        stored = dimension.where(F.col(end).isin(changes.OPEN_END, as_day(as_of)))
        if by_end:
            dimension = _open_and_closed(dimension, spec.keys, as_of, start, end)
        if spec.hash_buckets:
            moved = changes.scd2(dimension, rows, touched_only=True, **rules).select(BUCKET)
            again = stored.where((F.col(start) == as_day(as_of)) | (F.col(end) == as_day(as_of))).select(BUCKET)
            touched = buckets_of(moved.unionByName(again))
            if not touched:
                return
            dimension, rows = in_buckets(dimension, touched), in_buckets(rows, touched)
            # As stored, with what a load that died has left behind.
            before = {(r[end], r[BUCKET]) for r in in_buckets(stored, touched).select(end, BUCKET).distinct().collect()}
        complete = complete and keyless(dimension, spec).isEmpty()
        result = changes.scd2(dimension, rows, keys_not_null=complete, **rules)
        if not by_end:
            tables.replace_all(result, spec.name)
            return
        seen = Observation(f"{spec.name} {as_of}")
        result = result.observe(
            seen, F.count_if(F.col(end) == as_day(as_of)).alias("closed"),
            *([F.collect_set(F.struct(end, BUCKET)).alias("parts")] if spec.hash_buckets else []))
        tables.overwrite_partitions(result, spec.name)
        if spec.hash_buckets:
            left = before - {(r[end], r[BUCKET]) for r in observed(seen).get("parts", [])}
            tables.drop_partitions(spark, spec.name, [{end: e, BUCKET: b} for e, b in sorted(left)])
        elif not observed(seen).get("closed"):
            tables.drop_partition(spark, spec.name, end, as_of)


def load_version_range(
    slices: DataFrame, spec: TableSpec, first: str | dt.date, last: str | dt.date, version_key: str, date_column: str = "cob_dt",
    start: str = "eff_strt_dt", end: str = "eff_end_dt", identifier: str | None = None,
) -> None:
    """Type 2 load of all daily slices from ``first`` to ``last`` (both included) in one pass, with the result of loading them
    day by day.

    The slices are staged and audited as one input, unique by key and date. Of a plain dimension partitioned by the end
    date the open versions and those that end within the range or later are read and rewritten; it can be repeated.
    """
    spark = slices.sparkSession
    by_end = tuple(spec.stored_by) == (end,)
    if not by_end:
        if spec.hash_buckets:
            raise ValueError(f"{spec.name} has hash buckets: load its days one by one")
        tables.require_unpartitioned(spark, spec.name)
    chosen = slices.where(F.col(date_column).cast("date").between(as_day(first), as_day(last)))
    with compiled_methods(spark), scratch_space(spark, "load") as folder:
        staged = audit.stage(chosen, spec, folder, also=[date_column])
        dimension = spark.table(spec.name)
        if by_end:
            dimension = dimension.where(F.col(end) >= as_day(first))
            before = {r[end] for r in dimension.select(end).distinct().collect()}
            closed, open_ = dimension.where(F.col(end) != F.lit(changes.OPEN_END)), dimension.where(F.col(end) == F.lit(changes.OPEN_END))
            version = [*spec.keys, start]
            # As after a day's load that died between its two commits: the open copy of a version counts.
            twice = open_.select(*version).join(closed.select(*version), version, "left_semi")
            dimension = open_.unionByName(closed.join(twice, version, "left_anti").select(*dimension.columns))
        result = ranges.versions_from_range(
            dimension, staged.rows, spec.keys, first, last, date_column, spec.compared, spec.ignore, version_key, start, end,
            identifier=identifier)
        if not by_end:
            tables.replace_all(result, spec.name)
            return
        seen = Observation(f"{spec.name} {first} {last}")
        tables.overwrite_partitions(result.observe(seen, F.collect_set(end).alias("ends")), spec.name)
        tables.drop_partitions(spark, spec.name, [{end: e} for e in sorted(before - {*observed(seen).get("ends", [])})])


def load_upsert(new: DataFrame, spec: TableSpec) -> None:
    """Upsert without comparison; empty text counts as NULL in every text column.

    With ``hash_buckets`` only the buckets of the incoming keys are read and replaced.
    """
    spark = new.sparkSession
    row_level = tables.supports_row_level(spark, spec.name)
    if not (row_level or spec.hash_buckets):
        tables.require_unpartitioned(spark, spec.name)
    with compiled_methods(spark), scratch_space(spark, "load") as folder:
        incoming = audit.stage(empty_text_to_null(new), spec, folder).rows
        if row_level:
            tables.merge_rows(incoming, spec.name, spec.keys)
        elif spec.hash_buckets:
            touched = in_buckets(spark.table(spec.name), buckets_of(incoming))
            tables.overwrite_partitions(changes.upsert(touched, incoming, spec.keys), spec.name)
        else:
            tables.swap_table(changes.upsert(spark.table(spec.name), incoming, spec.keys), spec.name)
