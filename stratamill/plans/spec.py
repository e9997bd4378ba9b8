"""Declarations: which feed column becomes which typed column, and how a table is compared."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.functions.casting import empty_as_null, parse

DERIVED = "-"
#: Partition column of tables that are laid out by a hash of their key.
BUCKET = "key_bucket"


@dataclass(frozen=True)
class Field:
    """One target column. ``source`` is the feed column, or ``-`` for a computed column."""

    source: str
    name: str
    kind: str
    empty_to_null: bool = False

    @property
    def data_type(self) -> T.DataType:
        return T.DataType.fromDDL("bigint" if self.kind == "long" else self.kind)


def fields(text: str, **names: str) -> tuple[Field, ...]:
    """Fields from lines ``source target type [nullable]``; ``{name}`` marks are filled from ``names``."""
    rows = [line.split() for line in text.format(**names).splitlines() if line.strip()]
    return tuple(Field(*row[:3], empty_to_null=row[3:] == ["nullable"]) for row in rows)


@dataclass(frozen=True)
class TableSpec:
    """A target table: its fields, business key, and what counts as a change.

    ``ignore`` holds columns that never make a row "changed", beside the keys. ``empty_to_null`` switches the
    field marks on; ``required`` columns must not be NULL. ``buckets`` lays the table out in that many buckets of
    its keys, so that the stored side of a load is not shuffled; choose it so that a bucket fits a task, or leave
    it at 0 and let every load shuffle to the size of its data. ``hash_buckets`` partitions the table by a hash of
    its keys instead (the column ``key_bucket``, after ``partition_by``), so that a load rewrites only the buckets its
    changes fall into; choose it so that one bucket is a file or a few.
    """

    name: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...]
    ignore: tuple[str, ...] = ("cob_dt",)
    empty_to_null: bool = False
    required: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    buckets: int = 0
    hash_buckets: int = 0
    lead: tuple[Field, ...] = ()
    extra: tuple[Field, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def compared(self) -> list[str]:
        skipped = {*self.keys, *self.ignore}
        return [name for name in self.columns if name not in skipped]

    @property
    def schema(self) -> T.StructType:
        """Columns of the stored table: the fields between the bookkeeping columns ``lead`` and ``extra``."""
        bucket = (Field(DERIVED, BUCKET, "int"),) if self.hash_buckets else ()
        stored = (*self.lead, *self.fields, *self.extra, *bucket)
        return T.StructType([T.StructField(f.name, f.data_type) for f in stored])

    @property
    def stored_by(self) -> tuple[str, ...]:
        """The table's partition columns."""
        return (*self.partition_by, *([BUCKET] if self.hash_buckets else []))

    def with_bucket(self, df: DataFrame) -> DataFrame:
        """``df`` with the bucket of each row's key. Rows without a key match nothing: their whole content deals them out."""
        types = {f.name: f.data_type for f in self.fields}
        keyed = F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in self.keys))
        by_key = F.xxhash64(*[F.col(f"`{k}`").cast(types[k]) for k in self.keys])
        hashed = F.when(keyed, by_key).otherwise(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        return df.withColumn(BUCKET, F.pmod(hashed, F.lit(self.hash_buckets)).cast("int"))

    def project(self, feed: DataFrame, derived: Mapping[str, Column]) -> DataFrame:
        """Typed columns of an all-text feed, in declared order. ``derived`` gives the computed ones."""
        chosen = []
        for f in self.fields:
            if f.source == DERIVED:
                value = derived[f.name]
                value = value.cast(f.data_type)
            else:
                value = parse(F.col(f"`{f.source}`"), f.data_type)
            if f.empty_to_null and self.empty_to_null and f.kind == "string":
                value = empty_as_null(value)
            chosen.append(value.alias(f.name))
        return feed.select(*chosen)
