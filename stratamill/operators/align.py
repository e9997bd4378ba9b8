"""Alignment of a frame with a target schema, and unions of labelled feeds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.functions.casting import empty_as_null, parse, trimmed


def align(df: DataFrame, target: T.StructType, text_keys: Iterable[str] = ()) -> DataFrame:
    """Columns matched by lower-case name, in the target's order and types.

    Columns the input lacks become typed NULLs, columns the target lacks are dropped. Text that does not fit its
    type becomes NULL; a number that does not fit stops the job. ``text_keys`` (partition columns) are trimmed
    text. Two input columns that differ only in case are ambiguous and refused.
    """
    by_name: dict[str, str] = {}
    for name in df.columns:
        if name.lower() in by_name:
            raise ValueError(f"input columns {by_name[name.lower()]!r} and {name!r} differ only in case")
        by_name[name.lower()] = name
    types = {f.name: f.dataType for f in df.schema.fields}
    keys = {key.lower() for key in text_keys}
    chosen = []
    for wanted in target.fields:
        source = by_name.get(wanted.name.lower())
        if source is None:
            value = F.lit(None).cast(wanted.dataType)
        elif wanted.name.lower() in keys:
            value = trimmed(F.col(f"`{source}`"))
        elif types[source] == wanted.dataType:
            value = F.col(f"`{source}`")
        elif isinstance(types[source], T.StringType):
            value = parse(F.col(f"`{source}`"), wanted.dataType, day_first=False)
        else:
            value = F.col(f"`{source}`").cast(wanted.dataType)
        chosen.append(value.alias(wanted.name))
    return df.select(*chosen)


def empty_text_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Empty text becomes NULL in the given columns, or in all text columns."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    chosen = set(text if columns is None else columns)
    return df.select(*[empty_as_null(c).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns])


def union_labelled(feeds: Mapping[str, DataFrame], label_column: str = "type") -> DataFrame:
    """Feeds appended by column name, each row carrying the label of its feed."""
    parts = [df.withColumn(label_column, F.lit(label)) for label, df in feeds.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def distinct_labels(df: DataFrame, rules: Mapping[str, Column], columns: Sequence[str], label: str) -> DataFrame:
    """A distinct union of one branch per label, from a single scan.

    A row appears once under every label whose rule is true; a rule that is NULL does not match. The result is
    distinct over ``columns`` and the label.
    """
    matched = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    labelled = df.select(*columns, F.explode(matched).alias(label))
    return labelled.distinct()
