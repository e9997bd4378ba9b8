"""Write, audit, publish: the input of a load is computed once, judged by what was written, and only then loaded."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratamill.operators import quality
from stratamill.plans.spec import TableSpec
from stratamill.session import observed


@dataclass(frozen=True)
class Audited:
    """A staged input that may be published: its rows as stored, how many there are, and how many lack a key."""

    rows: DataFrame
    total: int
    keyless: int

    @property
    def keys_not_null(self) -> bool:
        return self.keyless == 0


def stage(new: DataFrame, spec: TableSpec, folder: str, also: Sequence[str] = ()) -> Audited:
    """``new`` written to ``folder`` and audited.

    Rows, rows without a key and NULLs of the required columns are counted by the job that writes; repeated keys are
    looked for among the stored keys alone, so the source runs once. Raises ``QualityError`` when required columns
    are NULL or keys repeat; the target has not been touched then. Rows without a key match nothing and are not held to be
    repeated. ``also`` names columns by which rows of one key may differ, such as the date of several slices.
    """
    seen = Observation()
    keyless = F.expr(" OR ".join(f"`{k}` IS NULL" for k in spec.keys) or "false")
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(spec.required)]
    counted = new.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(keyless).alias("keyless"), *nulls)
    if spec.hash_buckets:
        counted = spec.with_bucket(counted)
    path = f"{folder}/staged"
    counted.write.parquet(path)
    rows = new.sparkSession.read.schema(counted.schema).parquet(path)
    found = observed(seen)
    failed = {c: found[f"null_{i}"] for i, c in enumerate(spec.required) if found.get(f"null_{i}")}
    if failed:
        raise quality.QualityError(f"NULL found in required columns: {failed}")
    if spec.keys:
        quality.require_unique(rows.dropna(subset=list(spec.keys)).select(*spec.keys, *also), [*spec.keys, *also])
    return Audited(rows, found.get("total", 0), found.get("keyless", 0))
