"""The daily runs: each reads its feed tables for one business date and loads its target tables.

Targets have to exist (``tables.ensure_table`` creates those of a specification). Every run can be repeated for its
date. Table names are the caller's.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.jobs import cards, debt, deposits, loans, people, reference
from stratamill.jobs.landing_columns import DEPARTMENTS
from stratamill.plans.loads import Step, load_master, load_snapshot, load_versions
from stratamill.plans.spec import Field, TableSpec
from stratamill.sources import files, tables

Typed = Callable[[DataFrame, str, TableSpec], DataFrame]


def card_minutes(spark: SparkSession, log_table: str, target: str, as_of: str) -> None:
    """Card transactions per minute of one day."""
    load_snapshot(cards.transactions_per_minute(spark.table(log_table), as_of), target, as_of)


def debt_totals(spark: SparkSession, entity_table: str, line_table: str, spec: TableSpec, as_of: str) -> dict[str, int]:
    """Debt totals of one day into a master whose rows are marked I or U."""
    totals = debt.debt_totals(spark.table(entity_table), spark.table(line_table), as_of)
    return load_master(totals, spec, as_of)


def master(
    spark: SparkSession, feed_table: str, typed: Typed, spec: TableSpec, as_of: str, history: str | None = None
) -> dict[str, int]:
    """A type 1 master from its text feed; ``typed`` is the job's projection, such as ``deposits.accounts``."""
    return load_master(typed(spark.table(feed_table), as_of, spec), spec, as_of, history)


def deposit_accounts(
    spark: SparkSession, feed_table: str, spec: TableSpec, as_of: str, history: str | None = None
) -> dict[str, int]:
    return master(spark, feed_table, deposits.accounts, spec, as_of, history)


def deposit_products(spark: SparkSession, feed_table: str, spec: TableSpec, as_of: str) -> dict[str, int]:
    return master(spark, feed_table, deposits.products, spec, as_of)


def deposit_balances(spark: SparkSession, feed_table: str, spec: TableSpec, as_of: str) -> None:
    load_snapshot(deposits.account_balances(spark.table(feed_table), as_of, spec), spec.name, as_of)


def loan_accounts(
    spark: SparkSession, feed_table: str, spec: TableSpec, as_of: str, history: str | None = None
) -> dict[str, int]:
    return master(spark, feed_table, loans.accounts, spec, as_of, history)


def loan_details(spark: SparkSession, feed_table: str, spec: TableSpec, as_of: str) -> None:
    """The versioned loan details."""
    load_versions(loans.details(spark.table(feed_table), as_of, spec), spec, as_of, loans.VERSION_KEY)


def loan_balances(spark: SparkSession, feed_table: str, spec: TableSpec, as_of: str) -> None:
    load_snapshot(loans.account_balances(spark.table(feed_table), as_of, spec), spec.name, as_of)


def reference_table(spark: SparkSession, feed_table: str, spec: TableSpec, as_of: str) -> dict[str, int]:
    return master(spark, feed_table, reference.rows, spec, as_of)


def export_departments(spark: SparkSession, table: str, path: str, as_of: str) -> None:
    """One day of the department dimension as Parquet below ``path``, for a store that loads files."""
    files.export_day(spark.table(table), path, as_of, DEPARTMENTS.split(), file_format="parquet")


@dataclass(frozen=True)
class WorkforceSources:
    """Names of the tables the workforce report reads."""

    jobs: str
    pay: str
    quits: str
    past_jobs: str
    reviews: str
    persons: str
    tenures: str
    retirement: str
    positions: str


WORKFORCE_TABLES = (
    "dim_salary_empl", "dim_salary_cwr", "dim_ps_job_dsnv_daily_emp", "dim_ps_job_dsnv_daily_cwr",
    "dim_ps_job_dsnv_daily_cwr_ter_in_month", "dim_prior_exp", "dim_review_rating_yr_empl", "temp_empl_daily",
)


#: Job rows picked once for a report; five of the tables are made of them.
PICK_TABLES = ("picked_persons", "picked_records")


def ensure_pick_tables(spark: SparkSession, sources: WorkforceSources, schema: str, buckets: int) -> None:
    """Create the tables of picked rows: by report, in buckets of the person, so that reports join them where they lie."""
    columns = [f for f in spark.table(sources.jobs).schema.fields if f.name != "report_date"]
    chosen = (*(Field(f.name, f.name, f.dataType.simpleString()) for f in columns), Field("-", "report_date", "string"))
    for name in PICK_TABLES:
        tables.ensure_table(
            spark, TableSpec(f"{schema}.{name}", chosen, ("emplid",), partition_by=("report_date",), buckets=buckets))


def workforce_steps(
    sources: WorkforceSources,
    schema: str,
    report_dt: str,
    company: str,
    first_rated_year: int = people.FIRST_RATED_YEAR,
) -> list[Step]:
    """The workforce report as steps for ``run_steps``, to be run for the date of the slices.

    The first two pick the job rows in force (``ensure_pick_tables`` creates their tables), so that the jobs are read
    once for each kind of pick. Later steps read the tables that earlier ones wrote; a run that resumes finds them in place.
    """
    names = [f"{schema}.{table}" for table in WORKFORCE_TABLES]
    pay_emp, pay_cwr, head_emp, head_cwr, ended, prior, ratings, profile = names
    persons, records = (f"{schema}.{table}" for table in PICK_TABLES)

    def step(target: str, build: Callable[..., DataFrame]) -> Step:
        return Step(
            target, lambda spark, cob_dt: build(lambda name: tables.read_table(spark, name), cob_dt),
            date_column="report_date", date=report_dt)

    def picked(t: Callable[[str], DataFrame], name: str) -> DataFrame:
        return t(name).where(F.col("report_date") == report_dt)

    def dated(df: DataFrame) -> DataFrame:
        return df.withColumn("report_date", F.lit(report_dt))

    src = sources
    return [
        step(persons, lambda t, d: dated(people.person_picks(t(src.jobs), d, report_dt))),
        step(records, lambda t, d: dated(people.record_picks(t(src.jobs), d, report_dt))),
        step(pay_emp, lambda t, d: people.employee_pay_of(picked(t, persons), t(src.pay), d, report_dt, company)),
        step(pay_cwr, lambda t, d: people.contractor_pay_of(picked(t, records), t(src.pay), d, report_dt, company)),
        step(head_emp, lambda t, d: people.employee_headcount_of(picked(t, records), report_dt, company)),
        step(head_cwr, lambda t, d: people.contractor_headcount_of(picked(t, records), t(src.quits), report_dt, company)),
        step(ended, lambda t, d: people.contractors_terminated_of(picked(t, records), t(head_cwr), report_dt, company)),
        step(prior, lambda t, d: people.prior_experience(t(src.past_jobs), d, report_dt)),
        step(ratings, lambda t, d: people.yearly_ratings(t(src.reviews), d, report_dt, first_rated_year)),
        step(
            profile,
            lambda t, d: people.daily_profile(
                t(head_emp), t(src.persons), t(src.retirement), t(src.positions), t(pay_emp), t(src.tenures), t(prior),
                t(ratings), d, report_dt,
            ),
        ),
    ]
