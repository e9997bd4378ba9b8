"""Workforce: pay bands, headcount, experience, ratings, daily profile.

Input frames are daily slices; ``cob_dt`` is the text date of the slice and ``report_dt`` the ISO date the report
is for. ``company`` names the operating company in the job rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamill.functions.calendar import as_day, elapsed, first_of_month, is_month_end
from stratamill.functions.labels import code_label, pay_band, started_this_month
from stratamill.operators.asof import latest_rows

# Fixed values of the workforce feeds.
PRIMARY_JOB = "P"
EMPLOYEE, CONTRACTOR = "EMP", "CWR"
ACTIVE, INACTIVE = "A", "I"
EMPLOYEE_RATES = ("LC",)
CONTRACTOR_RATES = ("LC", "LKG", "LDT")
UNIT_SETS = ("CN", "CNTT", "QLTM", "SGD", "TRG", "TSC", "TTT")
HEADCOUNT_COLUMNS = (
    "emplid", "deptid", "ibsy_officer_cd", "jobcode", "job_entry_dt", "dept_entry_dt", "hire_dt", "last_hire_dt",
    "termination_dt", "effdt", "empl_rcd", "effseq", "contract_num", "action", "action_reason", "hr_status",
    "empl_status", "per_org", "full_part_time", "company", "setid_jobcode", "business_unit",
)
RATING_MODEL = "DGRT"
FIRST_RATED_YEAR = 2019
RETIRED = "RET"
BRANCH_SET = "CN"
HEAD_OFFICE = "Trụ sở chính"
GENDERS = {1: "Nam", 0: "Nữ"}
NO_EDUCATION = "NA"
DAYS_PER_YEAR = "365.25"
DAYS_PER_MONTH = "30.44"


def _slice(df: DataFrame, cob_dt: str) -> DataFrame:
    return df.where(F.col("cob_dt") == cob_dt)


def _starts_with_any(column: Column, prefixes: Sequence[str]) -> Column:
    found = F.lit(False)
    for prefix in prefixes:
        found = found | column.startswith(prefix)
    return found


def _pay(jobs: DataFrame, pay: DataFrame, cob_dt: str, prefixes: Sequence[str]) -> DataFrame:
    """Job rows with their pay rows of the same date and sequence."""
    paid = _slice(pay, cob_dt).where(_starts_with_any(F.col("comp_ratecd"), prefixes)).drop("cob_dt")
    return jobs.alias("a").join(paid.alias("c"), ["emplid", "empl_rcd", "effdt", "effseq"])


def person_picks(jobs: DataFrame, cob_dt: str, report_dt: str) -> DataFrame:
    """Primary job rows at the last effective date of the person.

    Sequence and record number are taken at that date as separate maxima.
    """
    primary = F.col("job_indicator") == PRIMARY_JOB
    return latest_rows(
        _slice(jobs, cob_dt), ["emplid"], report_dt, sequences=["effseq", "empl_rcd"], among=primary, keep=primary)


def record_picks(jobs: DataFrame, cob_dt: str, report_dt: str) -> DataFrame:
    """Primary job rows among those at the last effective date and sequence of the person's record."""
    return latest_rows(
        _slice(jobs, cob_dt), ["emplid", "empl_rcd"], report_dt, sequences=["effseq"], keep=F.col("job_indicator") == PRIMARY_JOB)


# The reports: each takes picked rows, which may be computed or stored ones.
def employee_pay_of(picked: DataFrame, pay: DataFrame, cob_dt: str, report_dt: str, company: str) -> DataFrame:
    """Pay and band of employees, from ``person_picks``."""
    chosen = picked.where((F.col("company") == company) & (F.col("per_org") == EMPLOYEE))
    return _pay(chosen.select("emplid", "empl_rcd", "effdt", "effseq"), pay, cob_dt, EMPLOYEE_RATES).select(
        "emplid", "empl_rcd", "effdt", "effseq", "comp_effseq", "comp_ratecd", "convert_comprt", "currency_cd",
        pay_band(F.col("convert_comprt")).alias("salary_band"),
        F.lit(report_dt).alias("report_date"),
    )


def contractor_pay_of(picked: DataFrame, pay: DataFrame, cob_dt: str, report_dt: str, company: str) -> DataFrame:
    """Pay and band of active contractors, per person and record number, from ``record_picks``."""
    chosen = picked.where(
        (F.col("company") == company) & (F.col("per_org") == CONTRACTOR) & (F.col("hr_status") == ACTIVE))
    chosen = chosen.select("emplid", "empl_rcd", "effdt", "effseq", "currency_cd", "action")
    return _pay(chosen, pay, cob_dt, CONTRACTOR_RATES).select(
        "emplid", "empl_rcd", "effdt", "effseq", "comp_effseq", "comp_ratecd", "convert_comprt",
        F.col("a.currency_cd").alias("currency_cd"), "action",
        pay_band(F.col("convert_comprt")).alias("salary_band"),
        F.lit(report_dt).alias("report_date"),
    )


def _headcount(picked: DataFrame, report_dt: str, company: str, keep: Column) -> DataFrame:
    chosen = picked.where((F.col("company") == company) & F.col("setid_jobcode").isin(*UNIT_SETS) & keep)
    return chosen.select(
        *HEADCOUNT_COLUMNS,
        started_this_month(F.col("hire_dt"), F.col("last_hire_dt"), report_dt).alias("new_hires"),
        F.lit(report_dt).alias("report_date"),
    )


def employee_headcount_of(picked: DataFrame, report_dt: str, company: str) -> DataFrame:
    return _headcount(picked, report_dt, company, F.col("per_org") == EMPLOYEE)


def contractor_headcount_of(picked: DataFrame, quits: DataFrame, report_dt: str, company: str) -> DataFrame:
    """Active contractors, and those whose last action of the day was to quit."""
    people = _headcount(picked, report_dt, company, F.col("per_org") == CONTRACTOR)
    gone = quits.where(F.col("report_date") == report_dt).select("emplid", F.lit(True).alias("quit"))
    return (
        people.join(gone, "emplid", "left")
        .where((F.col("hr_status") == ACTIVE) | F.col("quit").isNotNull())
        .select(*people.columns)
    )


def contractors_terminated_of(picked: DataFrame, listed: DataFrame, report_dt: str, company: str) -> DataFrame:
    """Contractors whose termination falls in the month or later and who are not in the contractor headcount."""
    ended = _headcount(
        picked,
        report_dt,
        company,
        (F.col("per_org") == CONTRACTOR)
        & (F.col("hr_status") == INACTIVE)
        & (F.col("termination_dt") >= first_of_month(as_day(report_dt))),
    )
    present = listed.where(F.col("report_date") == report_dt).select("emplid")
    return ended.join(present, "emplid", "left_anti").select(*ended.columns)


# The same from the job rows themselves.
def employee_pay(jobs: DataFrame, pay: DataFrame, cob_dt: str, report_dt: str, company: str) -> DataFrame:
    return employee_pay_of(person_picks(jobs, cob_dt, report_dt), pay, cob_dt, report_dt, company)


def contractor_pay(jobs: DataFrame, pay: DataFrame, cob_dt: str, report_dt: str, company: str) -> DataFrame:
    return contractor_pay_of(record_picks(jobs, cob_dt, report_dt), pay, cob_dt, report_dt, company)


def employee_headcount(jobs: DataFrame, cob_dt: str, report_dt: str, company: str) -> DataFrame:
    return employee_headcount_of(record_picks(jobs, cob_dt, report_dt), report_dt, company)


def contractor_headcount(
    jobs: DataFrame, quits: DataFrame, cob_dt: str, report_dt: str, company: str
) -> DataFrame:
    return contractor_headcount_of(record_picks(jobs, cob_dt, report_dt), quits, report_dt, company)


def contractors_terminated(
    jobs: DataFrame, listed: DataFrame, cob_dt: str, report_dt: str, company: str
) -> DataFrame:
    return contractors_terminated_of(record_picks(jobs, cob_dt, report_dt), listed, report_dt, company)


def prior_experience(past_jobs: DataFrame, cob_dt: str, report_dt: str) -> DataFrame:
    """Number of earlier employers per person."""
    counted = _slice(past_jobs, cob_dt).groupBy("emplid").agg(F.count(F.lit(1)).alias("nb_prior_work"))
    return counted.select(
        F.col("emplid").alias("id_iso"),
        "nb_prior_work",
        F.when(F.col("nb_prior_work") > 0, 1).otherwise(0).alias("exper"),
        F.lit(report_dt).alias("report_date"),
    )


def yearly_ratings(
    reviews: DataFrame, cob_dt: str, report_dt: str, first_year: int = FIRST_RATED_YEAR
) -> DataFrame:
    """Distinct ratings per person and year, from ``first_year`` to the year before the slice."""
    year = F.year("period_end_dt")
    rated = _slice(reviews, cob_dt).where(
        (F.col("rating_model") == RATING_MODEL) & year.between(first_year, int(cob_dt[:4]) - 1)
    )
    return rated.select(
        year.alias("yr"), "emplid", "review_rating", F.lit(report_dt).alias("report_date")
    ).distinct()


def daily_profile(
    headcount: DataFrame,
    persons: DataFrame,
    retirement: DataFrame,
    positions: DataFrame,
    salaries: DataFrame,
    tenures: DataFrame,
    experience: DataFrame,
    ratings: DataFrame,
    cob_dt: str,
    report_dt: str,
) -> DataFrame:
    """One row per head with age, tenure, pay, retirement gap and position.

    Every person table is cut to the report first and joined on the person alone, so that the heads are shuffled
    once for all of them. The small lookups (retirement ages, positions) are broadcast by Spark when their size
    allows it. The rating is the one of the year before the report.
    """
    of_report = F.col("report_date") == report_dt
    report_day = as_day(report_dt)
    a = headcount.where(of_report).alias("a")
    c = _slice(persons, cob_dt).select("emplid", "name", "sex", "birthdate", "highest_educ_lvl").alias("c")
    t = _slice(tenures, cob_dt).select("emplid", "tenure").alias("t")
    s = salaries.where(of_report & (F.col("effdt") <= report_day)).select("emplid", "convert_comprt").alias("s")
    e = experience.where(of_report).select(F.col("id_iso").alias("emplid"), "exper").alias("e")
    g = ratings.where(of_report & (F.col("yr") == int(report_dt[:4]) - 1)).select("emplid", "review_rating").alias("g")
    joined = a
    for side in (c, s, t, e, g):
        joined = joined.join(side, "emplid", "left")
    position = F.concat(F.col("a.setid_jobcode"), F.col("a.jobcode"))
    joined = joined.join(
        retirement.alias("r"),
        (F.col("c.sex") == F.col("r.gender_id")) & (F.year("a.effdt") == F.col("r.yr")),
        "left",
    ).join(positions.alias("p"), position == F.col("p.bu_post_id"), "left")
    born = F.col("c.birthdate").cast("date")
    months_at_exit = elapsed(F.col("a.effdt").cast("date"), born, DAYS_PER_MONTH)
    retired = F.col("a.action") == RETIRED
    return joined.select(
        F.year(report_day).alias("report_year"),
        F.month(report_day).alias("report_month"),
        is_month_end(report_day).alias("last_day_of_month"),
        "a.setid_jobcode",
        F.substring("a.deptid", 2, 3).alias("unitid"),
        "a.deptid",
        F.col("a.emplid").alias("id_iso"),
        "c.name",
        F.col("a.ibsy_officer_cd").alias("post"),
        "a.jobcode",
        F.col("c.sex").alias("gender_id"),
        code_label(F.col("c.sex"), GENDERS).alias("gender"),
        "c.birthdate",
        F.round(elapsed(report_day, born, DAYS_PER_YEAR), 2).alias("age"),
        F.round(elapsed(report_day, born, DAYS_PER_MONTH), 2).alias("age_month"),
        F.coalesce("c.highest_educ_lvl", F.lit(NO_EDUCATION)).alias("highest_edu_lvl"),
        F.when(F.col("e.exper") > 0, 1).otherwise(0).alias("exper"),
        F.col("s.convert_comprt").alias("base_salary"),
        F.coalesce(F.round(F.col("t.tenure") / 12, 1), F.lit(0)).alias("tenure"),
        "a.hire_dt",
        "a.last_hire_dt",
        "a.termination_dt",
        "a.effdt",
        "a.new_hires",
        "a.action",
        "a.action_reason",
        F.when(retired, F.round(months_at_exit, 1)).alias("m_retired"),
        F.when(retired, F.round(months_at_exit - F.col("r.m_standard_retire"), 2)).alias("standard_retired"),
        "a.hr_status",
        "a.full_part_time",
        "a.per_org",
        F.concat(F.col("a.setid_jobcode"), F.lit("_"), F.col("a.jobcode")).alias("bu_setid_jobcode"),
        "p.post_descr",
        "p.manager_staff",
        F.when(F.col("a.setid_jobcode") != BRANCH_SET, HEAD_OFFICE).otherwise(F.col("p.profession")).alias(
            "profession"
        ),
        "g.review_rating",
        "a.report_date",
    )
