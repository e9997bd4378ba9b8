"""Checks of the curated jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.feeds import COB, COMPANY, REPORT, feed, with_feeds
from checks.registry import register
from stratamill.jobs import cards, debt, people
from stratamill.operators.asof import latest_rows

def _listed(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# One pass over the log: every transaction gets the list of its labels, and the list is unnested.
_CARD_MINUTES = f"""
, tagged AS (
  SELECT cob_dt, CAST(time AS TIMESTAMP) AS moment, id,
    [if(trancode = '10', 'WITHDRAW_ATM', NULL), if(trancode = '10' AND toacct = 'QRCODEQR1QR2', 'WITHDRAW_ATM_QR', NULL),
     CASE WHEN trancode <> '110' THEN NULL WHEN list_contains({_listed(cards.ONLINE_CONDITIONS)}, poscondition) THEN 'PAYMENT_ONLINE'
          WHEN poscondition IS NOT NULL THEN 'PAYMENT_POS' END] AS tags,
    CASE WHEN respcode IS NULL THEN 'F_PARTNER' WHEN respcode = '1' THEN 'S'
         WHEN list_contains({_listed(cards.OWN_HOSTS)}, host) THEN 'F_OWN' ELSE 'F_PARTNER' END AS status
  FROM card_log
), single AS (
  SELECT DISTINCT cob_dt, hour(moment) AS h, minute(moment) AS m, id, unnest(tags) AS tag, status FROM tagged
)
SELECT CAST(cob_dt AS DATE) AS cob_dt, CAST(h AS INTEGER) AS hh, CAST(m AS INTEGER) AS mi, tag AS twr_type, status, count(*) AS sl
FROM single WHERE tag IS NOT NULL GROUP BY cob_dt, h, m, tag, status"""


@register("txn_by_minute", with_feeds("card_log") + _CARD_MINUTES.lstrip())
def txn_by_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.transactions_per_minute(feed(spark, sf_dir, "card_log"))


@register(
    "debt_totals",
    with_feeds("entities", "loan_lines")
    + """
SELECT e.msphieu, e.mst, CAST(l.cob_dt AS DATE) AS cob_dt,
       CAST(sum(CAST(duno_vnd AS DECIMAL(19,2))) AS DECIMAL(38,2)) AS sum_duno_vnd,
       CAST(sum(CAST(duno_usd AS DECIMAL(19,2))) AS DECIMAL(38,2)) AS sum_duno_usd
FROM entities e JOIN loan_lines l ON e.msphieu = l.msphieu AND e.cob_dt = l.cob_dt
WHERE dkkd <> '' AND e.cob_dt = '%s' GROUP BY ALL
""" % COB,
)
def debt_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debt.debt_totals(feed(spark, sf_dir, "entities"), feed(spark, sf_dir, "loan_lines"), COB)


# As-of picks by window maxima. ``newest``: the last known rows of a person's primary job; ``chosen``: those with the
# largest sequence and record; ``held``: per record, the last known rows with the largest sequence.
_NEWEST = f"""SELECT * FROM jobs WHERE job_indicator = 'P' AND effdt <= DATE '{REPORT}' AND emplid IS NOT NULL
  QUALIFY effdt = max(effdt) OVER (PARTITION BY emplid)"""
_CHOSEN = f"""SELECT * FROM ({_NEWEST})
  QUALIFY effseq = max(effseq) OVER (PARTITION BY emplid) AND empl_rcd = max(empl_rcd) OVER (PARTITION BY emplid)"""
_HELD = f"""SELECT * FROM (
    SELECT * FROM jobs WHERE effdt <= DATE '{REPORT}' AND emplid IS NOT NULL AND empl_rcd IS NOT NULL
    QUALIFY effdt = max(effdt) OVER (PARTITION BY emplid, empl_rcd))
  QUALIFY effseq = max(effseq) OVER (PARTITION BY emplid, empl_rcd)"""
# Pay bands, both ends included; the last has no upper end and leaves out its lower one.
_BANDS = """SELECT * FROM (VALUES (1, 0, 10000000), (2, 10000001, 20000000), (3, 20000001, 30000000), (4, 30000001, 40000000),
  (5, 40000001, 50000000), (6, 50000000, NULL)) b(band, low, high)"""
_PICK_COLUMNS = ["emplid", "effdt", "effseq", "empl_rcd", "contract_num"]


def _primary() -> F.col:
    return F.col("job_indicator") == people.PRIMARY_JOB


@register("asof_latest", with_feeds("jobs", newest=_NEWEST) + "SELECT emplid, effdt, effseq, empl_rcd, contract_num FROM newest")
def asof_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_rows(feed(spark, sf_dir, "jobs"), ["emplid"], REPORT, among=_primary(), keep=_primary())
    return rows.select(*_PICK_COLUMNS)


@register("asof_chained", with_feeds("jobs", chosen=_CHOSEN) + "SELECT emplid, effdt, effseq, empl_rcd, contract_num FROM chosen")
def asof_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_rows(
        feed(spark, sf_dir, "jobs"), ["emplid"], REPORT, sequences=["effseq", "empl_rcd"],
        among=_primary(), keep=_primary(),
    )
    return rows.select(*_PICK_COLUMNS)


@register(
    "asof_ties",
    with_feeds("jobs", held=_HELD)
    + "SELECT emplid, effdt, effseq, empl_rcd, count(*) AS tied_rows FROM held GROUP BY emplid, effdt, effseq, empl_rcd",
)
def asof_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_rows(feed(spark, sf_dir, "jobs"), ["emplid", "empl_rcd"], REPORT, sequences=["effseq"])
    return rows.groupBy("emplid", "effdt", "effseq", "empl_rcd").agg(F.count(F.lit(1)).alias("tied_rows"))




def _paid(picked: str, organisation: str, codes: str, more: str = "") -> str:
    """Pay rows of the picked jobs of one kind of worker, with their band and the columns ``more``."""
    return f"""SELECT p.emplid, p.empl_rcd, p.effdt, p.effseq, p.comp_effseq, p.comp_ratecd, p.convert_comprt,
  {more or 'p.currency_cd'}, CAST(b.band AS INTEGER) AS salary_band, '{REPORT}' AS report_date
FROM (SELECT * FROM ({picked}) WHERE job_indicator = 'P' AND company = '{COMPANY}' AND per_org = '{organisation}') j
JOIN (SELECT * FROM pay WHERE regexp_matches(comp_ratecd, '^({codes})')) p USING (emplid, cob_dt, empl_rcd, effdt, effseq)
LEFT JOIN ({_BANDS}) b ON CASE WHEN b.high IS NULL THEN p.convert_comprt > b.low ELSE p.convert_comprt BETWEEN b.low AND b.high END"""


_EMPLOYEE_PAY = _paid(_CHOSEN, "EMP", "LC")


@register("salary_band", with_feeds("jobs", "pay") + _EMPLOYEE_PAY)
def salary_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people.employee_pay(feed(spark, sf_dir, "jobs"), feed(spark, sf_dir, "pay"), COB, REPORT, COMPANY)


@register(
    "contractor_salary_band",
    with_feeds("jobs", "pay") + _paid(f"SELECT * FROM ({_HELD}) WHERE hr_status = 'A'", "CWR", "LC|LKG|LDT", "j.currency_cd, j.action"),
)
def contractor_salary_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people.contractor_pay(feed(spark, sf_dir, "jobs"), feed(spark, sf_dir, "pay"), COB, REPORT, COMPANY)


_HEAD = ", ".join(people.HEADCOUNT_COLUMNS)
_MONTH = f"{REPORT[:8]}01"
# Held primary jobs of the company's units, with the mark of those hired within the report's month.
_STAFF = f"""SELECT *, '{REPORT}' AS report_date,
  CAST(CAST(coalesce(hire_dt >= DATE '{_MONTH}' AND hire_dt <= DATE '{REPORT}', false)
    OR coalesce(last_hire_dt >= DATE '{_MONTH}' AND last_hire_dt <= DATE '{REPORT}', false) AS INTEGER) AS VARCHAR) AS new_hires
FROM ({_HELD}) WHERE job_indicator = 'P' AND company = '{COMPANY}' AND cob_dt = '{COB}'
  AND list_contains({_listed(people.UNIT_SETS)}, setid_jobcode)"""
_EMPLOYEES = f"SELECT {_HEAD}, new_hires, report_date FROM ({_STAFF}) WHERE per_org = 'EMP'"
# Contractors who are active or on the list of quitters; one listed several times counts as often.
_CONTRACTORS = f"""SELECT {_HEAD}, new_hires, report_date FROM (
  SELECT s.*, unnest(range(coalesce(q.times, 1))) FROM (SELECT * FROM ({_STAFF}) WHERE per_org = 'CWR') s
  LEFT JOIN (SELECT emplid AS gone, count(*) AS times FROM quits WHERE report_date = '{REPORT}' GROUP BY emplid) q
    ON s.emplid = q.gone
  WHERE q.gone IS NOT NULL OR s.hr_status = 'A')"""


@register("headcount_daily", with_feeds("jobs") + _EMPLOYEES)
def headcount_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people.employee_headcount(feed(spark, sf_dir, "jobs"), COB, REPORT, COMPANY)


@register("contractor_daily", with_feeds("jobs", "quits") + _CONTRACTORS)
def contractor_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs, quits = feed(spark, sf_dir, "jobs"), feed(spark, sf_dir, "quits")
    return people.contractor_headcount(jobs, quits, COB, REPORT, COMPANY)


@register(
    "terminated_not_listed",
    with_feeds("jobs", "quits", listed=_CONTRACTORS, staff=_STAFF)
    + f"""SELECT {_HEAD}, new_hires, report_date FROM staff ANTI JOIN listed USING (emplid, report_date)
WHERE per_org = 'CWR' AND hr_status = 'I' AND termination_dt >= DATE '{_MONTH}'""",
)
def terminated_not_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = feed(spark, sf_dir, "jobs")
    listed = people.contractor_headcount(jobs, feed(spark, sf_dir, "quits"), COB, REPORT, COMPANY)
    return people.contractors_terminated(jobs, listed, COB, REPORT, COMPANY)


_EXPERIENCE = f"""SELECT emplid AS id_iso, count(*) AS nb_prior_work,
  CAST(CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS INTEGER) AS exper, '{REPORT}' AS report_date
FROM past_jobs WHERE cob_dt = '{COB}' GROUP BY emplid"""
_FIRST_YEAR = 1996
_RATINGS = f"""SELECT DISTINCT CAST(year(period_end_dt) AS INTEGER) AS yr, emplid, review_rating,
  '{REPORT}' AS report_date FROM reviews
WHERE rating_model = 'DGRT' AND cob_dt = '{COB}' AND year(period_end_dt) BETWEEN {_FIRST_YEAR} AND {int(COB[:4]) - 1}"""


@register("experience", with_feeds("past_jobs") + _EXPERIENCE)
def experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people.prior_experience(feed(spark, sf_dir, "past_jobs"), COB, REPORT)


@register("ratings_distinct", with_feeds("reviews") + _RATINGS)
def ratings_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people.yearly_ratings(feed(spark, sf_dir, "reviews"), COB, REPORT, _FIRST_YEAR)


@register(
    "employee_profile",
    with_feeds(
        "jobs", "pay", "persons", "retirement", "positions", "tenures", "past_jobs", "reviews",
        heads=_EMPLOYEES, salaries=_EMPLOYEE_PAY, exper=_EXPERIENCE, ratings=_RATINGS,
    )
    + f"""
, people AS (  -- who they are, on the report's day
  SELECT emplid, name, birthdate, sex, ['Nữ', 'Nam'][CAST(sex AS INTEGER) + 1] AS gender, date_diff('day', birthdate, DATE '{REPORT}') AS days,
    coalesce(highest_educ_lvl, 'NA') AS highest_edu_lvl FROM persons
), places AS (  -- where they work
  SELECT *, setid_jobcode || '_' || jobcode AS bu_setid_jobcode, setid_jobcode || jobcode AS place FROM heads
), earned AS (SELECT * FROM salaries WHERE effdt <= DATE '{REPORT}'),
rated AS (SELECT emplid, review_rating FROM ratings WHERE yr = {int(REPORT[:4]) - 1}),
worked AS (SELECT id_iso AS emplid, exper FROM exper),
left_at AS (  -- age in months of those who retired, and the standard for their year and sex
  SELECT h.*, p.* EXCLUDE (emplid), CASE WHEN h.action = 'RET' THEN date_diff('day', p.birthdate, h.effdt) / 30.44 END AS months,
    r.m_standard_retire
  FROM places h LEFT JOIN people p USING (emplid) LEFT JOIN retirement r ON r.yr = year(h.effdt) AND r.gender_id = p.sex
)
SELECT {int(REPORT[:4])} AS report_year, {int(REPORT[5:7])} AS report_month,
  CAST(day(DATE '{REPORT}' + 1) = 1 AS INTEGER) AS last_day_of_month,
  l.setid_jobcode, l.deptid[2:4] AS unitid, l.deptid, l.emplid AS id_iso, l.name, l.ibsy_officer_cd AS post, l.jobcode,
  l.sex AS gender_id, l.gender, l.birthdate,
  CAST(round(l.days / 365.25, 2) AS DECIMAL(15,2)) AS age, CAST(round(l.days / 30.44, 2) AS DECIMAL(15,2)) AS age_month,
  coalesce(l.highest_edu_lvl, 'NA') AS highest_edu_lvl, CAST(coalesce(w.exper > 0, false) AS INTEGER) AS exper,
  e.convert_comprt AS base_salary, coalesce(round(t.tenure / 12, 1), 0) AS tenure,
  l.hire_dt, l.last_hire_dt, l.termination_dt, l.effdt, l.new_hires, l.action, l.action_reason,
  CAST(round(l.months, 1) AS DECIMAL(15,1)) AS m_retired,
  CAST(round(l.months - l.m_standard_retire, 2) AS DECIMAL(15,2)) AS standard_retired,
  l.hr_status, l.full_part_time, l.per_org, l.bu_setid_jobcode, o.post_descr, o.manager_staff,
  if(l.setid_jobcode = 'CN', o.profession, 'Trụ sở chính') AS profession, g.review_rating, l.report_date
FROM left_at l LEFT JOIN positions o ON o.bu_post_id = l.place LEFT JOIN earned e USING (emplid)
LEFT JOIN tenures t USING (emplid) LEFT JOIN worked w USING (emplid) LEFT JOIN rated g USING (emplid)
""",
)
def employee_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = feed(spark, sf_dir, "jobs")
    profile = people.daily_profile(
        people.employee_headcount(jobs, COB, REPORT, COMPANY),
        feed(spark, sf_dir, "persons"),
        feed(spark, sf_dir, "retirement"),
        feed(spark, sf_dir, "positions"),
        people.employee_pay(jobs, feed(spark, sf_dir, "pay"), COB, REPORT, COMPANY),
        feed(spark, sf_dir, "tenures"),
        people.prior_experience(feed(spark, sf_dir, "past_jobs"), COB, REPORT),
        people.yearly_ratings(feed(spark, sf_dir, "reviews"), COB, REPORT, _FIRST_YEAR),
        COB,
        REPORT,
    )
    rounded = {"age": 2, "age_month": 2, "m_retired": 1, "standard_retired": 2}
    return profile.withColumns({c: F.col(c).cast(f"decimal(15,{s})") for c, s in rounded.items()})
