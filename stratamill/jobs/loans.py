"""Loan accounts: master with change history, versioned details, daily balances.

Feeds are all text with a text date ``cob_dt`` (yyyy-MM-dd); dates inside are day first. ``bank`` is the short
lower-case code of the operating bank, which is part of some column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.functions.calendar import as_day, date_from_text
from stratamill.functions.casting import number
from stratamill.functions.lending import (
    days_to_due,
    effective_rate,
    is_open_account,
    term_months,
)
from stratamill.operators import changes
from stratamill.plans.spec import Field, TableSpec, fields

MARK = Field("-", "change_type", "string")
VERSION_KEY = "loan_act_dtls_sr_key"
VALIDITY = (
    Field("-", VERSION_KEY, "long"),
    Field("-", "eff_strt_dt", "date"),
    Field("-", "eff_end_dt", "date"),
    Field("-", "is_cur", "int"),
)
RATE = (9, 2)

# Feed column, target column, type; "nullable" marks text whose empty value means NULL.
MASTER_FIELDS = """
-           cob_dt                  date
cid         act_nbr                 long
acnrelc     act_rltns_cd            string
acn         cus_cif_nbr             long
title1      act_title               string
alpdue      auto_pmt_due_cd         int
alprty      auto_pmt_retry          int
alprtyd     auto_pmt_retry_day      int
auptcid     auto_pmt_act_nbr        long
ccl         faci_act_nbr            long
crcd        currency_cd             string
crlmt       credit_limit_amt_in_tc  decimal(19,2)
dfp         first_pmt_dt            date
odd         org_disburse_dt         date
odd2        first_disburse_dt       date
zpopt2      late_charge_calc_method string
zdarcupd    asset_cls_manual_update int
zfrzflg     special_debt_flag       int
zchanid     channel_cd              string
trate       promt_intrst_rate       decimal(9,2)
trexd       promt_intrst_rate_end_dt date
irn         nominal_interst_rate    decimal(9,2)
-           intrst_rate             decimal(9,2)
intfre      intrst_change_freq      string
zcomcode    inter_company_cd        string
zsldflg     syndicated_sold_flag    int
zsyndflg    syndicated_flag         int
z{bank}pct  {bank}_percentage       decimal(5,3)
ztrust1     trust_prod1_flag        int
ztrust2     trust_prod2_flag        int
zaldolflg   online_disburse_flag    int
zaldolstat  online_disburse_status  string
zcredorient credit_oriention_cd     string
zinex       intrst_exemption_flag   int
ztfsubcom   tf_sub_cmnt_flag        int
ztrid       transaction_id          string         nullable
refnum      refnum                  string         nullable
dist1fre    dist1fre                string
intfre      intfre                  string
index       index                   string
co          company_cd              string         nullable
glsc        glsc                    string         nullable
glcat1      glcat1                  string         nullable
glcat2      glcat2                  string         nullable
glcat3      glcat3                  string         nullable
glcat4      glcat4                  string         nullable
glcat5      glcat5                  string         nullable
glcat6      glcat6                  string         nullable
glcat7      glcat7                  string         nullable
glcat8      glcat8                  string         nullable
glcat9      glcat9                  string         nullable
glcat10     glcat10                 string         nullable
pcm         pmt_calc_method         string         nullable
dlrp        dealer_discount_flag    string         nullable
dtc         closed_dt               date
odo         overdraft_cd            string         nullable
pflg        ptcp_act_flag           int
"""

DETAIL_FIELDS = """
-         cob_dt                   date
cid       act_nbr                  long
boo       branch_cd                string
stat      status                   int
odt       created_dt               date
mdt       marturity_dt             date
zomdt     org_marturity_dt         date
trm       act_term_cd              string
trmd      act_term_days            int
-         act_term_month           decimal(8,2)
cc        cost_center              string         nullable
grp       prod_grp                 string
type      prod_type                string
subt      prod_sub_type            string         nullable
revf      revolve_flag             int
zsicsub   industry_cd              string
zpurcd    purpose_cd               string         nullable
off       officier_cd              string         nullable
zsecured  secured_flag             int
zccrel    cost_center_rltns        string
zdel10f   overdue_10d_flag         int
ztfmargin tf_margin_amt            decimal(19,2)
ztfmdext  tf_maturity_date_ext_cnt int
zmdec2    maturity_date_ext_cnt    int
extamt    total_ext_pmt_amt        decimal(19,2)
exttot    total_ext_pmt_cnt        int
exttotsc  sch_ext_pmt_cnt          int
extldt    last_ext_dt              date
cof       charge_off_flag          int
darcls    asset_cls                string
darcovr   asset_cls_ovr            string
"""

BALANCE_FIELDS = """
-         cob_dt                      date
cid       act_nbr                     long
crcd      currency_cd                 string
ziadbal   leadr_{bank}_bal_amt        decimal(19,2)
bal       ldgr_bal_amt                decimal(19,2)
ziadbal2  tot_{bank}_bal_amt          decimal(19,2)
zbal      tot_ostd_bal_amt            decimal(19,2)
avlbal    avail_bal_amt               decimal(19,2)
udbal     unadv_bal_amt               decimal(19,2)
zbaltot   dly_tot_bal_amt             decimal(19,2)
zicrbal   leader_{bank}_credit_limit_amt decimal(19,2)
crlmt     credit_limit_amt            decimal(19,2)
daa       dly_acr_intrst_amt          decimal(19,2)
acr       acr_intrst_amt              decimal(19,2)
poamt     prin_only_pmt_amt           decimal(19,2)
prnrpd    prin_paid_amt               decimal(19,2)
pvar      prin_prepaid_amt            decimal(19,2)
tdr       total_rlse_amt              decimal(19,2)
pmt       pmt_amt                     decimal(19,2)
-         prin_intrst_pmt_amt         decimal(19,2)
prinrec   prin_recvry_amt             decimal(19,2)
cupr      cur_prin_amt                decimal(19,2)
cupr2     cur_prin2_amt               decimal(19,2)
provoamt  provsn_ovr_amt              decimal(19,2)
dupr      tot_prin_due_amt            decimal(19,2)
tdue      tot_due_amt                 decimal(19,2)
unapf     unapl_funds_amt             decimal(19,2)
provbal   provsn_bal_amt              decimal(19,2)
zgprovbal gen_provsn_bal_amt          decimal(19,2)
zgprovcdt gen_provsn_calc_dt          date
zgprovpct gen_provsn_bal_pct          decimal(10,4)
zcuprco   prin_chrg_off_amt           decimal(19,2)
zcuprnco  prin_non_chrg_off_amt       decimal(19,2)
zduprco   prin_ovd_chrg_off_amt       decimal(19,2)
zduprnco  prin_ovd_non_chrg_off_amt   decimal(19,2)
ztdrtfsub tf_disburse_amt             decimal(19,2)
coltot    tot_col_held_amt            decimal(19,2)
totcol    tot_col_value_in_tc         decimal(19,2)
gtdue     grand_tot_due_amt           decimal(19,2)
dist1nd   next_due_dt                 date
-         days_to_due                 int
tld       last_transaction_dt         date
lpdt      last_pmt_dt                 date
fmld      last_maintaince_dt          date
"""


def account_master(bank: str, name: str = "std.loan_act_mstr", buckets: int = 0) -> TableSpec:
    return TableSpec(
        name, fields(MASTER_FIELDS, bank=bank), ("act_nbr",), empty_to_null=True, buckets=buckets, extra=(MARK,)
    )


def account_history(bank: str, name: str = "std.loan_act_mstr_hist") -> TableSpec:
    return TableSpec(name, fields(MASTER_FIELDS, bank=bank), ("act_nbr",), partition_by=("cob_dt",), extra=(MARK,))


def account_details(name: str = "std.loan_act_dtls", buckets: int = 0) -> TableSpec:
    """Versions, partitioned by their end date: a load touches the open ones and those it closes."""
    return TableSpec(
        name, fields(DETAIL_FIELDS), ("act_nbr",), empty_to_null=True, partition_by=("eff_end_dt",), buckets=buckets,
        lead=VALIDITY,
    )


def balances(bank: str, name: str = "std.loan_act_trns") -> TableSpec:
    return TableSpec(name, fields(BALANCE_FIELDS, bank=bank), ("act_nbr", "cob_dt"), partition_by=("cob_dt",))


def _slice(feed: DataFrame, as_of: str) -> DataFrame:
    return feed.where(F.col("cob_dt") == as_of)


def _open(feed: DataFrame, as_of: str) -> DataFrame:
    return _slice(feed, as_of).where(is_open_account(F.col("cpf"), F.col("stat"), F.col("dtc"), as_of))


def accounts(feed: DataFrame, as_of: str, spec: TableSpec) -> DataFrame:
    """Typed master rows of the open accounts of one business date."""
    rate = effective_rate(number("trate", *RATE), date_from_text("trexd"), number("irn", *RATE), as_of)
    return spec.project(_open(feed, as_of), {"cob_dt": as_day(as_of), "intrst_rate": rate})


def details(feed: DataFrame, as_of: str, spec: TableSpec) -> DataFrame:
    """Typed detail rows of the open accounts of one business date."""
    derived = {"cob_dt": as_day(as_of), "act_term_month": term_months(F.col("trm"))}
    return spec.project(_open(feed, as_of), derived)


def account_balances(feed: DataFrame, as_of: str, spec: TableSpec) -> DataFrame:
    """Balance snapshot of one business date, closed accounts included."""
    derived = {
        "cob_dt": as_day(as_of),
        "prin_intrst_pmt_amt": F.lit(None),
        "days_to_due": days_to_due(date_from_text("dist1nd"), as_of),
    }
    return spec.project(_slice(feed, as_of).where(F.col("cpf") == "0"), derived)


def updated_master(current: DataFrame, new: DataFrame, spec: TableSpec) -> DataFrame:
    return changes.scd1(current, new, spec.keys, spec.compared, spec.ignore)


def updated_details(dimension: DataFrame, new: DataFrame, as_of: str, spec: TableSpec) -> DataFrame:
    """The versioned dimension after the load of ``new``."""
    return changes.scd2(dimension, new, spec.keys, as_of, spec.compared, spec.ignore, VERSION_KEY)


def first_details(new: DataFrame, as_of: str, spec: TableSpec) -> DataFrame:
    """The dimension loaded for the first time."""
    versions = changes.with_validity(new, as_of, spec.keys[0], VERSION_KEY)
    return versions.select(*[f.name for f in spec.schema.fields])
