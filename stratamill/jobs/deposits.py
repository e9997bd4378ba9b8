"""Deposit accounts: master with change history, products, daily balances.

Feeds are all text with a text date ``cob_dt`` (yyyy-MM-dd); dates inside are day first. ``bank`` is the short
lower-case code of the operating bank, which is part of some column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.functions.calendar import as_day, date_from_text
from stratamill.functions.casting import number
from stratamill.functions.lending import effective_rate, term_months
from stratamill.operators import changes
from stratamill.plans.spec import Field, TableSpec, fields

MARK = Field("-", "change_type", "string")
RATE = (9, 2)

# Feed column, target column, type; "nullable" marks text whose empty value means NULL.
ACCOUNT_FIELDS = """
-         cob_dt                       date
cid       act_nbr                      long
acn       cus_cif_nbr                  long
title1    act_title                    string
grp       prod_grp                     string
type      prod_type                    string
boo       branch_cd                    string
crcd      currency_cd                  string
cc        cost_center                  string
initdsrc  init_src                     string
package   pkg_cd                       string         nullable
zibpkgid  ib_pkg_cd                    string         nullable
off       officer_cd                   string         nullable
zmgr      manage_user                  string         nullable
trm       act_term_cd                  string         nullable
trmd      act_term_days                int
-         act_term_month               decimal(8,2)
convacn   conv_act_nbr                 string         nullable
glsc      glsc                         string         nullable
zchanid   channel_id                   string         nullable
zchuid    channel_user_id              string         nullable
zkyc      zkyc                         string         nullable
zkyctyp   zkyc_type                    string         nullable
zluckacct lucky_nbr_flag               int
zinvid    ref_user_id                  string         nullable
trate     promt_intrst_rate            decimal(9,2)
trexd     promt_intrst_rate_end_dt     date
ztrstd    promt_intrst_rate_strt_dt    date
irn       nominal_interst_rate         decimal(9,2)
-         intrst_rate                  decimal(9,2)
odt       created_dt                   date
mdt       marturity_dt                 date
dtc       closed_dt                    date
rencd     prin_maturity_opt            int
stat      status                       int
rflg      rest_flag                    int
org       org_amt                      decimal(19,2)
pbksn     passbook_serial_nbr          string         nullable
odo       overdraft_opt                int
highvol   high_vol_act_flag            int
itrf      intrst_trsfr_act_nbr         long
iopt      intrst_opt                   int
ipf       intrst_posting_freq          string         nullable
racn      rollover_trsfr_act_nbr       long
iaf       intrst_avail_opt             int
intmatita intrst_maturiy_trsfr_act_nbr long
imo       intrst_maturiy_opt           int
zisva     zisva                        int
zva{bank} zva{bank}                    string         nullable
odsf      overdraft_pmt_flag           int
dfdep     first_depst_dt               date
zccrel    cost_center_rltns            string         nullable
acnrelc   act_rltns_cd                 string         nullable
phld      hold_flag                    int
hldamt    hold_amt                     decimal(19,2)
dlr       last_renew_dt                date
ntr       renew_cnt                    int
"""

PRODUCT_FIELDS = """
-     cob_dt            date
cls   prod_cls          string
grp   prod_grp          string
type  prod_type         string
crcd  currency_cd       string
rencd prin_maturity_opt int
des   prod_des          string
"""

BALANCE_FIELDS = """
-      cob_dt              date
cid    act_nbr             long
acn    cus_cif_nbr         long
crcd   currency_cd         string
bal    ldgr_bal_amt        decimal(19,2)
eodbal eod_ldgr_bal_amt    decimal(19,2)
balavl avail_bal_amt       decimal(19,2)
cntcr  credit_trns_cnt     int
cntdr  debit_trns_cnt      int
acr    acr_intrst_amt      decimal(19,2)
daa    dly_acr_intrst_amt  decimal(19,2)
fmld   last_maintaince_dt  date
tld    last_transaction_dt date
lcamt  last_credit_amt     decimal(19,2)
lcdt   last_credit_dt      date
odld   last_ovrdrft_dt     date
odo    ovrdrft_opt         int
odlim  ovrdrft_limit_amt   decimal(19,2)
ldamt  last_debit_amt      decimal(19,2)
lddt   last_debit_dt       date
ccld   last_contact_dt     date
"""


def account_master(bank: str, name: str = "std.depst_act_mstr", buckets: int = 0) -> TableSpec:
    return TableSpec(
        name, fields(ACCOUNT_FIELDS, bank=bank), ("act_nbr",), empty_to_null=True, buckets=buckets, extra=(MARK,)
    )


def account_history(bank: str, name: str = "std.depst_act_mstr_hist") -> TableSpec:
    return TableSpec(name, fields(ACCOUNT_FIELDS, bank=bank), ("act_nbr",), partition_by=("cob_dt",), extra=(MARK,))


def product_master(name: str = "std.depst_prod_mstr") -> TableSpec:
    return TableSpec(name, fields(PRODUCT_FIELDS), ("prod_type",), extra=(MARK,))


def balances(name: str = "std.depst_act_trns") -> TableSpec:
    return TableSpec(name, fields(BALANCE_FIELDS), ("act_nbr", "cob_dt"), partition_by=("cob_dt",))


def _slice(feed: DataFrame, as_of: str) -> DataFrame:
    return feed.where(F.col("cob_dt") == as_of)


def accounts(feed: DataFrame, as_of: str, spec: TableSpec) -> DataFrame:
    """Typed account rows of one business date."""
    rate = effective_rate(number("trate", *RATE), date_from_text("trexd"), number("irn", *RATE), as_of)
    derived = {"cob_dt": as_day(as_of), "act_term_month": term_months(F.col("trm")), "intrst_rate": rate}
    return spec.project(_slice(feed, as_of), derived)


def products(feed: DataFrame, as_of: str, spec: TableSpec) -> DataFrame:
    return spec.project(_slice(feed, as_of), {"cob_dt": as_day(as_of)})


def account_balances(feed: DataFrame, as_of: str, spec: TableSpec) -> DataFrame:
    """Balance snapshot of one business date."""
    return spec.project(_slice(feed, as_of), {"cob_dt": as_day(as_of)})


def updated_master(current: DataFrame, new: DataFrame, spec: TableSpec) -> DataFrame:
    """The master after the load of ``new``."""
    return changes.scd1(current, new, spec.keys, spec.compared, spec.ignore)
