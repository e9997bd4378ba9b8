"""Reference tables: payment types, collection status, service providers, transaction types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.functions.calendar import as_day
from stratamill.plans.spec import Field, TableSpec, fields

MARK = Field("-", "change_type", "string")

# Feed column, target column, type.
PAYMENT_TYPE_FIELDS = """
-         cob_dt                  date
key       eft_typ                 string
zrefvar   pay_typ                 string
desc      desc                    string
fmdesc    fmdesc                  string
crcd      currency_cd             string
etc       external_transaction_cd string
fincl     fin_transaction_typ     int
stbleft   eft_sys_typ             string
glin      gl_in                   long
glout     gl_out                  long
paymetdft dflt_pmt_method         string
odp       overdraft_protection    int
rev       reversal_transaction    int
zlimit    ibps_low_value_limit    decimal(19,2)
ztxnlimit si_transaction_limit    decimal(19,2)
tries     times_to_retry          int
zrcvbr    receive_branch          int
zibpscid  state_bank_settle_act   long
"""

COLLECTION_STATUS_FIELDS = """
-      cob_dt date
status status string
desc   desc   string
fmdesc fmdesc string
"""

SERVICE_PROVIDER_FIELDS = """
-       cob_dt        date
sprov   svc_prov      string
sprovd  svc_prov_desc string
bic     bic           string
bankcd  bank_cd       string
swiftcd swift_cd      string
"""

TRANSACTION_TYPE_FIELDS = """
-    cob_dt          date
desc desc            string
main limit_check_ind int
typ  transaction_typ int
"""


def payment_types(name: str = "std.eft_pmt_typ_ref") -> TableSpec:
    return TableSpec(name, fields(PAYMENT_TYPE_FIELDS), ("eft_typ",), extra=(MARK,))


def collection_status(name: str = "std.pmt_col_stat_ref") -> TableSpec:
    return TableSpec(name, fields(COLLECTION_STATUS_FIELDS), ("status",), extra=(MARK,))


def service_providers(name: str = "std.svc_prov_ref") -> TableSpec:
    return TableSpec(name, fields(SERVICE_PROVIDER_FIELDS), ("svc_prov",), extra=(MARK,))


def transaction_types(name: str = "std.trns_typ_ref") -> TableSpec:
    return TableSpec(name, fields(TRANSACTION_TYPE_FIELDS), ("desc",), extra=(MARK,))


def rows(feed: DataFrame, as_of: str, spec: TableSpec) -> DataFrame:
    """Typed rows of one business date."""
    return spec.project(feed.where(F.col("cob_dt") == as_of), {"cob_dt": as_day(as_of)})
