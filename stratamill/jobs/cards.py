"""Card transactions per minute, type and outcome."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.functions.calendar import as_day
from stratamill.functions.labels import outcome
from stratamill.operators.align import distinct_labels

# Fixed values of the card switch log.
CASH = "10"
PAYMENT = "110"
QR_ACCOUNT = "QRCODEQR1QR2"
ONLINE_CONDITIONS = (
    "52", "53", "59", "61", "62", "65", "66", "81", "82", "83", "84", "85", "86", "87", "88", "89",
)
OWN_HOSTS = ("100", "234", "232", "235")
OUTCOMES = ("S", "F_OWN", "F_PARTNER")
GROUP = ("cob_dt", "hh", "mi", "twr_type", "status")


def transactions_per_minute(
    log: DataFrame,
    as_of: str | dt.date | None = None,
    own_hosts: Sequence[str] = OWN_HOSTS,
    outcomes: tuple[str, str, str] = OUTCOMES,
) -> DataFrame:
    """Count of distinct transactions by date, hour, minute, type and outcome.

    ``log`` has the text columns cob_dt, time, id, trancode, respcode, host, toacct, poscondition. A QR cash
    withdrawal counts under both cash types; a payment without a position condition counts under neither. Without
    ``as_of`` all days are counted.
    """
    day = log if as_of is None else log.where(F.col("cob_dt") == F.date_format(as_day(as_of), "yyyy-MM-dd"))
    cash, payment = F.col("trancode") == CASH, F.col("trancode") == PAYMENT
    online = F.col("poscondition").isin(*ONLINE_CONDITIONS)
    rules = {
        "WITHDRAW_ATM": cash,
        "WITHDRAW_ATM_QR": cash & (F.col("toacct") == QR_ACCOUNT),
        "PAYMENT_POS": payment & ~online,
        "PAYMENT_ONLINE": payment & online,
    }
    moment = F.col("time").try_cast("timestamp")
    flat = day.where(cash | payment).withColumns(
        {
            "hh": F.hour(moment),
            "mi": F.minute(moment),
            "status": outcome(F.col("respcode"), F.col("host"), own_hosts, labels=outcomes),
        }
    )
    once = distinct_labels(flat, rules, ["cob_dt", "hh", "mi", "id", "status"], "twr_type")
    counted = once.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("sl"))
    return counted.withColumn("cob_dt", F.col("cob_dt").cast("date"))
