import datetime as dt
from decimal import Decimal

from stratamill.jobs import cards, debt, deposits, loans, people, trade

LOG = "cob_dt string, time string, id string, trancode string, respcode string, host string, toacct string, poscondition string"


def test_card_minutes(rows):
    at = "2025-01-15 09:30:59"
    log = rows(
        [
            ("2025-01-15", at, "1", "10", "1", "9", "QRCODEQR1QR2", None),
            ("2025-01-15", at, "1", "10", "1", "9", "QRCODEQR1QR2", None),
            ("2025-01-15", at, "2", "10", "0", "234", None, None),
            ("2025-01-15", at, "3", "110", None, "234", None, "52"),
            ("2025-01-15", at, "4", "110", "0", "7", None, "1"),
            ("2025-01-15", at, "5", "110", "1", "7", None, None),
            ("2025-01-16", at, "6", "10", "1", "7", None, None),
            ("2025-01-15", at, None, "10", "1", "7", None, None),
        ],
        LOG,
    )
    got = {(r["hh"], r["mi"], r["twr_type"], r["status"]): r["sl"] for r in cards.transactions_per_minute(log, "2025-01-15").collect()}
    assert got == {
        (9, 30, "WITHDRAW_ATM", "S"): 2,
        (9, 30, "WITHDRAW_ATM_QR", "S"): 1,
        (9, 30, "WITHDRAW_ATM", "F_OWN"): 1,
        (9, 30, "PAYMENT_ONLINE", "F_PARTNER"): 1,
        (9, 30, "PAYMENT_POS", "F_PARTNER"): 1,
    }
    named = cards.transactions_per_minute(log, "2025-01-15", own_hosts=["7"], outcomes=("OK", "OURS", "THEIRS"))
    assert {r["status"] for r in named.collect()} == {"OK", "OURS", "THEIRS"}


def test_debt_totals_equal_the_plain_join(rows):
    entities = rows(
        [("p", "m1", "r", "d"), ("p", "m1", "r", "d"), ("p", "m2", "r", "d"), ("q", "m3", "", "d"), ("s", "m4", None, "d")],
        "msphieu string, mst string, dkkd string, cob_dt string",
    ).withColumn("cob_dt", __import__("pyspark").sql.functions.lit("2025-01-15"))
    lines = rows(
        [("p", "2025-01-15", "3000000000.25", "1"), ("p", "2025-01-15", "x", None), ("q", "2025-01-15", "1", "1"), ("p", "2025-01-14", "5", "5")],
        "msphieu string, cob_dt string, duno_vnd string, duno_usd string",
    )
    got = {(r["mst"]): (r["sum_duno_vnd"], r["sum_duno_usd"]) for r in debt.debt_totals(entities, lines, "2025-01-15").collect()}
    assert got == {"m1": (Decimal("6000000000.50"), Decimal("2.00")), "m2": (Decimal("3000000000.25"), Decimal("1.00"))}


def test_contractors_keep_quitters_and_duplicates_of_the_quit_list(rows):
    names = ", ".join(
        f"{c} {'date' if c.endswith('_dt') or c == 'effdt' else 'int' if c in ('emplid', 'empl_rcd', 'effseq') else 'string'}"
        for c in people.HEADCOUNT_COLUMNS
    )
    schema = names + ", job_indicator string, cob_dt string"
    columns = [c.split()[0] for c in schema.split(", ")]

    def job(**values):
        base = {
            "emplid": 1, "empl_rcd": 0, "effdt": dt.date(2025, 1, 1), "effseq": 0, "hr_status": "A", "per_org": "CWR",
            "company": "C", "setid_jobcode": "CN", "job_indicator": "P", "cob_dt": "2025-02-01",
        }
        base.update(values)
        return tuple(base.get(c) for c in columns)

    jobs = rows(
        [job(), job(emplid=2, hr_status="I"), job(emplid=3, hr_status="I", termination_dt=dt.date(2025, 1, 9)), job(emplid=4, setid_jobcode="??"),
         job(emplid=5, effdt=dt.date(2025, 3, 1))],
        schema,
    )
    quits = rows([(2, "2025-01-31"), (2, "2025-01-31"), (3, "2025-01-30")], "emplid int, report_date string")
    listed = people.contractor_headcount(jobs, quits, "2025-02-01", "2025-01-31", "C")
    assert sorted(r["emplid"] for r in listed.collect()) == [1, 2, 2]
    ended = people.contractors_terminated(jobs, listed, "2025-02-01", "2025-01-31", "C")
    assert [r["emplid"] for r in ended.collect()] == [3]


def test_bank_code_names_columns(rows):
    assert "zvaown" in deposits.account_master("own").columns
    assert {"own_percentage", "trust_prod1_flag"} <= {*loans.account_master("own").columns}
    assert "leadr_own_bal_amt" in loans.balances("own").columns
    details = loans.account_details()
    assert [f.name for f in details.schema.fields][:4] == ["loan_act_dtls_sr_key", "eff_strt_dt", "eff_end_dt", "is_cur"]
    assert "cob_dt" not in details.compared and "act_nbr" not in details.compared


def test_trade_files(spark, rows, tmp_path):
    paths = {}
    for label in (trade.EXPORTS, trade.IMPORTS):
        paths[label] = str(tmp_path / label.replace(" ", "_"))
        data = rows([tuple(str(i) for i in range(11))], ", ".join(f"c{i} string" for i in range(11)))
        data.toDF(*trade.HEADERS).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(paths[label])
    got = trade.trade_feeds(spark, paths, "2025-02-10").collect()
    assert sorted(r["type"] for r in got) == [trade.IMPORTS, trade.EXPORTS]
    assert {(r["nam"], r["kim_ngach"], r["cob_dt"]) for r in got} == {("0", "9", "2025-02-28")}
