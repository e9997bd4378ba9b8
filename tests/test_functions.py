import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratamill import functions as fn


def values(rows, kind, data, column):
    df = rows([(i, v) for i, v in enumerate(data)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_term_months(rows):
    terms = ["1Y6M", "45D", "6M", "", None, "2Y3M15D", "abc", "10000Y"]
    expected = [Decimal(x) for x in ("18.00", "1.50", "6.00", "0.00", "0.00", "27.50", "0.00", "120000.00")]
    assert values(rows, "string", terms, fn.term_months) == expected


def test_whole_number_text(rows):
    texts = ["12", " 12 ", "-3", "12.9", "-0.5", "", None, "n/a", "1.2.3"]
    assert values(rows, "string", texts, fn.whole) == [12, 12, -3, 12, 0, None, None, None, None]
    assert values(rows, "string", ["99999999999"], lambda c: fn.whole(c, "bigint")) == [99999999999]


def test_decimal_text(rows):
    texts = ["12.345", ".5", "1e3", "-7", "", "x", None]
    expected = [Decimal("12.35"), Decimal("0.50"), Decimal("1000.00"), Decimal("-7.00"), None, None, None]
    assert values(rows, "string", texts, fn.number) == expected


@pytest.mark.parametrize(
    "text, rule",
    [
        ("3000000000", fn.whole), ("9" * 20, lambda c: fn.whole(c, "bigint")), ("123456789012345678.00", fn.number),
        ("12345678901234", lambda c: fn.surrogate_key("2025-01-15", c)),
    ],
)
def test_numbers_too_large_stop_the_job(rows, text, rule):
    with pytest.raises(PySparkException):
        values(rows, "string", [text], rule)


def test_day_first_dates(rows):
    texts = ["31/01/2025", "31/02/2024", "29/02/2024", "", "1/2/2024", "2024-01-31", None, "31/01/2025 "]
    good = [dt.date(2025, 1, 31), None, dt.date(2024, 2, 29), None, None, None, None, None]
    assert values(rows, "string", texts, fn.date_from_text) == good


def test_packed_moment(rows):
    texts = ["20250131235959", "2025013123595", "20251331000000", "", None]
    assert values(rows, "string", texts, fn.moment_from_text) == [dt.datetime(2025, 1, 31, 23, 59, 59)] + [None] * 4


@pytest.mark.parametrize(
    "amount, band",
    [
        ("0", 1), ("10000000", 1), ("10000000.50", None), ("10000001", 2), ("20000000", 2), ("30000000", 3),
        ("40000001", 5), ("50000000", 5), ("50000000.01", 6), ("-1", None),
    ],
)
def test_pay_band(rows, amount, band):
    assert values(rows, "decimal(19,2)", [Decimal(amount)], fn.pay_band) == [band]


def test_outcome_of_null_response(rows):
    df = rows([("1", "100"), ("0", "100"), ("0", "9"), (None, "100"), ("0", None)], "r string, h string")
    got = [r[0] for r in df.select(fn.outcome(F.col("r"), F.col("h"), ["100", "234"])).collect()]
    assert got == ["S", "F_OWN", "F_PARTNER", "F_PARTNER", "F_PARTNER"]


def test_month_and_year_ends(rows):
    days = [dt.date(2025, 1, 31), dt.date(2024, 1, 30)]
    assert values(rows, "date", days, fn.month_end_after) == [dt.date(2025, 1, 31), dt.date(2024, 1, 31)]
    ahead = values(rows, "date", days, lambda c: fn.month_end_after(c, 1))
    assert ahead == [dt.date(2025, 2, 28), dt.date(2024, 2, 29)]
    assert values(rows, "date", days, lambda c: fn.year_end_after(c, -1)) == [dt.date(2024, 12, 31), dt.date(2023, 12, 31)]
    assert values(rows, "date", days, fn.is_month_end) == [1, 0]


def test_day_window(rows):
    df = rows([(dt.date(2025, 3, 1),)], "d date")
    row = df.select(*[c.alias(n) for n, c in fn.day_window(F.col("d")).items()]).first().asDict()
    assert row == {
        "cob_dt_prev": "2025-02-28", "cob_dt": "2025-03-01", "cob_dt_next": "2025-03-02",
        "cob_dt_prev_nodash": "20250228", "cob_dt_nodash": "20250301", "cob_dt_next_nodash": "20250302",
    }


def test_days_to_due(rows):
    due = [dt.date(2025, 1, 10), dt.date(2025, 1, 15), dt.date(2025, 2, 1), None]
    assert values(rows, "date", due, lambda c: fn.days_to_due(c, "2025-01-15")) == [-5, -1, 17, None]


def test_effective_rate(rows):
    df = rows(
        [("5.00", dt.date(2025, 2, 1), "7.00"), ("5.00", dt.date(2025, 1, 15), "7.00"), ("5.00", None, "7.00")],
        "p string, e date, n string",
    )
    got = df.select(fn.effective_rate(F.col("p"), F.col("e"), F.col("n"), "2025-01-15")).collect()
    assert [r[0] for r in got] == ["5.00", "7.00", "7.00"]


def test_started_this_month(rows):
    d = dt.date
    df = rows(
        [(d(2025, 1, 1), None), (d(2024, 12, 31), d(2025, 1, 31)), (d(2025, 2, 1), None), (None, None)],
        "h date, r date",
    )
    got = df.select(fn.started_this_month(F.col("h"), F.col("r"), "2025-01-31")).collect()
    assert [r[0] for r in got] == ["1", "1", "0", "0"]


def test_surrogate_key(rows):
    assert values(rows, "bigint", [42, None], lambda c: fn.surrogate_key("2025-01-15", c)) == [25011542, None]
    assert values(rows, "string", ["7", "x7", ""], lambda c: fn.surrogate_key("2025-01-15", c)) == [2501157, None, None]


def test_open_accounts(rows):
    df = rows(
        [
            ("0", "1", None), ("0", "4", "15/01/2025"), ("0", "4", "14/01/2025"), ("0", None, None), ("1", "1", None),
            ("0", None, "20/01/2025"),
        ],
        "cpf string, stat string, dtc string",
    )
    kept = df.where(fn.is_open_account(F.col("cpf"), F.col("stat"), F.col("dtc"), "2025-01-15")).collect()
    assert [tuple(r) for r in kept] == [("0", "1", None), ("0", "4", "15/01/2025"), ("0", None, "20/01/2025")]


def test_elapsed_is_decimal(rows):
    df = rows([(dt.date(2025, 1, 1), dt.date(2000, 1, 1))], "a date, b date")
    age = df.select(F.round(fn.elapsed(F.col("a"), F.col("b"), "365.25"), 2).alias("age"))
    assert age.first()["age"] == Decimal("25.00") and age.schema["age"].dataType.simpleString() == "decimal(15,2)"


def test_code_label_and_blanks(rows):
    assert values(rows, "int", [1, 0, 7, None], lambda c: fn.code_label(c, {1: "a", 0: "b"})) == ["a", "b", None, None]
    assert values(rows, "string", ["", " ", None, "x"], fn.empty_as_null) == [None, " ", None, "x"]
    assert values(rows, "string", [" a ", None], fn.trimmed) == ["a", None]


def test_shuffle_partitions():
    from stratamill.session import shuffle_partitions

    assert shuffle_partitions(10 * 1024**4, 4000) == 20480
    assert shuffle_partitions(1, 8) == 16


def test_scratch_folder_follows_the_session(spark):
    from stratamill.session import scratch_dir

    root = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and (root is None or one.startswith(root))
