from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from cascata.functions import business as B
from cascata.functions import dates as D
from cascata.functions import text as T

c = F.col


def one(spark, schema, rows, expression):
    frame = spark.createDataFrame(rows, schema)
    return [r[0] for r in frame.select(expression.alias("x")).collect()]


def test_strip_removes_all_white_space(spark):
    rows = [("\t sp \n",), (" ana　",), ("a b",), (None,), ("   ",)]
    assert one(spark, "s string", rows, T.strip(c("s"))) == ["sp", "ana", "a b", None, ""]
    assert one(spark, "s string", [(" a ",)], T.trim_set(c("s"), "")) == [" a "]


def test_digits_and_numbers(spark):
    rows = [("Plano 20 x 3",), ("livre",), ("",), (None,), ("n 99999999999999999999",)]
    assert one(spark, "s string", rows, T.first_digits(c("s"))) == ["20", None, None, None, "9" * 20]
    assert one(spark, "s string", rows, T.first_number(c("s"))) == [20, None, None, None, None]


def test_joined_key_collides_and_keeps_null(spark):
    rows = [("1", "23"), ("12", "3"), ("1", None)]
    assert one(spark, "a string, b string", rows, T.join_key(c("a"), c("b"))) == ["123", "123", None]


def test_locale_number(spark):
    rows = [("1.234,56",), ("-7,5",), ("n/d",), (None,), (" 3 ",)]
    assert one(spark, "s string", rows, T.locale_number(c("s"))) == [1234.56, -7.5, 0.0, 0.0, 3.0]


def test_dates(spark):
    rows = [("31/01/2024",), ("2024-02-29",), ("1/2/2024",), ("31/02/2024",), ("x",), (None,)]
    expected = [date(2024, 1, 31), date(2024, 2, 29), date(2024, 2, 1), None, None, None]
    assert one(spark, "s string", rows, D.read_date(c("s"))) == expected
    day = [(date(2024, 1, 31),)]
    assert one(spark, "d date", day, D.shift_months(c("d"), 1)) == [date(2024, 2, 29)]
    assert one(spark, "d date", day, D.show_date(c("d"))) == ["31/01/2024"]
    assert one(spark, "d date", day, D.serial_day(c("d"))) == [45322]
    assert one(spark, "d date", day, B.serial_key(F.lit("7"), c("d"))) == ["745322"]


def test_weekday_cutoff_equals_the_list_form(spark):
    months = [(date(2020 + m // 12, m % 12 + 1, 1),) for m in range(120)]

    def by_hand(first, n):
        day = (first.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)
        found = []
        while len(found) < n:
            if day.weekday() < 5:
                found.append(day)
            day -= timedelta(days=1)
        return found

    for n in (1, 5, 6, 7, 10):
        assert one(spark, "m date", months, D.weekday_cutoff(c("m"), n)) == [by_hand(m, n)[-1] for m, in months]
        assert one(spark, "m date", months, D.last_weekdays(c("m"), n)) == [by_hand(m, n) for m, in months]


def test_region(spark):
    rows = [
        (None, None, ""), (" \t", None, ""), (" rs", "x", "Sul"), ("MG", None, "MG/ES"), ("rj ", None, "RJ"),
        ("AM", None, "NO/CO"), ("SE", None, "NE"), ("RR", None, "Outros"), ("sp", "são paulo ", "Sp Capital"),
        ("SP", None, "SP Interior & Litoral"), ("SP", "Campinas", "SP Interior & Litoral"), ("RSX", None, "Outros"),
    ]
    got = one(spark, "s string, m string, e string", rows, B.region(c("s"), c("m")))
    assert got == [r[2] for r in rows]


def test_sizes(spark):
    rows = [
        ("INSERcao 5", "M", "M"), ("Insercao", None, "Insercao"), ("Plano 25", "X", "PP"), ("Plano 26", "X", "P"),
        ("Plano 81", None, "M"), ("Plano 601", None, "G"), ("livre", "X", "X"), (None, None, ""),
    ]
    got = one(spark, "p string, t string, e string", rows, B.adjusted_size(c("p"), c("t")))
    assert got == [r[2] for r in rows]
    assert one(spark, "p string", [("livre",)], B.official_size(c("p"), "PP")) == ["PP"]
    assert one(spark, "p string", [("livre",)], B.official_size(c("p"))) == [None]
    assert one(spark, "t string", [("PP",), ("P",), (None,)], B.fold_smallest(c("t"))) == ["P", "P", None]


def test_teams_keep_their_spelling(spark):
    rows = [("online", "x"), ("Online", "x"), (" ND", None), ("Field", " ana "), ("Field", None), (None, "bo")]
    got = one(spark, "c string, p string", rows, B.team(c("c"), c("p"), "ONLINE", "ND"))
    assert got == ["ONLINE", "ONLINE", "ND", "ANA", "", "BO"]
    got = one(spark, "c string, p string", rows, B.payment_team(c("c"), c("p")))
    assert got == ["X", "Online", "", "ANA", "", "BO"]
    assert one(spark, "c string, p string", [("Field", "")], B.payment_coordinator(c("c"), c("p"))) == ["Field"]


def test_moved_is_never_null(spark):
    rows = [("Novo", "A", "B"), ("Flat", "A", "B"), ("Flat", None, "B"), (None, "A", "B"), ("Flat", "A", "A"), ("Flat", "A", None)]
    got = one(spark, "k string, a string, b string", rows, B.moved(c("k"), c("a"), c("b")))
    assert got == [False, True, False, False, False, False]


def test_elapsed_volume(spark):
    month = date(2024, 5, 1)  # last six weekdays start on Friday 24
    rows = [
        (date(2024, 5, 24), None, None, 10.0), (date(2024, 5, 23), None, None, 0.0),
        (date(2024, 5, 31), date(2020, 6, 2), None, 10.0),  # the year of the payment is ignored
        (date(2024, 5, 31), date(2024, 5, 31), None, 0.0),
        (date(2024, 5, 31), None, date(2024, 5, 1), 0.0), (date(2024, 5, 31), None, date(2023, 5, 1), 10.0),
        (date(2024, 6, 1), None, None, 0.0), (None, None, None, 0.0),
    ]
    data = [(d, p, x, 10.0) for d, p, x, _ in rows]
    got = one(
        spark, "d date, p date, x date, v double", data,
        B.elapsed_volume(c("d"), F.lit(month), c("p"), c("x"), c("v")),
    )
    assert got == [r[3] for r in rows]


def test_rounding_and_payment_region(spark):
    rows = [(Decimal("2.5"),), (Decimal("-2.5"),), (Decimal("0.5"),)]
    assert one(spark, "v decimal(5,2)", rows, F.round(c("v"), 0)) == [3, -3, 1]
    rows = [("RJ+MG+ES",), ("N+NE+CO",), (" Sul ",), (None,)]
    assert one(spark, "r string", rows, B.payment_region(c("r"))) == ["RJ", "NE", "Sul", None]
    rows = [(None, "P"), ("P", "P"), ("M", "P"), ("P", None)]
    got = one(spark, "b string, n string", rows, B.size_status(c("n"), c("b")))
    assert got == ["Novo", "OK", "Mudou", "Mudou"]
