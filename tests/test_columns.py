"""NULL, text and rounding rules on hand-made rows."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerloom import functions as L


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_missing_parts_count_as_empty_text(rows):
    df = rows("i int, a string, b string", (1, "1", "CASH"), (2, "1", None), (3, None, None))
    assert values(df.orderBy("i"), L.joined_text("a", F.lit("-"), "b")) == [("1-CASH",), ("1-",), ("-",)]


def test_sign_comes_from_quantity_and_null_counts_as_positive(rows):
    df = rows("q decimal(10,2), v decimal(10,2)", (D(-2), D(5)), (D(2), D(-5)), (None, D(-5)), (D(0), D(0)), (D(-1), D(0)))
    out = [r[0] for r in values(df, L.with_sign_of("q", "v"))]
    assert sorted(out) == sorted([D(-5), D(5), D(5), D(0), D(0)])
    assert not any(str(v).startswith("-0") for v in out)


def test_unknown_flag_negates(rows):
    df = rows("f string, v int", ("A", 3), ("B", 3), (None, 3))
    assert values(df, L.negate_unless("f", "A", "v")) == [(3,), (-3,), (-3,)]


def test_zero_divisors_give_null(rows):
    df = rows("a decimal(18,4), b decimal(18,4)", (D(1), D(0)), (D(1), None), (D(1), D(4)))
    assert values(df, L.ratio("a", "b")) == [(None,), (None,), (0.25,)]
    assert [r[0] for r in values(df, L.exact_ratio("a", "b"))] == [None, None, D("0.25")]
    assert values(df, L.to_other_currency("a", "b")) == [(None,), (1.0,), (0.25,)]


def test_cents_round_half_up_once(rows):
    df = rows("a decimal(18,4), b decimal(10,4)", (D("2.345"), D(1)), (D("0.03"), D(8)), (D("123.45"), D(2)))
    assert [r[0] for r in values(df, L.money(L.exact_ratio("a", "b")))] == [D("2.35"), D("0.00"), D("61.73")]


def test_margin(rows):
    df = rows("i int, v decimal(18,4), c decimal(18,4)", (1, D(10), D(7)), (2, D(0), D(7)), (3, None, D(7)), (4, D(3), D(2)), (5, D(10), None))
    assert [r[0] for r in values(df.orderBy("i"), L.margin_percent("v", "c"))] == [D("30.00"), D("0.00"), D("0.00"), D("33.33"), None]


def test_tax_ids(rows):
    df = rows(
        "i int, k string, n string", (1, "J", "11222333000181"), (2, "F", "12345678909"), (3, "J", "191"), (4, "F", "123456789012345"),
        (5, "F", "12AB"), (6, "J", None), (7, "X", "12345678909"), (8, None, "1"), (9, "J", "123456789012345"))
    assert [r[0] for r in values(df.orderBy("i"), L.tax_id_mask("k", "n"))] == [
        "11.222.333/0001-81", "123.456.789-09", "00.000.000/0001-91", "123.456.789-01", "000000012AB", None, None, None,
        "12.345.678/9012-34"]


def test_empty_text_and_nan(rows):
    df = rows("v string", ("",), (None,), ("x",), ("nan",), ("None",))
    assert values(df, L.blank_as_null("v"))[:3] == [(None,), (None,), ("x",)]
    assert values(df, L.nan_as_null("v")) == [("",), (None,), ("x",), (None,), ("None",)]


def test_text_is_cut_not_rejected(rows):
    df = rows("v string", ("é" * 5000,), ("short",), (None,))
    assert [len(r[0]) if r[0] else r[0] for r in values(df, L.capped_text("v"))] == [4000, 5, None]


def test_numbers_from_text(rows):
    df = rows("v string", ("3",), ("3.7",), ("1e2",), ("x",), ("",), (None,))
    assert values(df, L.to_number("v")) == [(3.0,), (3.7,), (100.0,), (None,), (None,), (None,)]
    assert values(df, L.to_integer("v")) == [(3,), (3,), (100,), (None,), (None,), (None,)]


def test_whole_numbers_beyond_doubles(rows):
    df = rows("v string", ("9007199254740993",), ("9223372036854775807.9",), ("9223372036854775808",), (" -12345678901234567 ",), ("0.99999999999",), ("-.5",))
    assert values(df, L.to_integer("v")) == [(9007199254740993,), (9223372036854775807,), (None,), (-12345678901234567,), (0,), (0,)]
    assert values(rows("v decimal(38,10)", (D("9007199254740993.5"),)), L.to_integer("v")) == [(9007199254740993,)]


def test_open_balance_policies(rows):
    df = rows(
        "i int, own boolean, q int, lost int, back int, sent int, here int",
        (1, True, 10, 1, 5, 2, 9), (2, True, 10, 1, 5, None, 9), (3, False, 10, 1, 5, None, 2), (4, False, 10, 1, None, 7, None))
    balance = L.open_balance(F.col("own"), "q", "lost", "back", "sent", "here")
    assert values(df.orderBy("i"), balance) == [(7,), (None,), (2,), (9,)]


def test_days(rows):
    df = rows("d date", (dt.date(2024, 3, 1),), (None,))
    assert values(df, L.day_text("d"), L.parsed_day(L.day_text("d"))) == [("01/03/2024", dt.date(2024, 3, 1)), (None, None)]


def test_last_day_is_open_when_one_is_missing(rows):
    day = dt.date(2024, 1, 5)
    df = rows("k int, d date", (1, day), (1, None), (2, day), (2, dt.date(2024, 2, 1)), (3, None))
    out = df.groupBy("k").agg(F.min("d").alias("a"), L.last_or_open("d").alias("z")).orderBy("k")
    assert values(out, "k", "a", "z") == [(1, day, None), (2, day, dt.date(2024, 2, 1)), (3, None, None)]


def test_unlisted_code_has_no_label(rows):
    df = rows("c string", ("1",), ("7",), (None,))
    assert values(df, L.code_label("c", {"1": "ONE", "2": "TWO"})) == [("ONE",), (None,), (None,)]
