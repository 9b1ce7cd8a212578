import datetime as dt

import pytest
from pyspark.sql import functions as F

from assaymill.functions import dates, numbers, text


def test_clean_name(one):
    got = one(text.clean_name, ["  aDA ", "mary  ann", "a    b", "O'BRIEN", "", None])
    assert got == ["Ada", "Mary ann", "A b", "O'brien", "", None]


def test_clean_email(one):
    assert one(text.clean_email, [" A@B.C ", "  ", None]) == ["a@b.c", None, None]


@pytest.mark.parametrize("raw, clean", [
    ("(212) 555-0100", "(212) 555-0100"), ("212-555-0100", "(212) 555-0100"),
    ("212.555.0100", "(212) 555-0100"), ("+1 212 555 0100", "(212) 555-0100"),
    ("2125550100", "(212) 555-0100"), ("212555010", "212555010"), ("  ", None), (None, None),
])
def test_normalize_phone(one, raw, clean):
    assert one(text.normalize_phone, [raw]) == [clean]


def test_normalize_state(one):
    raw = ["California", "calif.", "ca", " NY ", "new york", "Narnia", "", None]
    assert one(text.normalize_state, raw) == ["CA", "CA", "CA", "NY", "NY", None, None, None]


def test_standard_values(one):
    assert one(text.standardize_boolean, ["Y", " true", "1", "NO", "0", "maybe", None]) == [
        1, 1, 1, 0, 0, None, None]
    assert one(text.standardize_category, ["FOOT WEAR ", "Camping and  Hiking", "misc"]) == [
        "Footwear", "Camping & Hiking", None]
    assert one(text.standardize_channel, ["in-store", "In Store ", "ONLINE", "phone"]) == [
        "In-Store", "In-Store", "Online", None]
    assert one(text.standardize_payment_method, ["cc", "PayPal ", "cheque"]) == [
        "Credit Card", "PayPal", None]


def test_text_kind(one):
    assert one(text.text_kind, ["12.5", " 3 ", "$4", "", None]) == [
        "number", "number", "text", "text", "null"]


def test_parse_mixed_date(one):
    raw = ["03/09/2021", "2021-03-09", "2021-03-09 23:59:59", "9 March 2021", "2021-02-30", None]
    day = dt.date(2021, 3, 9)
    assert one(dates.parse_mixed_date, raw) == [day, day, day, None, None, None]


def test_numbers(one, spark):
    assert one(numbers.lenient_double, ["1.2 kg", "TBD", " 7", "-3.5x", "", None]) == [
        1.2, 0.0, 7.0, -3.5, 0.0, None]
    assert one(numbers.parse_weight, ["1.2 kg", "0.5", None]) == [1.2, 0.5, None]
    assert one(numbers.fix_discount_pct, [25.0, 0.25, 1.0, None], "double") == [
        0.25, 0.25, 1.0, None]
    df = spark.createDataFrame([(None, 10.0, 0.1), (3, 9.99, 0.25), (-2, 5.0, 0.0)],
                               "q int, p double, d double")
    net = [r[0] for r in df.select(numbers.net_amount(F.col("q"), F.col("p"), F.col("d"))).collect()]
    gross = [r[0] for r in df.select(numbers.gross_amount(F.col("q"), F.col("p"))).collect()]
    assert net == [0.0, 22.48, -10.0] and gross == [None, 29.97, -10.0]


def test_discount_tier_edges(one):
    assert one(numbers.discount_tier, [0.2, 0.19, 0.01, 0.0, None], "double") == [
        "High Discount (20%+)", "Standard Discount", "Standard Discount", "Full Price", "Full Price"]


def test_money_sum_is_exact_in_any_order(spark):
    cents = [10, 20, 30, 999999999999, -5] * 200
    df = spark.createDataFrame([(c / 100,) for c in cents], "v double").repartition(7)
    assert df.agg(numbers.money_sum(F.col("v"))).first()[0] == sum(cents) / 100


def test_fiscal_boundaries(one):
    days = [dt.date(2026, 9, 30), dt.date(2026, 10, 1), dt.date(2026, 12, 31), dt.date(2027, 1, 1)]
    assert one(dates.fiscal_year, days, "date") == [2026, 2027, 2027, 2027]
    assert one(dates.fiscal_quarter, days, "date") == [4, 1, 1, 2]


def test_date_parts(one):
    day = [dt.date(2026, 6, 30), dt.date(2024, 2, 29), dt.date(2026, 7, 5), None]
    assert one(dates.date_key, day, "date") == [20260630, 20240229, 20260705, None]
    assert one(dates.day_of_week, day[:3], "date") == [2, 4, 0]
    assert one(dates.is_weekend, day[:3], "date") == [0, 0, 1]


def test_month_ends(one):
    days = [dt.date(2026, 6, 1), dt.date(2026, 12, 5), dt.date(2026, 2, 3)]
    assert one(dates.calculated_month_end, days, "date") == [
        dt.date(2026, 6, 26), dt.date(2026, 12, 31), dt.date(2026, 2, 27)]
    assert one(dates.trimester_end, days, "date") == [
        dt.date(2026, 8, 28), dt.date(2026, 12, 31), dt.date(2026, 4, 24)]


def test_local_time_switches_on_the_utc_date(one):
    stamps = [dt.datetime(2026, 3, 7, 23, 59, 59), dt.datetime(2026, 3, 8, 0, 0, 0),
              dt.datetime(2026, 10, 31, 12, 0, 0), dt.datetime(2026, 11, 1, 12, 0, 0)]
    got = one(lambda c: F.date_format(dates.local_time_us_dst(c), "MM-dd HH:mm:ss"), stamps,
              "timestamp_ntz")
    assert got == ["03-07 17:59:59", "03-07 19:00:00", "10-31 07:00:00", "11-01 06:00:00"]
