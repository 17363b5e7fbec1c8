"""Months as values, as sets and as requests."""

from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from faremill.operators import periods as p
from faremill.plans import requests

ORDER = {
    "rebuild_mode": "full_raw_rebuild",
    "confirm_full_rebuild": " True",
    "confirm_serving_replacement": True,
    "expected_start_year": 1997,
    "expected_start_month": "9",
    "expected_end_year": "1998",
    "expected_end_month": 2,
}
WINTER = [("1997", "09"), ("1997", "10"), ("1997", "11"), ("1997", "12"), ("1998", "01"), ("1998", "02")]

months = st.integers(min_value=12, max_value=12 * 9999 - 1)


def named(number):
    return f"{number // 12:04d}", f"{number % 12 + 1:02d}"


def of(spark, *found):
    return spark.createDataFrame([tuple(x.split("-")) for x in found], "year string, month string")


def names(df):
    return sorted(f"{r['year']}-{r['month']}" for r in df.collect())


@given(months, st.integers(0, 400))
@settings(max_examples=60, deadline=None)
def test_a_range_holds_every_month_once_in_order(first, more):
    last = min(first + more, 12 * 9999 - 1)
    found = p.month_range(*named(first), *named(last))
    assert found == [named(n) for n in range(first, last + 1)]
    assert found == sorted(found)  # text order is calendar order


@given(months)
@settings(max_examples=60, deadline=None)
def test_first_and_last_day_enclose_the_month(number):
    year, month = named(number)
    first, last = p.first_of_month(year, month), p.last_of_month(int(year), int(month))
    assert first.day == 1 and first.month == last.month == int(month)
    if (year, month) != ("9999", "12"):
        assert (last + timedelta(days=1)).day == 1
    assert p.normalize_period(int(year), int(month)) == p.as_period(last) == (year, month)


@pytest.mark.parametrize(
    ("year", "month", "complaint"),
    [(1997, -3, "month"), (1997, "14", "month"), (-1, 4, "year"), ("next", 4, "year"), (1997, [], "month")],
)
def test_what_is_no_month_is_refused(year, month, complaint):
    with pytest.raises(ValueError, match=complaint):
        p.normalize_period(year, month)


def test_a_range_must_not_run_backwards():
    with pytest.raises(ValueError, match="1998-02.*1997-09"):
        p.month_range(1998, 2, 1997, 9)


def test_only_files_in_the_folder_of_their_month_are_found(spark):
    def key(folder, name, kind="yellow", end="parquet", root="abfs://lake/x"):
        year, month = folder.split("-")
        return f"{root}/raw/{kind}/year={year}/month={month}/{kind}_tripdata_{name}.{end}"

    good = [key(m, m) for m in ("1998-02", "1997-11", "1997-09")]
    repeated = [key("1997-11", "1997-11", root="file:/elsewhere")]
    strays = [
        key("1997-10", "1997-09"), key("1997-00", "1997-00"), key("0000-10", "0000-10"),
        key("1997-7", "1997-7"), key("1997-12", "1997-12", end="parquet.crc"),
        key("1997-12", "1997-12", end="orc"), key("1997-12", "1997-12", kind="lookup"),
        key("1997-12", "1997-12").replace("/raw/", "/draw/"),
    ]
    green = [key("1996-04", "1996-04", kind="green")]
    paths = spark.createDataFrame([(x,) for x in good + repeated + strays + green], "path string")
    found = [tuple(row) for row in p.discover_periods(paths).collect()]
    assert found == [("1997", "09"), ("1997", "11"), ("1998", "02")]
    assert names(p.discover_periods(paths, "green")) == ["1996-04"]


def test_sets_of_months_against_python_sets(spark):
    left, right = ["1997-09", "1997-09", "1997-12", "1998-01"], ["1997-12", "1997-10", "1997-10"]
    raw, wanted = of(spark, *left), of(spark, *right)
    only_left, only_right = sorted({*left} - {*right}), sorted({*right} - {*left})
    assert names(p.new_periods(raw, wanted)) == names(p.unexpected_periods(raw, wanted)) == only_left
    assert names(p.missing_periods(raw, wanted)) == only_right
    found = {(f"{r.year}-{r.month}", r.status) for r in p.compare_periods(raw, wanted).collect()}
    expected = {(m, "unexpected") for m in only_left} | {(m, "missing") for m in only_right}
    assert found == expected | {(m, "matched") for m in {*left} & {*right}}


def test_a_month_counts_as_processed_with_rows_in_all_tables(spark):
    tables = {
        "one": of(spark, "1997-09", "1997-10", "1997-11"),
        "two": of(spark, "1997-10", "1997-10", "1997-11"),
        "three": of(spark, "1997-11", "1997-09", "1997-10"),
    }
    assert names(p.fully_processed(tables)) == ["1997-10", "1997-11"]
    assert names(p.fully_processed({**tables, "four": tables["one"].limit(0)})) == []
    with pytest.raises(ValueError, match="no tables"):
        p.fully_processed({})


def test_sequences_and_bounds_come_from_the_outermost_months(spark):
    found = of(spark, "1998-02", "1997-09", "1997-11")
    assert names(p.month_sequence(p.period_bounds(found))) == ["-".join(m) for m in WINTER]
    assert tuple(p.expected_range(found).first()) == (date(1997, 9, 1), date(1998, 2, 28))
    leap = p.month_bounds(of(spark, "1996-02")).first()
    assert (leap.month_start, leap.next_month_start) == (date(1996, 2, 1), date(1996, 3, 1))


def test_a_rebuild_needs_exactly_the_confirmed_months():
    assert p.check_rebuild_source(WINTER[::-1] + WINTER[:1], WINTER) == WINTER
    with pytest.raises(ValueError, match="no raw"):
        p.check_rebuild_source([], WINTER)
    with pytest.raises(ValueError, match="Missing periods: 1997-12. Unexpected periods: 1999-01"):
        p.check_rebuild_source([m for m in WINTER if m[1] != "12"] + [("1999", "01")], WINTER)


def test_refresh_requests_are_bounded():
    asked = {"start_year": 1997, "start_month": 9, "end_year": 1998, "end_month": 2}
    assert requests.refresh_periods(asked) == requests.refresh_periods(asked, most=6) == WINTER
    with pytest.raises(ValueError, match="6 months.*5"):
        requests.refresh_periods(asked, most=5)
    with pytest.raises(ValueError, match="refresh_mode"):
        requests.refresh_periods({**asked, "refresh_mode": "merge"})
    # blank values take the default month
    assert requests.refresh_periods({"start_year": "", "end_month": "  "}) == requests.refresh_periods(None)
    assert len(requests.refresh_periods(None)) == 1


@pytest.mark.parametrize(
    ("change", "complaint"),
    [
        ({"rebuild_mode": "some"}, "rebuild_mode"),
        ({"confirm_full_rebuild": "sure"}, "confirm_full_rebuild"),
        ({"confirm_serving_replacement": 0}, "confirm_serving_replacement"),
        ({"expected_start_month": None}, "expected_start_month"),
        ({"expected_end_year": " "}, "expected_end_year"),
        ({"expected_end_year": 1996}, "1997-09.*1996-02"),
        ({"expected_start_month": 20}, "month"),
    ],
)
def test_rebuild_requests_need_every_confirmation(change, complaint):
    assert requests.rebuild_request(ORDER).expected == tuple(WINTER)
    with pytest.raises(ValueError, match=complaint) as refused:
        requests.rebuild_request({**ORDER, **change})
    assert "Nothing was changed" in str(refused.value)
