"""Trend windows and ranking: FIXTURES C2 plus brute-force property tests."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests import brute
from trafficlens.operators import ranking as RK
from trafficlens.operators import trends as T

LENGTHS = [1, 2, 13, 14, 15, 16, 20, 60, 61, 62, 70]


def _counts(spark, named_series):
    rows = []
    for name, c in named_series.items():
        for i, v in enumerate(c):
            rows.append((name, f"d{i:04d}", v))
    return spark.createDataFrame(rows, "title string, dt string, views bigint")


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)


def _check_table(spark, named):
    got = {}
    for r in T.trend_table(_counts(spark, named)).collect():
        got.setdefault(r.title, []).append(r)
    for name, c in named.items():
        rows = sorted(got[name], key=lambda r: r.idx)
        assert [r.views for r in rows] == c
        d, wa, ma = brute.daily(c), brute.windowed_at(c, 7), brute.windowed_at(c, 30)
        for r in rows:
            i = r.idx
            assert _close(r.daily_trend, d[i]), (name, i)
            assert _close(r.weekly_trend_at, wa[i]), (name, i)
            assert _close(r.monthly_trend_at, ma[i]), (name, i)
            assert _close(r.weekly_trend, wa[i - 1] if i > 0 else 0.0), (name, i)
            assert _close(r.monthly_trend, ma[i - 1] if i > 0 else 0.0), (name, i)


def test_fixture_series_t16(spark):
    c = brute.series(16)
    assert c == [6, 11, 5, 10, 15, 9, 14, 8, 13, 18, 12, 17, 22, 16, 21, 26]
    rows = sorted(T.trend_table(_counts(spark, {"T16": c})).collect(), key=lambda r: r.idx)
    assert round(rows[1].daily_trend, 6) == 0.833333
    assert round(rows[14].weekly_trend_at, 6) == 0.514286
    assert round(rows[15].weekly_trend_at, 6) == 0.652778
    assert round(rows[15].weekly_trend, 6) == 0.514286
    assert all(r.monthly_trend == 0.0 for r in rows)


def test_fixture_lengths_against_slices(spark):
    _check_table(spark, {f"T{n}": brute.series(n) for n in LENGTHS})


def test_zero_divisor_is_null(spark):
    rows = sorted(T.trend_table(_counts(spark, {"z": [0, 5, 0, 0]})).collect(), key=lambda r: r.idx)
    assert rows[1].daily_trend is None and rows[2].daily_trend == -1.0 and rows[3].daily_trend is None


def test_rank_fixtures(spark):
    named = {f"T{n}": brute.series(n) for n in (2, 16, 70)}
    got = {r.title: r for r in RK.rank_long(_counts(spark, named)).collect()}
    assert got["T16"].monthly_trend == 211.0
    assert math.isclose(got["T16"].daily_trend, 75.23739265616659, rel_tol=1e-12)
    assert math.isclose(got["T16"].error, 0.06696495301824251, rel_tol=1e-12)
    assert got["T70"].monthly_trend == 223.0
    assert math.isclose(got["T70"].daily_trend, 14.413151853449856, rel_tol=1e-12)
    assert math.isclose(got["T70"].error, 0.01878783393176317, rel_tol=1e-12)
    assert (got["T2"].monthly_trend, got["T2"].daily_trend, got["T2"].error) == (0.0, 0.0, 0.0)


def test_rank_arrays_matches_brute(spark):
    rows = [(i, [f"d{j:03d}" for j in range(n)], brute.series(n), sum(brute.series(n)))
            for i, n in enumerate(LENGTHS)]
    rows.append((99, [f"d{j:03d}" for j in range(10)], list(range(10)), 0))
    df = spark.createDataFrame(rows, "page_id bigint, dates array<string>, pageviews array<bigint>, "
                                     "total_pageviews bigint")
    for r in RK.rank_arrays(df).collect():
        src = next(x for x in rows if x[0] == r.page_id)
        m, d, e = brute.rank(src[2], src[3])
        assert _close(r.monthly_trend, m) and _close(r.daily_trend, d) and _close(r.error, e)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(min_value=0, max_value=50), min_size=1, max_size=130),
                min_size=1, max_size=4))
def test_property_trends_equal_slices(spark, many):
    _check_table(spark, {f"s{i}": c for i, c in enumerate(many)})


@pytest.mark.parametrize("n", [7, 8, 31])
def test_property_rank_long_equals_slices(spark, n):
    c = [(i * 7919) % 23 for i in range(n)]
    r = RK.rank_long(_counts(spark, {"x": c})).collect()[0]
    m, d, e = brute.rank(c, sum(c))
    assert _close(r.monthly_trend, m) and _close(r.daily_trend, d) and _close(r.error, e)
