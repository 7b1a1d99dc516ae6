"""Property tests of the 2-sigma rule.

Each hypothesis example builds many series at once and runs one Spark job,
so the properties are checked over hundreds of series per test.
"""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitewatts.plans import pipeline
from tests.helpers import daily_cents, flags_by_site, gold_for, series_readings

SETTINGS = dict(max_examples=6, deadline=None)

cents_values = st.integers(min_value=0, max_value=500_000)


def _flags(spark, series):
    return flags_by_site(pipeline.with_baseline(daily_cents(spark, series)))


def _exact_flags(values):
    n = len(values)
    mean = sum(values) / n
    var = sum((v - mean) ** 2 for v in values) / n
    # exact rational test: n*v - S > 0 and (n*v - S)^2 > 4 (n*Q - S^2)
    s = sum(values)
    q = sum(v * v for v in values)
    return sum(1 for v in values if n * v - s > 0 and (n * v - s) ** 2 > 4 * (n * q - s * s)), mean, var


@settings(**SETTINGS)
@given(st.lists(st.lists(cents_values, min_size=1, max_size=5), min_size=1, max_size=40))
def test_a_five_days_or_fewer_never_flag(spark, many):
    series = {f"S{i}": v for i, v in enumerate(many)}
    assert all(n == 0 for n in _flags(spark, series).values())


@settings(**SETTINGS)
@given(
    st.lists(
        st.tuples(
            st.integers(min_value=6, max_value=40),
            st.integers(min_value=1, max_value=40),
            st.integers(min_value=0, max_value=10_000),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_b_spike_days_flag_iff_below_a_fifth(spark, specs):
    series, expect = {}, {}
    for i, (n, k, base) in enumerate(specs):
        k = min(k, n - 1)
        series[f"S{i}"] = [base] * (n - k) + [base + 100_000] * k
        expect[f"S{i}"] = k if 5 * k < n else 0
    assert _flags(spark, series) == expect


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(min_value=1, max_value=60), cents_values), min_size=1, max_size=60))
def test_c_constant_series_never_flag(spark, specs):
    series = {f"S{i}": [v] * n for i, (n, v) in enumerate(specs)}
    assert all(n == 0 for n in _flags(spark, series).values())


@settings(**SETTINGS)
@given(st.lists(st.lists(st.integers(min_value=0, max_value=99_999), min_size=1, max_size=30), min_size=1, max_size=30))
def test_flag_equals_exact_rational_rule(spark, many):
    series = {f"S{i}": v for i, v in enumerate(many)}
    got = _flags(spark, series)
    assert got == {k: _exact_flags(v)[0] for k, v in series.items()}


@settings(**SETTINGS)
@given(st.lists(st.lists(st.integers(min_value=0, max_value=99_999), min_size=2, max_size=30), min_size=1, max_size=20))
def test_mean_and_sigma_are_correctly_computed(spark, many):
    series = {f"S{i}": v for i, v in enumerate(many)}
    rows = pipeline.with_baseline(daily_cents(spark, series)).select("site_id", "site_mean_kwh", "site_stddev_kwh").distinct().collect()
    for r in rows:
        _n, mean, var = _exact_flags(series[r["site_id"]])
        assert math.isclose(r["site_mean_kwh"], mean / 100, rel_tol=1e-12, abs_tol=1e-12)
        assert math.isclose(r["site_stddev_kwh"], math.sqrt(var) / 100, rel_tol=1e-9, abs_tol=1e-9)


@settings(**SETTINGS)
@given(
    st.lists(st.lists(st.integers(min_value=0, max_value=99_999), min_size=1, max_size=20), min_size=1, max_size=20),
    st.integers(min_value=2, max_value=7),
)
def test_e_flag_invariant_under_integer_scaling(spark, many, factor):
    series = {f"S{i}": v for i, v in enumerate(many)}
    scaled = {k: [x * factor for x in v] for k, v in series.items()}
    assert _flags(spark, series) == _flags(spark, scaled)


def test_d_gold_total_equals_silver_sum(spark):
    series = {"SITE-0001": [1.234, 2.5, 0.001, 7.777], "SITE-0003": [0.13] * 7}
    g = gold_for(spark, series)
    total_gold = g.agg(F.sum("total_kwh")).first()[0]
    total_in = sum(sum(v) for v in series.values())
    n_rows = g.count()
    assert abs(total_gold - total_in) <= 0.005 * n_rows + 1e-9


def test_f_partitioning_does_not_change_results(spark):
    series = {f"SITE-{i:04d}": [float((i * 7 + d * 13) % 29) for d in range(12)] for i in range(1, 11)}
    r = series_readings(spark, series)
    from tests.helpers import dims

    t = dims(spark)
    a = pipeline.build_gold(r, t["sites"], t["regions"], t["business_units"]).collect()
    b = pipeline.build_gold(r.repartition(7).orderBy(F.rand(3)), t["sites"], t["regions"], t["business_units"]).collect()
    key = lambda x: (x["site_id"], x["reading_date"])
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
    assert {key(x) for x in a} == {key(x) for x in b}
