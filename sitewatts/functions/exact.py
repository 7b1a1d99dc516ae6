"""Sums and spreads of measured values that are exact, and that NaN, infinities and huge values don't stop.

A double is summed as whole units and billionths (exact for up to nine decimals,
whatever the order of the rows) while it is near zero, and as a double where it
isn't: NaN, infinities and values from the limit on go to a sum of their own, in
which IEEE arithmetic does what a plain ``sum`` would. Each function gives mergeable
sums, to be added over groups or windows, and SQL for the final value.

* ``parts``: long sums for groups of up to 4e9 rows of values below 2^31; groups of any size add up.
* ``moments``: decimal sums for groups of any size (8e12 rows) of values below 2^40; mean
  and population spread. The spread is n*Q - S^2 of the deviations from the whole-billionth mean,
  put together in 38-digit integers, so values of 1e8 +- 0.0005 keep theirs.
* ``cents``: daily totals as whole cents, null for totals from ``MOST_KWH`` on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Readings from here on (or not finite) are summed as doubles by ``parts`` / by ``moments``.
NEAR_PART, NEAR_MOMENT = "2147483648D", "1099511627776D"
#: Daily totals (kWh) from here on, or not finite, aren't counted in cents.
MOST_KWH = 1e12


# -- sums ---------------------------------------------------------------------


def _nano(v: str) -> str:
    return f"CAST(({v} - floor({v})) * 1e9D + 0.5D AS BIGINT)"


def parts(v: str, name: str) -> list[Column]:
    """Long sums of the column or SQL ``v``: <name>_whole, <name>_nano, and <name>_far (double)."""
    near = f"abs({v}) < {NEAR_PART}"
    return [
        F.expr(f"sum(CASE WHEN {near} THEN floor({v}) END) AS {name}_whole"),
        F.expr(f"sum(CASE WHEN {near} THEN {_nano(v)} END) AS {name}_nano"),
        F.expr(f"sum(CASE WHEN {near} THEN NULL ELSE {v} END) AS {name}_far"),
    ]


def near_sql(name: str) -> str:
    """The near values' exact sum, as decimal(30,9)."""
    return (
        f"(CAST(coalesce({name}_whole, 0) AS DECIMAL(19,0))"
        f" + CAST(coalesce({name}_nano, 0) AS DECIMAL(19,0)) * 0.000000001BD)"
    )


def merged_sum_sql(name: str) -> str:
    """Aggregate of rows of ``parts``: the sum as a double, rounded once where all values are near."""
    return f"(CAST(sum({near_sql(name)}) AS DOUBLE) + coalesce(sum({name}_far), 0D))"


# -- moments ------------------------------------------------------------------

_MOMENTS = ("n", "a", "b", "aa", "ab", "bb", "fn", "f", "ff")


def moments(v: str, name: str) -> list[Column]:
    """Sums of the column or SQL ``v`` from which ``mean_sql`` and ``spread_sql`` work.

    n near values a + b / 1e9 (whole, billionths) with their products; fn far ones with f and ff.
    """
    near = f"abs({v}) < {NEAR_MOMENT}"
    a = f"CASE WHEN {near} THEN CAST(floor({v}) AS DECIMAL(13,0)) END"
    b = f"CASE WHEN {near} THEN CAST({_nano(v)} AS DECIMAL(10,0)) END"
    far = f"CASE WHEN {near} THEN NULL ELSE {v} END"
    one = {
        "n": f"count({a})", "a": f"sum(CAST({a} AS DECIMAL(18,0)))", "b": f"sum(CAST({b} AS DECIMAL(18,0)))",
        "aa": f"sum(({a}) * ({a}))", "ab": f"sum(({a}) * ({b}))", "bb": f"sum(({b}) * ({b}))",
        "fn": f"count({far})", "f": f"sum({far})", "ff": f"sum(({far}) * ({far}))",
    }
    return [F.expr(f"{one[m]} AS {name}_{m}") for m in _MOMENTS]


def merged_moments(name: str, over: str = "", into: str | None = None) -> list[str]:
    """SQL of the sums of ``moments`` added up over groups, or over a window (``over``)."""
    return [f"sum({name}_{m}) {over} AS {into or name}_{m}" for m in _MOMENTS]


def moment_columns(name: str) -> list[str]:
    return [f"{name}_{m}" for m in _MOMENTS]


def _whole(x: str) -> str:
    return f"CAST(coalesce({x}, 0) AS DECIMAL(38,0))"


def mean_sql(name: str) -> str:
    """Mean of all values; null without any. The near sum is rounded once, then divided."""
    near = f"CAST(CAST(coalesce({name}_a, 0) AS DECIMAL(28,0)) + CAST(coalesce({name}_b, 0) AS DECIMAL(28,0)) * 0.000000001BD AS DOUBLE)"
    return f"CASE WHEN {name}_n + {name}_fn > 0 THEN ({near} + coalesce({name}_f, 0D)) / CAST({name}_n + {name}_fn AS DOUBLE) END"


def with_spread(df: DataFrame, name: str, out: str) -> DataFrame:
    """Add ``out``: the population standard deviation of the values behind the sums ``name``_*.

    Null without any value. With far values it comes from double sums (NaN where one isn't finite).
    """
    n = f"CAST({name}_n AS DECIMAL(38,0))"
    a, b, aa, ab, bb = (_whole(f"{name}_{m}") for m in ("a", "b", "aa", "ab", "bb"))
    total = f"try_add(try_multiply({a}, 1000000000BD), {b})"  # sum in billionths
    # c: the mean in whole billionths, rounded down, as whole units (m) and billionths (k)
    step = df.selectExpr("*", f"floor({total} / nullif({n}, 0)) AS _c0")
    step = step.selectExpr("*", "CAST(floor(_c0 / 1000000000BD) AS DECIMAL(38,0)) AS _m", f"{total} AS _total")
    step = step.selectExpr("*", "CAST(_c0 - _m * 1000000000BD AS DECIMAL(38,0)) AS _k")
    d = lambda x, y: f"CAST({x} AS DECIMAL(38,0)) * CAST({y} AS DECIMAL(38,0))"
    step = step.selectExpr(
        "*",
        f"{aa} - 2 * {d('_m', a)} + {n} * {d('_m', '_m')} AS _aa",
        f"{ab} - {d('_m', b)} - {d('_k', a)} + {n} * {d('_m', '_k')} AS _ab",
        f"{bb} - 2 * {d('_k', b)} + {n} * {d('_k', '_k')} AS _bb",
        f"_total - {n} * CAST(_c0 AS DECIMAL(38,0)) AS _r",
    )
    squares = "try_add(try_add(try_multiply(_aa, CAST(1000000000000000000BD AS DECIMAL(19,0))), try_multiply(_ab, 2000000000BD)), _bb)"
    exact = f"try_subtract(try_multiply({squares}, {n}), try_multiply(_r, _r))"
    rough = f"(CAST(_aa AS DOUBLE) * 1e18D + CAST(_ab AS DOUBLE) * 2e9D + CAST(_bb AS DOUBLE)) * CAST({name}_n AS DOUBLE)"
    near = f"sqrt(greatest(0D, coalesce(CAST({exact} AS DOUBLE), {rough}))) / (CAST({name}_n AS DOUBLE) * 1e9D)"
    raw = f"(CAST({aa} AS DOUBLE) + CAST({ab} AS DOUBLE) * 2e-9D + CAST({bb} AS DOUBLE) * 1e-18D + {name}_ff)"
    mean = mean_sql(name)
    far = f"sqrt(greatest(0D, {raw} / CAST({name}_n + {name}_fn AS DOUBLE) - ({mean}) * ({mean})))"
    spread = f"CASE WHEN {name}_fn > 0 THEN {far} WHEN {name}_n > 0 THEN {near} END"
    return step.selectExpr("*", f"{spread} AS {out}").drop("_c0", "_m", "_total", "_k", "_aa", "_ab", "_bb", "_r")


# -- daily totals -------------------------------------------------------------


def cents_sql(v: str) -> str:
    """A daily total (two decimals) as whole cents; null where it isn't near."""
    return f"CASE WHEN abs({v}) < {MOST_KWH!r}D THEN CAST(floor({v} * 100 + 0.5D) AS BIGINT) END"


def far_sql(v: str) -> str:
    """The total where ``cents_sql`` is null."""
    return f"CASE WHEN abs({v}) < {MOST_KWH!r}D THEN NULL ELSE {v} END"


def kwh_sum(v: str) -> Column:
    """Sum of daily totals: cents divided once; NaN, infinite and huge totals as doubles."""
    near = f"CAST(sum({cents_sql(v)}) AS DOUBLE) / 100D"
    far = f"sum({far_sql(v)})"
    return F.expr(f"CASE WHEN {far} IS NULL THEN {near} ELSE {far} + coalesce({near}, 0D) END")


def kwh_mean(v: str) -> Column:
    """Mean of daily totals, one division from ``kwh_sum``'s parts."""
    near, far, n = f"CAST(sum({cents_sql(v)}) AS DOUBLE)", f"sum({far_sql(v)})", f"count({v})"
    return F.expr(
        f"CASE WHEN {far} IS NULL THEN try_divide({near}, CAST({n} * 100 AS DOUBLE)) "
        f"ELSE ({far} + coalesce({near}, 0D) / 100D) / CAST({n} AS DOUBLE) END"
    )
