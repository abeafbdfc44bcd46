"""Monthly roll-ups, resampling, rolling means, milestones and spectra.

Inputs may be raw rows or series. Whatever needs one ordered series in one
place first aggregates to days or months, so its size is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions import dates as dt
from driftline.operators.scale import ROWS_PER_TASK, look_back, running_total


def monthly_counts(rows: DataFrame, ts: str, since: str | None = None) -> DataFrame:
    """Rows per month, optionally from a date on (inclusive)."""
    if since is not None:
        rows = rows.where(F.col(ts) >= F.lit(since).cast("timestamp_ntz"))
    return rows.groupBy(dt.month_start(F.col(ts)).alias("month")).agg(
        F.count("*").alias("revisions")
    )


def records_per_month(rows: DataFrame, ts: str) -> DataFrame:
    day = F.to_date(ts)
    return rows.groupBy(F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.count("*").alias("records")
    )


def rolling_mean(
    rows: DataFrame,
    value: str,
    n: int,
    order: Sequence[Column],
    group: Sequence[str] = (),
    out: str = "rolling_mean",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Mean of the last ``n`` rows; null until ``n`` non-null values are there.

    ``order`` must be total. Works on raw rows as on series: long inputs are cut
    into blocks that overlap by n-1 rows. For a series with one row per day or
    month pass ``rows_per_task=None``; for costly rows a written frame.
    """
    framed = look_back(
        rows,
        group,
        order,
        n - 1,
        {"_m": (F.avg(value), True), "_c": (F.count(value), True)},
        rows_per_task,
    )
    return framed.withColumn(out, F.when(F.col("_c") == n, F.col("_m"))).drop("_m", "_c")


def resample_weeks(
    rows: DataFrame, date: str, value: str, weeks: int, group: Sequence[str] = ()
) -> DataFrame:
    """Mean per bin of ``weeks`` weeks, labelled by the bin's closing Sunday.

    Bins start from the first Sunday on or after the earliest date; bins without
    rows stay in the result with a null mean. ``group, label, mean``.
    """
    group = list(group)
    daily = (
        rows.where(F.col(date).isNotNull())
        .groupBy(*group, F.to_date(date).alias("_d"))
        .agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
    )
    # One row per calendar day and group at most, so the window stays small.
    first_day = F.min("_d").over(Window.partitionBy(*group))
    bins = (
        daily.withColumn("_a", dt.first_sunday(first_day))
        .groupBy(*group, dt.week_label(F.col("_d"), F.col("_a"), weeks).alias("label"))
        .agg(F.sum("_s").alias("_s"), F.sum("_c").alias("_c"))
    )
    step = F.expr(f"interval {7 * weeks} days")
    every = F.sequence(F.min("label"), F.max("label"), step)
    spine = (
        bins.groupBy(*group)
        .agg(every.alias("_labels"))
        .select(*group, F.explode("_labels").alias("label"))
    )
    return spine.join(bins, [*group, "label"], "left").select(
        *group, "label", F.try_divide(F.col("_s").cast("double"), "_c").alias("mean")
    )


def milestone_means(
    rows: DataFrame, date: str, value: str, milestone: str, digits: int = 2
) -> DataFrame:
    """Means before and from a milestone on, rounded half to even, in one pass."""
    cut = F.lit(milestone).cast("timestamp_ntz")
    before, after = F.col(date) < cut, F.col(date) >= cut
    return rows.agg(
        F.bround(F.avg(F.when(before, F.col(value))), digits).alias("mean_before"),
        F.bround(F.avg(F.when(after, F.col(value))), digits).alias("mean_after"),
        F.count(F.when(before, F.lit(1))).alias("rows_before"),
        F.count(F.when(after, F.lit(1))).alias("rows_after"),
        F.to_date(F.min(F.when(before, F.col(date)))).alias("first_before"),
        F.to_date(F.max(F.when(before, F.col(date)))).alias("last_before"),
        F.to_date(F.min(F.when(after, F.col(date)))).alias("first_after"),
        F.to_date(F.max(F.when(after, F.col(date)))).alias("last_after"),
    )


def date_histogram(rows: DataFrame, date: str, bins: int = 30) -> DataFrame:
    """Rows in ``bins`` equal spans from first to last date; empty spans stay.

    ``bin`` counts from 0; the last span includes its end. If all dates are
    equal they fall into the middle bin, as with a range widened on both sides.
    """
    daily = (
        rows.where(F.col(date).isNotNull())
        .groupBy(F.to_date(date).alias("_d"))
        .agg(F.count("*").alias("_n"))
    )
    first = daily.agg(F.min("_d")).scalar()
    last = daily.agg(F.max("_d")).scalar()
    span = F.datediff(last, first)
    at = F.floor(F.try_divide(F.datediff("_d", first) * F.lit(bins), span))
    placed = daily.withColumn(
        "bin", F.least(F.coalesce(at, F.lit(bins // 2)), F.lit(bins - 1)).cast("int")
    )
    filled = placed.groupBy("bin").agg(F.sum("_n").alias("records"))
    spine = rows.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(filled, "bin", "left").select(
        "bin", F.coalesce("records", F.lit(0).cast("long")).alias("records")
    )


def series_summary(series: DataFrame, ts: str, value: str) -> DataFrame:
    """Total, mean, maximum and the first time of the maximum."""
    return series.agg(
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        F.max(value).alias("maximum"),
        F.min_by(ts, F.when(F.col(value).isNotNull(), F.struct((-F.col(value)).alias("v"), ts)))
        .alias("maximum_at"),
    )


def summary_text(summary: DataFrame) -> DataFrame:
    """The summary written out: thousands separated, the month by name."""
    return summary.select(
        F.format_number("total", 0).alias("total"),
        F.format_number("mean", 0).alias("mean"),
        F.format_number("maximum", 0).alias("maximum"),
        F.date_format("maximum_at", "MMMM yyyy").alias("maximum_at"),
    )


def top_rows(series: DataFrame, ts: str, value: str, n: int = 10) -> DataFrame:
    """The ``n`` largest values, earlier times first among equals."""
    return series.orderBy(F.desc(value), ts).limit(n)


def dft_spectrum(
    series: DataFrame, group: Sequence[str], order: str, value: str
) -> DataFrame:
    """Fourier magnitudes of each series at k = 0 .. n/2.

    ``series`` has one row per time step of an aggregated series, so a series is
    as long as the calendar and is held as one array; many series run in
    parallel. ``frequency`` is k/n, negative at the Nyquist point of even n.
    """
    points = series.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("t"), F.col(value).alias("x"))))
        .alias("_p")
    )
    values = F.transform("_p", lambda p: p["x"].cast("double"))
    framed = points.select(*group, values.alias("_x"), F.size("_p").alias("n"))

    def part(k: Column, wave) -> Column:
        turn = F.lit(2.0) * F.pi() * k / F.col("n")
        terms = F.transform("_x", lambda x, i: x * wave(turn * i))
        return F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v)

    half = F.expr("n div 2").cast("int")
    k = F.col("k")
    return (
        framed.where(F.col("n") > 0)
        .select(*group, "n", "_x", F.explode(F.sequence(F.lit(0), half)).alias("k"))
        .select(
            *group,
            "k",
            "n",
            F.when(k * 2 == F.col("n"), F.lit(-0.5)).otherwise(k / F.col("n")).alias("frequency"),
            F.sqrt(F.pow(part(k, F.cos), F.lit(2)) + F.pow(part(k, F.sin), F.lit(2)))
            .alias("magnitude"),
        )
    )


def dominant_period(
    series: DataFrame, group: Sequence[str], order: str, value: str, keep_mean: bool = False
) -> DataFrame:
    """Strongest frequency of each series and its period (null at frequency 0).

    Without ``keep_mean`` the constant part k = 0 is left out; with it, a series
    of non-negative values always has frequency 0 and no period.
    """
    spectrum = dft_spectrum(series, group, order, value)
    if not keep_mean:
        spectrum = spectrum.where(F.col("k") > 0)
    best = F.min_by(
        F.struct("k", "frequency", "magnitude"), F.struct((-F.col("magnitude")).alias("m"), "k")
    )
    grouped = spectrum.groupBy(*group) if group else spectrum.groupBy()
    return (
        grouped.agg(best.alias("_b"))
        .select(*group, "_b.k", "_b.frequency", "_b.magnitude")
        .withColumn("period", F.try_divide(F.lit(1.0), "frequency"))
    )


def peaks(
    series: DataFrame,
    order: str,
    value: str,
    trailing: int = 12,
    threshold: float = 2.0,
    group: Sequence[str] = (),
) -> DataFrame:
    """Score of each step against the ``trailing`` steps before it.

    ``series`` is aggregated (one row per time step). ``z`` is null while fewer
    than ``trailing`` earlier steps exist or they do not vary.
    """
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(-trailing, -1)
    z = F.when(
        F.count(value).over(w) == trailing,
        F.try_divide(F.col(value) - F.avg(value).over(w), F.stddev(value).over(w)),
    )
    return series.withColumn("z", z).withColumn(
        "is_peak", F.coalesce(F.col("z") >= threshold, F.lit(False))
    )


def change_points(
    series: DataFrame,
    order: str,
    value: str,
    group: Sequence[str] = (),
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Where each series changes its level most, by cumulative sums (CUSUM).

    ``value`` is whole-numbered and ``order`` unique in a series. The sum of the
    deviations from the mean, up to each step and n-fold to stay whole, is
    n * prefix - step * total; the change comes after the step where it is farthest
    from 0, the earliest of equals. Returns ``group, last_before, deviation, steps,
    steps_before, mean_before, mean_after``; a series that never deviates has none.
    Prefixes are running totals, so a series may be longer than a task can hold.
    """
    keys = list(group) or ["_all"]  # one series still needs a key to join on
    every = series if group else series.withColumn("_all", F.lit(0))
    rows = every.where(F.col(value).isNotNull()).select(*keys, order, value)
    whole = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.sum(value).alias("_total"))
    first = [F.asc(order)]
    summed = running_total(rows, keys, first, F.col(value).cast("long"), "_prefix", rows_per_task)
    summed = running_total(summed, keys, first, F.lit(1).cast("long"), "_step", rows_per_task)
    joined = summed.join(whole, keys)
    off = F.col("_n") * F.col("_prefix") - F.col("_step") * F.col("_total")
    best = F.max_by(
        F.struct(order, "_off", "_n", "_total", "_prefix", "_step"),
        F.struct(F.abs("_off"), -F.col("_step")),
    )
    picked = joined.withColumn("_off", off).groupBy(*keys).agg(best.alias("_b"))
    return picked.where("_b._off <> 0").select(
        *group,
        F.col(f"_b.{order}").alias("last_before"),
        F.abs("_b._off").alias("deviation"),
        F.col("_b._n").alias("steps"),
        F.col("_b._step").alias("steps_before"),
        (F.col("_b._prefix") / F.col("_b._step")).alias("mean_before"),
        (
            (F.col("_b._total") - F.col("_b._prefix")) / (F.col("_b._n") - F.col("_b._step"))
        ).alias("mean_after"),
    )
