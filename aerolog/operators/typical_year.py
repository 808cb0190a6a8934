"""Typical meteorological years: the Finkelstein-Schafer selection and the plain mean.

The windows below rank daily values of one station and calendar month (31 per year of history).
They all cluster on (station, month), so the daily table is shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.calendar import in_typical_year, not_leap_day
from ..schemas import KEYS
from ..session import dealt
from .resample import daily_mean

#: Variables that are ranked; the last one (wind) only breaks the final choice.
RANKED = ("t_db", "ghi", "rh", "v_air")
SCORED = ("t_db", "ghi", "rh")
MEAN_FIELDS = ("v_air", "t_db", "t_dp", "rh", "p_atm", "rain", "ghi")
SOIL_FIELDS = ("soil_t_0_7", "soil_t_7_28", "soil_t_28_100", "soil_t_100_255")


def finkelstein_schafer(daily: DataFrame, variables: Sequence[str] = RANKED,
                        wind: str | None = "v_air", keys: Sequence[str] = KEYS, day: str = "day",
                        denominator: str = "n", whole_months: bool = False) -> DataFrame:
    """``fs_<variable>`` per station, year and month, and the monthly mean of ``wind``.

    The statistic sums the distances between the distribution of a single month and that of the
    same calendar month over all years.  ``denominator`` is ``"n"`` or ``"n+1"``.  With
    ``whole_months``, months with missing days are left out before ranking: they have fewer terms
    and would look typical. Only values that are there are ranked and counted; a variable without any
    has a NULL statistic.
    """
    if denominator not in ("n", "n+1"):
        raise ValueError(f"denominator must be 'n' or 'n+1', not {denominator!r}")
    extra = 1 if denominator == "n+1" else 0
    columns = dict.fromkeys([*variables, *([wind] if wind else [])])
    rows = (
        daily.where(F.col(day).isNotNull())
        .select(*keys, day, F.year(day).alias("year"), F.month(day).alias("month"), *columns)
    )
    rows = dealt(rows, *keys, "month")
    all_years = Window.partitionBy(*keys, "month")
    one_year = Window.partitionBy(*keys, "month", "year")
    if whole_months:
        rows = (
            rows.withColumn("_days", F.count(F.lit(1)).over(one_year))
            .where(F.col("_days") == F.dayofmonth(F.last_day(day))).drop("_days")
        )

    def distribution(group, order, v) -> Column:
        # rank and count share the window, so counting costs no further sort; NULLs come last and don't count
        ordered = group.orderBy(*order)
        size = F.count(v).over(
            ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        return F.row_number().over(ordered) / (size + extra)

    for v in variables:
        order = (F.round(v, 9).asc_nulls_last(), day)
        rows = rows.withColumn(f"_d_{v}", F.when(F.col(v).isNotNull(), F.abs(
            distribution(one_year, order, v) - distribution(all_years, order, v))))
    return rows.groupBy(*keys, "month", "year").agg(
        *[F.sum(f"_d_{v}").alias(f"fs_{v}") for v in variables],
        *([F.avg(wind).alias("_wind")] if wind else []),
    )


def typical_months(statistics: DataFrame, keys: Sequence[str] = KEYS,
                   scored: Sequence[str] = SCORED, variant: str = "sum",
                   best: int = 3) -> DataFrame:
    """The chosen year of each calendar month and its total.

    Of the ``best`` years with the lowest total, the one whose mean wind is nearest to the mean of
    those years.  ``variant="as_written"`` counts the first variable once per scored variable.
    The total sums the statistics that a month has; a month without any comes last, and so does a
    candidate without wind.
    """
    if variant == "as_written":
        total = sum((F.col(f"fs_{scored[0]}") for _ in scored), F.lit(0.0))
    elif variant == "sum":
        known = F.coalesce(*(F.col(f"fs_{v}") for v in scored))
        total = F.when(known.isNotNull(), sum((F.coalesce(f"fs_{v}", F.lit(0.0)) for v in scored), F.lit(0.0)))
    else:
        raise ValueError(f"unknown variant {variant!r}")
    month = Window.partitionBy(*keys, "month")
    candidates = (
        statistics.withColumn("fs_tot", total)
        .withColumn("_rank", F.row_number().over(month.orderBy(F.round("fs_tot", 9).asc_nulls_last(), "year")))
        .where(F.col("_rank") <= best)
        .withColumn("_gap", F.round(F.abs(F.col("_wind") - F.avg("_wind").over(month)), 9))
    )
    return candidates.groupBy(*keys, "month").agg(
        F.min_by(F.struct("year", "fs_tot"), F.struct(F.col("_gap").isNull(), "_gap", "_rank")).alias("_best"),
    ).select(*keys, "month", F.col("_best.year").alias("chosen_year"), "_best.fs_tot")


def typical_rows(series: DataFrame, chosen: DataFrame, columns: Sequence[str],
                 keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """The rows of the chosen months, dated 1970.

    The twelve chosen years of a station become one row, so that the join goes by station alone: a
    series that is laid out by station stays where it is, and only the choice moves. No side is
    forced to be broadcast; the runtime sizes decide.
    """
    picked = chosen.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("month", "chosen_year"))).alias("_years"))
    rows = series.where(not_leap_day(F.col(ts))).join(picked, list(keys))
    return rows.where(F.try_element_at("_years", F.month(ts)) == F.year(ts)).select(
        *keys, in_typical_year(F.col(ts)).alias("tmy_ts"), *columns)


def iso_typical_year(hourly: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS,
                     ts: str = "ts", scored: Sequence[str] = SCORED, wind: str = "v_air",
                     **options) -> DataFrame:
    """Typical year of a dense hourly series: daily means, statistics, choice, rows.

    ``scored`` are the variables of the total; a source without global radiation scores another one
    (``dif``). Options: ``denominator``, ``variant``, ``whole_months``.
    """
    variant = options.pop("variant", "sum")
    daily = daily_mean(hourly, [*scored, wind], keys, ts)
    chosen = typical_months(finkelstein_schafer(daily, scored, wind, keys, **options), keys, scored, variant)
    return typical_rows(hourly, chosen, columns, keys, ts)


def mean_typical_year(hourly: DataFrame, mean: Sequence[str] = MEAN_FIELDS,
                      mode: Sequence[str] = ("wind_dir",), keys: Sequence[str] = KEYS,
                      ts: str = "ts") -> DataFrame:
    """Average over the years of every calendar hour; the most frequent wind direction (smallest on ties).

    Values are counted before the most frequent is chosen. Rows move once, by calendar hour, which
    suits both aggregations: years of one hour seldom meet in a task before.
    """
    rows = hourly.where(not_leap_day(F.col(ts))).select(*keys, in_typical_year(F.col(ts)).alias("tmy_ts"), *mean, *mode).repartition(*keys, "tmy_ts")
    if len(mode) != 1:  # several are left to the built-in aggregate: a group has one row a year
        return rows.groupBy(*keys, "tmy_ts").agg(*[F.avg(c).alias(c) for c in mean], *[F.mode(c, True).alias(c) for c in mode])
    value = F.col(mode[0])
    counted = rows.groupBy(*keys, "tmy_ts", value).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in mean], *[F.count(c).alias(f"_n_{c}") for c in mean])
    return counted.groupBy(*keys, "tmy_ts").agg(
        *[F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_n_{c}")).alias(c) for c in mean],
        F.max_by(value, F.when(value.isNotNull(), F.struct("_n", -value))).alias(mode[0]))
