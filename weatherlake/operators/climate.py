"""Climatology of one indicator: monthly and seasonal means, statistics per
year-month, one year against the others, paired indicators and per-year
series.

Every function works on one position (``lat``/``lon`` given, matched in the
stored float type) or on all positions at once (``lat=None``), in which case
the position becomes part of the grouping key.  Each result is one
``groupBy().agg()``: a partial aggregate before the shuffle (so a position
holding a third of all rows costs no more than any other) and a final
aggregate after it.  Aggregates run on doubles; NULL values are dropped first,
which also decides which groups exist.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weatherlake import schema
from weatherlake.functions.exprs import as_double, f_to_c, half_even, position_eq, validate_indicator


def _scope(obs: DataFrame, indicator: str, lat: float | None, lon: float | None) -> tuple[DataFrame, list[str]]:
    validate_indicator(indicator, "numeric", obs.columns)
    if lat is None:
        if lon is not None:
            raise ValueError("lon given without lat")
        return obs, ["lat", "lon"]
    return obs.filter(position_eq(lat, lon)), ([] if lon is not None else ["lon"])


def _value(indicator: str, pre_round: int | None) -> Column:
    return as_double(indicator) if pre_round is None else half_even(indicator, pre_round)


def _finish(mean: Column, to_celsius: bool, indicator: str | None = None) -> Column:
    if to_celsius and indicator is not None and indicator not in schema.FAHRENHEIT_INDICATORS:
        raise ValueError(f"{indicator!r} is not a temperature in Fahrenheit")
    return f_to_c(mean) if to_celsius else mean


def seasonal_mean(obs: DataFrame, indicator: str = "tmpf", lat: float | None = None, lon: float | None = None,
                  *, pre_round: int | None = None, to_celsius: bool = False) -> DataFrame:
    """Mean of the indicator per calendar month over all years.

    ``pre_round`` rounds each value (half to even) before averaging;
    ``to_celsius`` converts the mean from Fahrenheit.
    Columns: [lat, lon,] month, n_obs, mean.
    """
    df, keys = _scope(obs, indicator, lat, lon)
    return (df.filter(F.col(indicator).isNotNull())
            .groupBy(*keys, "month")
            .agg(F.count(F.lit(1)).alias("n_obs"),
                 _finish(F.avg(_value(indicator, pre_round)), to_celsius, indicator).alias("mean")))


def monthly_mean(obs: DataFrame, indicator: str = "tmpf", lat: float | None = None, lon: float | None = None,
                 *, pre_round: int | None = 1, to_celsius: bool = False) -> DataFrame:
    """Mean of the indicator per (year, month).
    Columns: [lat, lon,] year, month, n_obs, mean."""
    df, keys = _scope(obs, indicator, lat, lon)
    return (df.filter(F.col(indicator).isNotNull())
            .groupBy(*keys, "year", "month")
            .agg(F.count(F.lit(1)).alias("n_obs"),
                 _finish(F.avg(_value(indicator, pre_round)), to_celsius, indicator).alias("mean")))


def historical_stats(obs: DataFrame, indicator: str = "tmpf", lat: float | None = None, lon: float | None = None,
                     *, limit: int | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """Count, mean and population standard deviation per (year, month).

    ``limit`` keeps only the first ``limit`` rows of each position in time
    order (ties by station, then by ``tie_break`` columns) before NULLs are
    dropped.  Rows per (year, month) are counted first, by hash; only the
    months that hold a position's first rows are then ranked, so a long history
    is neither sorted nor brought to one task.
    Columns: [lat, lon,] year, month, n_obs, mean, std.
    """
    df, keys = _scope(obs, indicator, lat, lon)
    if limit is not None:
        order = ([F.col(c) for c in schema.TIME_PARTS] + [F.col("station").asc_nulls_last()]
                 + [F.col(c).asc_nulls_last() for c in tie_break])
        df = _first_months(df, keys, limit)
        if not keys:
            df = df.orderBy(*order).limit(limit)
        else:
            w = Window.partitionBy(*keys).orderBy(*order)
            df = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit).drop("_rn")
    x = as_double(indicator)
    return (df.filter(F.col(indicator).isNotNull())
            .groupBy(*keys, "year", "month")
            .agg(F.count(F.lit(1)).alias("n_obs"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")))


def _first_months(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """The rows of the months that hold the first ``limit`` rows per key."""
    groups = [*keys, "year", "month"]
    n = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("year", "month").rowsBetween(Window.unboundedPreceding, -1)
    needed = n.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).filter(F.col("_before") < limit)
    needed = needed.select(*[F.col(c).alias(f"_{c}") for c in groups])
    same = F.lit(True)
    for c in groups:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(needed, same, "left_semi")


def yearly_series(obs: DataFrame, indicator: str = "tmpf", lat: float | None = None, lon: float | None = None,
                  *, pre_round: int | None = 1, to_celsius: bool = False) -> DataFrame:
    """Monthly means gathered into one month-ordered list per year.

    The list holds at most twelve entries, so the second aggregation is
    bounded whatever the data size.
    Columns: [lat, lon,] year, series array<struct<month, value>>.
    """
    monthly = monthly_mean(obs, indicator, lat, lon, pre_round=pre_round, to_celsius=to_celsius)
    keys = [c for c in monthly.columns if c in ("lat", "lon")]
    return (monthly.groupBy(*keys, "year")
            .agg(F.sort_array(F.collect_list(F.struct(F.col("month"), F.col("mean").alias("value"))))
                 .alias("series")))


def year_vs_seasonal(obs: DataFrame, indicator: str, year: int, lat: float | None = None,
                     lon: float | None = None) -> DataFrame:
    """One year's monthly mean beside the mean of all other years, per month.

    One pass with conditional aggregates; a month present in only one of the
    two series is kept, with NULL in the other.
    Columns: [lat, lon,] month, others_n, others_mean, year_n, year_mean.
    """
    df, keys = _scope(obs, indicator, lat, lon)
    x = as_double(indicator)
    is_year = F.col("year") == F.lit(year)
    other = F.when(~is_year, x)
    this = F.when(is_year, x)
    return (df.filter(F.col(indicator).isNotNull())
            .groupBy(*keys, "month")
            .agg(F.count(other).alias("others_n"), F.avg(other).alias("others_mean"),
                 F.count(this).alias("year_n"), F.avg(this).alias("year_mean")))


def seasonal_pair(obs: DataFrame, first: str = "tmpf", second: str = "relh", lat: float | None = None,
                  lon: float | None = None, *, first_celsius: bool = True, second_celsius: bool = False) -> DataFrame:
    """Seasonal means of two indicators on one month axis, each skipping its
    own NULLs; a month seen by only one indicator keeps a NULL for the other.
    Columns: [lat, lon,] month, <first>_n, <first>_mean, <second>_n, <second>_mean.
    """
    df, keys = _scope(obs, first, lat, lon)
    validate_indicator(second, "numeric", obs.columns)
    a, b = as_double(first), as_double(second)
    return (df.filter(F.col(first).isNotNull() | F.col(second).isNotNull())
            .groupBy(*keys, "month")
            .agg(F.count(a).alias(f"{first}_n"), _finish(F.avg(a), first_celsius, first).alias(f"{first}_mean"),
                 F.count(b).alias(f"{second}_n"), _finish(F.avg(b), second_celsius, second).alias(f"{second}_mean")))


# The series labels of the year-against-seasonal figure.
SEASONAL_LABEL = "Seasonal mean"
YEAR_LABEL = "{year} values"


def year_vs_seasonal_series(obs: DataFrame, indicator: str, year: int, lat: float | None = None,
                            lon: float | None = None) -> DataFrame:
    """``year_vs_seasonal`` in long, plot-ready form: one row per month and
    series, labelled as the figure's legend.  A month missing from a series
    has no row for it.  Columns: [lat, lon,] month, series, value."""
    wide = year_vs_seasonal(obs, indicator, year, lat, lon)
    keys = [c for c in wide.columns if c in ("lat", "lon")] + ["month"]
    long = wide.select(*keys, F.col("others_mean").alias(SEASONAL_LABEL),
                       F.col("year_mean").alias(YEAR_LABEL.format(year=year)))
    return (long.unpivot(keys, [SEASONAL_LABEL, YEAR_LABEL.format(year=year)], "series", "value")
            .filter(F.col("value").isNotNull()))


def yearly_vs_seasonal_series(obs: DataFrame, indicator: str = "tmpf", lat: float | None = None, lon: float | None = None,
                              *, pre_round: int | None = 1, to_celsius: bool = False) -> DataFrame:
    """Each year against the seasonal mean, in long, plot-ready form: the
    seasonal line and one line per year on the same month axis, labelled as
    the figure's legend.  One scan: both means are grouping sets of one
    aggregation.  Columns: [lat, lon,] month, series, value."""
    df, keys = _scope(obs, indicator, lat, lon)
    value = _finish(F.avg(_value(indicator, pre_round)), to_celsius, indicator)
    grouped = df.filter(F.col(indicator).isNotNull()).select(*keys, "month", "year", indicator).groupingSets(
        [[*keys, "month", "year"], [*keys, "month"]], *keys, "month", "year").agg(value.alias("value"), F.grouping("year").alias("_all"))
    series = F.when(F.col("_all") == 1, F.lit(SEASONAL_LABEL)).otherwise(F.concat(F.col("year").cast("string"), F.lit(YEAR_LABEL.format(year=""))))
    return grouped.select(*keys, "month", series.alias("series"), "value")


def plot_order(df: DataFrame) -> DataFrame:
    """Sort a climatology result the way its figure reads: by position, then
    year and month numerically, then series.  Results are unordered by
    default, since a global sort costs a sampling job and a shuffle; call
    this on the (small) aggregated result only when order matters."""
    keys = [c for c in ("lat", "lon", "year", "month", "series") if c in df.columns]
    return df.orderBy(*keys)
