"""Calendar columns, the date and time dimensions, and zone conversion."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOREVER = "2099-12-31 23:59:59"


def calendar_parts(df: DataFrame, ts: str, suffix: str = "") -> DataFrame:
    """Add ``year month day weekday hour`` of ``ts`` (Monday is weekday 0)."""
    c = F.col(ts)
    return df.withColumns(
        {
            f"year{suffix}": F.year(c),
            f"month{suffix}": F.month(c),
            f"day{suffix}": F.dayofmonth(c),
            f"weekday{suffix}": F.weekday(c),
            f"hour{suffix}": F.hour(c),
        }
    )


def day_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def hour_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHH")


def parse_timestamp(text: Column, pattern: str = "yyyyMMddHHmmss") -> Column:
    """A timestamp, or NULL where the text does not fit the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern))


def seconds_of_day(ts: Column) -> Column:
    """Seconds since midnight with their fraction, as a decimal."""
    whole = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("decimal(14,6)")
    return whole + F.extract(F.lit("SECOND"), ts)


def dim_time_id(ts: Column, time_key: str = "until") -> Column:
    """Whole seconds to the next midnight (``until``) or since the last one (``since``)."""
    if time_key == "since":
        return F.floor(seconds_of_day(ts)).cast("int")
    if time_key != "until":
        raise ValueError(f"time_key is until or since, not {time_key!r}")
    return F.pmod(F.lit(86400) - F.ceil(seconds_of_day(ts)), F.lit(86400)).cast("int")


def to_utc(df: DataFrame, ts: str, zone_by: Column | str, name: str = "utc") -> DataFrame:
    """Add ``ts``, a local time in zone ``zone_by``, as UTC."""
    zone = F.lit(zone_by) if isinstance(zone_by, str) else zone_by
    return df.withColumn(name, F.to_utc_timestamp(F.col(ts), zone))


def folder_stamp(when: dt.datetime) -> str:
    """A landing folder name; the hour is on the 24-hour clock, so no two runs of a day meet."""
    return when.strftime("%Y_%m_%d_%H_%M_%S")


def timestamp_slots(df: DataFrame, ts: str, minutes: int = 15) -> DataFrame:
    """Every slot of ``minutes`` between the first and the last ``ts``, as column ``slot``."""
    low, high = df.select(
        F.min(ts).cast("timestamp_ntz").cast("string"), F.max(ts).cast("timestamp_ntz").cast("string")
    ).first()
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "slot TIMESTAMP_NTZ")
    step = minutes * 60
    start = dt.datetime.fromisoformat(low)
    midnight = start.replace(hour=0, minute=0, second=0, microsecond=0)
    first = midnight + dt.timedelta(seconds=(start - midnight) // dt.timedelta(seconds=step) * step)
    count = (dt.datetime.fromisoformat(high) - first) // dt.timedelta(seconds=step) + 1
    at = f"TIMESTAMP_NTZ'{first.isoformat(sep=' ')}'"
    return spark.range(count).select(
        F.expr(f"{at} + make_dt_interval(0, 0, 0, id * {step})").alias("slot")
    )


def _week_of(day_number: Column, first_day: Column) -> Column:
    """Number of the Sunday-started week that a day falls in, counted from ``first_day``."""
    return F.floor((day_number + F.dayofweek(first_day) - 2) / 7) + 1


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day of ``start..end``, with the columns of the date dimension."""
    span = (end - start).days + 1
    days = spark.range(span).select(
        F.date_add(F.lit(start.isoformat()).cast("date"), F.col("id").cast("int")).alias("date")
    )
    d = F.col("date")
    day = F.dayofmonth(d)
    month_start, quarter_start, year_start = (
        F.trunc(d, unit).cast("date") for unit in ("month", "quarter", "year")
    )
    next_month = F.add_months(month_start, 1)
    next_year = F.add_months(year_start, 12)
    suffix = (
        F.when(day.isin(11, 12, 13), "th")
        .when(day % 10 == 1, "st")
        .when(day % 10 == 2, "nd")
        .when(day % 10 == 3, "rd")
        .otherwise("th")
    )
    quarter_name = F.element_at(
        F.array(*[F.lit(n) for n in ("First", "Second", "Third", "Fourth")]), F.quarter(d)
    )
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("dim_date_id"),
        d,
        day.alias("day"),
        suffix.alias("day_suffix"),
        F.dayofweek(d).alias("week_day"),
        F.date_format(d, "EEEE").alias("week_day_name"),
        F.ceil(day / 7).cast("int").alias("DOW_in_month"),
        F.dayofyear(d).alias("day_of_year"),
        _week_of(day, month_start).cast("int").alias("week_of_month"),
        _week_of(F.dayofyear(d), year_start).cast("int").alias("week_of_year"),
        F.weekofyear(d).alias("ISO_week_of_year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        quarter_name.alias("quarter_name"),
        F.year(d).alias("year"),
        F.date_format(d, "MMyyyy").alias("MMYYYY"),
        F.date_format(d, "MMM yyyy").alias("month_year"),
        month_start.alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        quarter_start.alias("first_day_of_quarter"),
        F.date_sub(F.add_months(quarter_start, 3), 1).alias("last_day_of_quarter"),
        year_start.alias("first_day_of_year"),
        F.date_sub(next_year, 1).alias("last_day_of_year"),
        next_month.alias("first_day_of_next_month"),
        next_year.alias("first_day_of_next_year"),
    )


# Part-of-day buckets of the time dimension: (first hour, label). Labels are this library's.
DAY_BUCKETS = [(0, "Night"), (6, "Morning"), (12, "Afternoon"), (18, "Evening")]


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per second of a day, with the columns of the time dimension."""
    s = F.col("id").cast("int")
    hour = F.floor(s / 3600).cast("int")
    minute = F.floor(s % 3600 / 60).cast("int")

    def clock(*parts: Column) -> Column:
        return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])

    half = F.when(minute < 30, 0).otherwise(30)
    bucket, label = F.lit(0), F.lit(DAY_BUCKETS[0][1])
    for number, (first_hour, name) in enumerate(DAY_BUCKETS):
        bucket = F.when(hour >= first_hour, number).otherwise(bucket)
        label = F.when(hour >= first_hour, name).otherwise(label)
    return spark.range(86400).select(
        s.alias("dim_time_id"),
        (hour * 10000 + minute * 100 + s % 60).alias("time_alt_key"),
        clock(hour, minute, s % 60).alias("time"),
        clock(hour, half, F.lit(0)).alias("time_30"),
        hour.alias("hour_30"),
        minute.alias("minute_number"),
        (s % 60).alias("second_number"),
        s.alias("time_in_second"),
        F.concat(clock(hour, F.lit(0)), F.lit("-"), clock(hour, F.lit(59))).alias("hourly_bucket"),
        bucket.cast("int").alias("day_time_bucket_group_key"),
        label.alias("day_time_bucket"),
    )
