"""Generated and seeded dimensions: calendar, time of day, states, channels, actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.functions.columns import date_key, flag


def _days(spark: SparkSession, start: str, end: str) -> DataFrame:
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(span).alias("full_date"))


def _pick(names: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), number.cast("int"))


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("int")


def with_hijri(df: DataFrame, date_col: str) -> DataFrame:
    """Tabular Islamic calendar (30-year cycle); may differ from sighting by a day."""
    day = F.unix_date(date_col) + 2440588 - 1948440  # days since 1 Muharram, year 1
    year = _div(day * 30 + 10646, 10631)
    return (
        df.withColumn("_d", day)
        .withColumn("hijri_year", year)
        .withColumn("_doy", F.col("_d") - (F.col("hijri_year") - 1) * 354 - _div(F.col("hijri_year") * 11 + 3, 30))
        # months alternate 30 and 29 days: month m starts after ceil(29.5 * (m - 1)) days
        .withColumn("hijri_month_num", F.least(F.lit(12), _div(F.col("_doy") * 2, 59) + 1))
        .withColumn("hijri_day", (F.col("_doy") - F.ceil((F.col("hijri_month_num") - 1) * 29.5) + 1).cast("int"))
        .drop("_d", "_doy")
    )


def dim_date(spark: SparkSession, start: str, end: str, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar with Gregorian, fiscal and Hijri attributes and Friday/Saturday weekends.

    ``holidays`` (``full_date date, holiday_nm string``) comes from a maintained
    reference; without it no day is a holiday.
    """
    d = F.col("full_date")
    quarter, year = F.quarter(d), F.year(d)
    month2 = F.lpad(F.month(d).cast("string"), 2, "0")
    base = with_hijri(_days(spark, start, end), "full_date")
    if holidays is None:
        named = base.withColumn("holiday_nm", F.lit(None).cast("string"))
    else:
        named = base.join(holidays.select("full_date", "holiday_nm"), "full_date", "left")
    weekend = F.dayofweek(d).isin(6, 7)
    return named.select(
        date_key(d).alias("date_sk"),
        d,
        F.dayofweek(d).alias("day_of_week_num"),
        F.date_format(d, "EEEE").alias("day_of_week_nm_en"),
        _pick(K.WEEKDAYS_AR, F.dayofweek(d)).alias("day_of_week_nm_ar"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_nm_en"),
        _pick(K.MONTHS_AR, F.month(d)).alias("month_nm_ar"),
        quarter.alias("quarter_num"),
        F.concat(F.lit("Q"), quarter.cast("string"), F.lit(" "), year.cast("string")).alias("quarter_nm"),
        year.alias("year_num"),
        year.alias("fiscal_year"),
        F.concat(F.lit("FY"), year.cast("string"), F.lit("Q"), quarter.cast("string")).alias("fiscal_quarter"),
        F.concat(F.lit("FY"), year.cast("string"), F.lit("M"), month2).alias("fiscal_month"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(
            F.lpad(F.col("hijri_day").cast("string"), 2, "0"), F.lit("/"),
            F.lpad(F.col("hijri_month_num").cast("string"), 2, "0"), F.lit("/"),
            F.col("hijri_year").cast("string"), F.lit("-H"),
        ).alias("hijri_date"),
        "hijri_day",
        "hijri_month_num",
        _pick(K.HIJRI_MONTHS_AR, F.col("hijri_month_num")).alias("hijri_month_nm_ar"),
        "hijri_year",
        flag(~weekend).alias("is_weekday"),
        flag(weekend).alias("is_weekend"),
        flag(F.col("holiday_nm").isNotNull()).alias("is_public_holiday"),
        "holiday_nm",
        flag(F.col("hijri_month_num") == 9).alias("is_ramadan"),
        flag((F.col("hijri_month_num") == 12) & F.col("hijri_day").between(8, 13)).alias("is_hajj_period"),
        flag(d == F.last_day(d)).alias("is_last_day_of_month"),
        flag((d == F.last_day(d)) & (F.month(d) % 3 == 0)).alias("is_last_day_of_quarter"),
    )


def dim_date_compact(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Calendar of the pipeline half: Gregorian attributes only."""
    d = F.col("full_date")
    return _days(spark, start, end).select(
        date_key(d).alias("date_key"),
        d.alias("calendar_date"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("fiscal_year"),
        F.dayofweek(d).isin(6, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday_ksa"),
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """The 1440 minutes of a day."""
    minutes = spark.range(1440).select(
        (F.col("id") / 60).cast("int").alias("h"), (F.col("id") % 60).cast("int").alias("m")
    )
    h, m = F.col("h"), F.col("m")
    clock = lambda total: F.concat(
        F.lpad(((total / 60).cast("int") % 24).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((total % 60).cast("string"), 2, "0"),
    )
    start = h * 60 + (m / 30).cast("int") * 30
    return minutes.select(
        (h * 100 + m).alias("time_sk"),
        h.alias("hour_24"),
        m.alias("minute_of_hour"),
        F.when(h.between(5, 11), "Morning").when(h.between(12, 16), "Afternoon")
        .when(h.between(17, 20), "Evening").otherwise("Night").alias("time_of_day_nm"),
        F.when(h.between(1, 6), "NIGHT_BATCH").when(h.between(8, 21), "PEAK").otherwise("OFF_PEAK")
        .alias("business_period"),
        F.concat(clock(start), F.lit("-"), clock(start + 30)).alias("half_hour_bucket"),
        F.lit(3).alias("ast_offset_hours"),
    )


def seed_order_states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(K.ORDER_STATES, K.ORDER_STATE_SCHEMA)


def seed_channels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(K.CHANNELS, K.CHANNEL_SCHEMA)


def seed_actions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(K.ACTIONS, K.ACTION_SCHEMA)
