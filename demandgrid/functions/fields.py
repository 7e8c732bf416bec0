"""Scalar expressions over days, hours, categories and predictions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAYS = 7
HOURS = 24

# Day 0 is Sunday.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# The characters a category name keeps.
CATEGORY_STRIP_PATTERN = "[^a-z0-9 ]"

# Seasonal factors.
WEEKEND_DAYS, WEEKEND_FACTOR = [0, 6], 1.5
PEAK_HOURS, PEAK_FACTOR = [7, 8, 9, 17, 18, 19], 1.8
FIRST_DAYTIME_HOUR, LAST_DAYTIME_HOUR, NIGHT_FACTOR = 6, 22, 0.3

# Report lines.
RANKED_LINE = "%2d. Day %d, Hour %2d, %-20s: %6.1f items"
RANKED_DAY_LINE = "%2d. Hour %2d, %-20s: %6.1f items"
LOOKUP_LINE = "%s %2d:00, %-15s: %s"
LOOKUP_VALUE = "%6.1f items"
LOOKUP_MISS = "NOT CACHED"

CELL_KEYS = ["day_of_week", "hour_of_day", "category"]

PREDICTION_JSON = T.StructType(
    [
        T.StructField("prediction", T.DoubleType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("cached_at", T.StringType()),
    ]
)


def quoted(name: str) -> Column:
    """The column of exactly this name, even with dots, spaces or backticks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def day_of_week(ts: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return (F.dayofweek(ts) - 1).cast("int")


def calendar_day(ts: Column) -> Column:
    """The date as the integer yyyymmdd, usable as a digit-named day folder."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def normalize_category(category: Column) -> Column:
    """The one spelling used when training, scoring and looking up."""
    return F.regexp_replace(F.trim(F.lower(category)), CATEGORY_STRIP_PATTERN, "")


def cell_key(day: Column, hour: Column, category: Column) -> Column:
    return F.concat_ws(":", day, hour, category)


def key_parts(key: Column) -> Column:
    """Split ``day:hour:category``; null unless there are exactly three parts."""
    parts = F.split(key, ":", -1)
    return F.when(
        F.size(parts) == 3,
        F.struct(
            parts[0].try_cast("int").alias("day_of_week"),
            parts[1].try_cast("int").alias("hour_of_day"),
            parts[2].alias("category"),
        ),
    )


def round_prediction(prediction: Column) -> Column:
    """Two decimals, half up."""
    return F.round(prediction, 2)


def day_label(day: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in DAY_NAMES]), day)


def iso_now() -> Column:
    """The query's start time as ISO text; one value for a whole write."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def prediction_json(prediction: Column, day: Column, hour: Column, category: Column, cached_at: Column) -> Column:
    return F.to_json(
        F.struct(
            prediction.alias("prediction"),
            day.alias("day_of_week"),
            hour.alias("hour_of_day"),
            category.alias("category"),
            cached_at.alias("cached_at"),
        )
    )


def parse_prediction(value: Column) -> Column:
    return F.from_json(value, PREDICTION_JSON)


def ranked_line(rank: Column, day: Column, hour: Column, category: Column, prediction: Column) -> Column:
    """One line of the overall top list."""
    return F.format_string(RANKED_LINE, rank, day, hour, category, F.round(prediction, 1))


def ranked_day_line(rank: Column, hour: Column, category: Column, prediction: Column) -> Column:
    """One line of a single day's top list."""
    return F.format_string(RANKED_DAY_LINE, rank, hour, category, F.round(prediction, 1))


def lookup_line(day: Column, hour: Column, category: Column, prediction: Column) -> Column:
    """One line of a lookup listing; a missing prediction is named as such."""
    value = F.when(prediction.isNull(), F.lit(LOOKUP_MISS)).otherwise(
        F.format_string(LOOKUP_VALUE, F.round(prediction, 1))
    )
    return F.format_string(LOOKUP_LINE, day_label(day), hour, category, value)


def seasonal_count(base: Column, day: Column, hour: Column) -> Column:
    """Weekend, peak-hour and night factors in that order, truncated after each."""
    weekend = F.when(day.isin(WEEKEND_DAYS), (base * WEEKEND_FACTOR).cast("bigint")).otherwise(base.cast("bigint"))
    peak = F.when(hour.isin(PEAK_HOURS), (weekend * PEAK_FACTOR).cast("bigint")).otherwise(weekend)
    is_night = (hour < FIRST_DAYTIME_HOUR) | (hour > LAST_DAYTIME_HOUR)
    return F.when(is_night, (peak * NIGHT_FACTOR).cast("bigint")).otherwise(peak)


def in_train_split(day: Column, hour: Column, category: Column, tenths: int = 8) -> Column:
    """True for about ``tenths`` of ten cells, decided by the cell's key alone.

    Unlike a random split this does not depend on how the rows are laid out, so
    a lost and recomputed partition lands on the same side.
    """
    bucket = F.conv(F.substring(F.md5(cell_key(day, hour, category).cast("binary")), 1, 4), 16, 10).cast("int") % 10
    return bucket < tenths
