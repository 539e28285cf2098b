"""Raw tag counts from the trends feed, per hour, day and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.functions.times import PERIODS, READABLE, stamp

KEY = ("tag", "period", "stamp")


def fan_out(trends: DataFrame, *carry: str) -> DataFrame:
    """Each record once per period, with the stamp of that period."""
    places = F.array(
        *[
            F.struct(F.lit(period).alias("period"), F.expr(stamp(period, "event_time")).alias("stamp"))
            for period in PERIODS
        ]
    )
    return trends.select(
        "tag",
        F.explode(places).alias("place"),
        F.col("count").alias("raw_count"),
        F.date_format("event_time", READABLE).alias("timestamp_readable"),
        "event_time",
        *carry,
    ).select("tag", "place.period", "place.stamp", "raw_count", "timestamp_readable", "event_time", *carry)


def latest_counts(trends: DataFrame, version: str = "version") -> DataFrame:
    """The last count of each (tag, period, stamp), as repeated puts on one key leave it.

    Records are cut to the last of each tag and hour before they fan out, since the last
    of a day or month is the last of one of its hours.
    """
    last_of_hour = _last(trends, ["tag", F.date_trunc("hour", "event_time")], ["tag", "count", "event_time"], version)
    counts = ["tag", "period", "stamp", "raw_count", "timestamp_readable", "event_time"]
    return _last(fan_out(last_of_hour, version), list(KEY), counts, version).drop(version)


def _last(rows: DataFrame, keys: list, columns: list[str], version: str) -> DataFrame:
    """The last row of each key by time and version: a partial aggregate, without sorting."""
    newest = F.max_by(F.struct(*columns, version), F.struct("event_time", version))
    return rows.groupBy(*keys).agg(newest.alias("last")).select("last.*")


def monthly_counts(trends: DataFrame, version: str = "version") -> DataFrame:
    """The compact layout: row key ``tag#yyyyMM`` and one count."""
    month = F.expr(stamp("monthly", "event_time"))
    keyed = trends.withColumn("row_key", F.concat_ws("#", "tag", month))
    return _last(keyed, ["row_key"], ["row_key", "count", "event_time"], version).select("row_key", "count")
