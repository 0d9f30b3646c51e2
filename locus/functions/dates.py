"""Dates, time zones and opening states as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EAST, CENTRAL, MOUNTAIN, PACIFIC = "America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles"
# States of one zone, and the lines that split the others.
ONE_ZONE = {
    CENTRAL: "AL AR IL IA LA MN MS MO OK WI",
    MOUNTAIN: "CO MT NM UT WY",
    PACIFIC: "CA NV WA",
    "America/Phoenix": "AZ",
    "Pacific/Honolulu": "HI",
    "America/Anchorage": "AK",
    "America/Puerto_Rico": "PR",
}
SOON_MINUTES = 45


def zone_of(state: Column, lat: Column, lon: Column) -> Column:
    """A place's time zone; Eastern where the state is unknown."""
    split = [
        ("FL", (lon < -85.0) & (lat > 29.5), CENTRAL, EAST),
        ("TN", lon > -85.4, EAST, CENTRAL),
        ("KY", lon > -86.2, EAST, CENTRAL),
        ("IN", (lon < -86.9) & ((lat > 41.0) | (lat < 38.4)), CENTRAL, EAST),
        ("MI", (lon < -87.5) & (lat > 45.0), CENTRAL, EAST),
        ("TX", lon < -104.8, MOUNTAIN, CENTRAL),
        ("KS NE", lon < -101.4, MOUNTAIN, CENTRAL),
        ("ND SD", lon < -100.6, MOUNTAIN, CENTRAL),
        ("ID", lat > 45.6, PACIFIC, MOUNTAIN),
        ("OR", (lon < -117.4) & (lat < 44.6), MOUNTAIN, PACIFIC),
    ]
    out = F.when(F.lit(False), EAST)
    for states, line, there, here in split:
        out = out.when(state.isin(states.split()), F.when(line, there).otherwise(here))
    for zone, states in ONE_ZONE.items():
        out = out.when(state.isin(states.split()), zone)
    return out.otherwise(EAST)


def days_since(day: Column, today: Column, never: int = 10_000) -> Column:
    return F.coalesce(F.datediff(today, day), F.lit(never))


def since_day(days: Column, today: Column) -> Column:
    """The first of the last `days` days as text; "0000-00-00" for null, which sorts before all days."""
    return F.coalesce(F.date_format(F.date_sub(today, days - 1), "yyyy-MM-dd"), F.lit("0000-00-00"))


def civil_day(at: Column, zone: str) -> Column:
    return F.date_format(F.from_utc_timestamp(at, zone), "yyyy-MM-dd")


def local_minute(at: Column, zone: Column) -> Column:
    """struct(dow, minute) of a moment in a zone, Monday 0."""
    local = F.from_utc_timestamp(at, zone)
    return F.struct(F.weekday(local).alias("dow"), (F.hour(local) * 60 + F.minute(local)).alias("minute"))


def open_state(spans: DataFrame, key: str, now: Column) -> DataFrame:
    """(key, state, opens_in, opens) of weeks (key, dow, o, c) at `now` (struct(dow, minute)): open (yesterday's hours past
    midnight, or today's), closes soon, later (today), tomorrow, day (the next opening is opens_in days ahead), closed."""
    s = spans.withColumn("_now", now)
    dow, minute = F.col("_now.dow"), F.col("_now.minute")
    ahead = (F.col("dow") - dow + 7) % 7
    rest = F.when((ahead == 6) & (F.col("c") - 1440 > minute), F.col("c") - 1440 - minute).when((ahead == 0) & (F.col("o") <= minute) & (F.col("c") > minute), F.col("c") - minute)
    in_days = F.when((ahead == 0) & (F.col("o") <= minute), 7).otherwise(ahead)
    g = s.groupBy(key).agg(F.max(rest).alias("rest"), F.min(F.struct(in_days.alias("n"), F.col("o"))).alias("next"))
    shut = F.when(F.col("next.n") == 0, "later").when(F.col("next.n") == 1, "tomorrow").when(F.col("next").isNotNull(), "day").otherwise("closed")
    state = F.when(F.col("rest") <= SOON_MINUTES, "closes soon").when(F.col("rest").isNotNull(), "open").otherwise(shut)
    closed = F.col("rest").isNull()
    return g.select(key, state.alias("state"), F.when(closed, F.col("next.n")).cast("int").alias("opens_in"), F.when(closed, F.col("next.o")).alias("opens"))
