"""Calendar attributes: weekday name, weekend test, activity routing text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Group prefixes of the activity id.
WEEKDAY_GROUP = "weekday_activities"
WEEKEND_GROUP = "weekend_activities"

# Lower-case English day names in Spark's dayofweek order (Sunday = 1).
DAY_NAMES = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]


def day_name(d: Column) -> Column:
    """Lower-case English weekday name ('monday' … 'sunday'); no per-row date formatting."""
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), F.dayofweek(d))


def is_weekend(d: Column) -> Column:
    """Saturday or Sunday (Spark's dayofweek: Sunday = 1, Saturday = 7)."""
    return F.dayofweek(d).isin(1, 7)


def activity_id(activity: Column, is_weekday: Column) -> Column:
    """'<group>.<activity with spaces as underscores>'."""
    group = F.when(is_weekday, F.lit(WEEKDAY_GROUP)).otherwise(F.lit(WEEKEND_GROUP))
    return F.concat(group, F.lit("."), F.regexp_replace(activity, " ", "_"))


# Fixed value: the sentence.
def activity_message(day: Column, activity: Column) -> Column:
    """"It's <Day> and I'm busy with <activity>." (day capitalised)."""
    return F.concat(F.lit("It's "), F.initcap(day), F.lit(" and I'm busy with "), activity, F.lit("."))
