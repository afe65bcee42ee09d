"""Small reporting transforms: JSON order totals, calendar activities, invitation text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import activity_id, activity_message, day_name, is_weekend
from ..functions.text import html_invitation, map_value_sum, money_text, parse_number_map
from ..sources.inline import INVITATION_BODY, INVITATION_SUBJECT, ORDER_TOTAL_PREFIX


def order_totals(df: DataFrame, json_col: str, group: list[str]) -> DataFrame:
    """Per group: number of documents, total of all map values, and the printed message.

    Each document's values are summed in place (no explode), then a partial/final
    hash aggregate totals them per group.
    """
    per_doc = df.select(*group, map_value_sum(parse_number_map(F.col(json_col))).alias("_v"))
    agg = per_doc.groupBy(*group).agg(F.count(F.lit(1)).alias("n_documents"), F.sum("_v").alias("_t"))
    return agg.select(
        *group,
        "n_documents",
        F.round("_t", 2).alias("total_order_value"),
        money_text(ORDER_TOTAL_PREFIX, F.col("_t")).alias("message"),
    )


def weekend_split(orders: DataFrame) -> DataFrame:
    """Orders counted and summed for weekends and for working days."""
    g = orders.groupBy(is_weekend(F.col("o_orderdate")).alias("is_weekend"))
    return g.agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price"))


def calendar_activity(orders: DataFrame, dim: DataFrame) -> DataFrame:
    """Orders counted and summed per weekday with that day's activity.

    The orders are first reduced to one row per weekday (partial aggregation before the
    shuffle), so the day table is joined to seven rows, not to every order.
    """
    per_day = (
        orders.select(day_name(F.col("o_orderdate")).alias("day"), "o_totalprice")
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price"))
    )
    j = per_day.join(F.broadcast(dim), "day", "left")
    return j.select(
        "day",
        "is_weekday",
        "activity",
        activity_id(F.col("activity"), F.col("is_weekday")).alias("activity_id"),
        activity_message(F.col("day"), F.col("activity")).alias("message"),
        "n_orders",
        "total_price",
    )


def invitations(recipients: DataFrame, key_cols: list[str]) -> DataFrame:
    """The beach-day invitation rendered once per recipient row."""
    subject, body = F.lit(INVITATION_SUBJECT), F.lit(INVITATION_BODY)
    return recipients.select(
        *key_cols, subject.alias("subject"), body.alias("body"), html_invitation(subject, body).alias("html")
    )
