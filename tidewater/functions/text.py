"""Small text and JSON-map expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_MAP = "map<string,double>"


def parse_number_map(json_text: Column) -> Column:
    """JSON object of numbers -> map<string,double>."""
    return F.from_json(json_text, NUMBER_MAP)


def map_value_sum(m: Column) -> Column:
    """Sum of a map's values (0.0 for an empty map, NULL for a NULL map)."""
    return F.aggregate(F.map_values(m), F.lit(0.0), lambda acc, x: acc + x)


def money_text(prefix: str, value: Column) -> Column:
    """'<prefix><value with two decimals>'."""
    return F.format_string(prefix + "%.2f", value)


# Fixed value: the HTML template.
def html_invitation(subject: Column, body: Column) -> Column:
    """'<title>{subject}</title><p>{body}</p>'."""
    return F.concat(F.lit("<title>"), subject, F.lit("</title><p>"), body, F.lit("</p>"))
