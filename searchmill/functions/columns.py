"""Column expressions: every rule stays inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_url_params(url: Column) -> Column:
    """Everything before the first `?`; null stays null."""
    return F.substring_index(url, "?", 1)


def demand_floor(demand: Column, impressions: Column) -> Column:
    """Raise demand to impressions. A null demand stays null, so this is not `greatest`."""
    return F.when(demand < impressions, impressions).otherwise(demand)


def click_cap(clicks: Column, impressions: Column) -> Column:
    """Lower clicks to impressions. Null clicks stay null, so this is not `least`."""
    return F.when(clicks > impressions, impressions).otherwise(clicks)


def any_positive(demand: Column, impressions: Column, clicks: Column) -> Column:
    """The row carries traffic. Position alone does not count."""
    return (demand > 0) | (impressions > 0) | (clicks > 0)


def header_date(name: Column) -> Column:
    return F.get(F.split(name, "_"), F.lit(0))


def header_metric(name: Column) -> Column:
    """Second part of a dated column name; null when there is none."""
    return F.get(F.split(name, "_"), F.lit(1))


def date_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")
