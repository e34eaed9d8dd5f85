"""Interval tests and labelled bands as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelake.rules import CELSIUS, IMBALANCE, Bands, Interval


def inside(value: Column, interval: Interval) -> Column:
    """True where ``value`` lies in ``interval``; NULL where ``value`` is NULL."""
    tests = []
    if interval.low is not None:
        tests.append(value > interval.low if interval.low_open else value >= interval.low)
    if interval.high is not None:
        tests.append(value < interval.high if interval.high_open else value <= interval.high)
    return reduce(lambda a, b: a & b, tests)


def banded(value: Column, bands: Bands, *, null_is_unknown: bool = False) -> Column:
    """The label of the first band holding ``value``.

    A NULL value matches no band and takes the default label, unless
    ``null_is_unknown`` asks for NULL.
    """
    chain = F.when(value.isNull(), F.lit(None).cast("string")) if null_is_unknown else F
    for label, interval in bands.steps:
        chain = chain.when(inside(value, interval), F.lit(label))
    return chain.otherwise(F.lit(bands.default))


def celsius_bucket(fahrenheit: Column) -> Column:
    return banded(to_celsius(fahrenheit), CELSIUS)


def imbalance_category(imbalance: Column) -> Column:
    return banded(imbalance, IMBALANCE)


def to_celsius(fahrenheit: Column) -> Column:
    return (fahrenheit - 32) * 5.0 / 9.0
