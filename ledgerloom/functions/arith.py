"""Whole-number helpers shared by the balance operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column, b) -> Column:
    """Integer division that truncates toward zero; BIGINT."""
    return F.call_function("div", a.cast("bigint"), b if isinstance(b, Column) else F.lit(b))


def to_int(x: Column) -> Column:
    """Round half away from zero, then INT: what assigning a decimal to an integer column does."""
    return F.round(x).cast("int")


def money(x: Column) -> Column:
    return x.cast("decimal(14,2)")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``.

    Inside higher-order functions an expression used twice is computed twice; a one-element
    transform binds it instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
