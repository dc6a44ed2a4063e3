"""Name an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    Inside a higher-order function, an outer expression is evaluated again for each
    element. Passing it through a one-element array turns it into a lambda variable,
    which is computed once per row. Use it when ``body`` needs ``value`` more than
    once or from inside a lambda.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
