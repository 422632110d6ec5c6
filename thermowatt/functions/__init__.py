"""Scalar functions as SQL text, for ``expr`` and ``selectExpr``.

Text crosses to the JVM in one step. A large tree of ``Column`` objects costs
a call per node, which is longer than many of the queries built from it run.
"""

from .numbers import float_text, mean_of_units, round_half_even, sum_of_units, text_number, to_units
from .shape import once, out_of_line
from .times import day_of, hour_of, iso_instant, iso_text

__all__ = [
    "day_of", "float_text", "hour_of", "iso_instant", "iso_text", "mean_of_units",
    "once", "out_of_line", "round_half_even", "sum_of_units", "text_number", "to_units",
]
