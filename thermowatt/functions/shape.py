"""Expressions that steer how Spark evaluates other expressions."""

from __future__ import annotations


def once(expr: str) -> str:
    """Generator of one row holding ``expr``; use it in a projection under an alias.

    A filter on the result stays above the generator. On a plain projection it
    would be pushed below, and an expensive ``expr`` evaluated again for every
    place the filter mentions it.
    """
    return f"explode(array({expr}))"


def out_of_line(expr: str) -> str:
    """``expr``, kept out of the code generated for its surroundings.

    For large branches that few rows take: the JVM does not compile a
    generated method beyond 8 kB, so one such branch slows down every row.
    """
    return f"element_at(transform(array(0), _unused -> {expr}), 1)"
