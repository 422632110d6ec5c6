"""Number formatting and rounding."""

from __future__ import annotations


def round_half_even(x: str, digits: int) -> str:
    """Round a double on its exact binary value, ties to even.

    Spark's ``round`` works on the shortest decimal text and rounds ties away
    from zero, so 2.675 gives 2.68 there and 2.67 here.
    """
    return f"cast(format_number({x}, '0.{'0' * digits}') AS double)"


def to_units(x: str, decimals: int) -> str:
    """A value known to have ``decimals`` places, as a whole number of its last place."""
    return f"cast(rint(({x}) * {10**decimals}D) AS bigint)"


def mean_of_units(total: str, n: str, decimals: int, digits: int) -> str:
    """Mean of ``n`` values summed in units, rounded half up to ``digits`` places.

    Integer arithmetic only, so the result does not depend on the order in
    which partitions were added up.
    """
    up = 10 ** max(digits - decimals, 0)
    step = f"{10 ** max(decimals - digits, 0)}L * ({n})"
    whole = f"(abs({total}) * {2 * up}L + {step}) div (2L * {step})"
    return f"signum(cast({total} AS double)) * cast({whole} AS double) / {10**digits}D"


def sum_of_units(total: str, decimals: int, digits: int) -> str:
    """A sum in units, rounded half up to ``digits`` places."""
    return mean_of_units(total, "1L", decimals, digits)


def float_text(x: str) -> str:
    """Shortest text of a double: plain notation from 1e-4 up to 1e16, else ``1.5e+16``."""
    text = f"cast({x} AS string)"
    plain = rf"regexp_replace(cast(cast({x} AS decimal(38,21)) AS string), r'(\.\d+?)0+$', '$1')"
    mantissa = rf"regexp_replace(substring_index({text}, 'E', 1), r'\.0$', '')"
    exponent = f"try_cast(substring_index({text}, 'E', -1) AS int)"
    power = f"concat(if({exponent} < 0, 'e-', 'e+'), format_string('%02d', abs({exponent})))"
    return f"""CASE WHEN {x} = 0 OR (abs({x}) >= 1e-3D AND abs({x}) < 1e7D) THEN {text}
        WHEN abs({x}) >= 1e-4D AND abs({x}) < 1e16D THEN {plain}
        ELSE concat({mantissa}, {power}) END"""


def text_number(text: str) -> str:
    """Double held in a text, or null.

    Surrounding blanks, exponents and single underscores between digits are
    fine; type suffixes (``22d``), hexadecimal and non-finite words are not.
    """
    digits = r"\d+(?:_\d+)*"
    number = rf"^\s*[+-]?(?:{digits}(?:\.(?:{digits})?)?|\.{digits})(?:[eE][+-]?{digits})?\s*$"
    return f"CASE WHEN {text} RLIKE r'{number}' THEN try_cast(translate(trim({text}), '_', '') AS double) END"
