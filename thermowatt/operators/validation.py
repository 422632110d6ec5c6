"""Contract check of raw JSON messages: one pass, first failure wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..contract import READINGS, TEMP_RANGE_C
from ..functions import float_text, iso_instant, once, out_of_line, text_number

# Reason codes in the order the checks are made, as the stored
# tables know them. MISSING and NULL carry the field name after a colon. The
# reason texts of `_checks` and the kind names are fixed values as well.
MALFORMED = "malformed"
NOT_OBJECT = "not_object"
MISSING = "missing"
NULL = "null"
CAST = "type_cast"
NEGATIVE_POWER = "negative_power"
TEMP_RANGE = "temperature_range"

_FIELDS = READINGS.names
_TEXT_FIELDS = ("device_id", "room")
_NUMBER_FIELDS = ("temperature_c", "power_kw")
_PLAIN_NUMBER = r"^-?\d{1,18}(?:\.\d{1,18})?$"


def decode(value: Column) -> Column:
    """Message bytes as text; an absent value becomes the empty text."""
    return F.coalesce(value.cast("string"), F.lit(""))


def _is_kind(path: str, kind: str) -> str:
    """Whether the JSON value at ``path`` of the payload has the given type."""
    value = f"try_variant_get(try_parse_json(raw_payload), '{path}', 'variant')"
    return f"coalesce(schema_of_variant({value}) = '{kind}', false)"


def _number(field: str) -> str:
    """Finite double of a JSON number, boolean or numeric text, else null."""
    text = f"_{field}"
    flag = f"if({text} IN ('true', 'false') AND {_is_kind('$.' + field, 'BOOLEAN')}, cast({text} = 'true' AS double), NULL)"
    other = f"coalesce({text_number(text)}, {flag})"
    finite = f"nullif(nullif({other}, double('Infinity')), double('-Infinity'))"
    return f"""CASE WHEN {text} RLIKE r'{_PLAIN_NUMBER}' THEN try_cast({text} AS double)
        WHEN {text} IS NOT NULL THEN {out_of_line(finite)} END"""


def _instant(field: str) -> str:
    """Timestamp of an ISO text. A bare number is not one, though eight digits look like a date."""
    text = f"_{field}"
    quoted = f"if({_is_kind('$.' + field, 'STRING')}, {iso_instant(text)}, NULL)"
    return f"CASE WHEN length({text}) = 8 THEN {out_of_line(quoted)} ELSE {iso_instant(text)} END"


# Name of a top-level JSON value that is not an object, as written in the reason.
_KIND_NAME = r"""CASE regexp_extract(raw_payload, r'^\s*(\S)', 1)
    WHEN '[' THEN 'list' WHEN '"' THEN 'str' WHEN 't' THEN 'bool' WHEN 'f' THEN 'bool' WHEN 'n' THEN 'NoneType'
    ELSE if(raw_payload RLIKE r'^\s*-?\d+\s*$', 'int', 'float') END"""

# The message inside an array, so that text after its first JSON value is a syntax error.
_WRAPPED = "concat('[', raw_payload, ',null]')"

_IN_RANGE = f"temperature_c BETWEEN {TEMP_RANGE_C[0]}D AND {TEMP_RANGE_C[1]}D"


def _checks() -> list[tuple[str, str, str]]:
    """(fails, reason code, reason as SQL) of every check, in order."""
    alone = f"try_parse_json({_WRAPPED})"
    one_value = (
        f"coalesce(try_variant_get({alone}, '$[2]', 'variant') IS NULL "
        f"AND is_variant_null(try_variant_get({alone}, '$[1]', 'variant')), false)"
    )
    # A text that begins like an object and is none needs no second parse: it is no JSON, or more than one value.
    checks = [
        (f"NOT _object AND (raw_payload RLIKE r'^\\s*[{{]' OR NOT {one_value})", MALFORMED, "'Malformed JSON syntax: not one JSON value'"),
        ("NOT _object", NOT_OBJECT, f"concat('Expected JSON object, got ', {_KIND_NAME})"),
    ]
    for f in _FIELDS:
        absent = f"NOT array_contains(json_object_keys(raw_payload), '{f}')"
        checks.append((f"_{f} IS NULL AND {absent}", f"{MISSING}:{f}", f'"Missing required field \'{f}\'"'))
        checks.append((f"_{f} IS NULL", f"{NULL}:{f}", f'"Field \'{f}\' cannot be null"'))
    for f in (*_NUMBER_FIELDS, "event_ts"):
        checks.append((f"{f} IS NULL", CAST, f"'Field type cast error: {f}'"))
    power, temp = float_text("power_kw"), float_text("temperature_c")
    checks.append(("power_kw < 0", NEGATIVE_POWER, f"concat('power_kw cannot be negative (', {power}, ')')"))
    checks.append((
        f"NOT {_IN_RANGE}", TEMP_RANGE, f"concat('temperature_c out of physical range (', {temp}, ')')"
    ))
    return checks


def _outcome() -> str:
    """Struct (reason_code, reason) of the first check that fails, null for a good message."""
    good = " AND ".join(["_object", "power_kw >= 0", _IN_RANGE, *[f"{f} IS NOT NULL" for f in _FIELDS]])
    chain = " ".join(
        f"WHEN {fails} THEN named_struct('reason_code', '{code}', 'reason', {reason})" for fails, code, reason in _checks()
    )
    return f"CASE WHEN NOT coalesce({good}, false) THEN {out_of_line(f'CASE {chain} END')} END"


def validate(raw: DataFrame, payload: str = "value") -> DataFrame:
    """Check every message of ``raw`` against the readings contract.

    Adds the five contract columns, ``raw_payload``, ``reason_code`` and
    ``reason`` (both null for a good message); other columns pass through. For
    a bad message the contract columns hold what could be read of it.
    Works on batch and streaming input. The text of a good message is parsed
    once; only a bad one is looked at again, to name what is wrong with it.
    """
    keep = [f"`{c}`" for c in raw.columns if c != payload]
    fields = ", ".join(f"{f}: string" for f in _FIELDS)
    strict = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"
    values = f"from_json({_WRAPPED}, 'array<struct<{fields}>>', {strict})"
    opened = (
        raw.selectExpr(*keep, f"coalesce(cast(`{payload}` AS string), '') AS raw_payload")
        .selectExpr(*keep, "raw_payload", f"{once(values)} AS _values")
        .selectExpr(
            *keep,
            "raw_payload",
            "coalesce(size(_values) = 2 AND get(_values, 1) IS NULL AND get(_values, 0) IS NOT NULL, false) AS _object",
            *[f"get(_values, 0).{f} AS _{f}" for f in _FIELDS],
        )
    )
    typed = opened.selectExpr(
        "*",
        *[f"_{f} AS {f}" for f in _TEXT_FIELDS],
        f"{_instant('event_ts')} AS event_ts",
        *[f"{_number(f)} AS {f}" for f in _NUMBER_FIELDS],
    )
    # Judged first and shielded after, so that both steps run as generated code.
    judged = typed.selectExpr(*keep, "raw_payload", *_FIELDS, f"{_outcome()} AS _found").selectExpr(
        *keep, "raw_payload", *_FIELDS, f"{once('_found')} AS _outcome"
    )
    return judged.selectExpr(*keep, *_FIELDS, "raw_payload", "_outcome.reason_code", "_outcome.reason")


def valid_readings(validated: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Good messages in the readings contract; ``extra`` columns are kept behind it."""
    return validated.where(F.col("reason_code").isNull()).select(*_FIELDS, *extra)


def rejected_rows(validated: DataFrame, as_of: Column | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """Dead letters ``(raw_payload, reason, ts)``; ``ts`` is now unless ``as_of`` is given."""
    ts = F.current_timestamp() if as_of is None else as_of
    return validated.where(F.col("reason_code").isNotNull()).select(
        "raw_payload", "reason", ts.cast("timestamp").alias("ts"), *extra
    )


def split_valid(validated: DataFrame, as_of: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``(readings, rejected)``. Persist ``validated`` first when both sides are used."""
    return valid_readings(validated), rejected_rows(validated, as_of)
