"""ISO-8601 text and UTC time units."""

from __future__ import annotations

from .shape import out_of_line

_ZONE = r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)"
_ZULU = r"^\d{4}-\d{2}-\d{2}.\d{2}:\d{2}:\d{2}(?:[.,]\d*)?Z$"
_PLAIN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,9})?Z$"
_FULL = rf"^\d{{4}}-\d{{2}}-\d{{2}}.\d{{2}}:\d{{2}}:\d{{2}}(?:[.,]\d*)?{_ZONE}$"


def _instant(text: str) -> str:
    return f"try_to_timestamp(concat(left({text}, 10), 'T', translate(substr({text}, 12), ',', '.')))"


def _spread(text: str) -> str:
    """Any accepted form as ``yyyy-mm-dd?hh:mm:ss`` with fraction and offset as given."""
    tail = rf"(?=$|{_ZONE}$)"
    steps = [
        (r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3"),
        (rf"^(.{{10}}.\d{{2}})(\d{{2}})(\d{{2}}(?:[.,]\d*)?){tail}", "$1:$2:$3"),
        (rf"^(.{{10}}.\d{{2}})(\d{{2}}){tail}", "$1:$2"),
        (rf"^(.{{10}}.\d{{2}}){tail}", "$1:00"),
        (rf"^(.{{10}}.\d{{2}}:\d{{2}}){tail}", "$1:00"),
        (r"^(.{10})Z?$", "$1T00:00:00"),
    ]
    for pattern, replacement in steps:
        text = f"regexp_replace({text}, r'{pattern}', '{replacement}')"
    return text


def iso_instant(text: str) -> str:
    """Timestamp of an ISO-8601 text, or null.

    Takes calendar dates with or without dashes, any one-character separator,
    times down to the hour, and ``Z`` or numeric offsets. A text without an
    offset is read as UTC. Week dates are not taken.
    """
    spread = _spread(text)
    zoned = f"transform(array({spread}), t -> if(t RLIKE r'^.{{11}}.*{_ZONE}$', t, concat(t, 'Z')))"
    other = f"element_at(transform({zoned}, z -> CASE WHEN z RLIKE r'{_FULL}' THEN {_instant('z')} END), 1)"
    return f"""CASE WHEN {text} RLIKE r'{_PLAIN}' THEN try_cast({text} AS timestamp)
        WHEN {text} RLIKE r'{_ZULU}' THEN {_instant(text)} ELSE {out_of_line(other)} END"""


def iso_text(ts: str) -> str:
    """ISO text of an instant with ``+00:00``; the fraction is left out when it is zero."""
    whole = f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss\")"
    micros = f"date_format({ts}, 'SSSSSS')"
    return f"concat({whole}, if({micros} = '000000', '', concat('.', {micros})), '+00:00')"


def hour_of(ts: str) -> str:
    """Start of the UTC hour, as a timestamp without zone."""
    return f"cast(date_trunc('hour', {ts}) AS timestamp_ntz)"


def day_of(ts: str) -> str:
    """Start of the UTC day, as a timestamp without zone."""
    return f"cast(date_trunc('day', {ts}) AS timestamp_ntz)"
