import random
from datetime import datetime, timezone

import pytest

from thermowatt.functions import (
    float_text, iso_instant, iso_text, mean_of_units, round_half_even, sum_of_units, text_number, to_units,
)


def column(spark, values, kind, *expressions):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [tuple(r) for r in df.selectExpr(*expressions).collect()]


def test_round_half_even_is_pythons_round(spark):
    rng = random.Random(1)
    values = [2.675, 1.005, 0.125, 0.0625, -0.125, -2.675, 0.0, 1e15 + 0.3, 123456789.985]
    values += [rng.uniform(-200, 200) for _ in range(300)] + [rng.randrange(4000) / 8 / rng.randrange(1, 9) for _ in range(300)]
    found = column(spark, values, "double", round_half_even("x", 2), round_half_even("x", 3))
    assert found == [(round(v, 2), round(v, 3)) for v in values]


def test_float_text_is_pythons_repr(spark):
    rng = random.Random(2)
    values = [0.0, -99.9, 120.01, 1e16, 1.5e16, -5e-05, 0.0001, 0.00012, 9999999.0, 1e7, 12345678.5, 1e15, 123456789012345.6, 1e-300, 1e300]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-3, 15) for _ in range(200)]
    assert [r[0] for r in column(spark, values, "double", float_text("x"))] == [repr(v) for v in values]


@pytest.mark.parametrize("text", [
    "22", "22.0", "-1.5e3", "+.5", "5.", "1_000.5", " 22.0 ", "1E5", "007",
    "", "abc", "22d", "22f", "0x10", "1__0", "_1", "1_", "--1", "1.2.3", ".", "e5", "true",
])
def test_text_number_is_pythons_float(spark, text):
    try:
        expected = float(text)
    except ValueError:
        expected = None
    assert column(spark, [text], "string", text_number("x")) == [(expected,)]


def test_text_number_refuses_non_finite_words(spark):
    assert column(spark, ["NaN", "inf", "-Infinity"], "string", text_number("x")) == [(None,)] * 3


ISO = [
    "2026-10-08T12:00:00.000Z", "2026-10-08T12:00:00Z", "2026-10-08 12:00:00", "2026-10-08x12:00:00.5",
    "2026-10-08T12", "2026-10-08T12:30", "2026-10-08", "2026-10-08T12Z", "2026-10-08T12:00Z", "2026-10-08T12:30+05:30",
    "2026-10-08T12:00:00+0530", "2026-10-08T12:00:00+05", "2026-10-08T12:00:00-05:30:15", "2026-10-08T12:00:00,25Z",
    "2026-10-08T12:00:00.1234567Z", "20261008", "20261008T120000", "20261008T1230Z", "20261008T12:30:15.5+01:00",
    "2026-10-08T120000.5Z", "0001-01-01T00:00:00Z", "2024-02-29T23:59:59.999999Z",
    "2026", "2026-10", "T12:00:00", "12:00:00", "2026-10-08T12:00:60Z", "2026-10-08T24:00:00Z", "2026-13-01T00:00:00Z",
    "2026-02-29T00:00:00Z", "2026-10-08T12:00:00 Europe/Paris", "2026-10-8T1:2:3", " 2026-10-08T12:00:00Z", "bad", "",
    "now", "epoch", "2026-10-08T12:00:00z", "2026-10-08T1", "2026-10-08T12:0", "2026-10-08T", "2026-10-08Z", "2026-10-08+05:30",
]


def test_iso_instant_follows_fromisoformat(spark):
    def python(text):
        try:
            ts = datetime.fromisoformat(text.replace("Z", "+00:00"))
        except ValueError:
            return None
        return ts.replace(tzinfo=ts.tzinfo or timezone.utc).astimezone(timezone.utc).replace(tzinfo=None)

    found = column(spark, ISO, "string", "x", f"cast({iso_instant('x')} AS timestamp_ntz)")
    assert found == [(t, python(t)) for t in ISO]


def test_iso_text_is_pythons_isoformat(spark):
    times = [datetime(2026, 10, 8, 12, 0, 0, m, tzinfo=timezone.utc) for m in (0, 5, 123456)]
    assert [r[0] for r in column(spark, times, "timestamp", iso_text("x"))] == [t.isoformat() for t in times]


def test_units_are_exact_and_half_up(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.15,)], "x double")
    total = f"sum({to_units('x', 2)})"
    row = df.selectExpr(
        f"{mean_of_units(total, 'count(1)', 2, 2)} AS a", f"{mean_of_units(total, 'count(1)', 2, 4)} AS b",
        f"{sum_of_units(total, 2, 1)} AS c", f"{mean_of_units('-' + total, 'count(1)', 2, 1)} AS d",
    ).first()
    assert tuple(row) == (0.15, 0.15, 0.5, -0.2)
