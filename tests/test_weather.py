import json

import pytest

from thermowatt import default_stations, weather_to_readings
from thermowatt.sources import read_weather, stream_weather
from thermowatt.streaming import stream_into

NYC, LDN = {"lat": 40.71, "lon": -74.00}, {"lat": 51.50, "lon": -0.12}
LINES = [
    ({**NYC, "current": {"temperature_2m": 18.26, "wind_speed_10m": 10.0}}, ("sensor-nyc", "NewYork-Central", 18.26, 2.3)),
    ({**LDN, "current": {}}, ("sensor-ldn", "London-City", 20.0, 1.1)),
    ({**LDN}, ("sensor-ldn", "London-City", 20.0, 1.1)),
    ({**LDN, "current": {"temperature_2m": 2.675, "wind_speed_10m": "7"}}, ("sensor-ldn", "London-City", 2.67, 1.85)),
    ({**NYC, "current": {"temperature_2m": None}}, None),
    ({**NYC, "current": {"temperature_2m": "warm"}}, None),
    ({**NYC, "current": {"temperature_2m": [1]}}, None),
    ({**NYC, "current": None}, None),
    ({**NYC, "current": 5}, None),
    ({"lat": 1.0, "lon": 2.0, "current": {}}, None),
]


@pytest.fixture
def landed(tmp_path):
    (tmp_path / "in").mkdir()
    text = "\n".join(json.dumps(line) for line, _ in LINES) + "\nbroken\n"
    (tmp_path / "in" / "a.json").write_text(text)
    return str(tmp_path / "in")


def rows(df):
    return sorted((r["device_id"], r["room"], r["temperature_c"], r["power_kw"]) for r in df.collect())


EXPECTED = sorted(r for _, r in LINES if r is not None)


def test_responses_to_readings(spark, landed):
    assert rows(weather_to_readings(read_weather(spark, landed), default_stations(spark))) == EXPECTED


def test_the_join_is_left_to_spark(spark, landed):
    found = weather_to_readings(read_weather(spark, landed), default_stations(spark))
    assert "hint" not in found._jdf.queryExecution().logical().toString().lower()
    assert rows(found) == EXPECTED


def test_stream(spark, landed, tmp_path):
    stream = weather_to_readings(stream_weather(spark, landed), default_stations(spark))

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(str(tmp_path / f"out/{batch_id}"))

    stream_into(stream, sink, str(tmp_path / "checkpoint"), {"availableNow": True}).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out/*"))) == EXPECTED
