"""Sources."""

from .files import read_readings, read_weather, stream_parquet, stream_text, stream_weather
from .jdbc import postgres_url, read_readings_jdbc
from .kafka import read_kafka, source_options, stream_kafka
from .workspace import drop_folder, move_folder, shared_folder

__all__ = [
    "drop_folder", "move_folder", "postgres_url", "read_kafka", "read_readings", "read_readings_jdbc", "read_weather",
    "shared_folder", "source_options", "stream_kafka", "stream_parquet", "stream_text", "stream_weather",
]
