"""Folding of batches of a table that a stream writes."""

import pytest

from thermowatt.contract import ROLLUPS
from thermowatt.sinks import BatchTable
from thermowatt.sources.workspace import list_folder
from thermowatt.streaming import latest_rollups

from .helpers import at, bag


def batch(spark, n):
    rows = [(f"d{n % 3}", at(0), float(n), 1.0, 1.0, n), (f"e{n}", at(86_400), 0.5, 1.0, 1.0, 1)]
    return spark.createDataFrame(rows, ROLLUPS)


@pytest.mark.parametrize("ts", ["window_start", None])
def test_rows_stay_and_folders_do_not_grow(spark, tmp_path, ts):
    table, want = BatchTable(str(tmp_path / "t"), ROLLUPS, ts), []
    for n in range(24):
        table.add(batch(spark, n), n)
        want += batch(spark, n).collect()
        if n % 4 == 3:
            table.compact(spark, n)
            assert bag(table.rows(spark)) == bag(spark.createDataFrame(want, ROLLUPS))
    folded = list_folder(spark, f"{table.path}-folded/*")
    left = list_folder(spark, f"{table.path}/{'' if ts is None else 'event_date=*/'}batch_id=*")
    assert len(folded) <= 5 and len(left) <= (1 if ts is None else 2) * 9
    newest = {r.device_id: r.n for r in latest_rollups(spark, table).where("device_id LIKE 'd%'").collect()}
    assert newest == {"d0": 21, "d1": 22, "d2": 23}


def test_a_fold_that_did_not_end_is_not_read(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"), ROLLUPS, "window_start")
    for n in range(4):
        table.add(batch(spark, n), n)
    table.compact(spark, 4)
    (tmp_path / "t-folded" / "0-4" / "_SUCCESS").unlink()
    assert table.rows(spark).count() == 8
    table.compact(spark, 4)
    table.compact(spark, 4)
    assert table.rows(spark).count() == 8
    assert not list_folder(spark, f"{table.path}/event_date=*/batch_id=*")
