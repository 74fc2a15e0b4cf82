"""The newest files are ranked from the listing; empty ones do not count."""

import os

from shoptrail.sources.files import read_newest_files


def test_newest_files_that_hold_rows(spark, tmp_path):
    for i in range(8):
        rows = spark.createDataFrame([(f"e{i}",)] if i not in (5, 7) else [], "event_id string").coalesce(1)
        rows.write.parquet(str(tmp_path / str(i)))
        for f in (tmp_path / str(i)).glob("*.parquet"):
            os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))

    def ids(n):
        return [r["event_id"] for r in read_newest_files(spark, str(tmp_path), files=n).collect()]
    assert ids(2) == ["e4", "e6"]  # the files 6 and 4; their rows go by event id
    assert len(ids(5)) == 5 and len(ids(50)) == 6
    empty = tmp_path / "none"
    spark.createDataFrame([], "event_id string").coalesce(1).write.parquet(str(empty))
    assert read_newest_files(spark, str(empty)).count() == 0
