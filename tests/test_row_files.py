"""Row files are written by as many tasks as the session has partitions."""

from vitalmart.session import scratch_path
from vitalmart.sources import writers


def test_rows_in_one_split_are_written_by_many_tasks(spark, monkeypatch):
    seen = []
    frame = type(spark.range(1))
    plain = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda df, *a, **k: seen.append(df.rdd.getNumPartitions()) or plain(df, *a, **k))
    files = spark.range(0, 200, 1, 1).selectExpr("concat('a/', id) as path", "cast(id as string) as value")
    assert writers.write_row_files(files, scratch_path(spark, "spread")) == 200
    assert seen == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
