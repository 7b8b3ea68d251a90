"""Writes that fail half way, drivers lost between renames, and files named by rows."""

import os

import pytest
from pyspark.sql import functions as F

from vitalmart.session import scratch_path
from vitalmart.sources import readers, tables, writers

UUID = "00000000-0000-4000-8000-0000000000{:02x}"


@pytest.fixture(scope="module")
def schema(spark):
    spark.sql("CREATE SCHEMA swaps")
    return "swaps"


def left_over(spark, schema):
    place = spark.catalog.getDatabase(schema).locationUri.removeprefix("file:")
    return [n for n in [*tables.list_tables(spark, schema), *os.listdir(place)] if tables.DRAFT in n or tables.FORMER in n]


def failing(spark, at=900):
    return spark.range(0, 1000, 1, 8).select(F.expr(f"if(id = {at}, raise_error('half way'), id)").cast("bigint").alias("id"))


def test_a_failing_write_leaves_the_old_table(spark, schema, rows):
    name = f"{schema}.kept"
    assert tables.write_table(spark.range(5), name).row_count == 5
    with pytest.raises(Exception, match="half way"):
        tables.write_table(failing(spark), name)
    assert rows(spark.table(name)) == [(n,) for n in range(5)]
    assert left_over(spark, schema) == []
    entry = tables.attempt("silver", "kept", lambda: tables.write_table(failing(spark), name))
    assert not entry.success and "half way" in entry.error and spark.table(name).count() == 5


def test_a_failing_first_write_leaves_no_table(spark, schema):
    with pytest.raises(Exception, match="half way"):
        tables.write_table(failing(spark), f"{schema}.never")
    assert not spark.catalog.tableExists(f"{schema}.never") and left_over(spark, schema) == []


def test_fewer_rows_than_seen_are_refused(spark, schema, monkeypatch):
    name = f"{schema}.short"
    tables.write_table(spark.range(3), name)
    real = type(spark).table
    monkeypatch.setattr(type(spark), "table", lambda self, n: real(self, n).limit(2) if tables.DRAFT in n else real(self, n))
    with pytest.raises(RuntimeError, match="7 rows written, 2 found"):
        tables.write_table(spark.range(7), name)
    monkeypatch.undo()
    assert spark.table(name).count() == 3 and left_over(spark, schema) == []


def test_replaced_tables_have_the_new_columns_and_may_read_themselves(spark, schema, rows):
    name = f"{schema}.changed"
    tables.write_table(spark.range(4), name)
    tables.write_table(spark.table(name).select("id", (F.col("id") * 2).alias("twice")).where("id > 1"), name)
    assert rows(spark.table(name)) == [(2, 4), (3, 6)] and left_over(spark, schema) == []


def test_partitions_and_buckets_move_along(spark, schema, rows):
    frame = spark.range(20).select("id", (F.col("id") % 3).cast("string").alias("_state"))
    name = f"{schema}.by_state"
    for low in (0, 10):
        tables.write_table(frame.where(F.col("id") >= low), name, partition_by=("_state",))
        found = spark.table(name)
        assert rows(found, "id") == [(n,) for n in sorted(range(low, 20), key=lambda n: repr((n,)))]
        assert found.where("_state = '1'").count() == len([n for n in range(low, 20) if n % 3 == 1])
    assert {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {f"_state={n}" for n in range(3)}
    tables.write_table(spark.range(50), f"{schema}.bucketed", bucket_by=(4, "id"))
    tables.write_table(spark.range(60), f"{schema}.bucketed", bucket_by=(4, "id"))
    plan = spark.table(f"{schema}.bucketed").groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
    assert spark.table(f"{schema}.bucketed").count() == 60


def test_recovery_after_a_lost_driver(spark, schema):
    for name in ("lost", "done"):
        tables.write_table(spark.range(6), f"{schema}.{name}")
    # lost between the two renames; after them; while the draft was written
    spark.sql(f"ALTER TABLE {schema}.lost RENAME TO {schema}.lost{tables.FORMER}1")
    spark.range(2).write.saveAsTable(f"{schema}.done{tables.FORMER}2")
    spark.range(3).write.saveAsTable(f"{schema}.lost{tables.DRAFT}3")
    assert tables.recover_tables(spark, schema) == ["lost"]
    assert spark.table(f"{schema}.lost").count() == spark.table(f"{schema}.done").count() == 6
    assert left_over(spark, schema) == [] and tables.recover_tables(spark, schema) == []


def test_row_files_are_read_whole(spark, rows):
    root = scratch_path(spark, "row-files")
    long = " ".join(f"word{n}" for n in range(20_000))
    notes = [
        ("Ohio", "Ann_Lee", "01", f"{long}\r\n\n{long[:50]}\t"),
        ("Ohio", "Bo_Ek", "02", ""),
        ("Texas", "Cy_Ö", "03", "ünï 日本 😀\n\n"),
        ("Texas", "Di_No", "04", None),
    ]
    rows_ = [(f"{s}/output/notes/{n}_{UUID.format(int(i))}.txt", v) for s, n, i, v in notes]
    stray = [("Ohio/output/notes/index.txt", "x"), (f"Ohio/output/notes/Ann_{UUID.format(1)}.txt.bak", "x"), (None, "x")]
    frame = spark.createDataFrame(rows_ + stray, "path string, value string").repartition(3)
    assert writers.write_row_files(frame, root) == 6
    assert writers.write_row_files(frame, root) == 6  # again: the same files
    read = readers.read_notes(spark, root).collect()
    found = {r["patient_id"]: r for r in read}
    assert len(found) == len(read) == 2  # scans skip empty files
    for state, _, i, value in notes:
        if value:
            r = found[UUID.format(int(i))]
            assert r["note_content"] == value and r["_state"] == state
    assert found[UUID.format(1)]["patient_name"] == "Ann_Lee" and len(found[UUID.format(1)]["note_content"].split()) > 20_000
    assert writers.write_row_files(frame.limit(0), root) == 0
