"""Whole files and state folders are found by tasks and not by the driver."""

import os

from vitalmart.sources import readers

UUID = "00000000-0000-4000-8000-{:012d}"


def put(root, name, text):
    os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
    with open(f"{root}/{name}", "wb") as out:
        out.write(text)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_no_scan_lists_note_files(spark, tmp_path):
    for n in range(30):
        put(tmp_path, f"Ohio/output/notes/A_{UUID.format(n)}.txt", b"x")
        put(tmp_path, f"Ohio/output/text_encounters/A_{UUID.format(n)}{n}.txt", b"x")
    for read in (readers.read_notes, readers.read_encounter_notes, readers.states_under):
        plan = plan_of(read(spark, str(tmp_path)))
        assert "FileScan" not in plan and "InMemoryFileIndex" not in plan
    assert readers.read_notes(spark, str(tmp_path)).count() == 30


def test_names_and_bytes_as_a_scan_gives_them(spark, tmp_path, rows):
    names = ["a b%20", "ünï#?[x]", "_left=in", "_left_out", ".hidden"]
    for n, name in enumerate(names):
        put(tmp_path, f"New York/output/notes/{name}_{UUID.format(n)}.txt", b"\xef\xbb\xbfline\r\n\xff")
    put(tmp_path, f"New York/output/notes/empty_{UUID.format(9)}.txt", b"")
    put(tmp_path, f"New York/output/notes/deep/x_{UUID.format(8)}.txt", b"x")
    put(tmp_path, f".dot/output/notes/x_{UUID.format(7)}.txt", b"x")
    put(tmp_path, "Ohio/output/csv/x.csv", b"x")
    for root in (str(tmp_path), f"file://{tmp_path}"):
        scan = spark.read.option("pathGlobFilter", "*.txt").text(f"{root}/*/output/notes/", wholetext=True)
        expected = readers.notes_of(scan.transform(readers.audit("SYNTHEA.NOTES"))).drop("_load_dts")
        found = readers.read_notes(spark, root).drop("_load_dts")
        binary = "cast(note_content as binary) as note_content"
        shown = [binary if n == "note_content" else n for n in expected.columns]
        assert rows(found.selectExpr(*shown)) == rows(expected.selectExpr(*shown))
        assert found.count() == 4 and found.dtypes == expected.dtypes


def test_states_as_a_scan_finds_them(spark, tmp_path, rows):
    for name in ("A/output/csv/x", "B/output/csv/deep/x", "B/output/y", "C/other/x", "D/E/output/x", ".F/output/x", "G/output/_x"):
        put(tmp_path, name, b"x")
    put(tmp_path, "H/output/csv/x", b"")
    put(tmp_path, "top", b"x")
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path))
    assert rows(readers.states_under(spark, str(tmp_path))) == rows(readers.states_of(scan)) == [("A",), ("B",), ("E",)]
