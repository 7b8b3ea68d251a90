"""Readers and table helpers over small files of each kind."""

import pathlib

import pytest

from vitalmart.sources import layouts, readers, tables

UUID = "00000000-0000-4000-8000-0000000000ab"


def put(root: pathlib.Path, path: str, text: str) -> None:
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text)


@pytest.fixture
def source(tmp_path):
    put(tmp_path, "Ohio/output/csv/supplies.csv", "2020-01-01,p1,e1,c1,Gauze,2\n")
    put(
        tmp_path,
        "Texas/output/csv/supplies.csv",
        'DATE,PATIENT,ENCOUNTER,CODE,DESCRIPTION,QUANTITY\n2020-01-02,p2,,c2,"Tape, wide",x\n',
    )
    put(tmp_path, "Texas/output/symptoms/csv/symptoms.csv", "p2,F,white,hispanic,1,2,flu,3,cough\n")
    put(tmp_path, f"Ohio/output/notes/Ann_Lee_{UUID}.txt", "line 1\nline 2")
    put(tmp_path, "Ohio/output/notes/readme.txt", "no patient")
    put(tmp_path, f"Ohio/output/text_encounters/Ann_Lee_{UUID}12.txt", "seen")
    put(tmp_path, ".hidden/output/csv/supplies.csv", "")
    return str(tmp_path)


def test_raw_csv_over_states(spark, source, rows):
    df = readers.read_raw(spark, source, "supplies")
    assert rows(df, "PATIENT", "DESCRIPTION", "ENCOUNTER", "_state", "_rec_src") == [
        ("p1", "Gauze", "e1", "Ohio", "SYNTHEA.SUPPLIES"),
        ("p2", "Tape, wide", None, "Texas", "SYNTHEA.SUPPLIES"),
    ]
    kept = readers.read_raw(spark, source, "supplies", keep_header_rows=True)
    assert kept.filter("PATIENT = 'PATIENT'").count() == 1
    assert readers.read_raw(spark, source, "supplies", state="Ohio").count() == 1
    assert {"_load_dts", "_file_name"} <= set(df.columns)


def test_symptoms_and_states(spark, source, rows):
    assert rows(readers.read_raw(spark, source, "symptoms"), "PATHOLOGY", "_state") == [("flu", "Texas")]
    assert rows(readers.states_under(spark, source)) == [("Ohio",), ("Texas",)]


def test_notes(spark, source, rows):
    shown = rows(readers.read_notes(spark, source), "patient_id", "patient_name", "note_content", "_state")
    assert shown == [(UUID, "Ann_Lee", "line 1\nline 2", "Ohio")]
    shown = rows(readers.read_encounter_notes(spark, source), "patient_id", "encounter_number", "encounter_content")
    assert shown == [(UUID, "12", "seen")]


def test_pipe_files_ignore_quotes_and_the_closing_pipe(spark, tmp_path, rows):
    put(tmp_path, "RXNDOC.RRF", 'a|"b|c|d|\ne|f||h|\n')
    df = readers.read_piped(spark, str(tmp_path / "RXNDOC.RRF"), "doc")
    assert rows(df) == [("a", '"b', "c", "d"), ("e", "f", None, "h")]


def test_fixed_width_fields_are_trimmed(spark, tmp_path):
    put(tmp_path, "order.txt", f"00001 {'A000':<7} 1 {'Short':<60} Long text\n")
    df = readers.read_fixed_width(spark, str(tmp_path / "order.txt"), layouts.DIAGNOSIS_CODE_RECORD)
    assert tuple(df.first()) == ("00001", "A000", "1", "Short", "Long text")


def test_tab_files(spark, tmp_path):
    put(tmp_path, "package.txt", 'A\tB\tC\tD\tE\tF\tG\tH\np\tn\tc\t"quoted ""x"""\ts\t\tN\tY\n')
    row = readers.read_tabbed(spark, str(tmp_path / "package.txt"), "ndc_package").first()
    assert (row["product_id"], row["end_marketing_date"], row["sample_package"]) == ("p", None, "Y")


def test_names_and_composition(spark):
    df = spark.createDataFrame([(1, 2)], ["A b", "C-d"])
    assert df.transform(readers.tidy_names()).columns == ["A_b", "C_d"]
    assert df.transform(readers.tidy_names(lower=True)).columns == ["a_b", "c_d"]
    double, add = (lambda x: x * 2), (lambda x: x + 1)
    assert (tables.pipe(3, double, add), tables.compose(double, add)(3)) == (7, 8)
    assert tables.Layers(gold="g").table("gold", "t") == "g.t"
    assert tables.Layers().table("other", "t") == "other.t"
    assert layouts.tables_in("administrative") == ("organizations", "providers", "payers")
    assert layouts.tables_in("none") == ()
