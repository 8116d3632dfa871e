from __future__ import annotations

import csv
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tamis.operators.messages import rows_to_messages
from tamis.sources import records
from tamis.sources.files import (
    UnclosedQuote,
    read_csv_infer,
    read_csv_strings,
    read_delimited_rows,
    write_csv,
)
from tests.conftest import physical

CASES = {
    "plain": (
        'a,b,c\n1,2,3\n,x,\n"",y,""\n\n   \n1,2\n1,,3,4\n1,\n,,3,4\n'
        '"q""q",z,w\n"x,y",1\n"x,y",,3,"4,5"\n5" pipe,a,b\né,1,2'
    ),
    "crlf": "a,b,c\r\n1,2,3\r\n\r\n,x,\r\n",
    "breaks": 'a,b,c\n1,"l1\nl2",3\n"x\n\ny",,\n1,"s\nt"\n9,8,7\n"a ""b""\n, c",1,2,3\n',
}


def _write(folder, name, text):
    path = f"{folder}/{name}.csv"
    with open(path, "w", encoding="utf-8", newline="") as file:
        file.write(text)
    return path


def _by_csv_module(path):
    with open(path, encoding="utf-8-sig") as file:
        rows = csv.reader(file)
        header = next(rows)
        return sorted(json.dumps(dict(zip(header, row)), sort_keys=True) for row in rows)  # noqa: B905


def _messages(frame):
    values = rows_to_messages(frame).collect()
    return sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in values)


@pytest.mark.parametrize("name", CASES)
def test_rows_equal_the_csv_module(spark, folder, name):
    path = _write(folder, name, CASES[name])
    assert _messages(read_delimited_rows(spark, path)) == _by_csv_module(path)


def test_folder_with_both_kinds_of_files(spark, tmp_path):
    folder = tmp_path / "some files%20"
    folder.mkdir()
    want = []
    for name, text in CASES.items():
        want += _by_csv_module(_write(folder, name, text))
    frame = read_delimited_rows(spark, str(folder))
    assert _messages(frame) == sorted(want)
    assert _messages(frame.select("a")) == sorted(
        json.dumps({k: v for k, v in json.loads(m).items() if k == "a"}) for m in want
    )


def test_cells_go_by_name(spark, tmp_path):
    folder = tmp_path / "headers"
    folder.mkdir()
    texts = {"one": "x,y\n1,2\n", "two": "y,x\n3,4\n\n", "three": "z,x,z\n5,\"6\n7\",8\n"}
    want = []
    for name, text in texts.items():
        want += _by_csv_module(_write(folder, name, text))
    frame = read_delimited_rows(spark, str(folder))
    assert sorted(frame.columns) == ["x", "y", "z"]
    assert _messages(frame) == sorted(want)


def test_a_repeated_name_has_its_last_cell(spark, folder):
    path = _write(folder, "t", "a,b,a\n1,2,3\n4,5\n")
    assert _messages(read_delimited_rows(spark, path)) == ['{"a": "3", "b": "2"}', '{"b": "5"}']


def test_an_unclosed_quote_names_its_file(spark, folder):
    _write(folder, "good", 'a,b\n1,"x\ny"\n')
    _write(folder, "bad", 'a,b\n1,"x\n' + "2,3\n" * 9)
    with pytest.raises(UnclosedQuote, match="bad.csv") as error:
        read_delimited_rows(spark, folder)
    assert "good" not in str(error.value)


def test_text_is_scanned_twice(spark, folder, monkeypatch):
    scans = []
    lines = records._lines
    monkeypatch.setattr(records, "_lines", lambda *args: scans.append(args) or lines(*args))
    path = _write(folder, "breaks", CASES["breaks"])
    plan = physical(read_delimited_rows(spark, path))
    assert len(scans) == 2 and "FileScan text" not in plan


@pytest.fixture
def tiny_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "40b", "spark.sql.files.openCostInBytes": "1"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)


_CELLS = st.sampled_from(
    ["", "x", '""', '"q"', '5" pipe', '"a\nb"', '"a ""z""\n\n,c"', "é", "  ", '"\n"']
)
_TEXTS = st.lists(st.lists(_CELLS, max_size=4).map(",".join), min_size=5, max_size=25)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=_TEXTS, end=st.sampled_from(["", "\n"]))
def test_records_cross_splits(spark, tiny_splits, tmp_path_factory, lines, end):
    folder = str(tmp_path_factory.mktemp("csv"))
    path = _write(folder, "t", "a,b,c\n" + "\n".join(lines) + end)
    for multiline in (None, True):
        frame = read_delimited_rows(spark, path, multiline=multiline)
        assert _messages(frame) == _by_csv_module(path)


def test_record_larger_than_a_split(spark, tiny_splits, folder):
    cell = "\n".join(f"line {i}" for i in range(60))
    path = _write(folder, "t", f'a,"b\nb"\n1,"{cell}"\n2,x\n"{cell}",3\n')
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    assert _messages(read_delimited_rows(spark, path)) == _by_csv_module(path)


def test_known_layout_needs_no_scan(spark, folder):
    path = _write(folder, "breaks", CASES["breaks"])
    assert _messages(read_delimited_rows(spark, path, multiline=True)) == _by_csv_module(path)
    path = _write(folder, "plain", CASES["plain"])
    assert _messages(read_delimited_rows(spark, path, multiline=False)) == _by_csv_module(path)
    assert "Exchange" not in physical(read_delimited_rows(spark, path))


def test_strings_and_inference(spark, folder):
    path = _write(folder, "t", "﻿idperiod,year\n202001,2020\n202002,2020\n")
    assert read_csv_strings(spark, path).dtypes == [("idperiod", "string"), ("year", "string")]
    inferred = read_csv_infer(spark, path)
    assert inferred.dtypes == [("idperiod", "int"), ("year", "int")]
    again = read_csv_infer(spark, path, inferred.schema)
    assert again.collect() == inferred.collect()


def test_write_modes(spark, folder):
    rows = spark.createDataFrame([("1", "a")], "x string, y string")
    write_csv(rows, f"{folder}/o")
    assert spark.read.text(f"{folder}/o").first().value == "1,a"
    with pytest.raises(Exception, match="(?i)already.exists"):
        write_csv(rows, f"{folder}/o")
    write_csv(rows, f"{folder}/o", header=True, mode="overwrite")
    assert spark.read.option("header", True).csv(f"{folder}/o").collect() == rows.collect()


def test_any_number_of_headers(spark, folder):
    """No two of 130 files have the same header; names repeat, move and are absent."""
    want = []
    for n in range(130):
        names = ["a", f"x{n}", "b"] if n % 2 else ["b", "a", "a", f"x{n}"]
        cells = [f"1-{n}", f"2\n{n}", "", "4"][: len(names)]
        with open(f"{folder}/{n:03}.csv", "w") as file:
            file.write(",".join(names) + "\n" + ",".join(f'"{c}"' for c in cells) + "\n")
        own = dict(zip(names, cells))
        want.append((own.get("a"), own.get("b"), own.get(f"x{n}")))
    rows = read_delimited_rows(spark, folder)
    assert len(rows.columns) == 132 and {"a", "b", "x0", "x129"} <= set(rows.columns)
    got = [
        (r.a, r.b, next(v for name, v in r.asDict().items() if name[0] == "x" and v is not None))
        for r in rows.collect()
    ]
    assert sorted(got) == sorted(want)


def test_short_long_and_blank_records_of_several_headers(spark, folder):
    with open(f"{folder}/1.csv", "w") as file:
        file.write('a,b\n1\n2,"x\ny",3\n \n\n4,\n')
    with open(f"{folder}/2.csv", "w") as file:
        file.write("b,c,a\n5,6\n7,8,9,10\n")
    rows = read_delimited_rows(spark, folder).select("a", "b", "c")
    want = [("1", None, None), ("2", "x\ny", None), (" ", None, None), (None, None, None), ("4", "", None)]
    want += [(None, "5", "6"), ("9", "7", "8")]
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(want, key=repr)


def test_more_splits_than_may_be_broadcast(spark, folder, monkeypatch):
    records = [(str(i), f"line\n{i}" * (1 + i % 40)) for i in range(400)]
    with open(f"{folder}/big.csv", "w") as file:
        file.write("a,b\n" + "".join(f'{a},"{b}"\n' for a, b in records))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        for bound in (200_000, 0):
            monkeypatch.setattr("tamis.sources.records._SMALL", bound)
            got = sorted(map(tuple, read_delimited_rows(spark, folder).collect()))
            assert got == sorted(records)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
