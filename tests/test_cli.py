from __future__ import annotations

import pytest

import tamis.__main__ as cli
from tamis.contracts import CONTRACTS
from tamis.plans.lake import BRONZE, SILVER, Lake
from tamis.sources.topics import ERROR_TOPIC, Topics, read_topic


@pytest.fixture
def run(spark, monkeypatch):
    monkeypatch.setattr(cli, "build", lambda app, **conf: spark)
    return lambda *args: cli.main([str(a) for a in args])


FACT = "ID,NumAff,NumImm,IDPeriode,MontantDeclaration\n"


def test_from_csv_to_silver(spark, run, folder, capsys):
    source = f"{folder}/FactDeclaration.csv"
    with open(source, "w") as file:
        file.write(FACT + "1,a,i,202001,-2.5\nx,a,i,202001,1\n3,a,i\n4,,i,202002,7\n")
    topics = ("--topics", f"{folder}/topics", "--format", "parquet")
    lake = ("--lake", f"{folder}/lake")
    assert run("publish", *topics, f"{source}=FactDeclaration") == 0
    assert run("ingest", *topics, *lake, "FactDeclaration", "Unknown") == 0
    assert run("promote", *topics, *lake, "FactDeclaration", "DimAssure") == 0
    contract = CONTRACTS["FactDeclaration"]
    tables = Lake(f"{folder}/lake")
    assert tables.rows(spark, BRONZE, contract).count() == 3
    assert sorted(r.ID for r in tables.rows(spark, SILVER, contract).collect()) == [1, 4]
    errors = Topics(f"{folder}/topics", "parquet")
    assert read_topic(spark, errors, ERROR_TOPIC).count() == 2
    capsys.readouterr()
    totals = ("--target", f"{folder}/totals", "--checkpoint", f"{folder}/check-totals")
    assert run("errors", *topics, *totals) == 0
    shown = capsys.readouterr().out.splitlines()
    assert shown == ["missing_columns\t1", "type_cast_error\t1"]
    records = ("--target", f"{folder}/records", "--checkpoint", f"{folder}/check-records")
    assert run("errors", *topics, *records, "--records", "json") == 0
    assert spark.read.json(f"{folder}/records").count() == 2


def test_increments_replacement_compaction_and_gold(spark, run, folder):
    topics = ("--topics", f"{folder}/topics", "--format", "parquet", "--read-option", "mergeSchema=false")
    lake = ("--lake", f"{folder}/lake")
    contract, tables = CONTRACTS["FactDeclaration"], Lake(f"{folder}/lake")
    for number, rows in ((1, 1), (2, 2)):
        source = f"{folder}/{number}.csv"
        with open(source, "w") as file:
            file.write(FACT + f"{number},a,i,20200{number},-2.5\n")
        assert run("publish", *topics, f"{source}=FactDeclaration") == 0
        assert run("ingest", *topics, *lake, "FactDeclaration") == 0
        assert tables.rows(spark, BRONZE, contract).count() == rows
        assert run("promote", *topics, *lake, "FactDeclaration") == 0
    assert run("compact", *lake, "--hours", "0", "FactDeclaration") == 0
    assert len(tables.live(spark, BRONZE, contract)) == 2
    assert len({state.attempt for state in tables.live(spark, BRONZE, contract).values()}) == 1
    assert run("gold", *lake, "--path", f"{folder}/gold", "FactDeclaration", "year_gold") == 0
    assert [tuple(r) for r in spark.table("year_gold").collect()] == [("2020", 5.0)]
    spark.sql("DROP TABLE year_gold")
    assert run("gold", *lake, "DimAssure", "none") == 1  # it has no query
    assert run("ingest", *topics, *lake, "--replace", "all", "FactDeclaration") == 0
    assert tables.rows(spark, BRONZE, contract, "all").count() == 2
    assert run("ingest", *topics, *lake, "--option", "no-value", "FactDeclaration") == 1


def test_map_and_sql(spark, run, folder):
    source = f"{folder}/in.csv"
    with open(source, "w") as file:
        file.write(FACT + "1,a,i,202001,-2.5\n")
    assert run("map", "FactDeclaration", source, f"{folder}/mapped") == 0
    assert spark.read.text(f"{folder}/mapped").first().value == "1,a,i,202001,2.5"
    assert run("map", "FactDeclaration", source, f"{folder}/mapped") == 1  # target exists
    for _ in range(2):
        assert run("sql", "FactDeclaration", source, f"{folder}/sql") == 0
    assert spark.read.csv(f"{folder}/sql", header=True).first().Year == "2020"
    with open(f"{folder}/bad.sql", "w") as file:
        file.write("SELECT nothing FROM FactDeclaration")
    args = ("FactDeclaration", source, f"{folder}/sql")
    assert run("sql", *args, "--sql", f"{folder}/bad.sql") == 1


@pytest.mark.parametrize(
    "args",
    [
        ("map", "DimAffilie", "in", "out"),
        ("sql", "DimAssure", "in", "out"),
        ("sql", "FactDeclaration", "/nothing/in.csv", "out"),
        ("publish", "--topics", "x", "no-topic-given"),
    ],
)
def test_failures_exit_with_1(run, args):
    assert run(*args) == 1


@pytest.mark.parametrize("args", [(), ("ingest",), ("ingest", "--topics", "x", "--lake", "y")])
def test_usage_errors_exit_with_1(run, args):
    with pytest.raises(SystemExit) as exit_:
        run(*args)
    assert exit_.value.code == 1


def test_failed_topic_exits_with_1(run, folder):
    args = ("--topics", f"{folder}/none", "--format", "parquet", "--lake", folder)
    assert run("ingest", *args, "DimAssure") == 1
