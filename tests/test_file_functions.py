"""File functions in SQL text."""

import json

import pytest

from tidelake.plans import adhoc, file_functions
from tests.test_files import put


@pytest.fixture
def ticks(tmp_path):
    put(tmp_path, "ticks/a.csv", 'symbol,price,day\nA,1.5,2024-01-02\n"B, C",2,2024-01-03\n')
    put(tmp_path, "ticks/deep/b.csv", "symbol,price,day\nD,,2024-01-04\n")
    return tmp_path / "ticks"


def rows(spark, text, **parameters):
    return [tuple(r) for r in adhoc.query(spark, text, **parameters).collect()]


def test_types_are_found(spark, ticks):
    assert [t for _, t in adhoc.query(spark, f"SELECT * FROM read_csv('{ticks}/a.csv', header=true)").dtypes] == ["string", "double", "date"]
    assert rows(spark, f"SELECT sum(price), count(*) FROM read_csv_auto('{ticks}/a.csv')") == [(3.5, 2)]
    assert rows(spark, f"SELECT max(day) FROM '{ticks}/a.csv'")[0][0].isoformat() == "2024-01-03"
    assert rows(spark, f"SELECT price FROM read_csv('{ticks}/a.csv', all_varchar=true) WHERE symbol = :s", s="A") == [("1.5",)]
    assert rows(spark, f"SELECT sum(price) FROM read_csv('{ticks}/a.csv', header=true, sample_size=2)") == [(3.5,)]


def test_values_beyond_the_sample_are_an_error_and_not_lost(spark, tmp_path):
    put(tmp_path, "x.csv", "n\n" + "1\n" * 5 + "one\n")
    assert rows(spark, f"SELECT count(n) FROM read_csv('{tmp_path}/x.csv', header=true)") == [(6,)]
    with pytest.raises(Exception, match="(?i)malformed"):
        rows(spark, f"SELECT sum(n) FROM read_csv('{tmp_path}/x.csv', header=true, sample_size=3)")


def test_directories_lists_and_names(spark, ticks):
    assert rows(spark, f"SELECT count(*) FROM read_csv('{ticks}/**/*.csv', header=true)") == [(3,)]
    assert rows(spark, f"SELECT count(*), count(DISTINCT filename) FROM read_csv(['{ticks}/a.csv', '{ticks}/deep/b.csv'], filename=true, "
                       "union_by_name=true)") == [(3, 2)]
    assert rows(spark, f"SELECT * EXCLUDE price FROM read_csv('{ticks}/deep/*.csv', header=true, columns={{'symbol': 'VARCHAR', "
                       "'price': 'DOUBLE', 'day': 'VARCHAR'})") == [("D", "2024-01-04")]


def test_headerless_and_separators(spark, tmp_path):
    put(tmp_path, "x.txt", "1;a\n2;b\n")
    assert rows(spark, f"SELECT sum(k) FROM read_csv('{tmp_path}/x.txt', sep=';', names=['k', 'v'])") == [(3,)]
    put(tmp_path, "d.txt", "d\n03/02/2024\n")
    assert rows(spark, f"SELECT month(d) FROM read_csv('{tmp_path}/d.txt', header=true, dateformat='%d/%m/%Y')") == [(2,)]


def test_json_layouts(spark, tmp_path):
    put(tmp_path, "l.ndjson", '{"a": 1}\n{"a": 2}\n')
    put(tmp_path, "p.json", '[\n {"a": 3},\n {"a": 4}\n]')
    for path, total in (("l.ndjson", 3), ("p.json", 7)):
        assert rows(spark, f"SELECT sum(a) FROM read_json('{tmp_path}/{path}')") == [(total,)]
        assert rows(spark, f"SELECT sum(a) FROM '{tmp_path}/{path}'") == [(total,)]


def test_other_text_stays(spark, ticks):
    text = "SELECT 'read_csv(''x'')' AS `read_csv`, /* FROM 'a.csv' */ a * excluded FROM t -- * EXCLUDE (b)"
    assert file_functions.expanded(spark, text) == (text, {})
    assert rows(spark, "SELECT 1 AS one") == [(1,)]
    same = f"SELECT 1 FROM read_csv('{ticks}/a.csv') x JOIN read_csv('{ticks}/a.csv') y ON x.symbol = y.symbol"
    assert len(file_functions.expanded(spark, same)[1]) == 1
    adhoc.query(spark, same).collect()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("file_")]


@pytest.mark.parametrize("call, error", [("read_csv()", "path"), ("read_csv('x', frob=1)", "frob"), ("read_csv('x'", "closed"), ("read_csv(y)", "constants")])
def test_wrong_calls(spark, ticks, call, error):
    with pytest.raises(ValueError, match=error):
        adhoc.query(spark, f"SELECT * FROM {call.replace('x', str(ticks / 'a.csv'))}")


def test_filters_reach_the_scan(spark, ticks):
    plan = adhoc.query(spark, f"SELECT symbol FROM read_csv('{ticks}/a.csv', header=true) WHERE price > 1")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(price), GreaterThan(price,1.0)]" in plan and "ReadSchema: struct<symbol:string,price:double>" in plan


def test_schema_of_many_documents_is_found_by_many_tasks(spark, tmp_path):
    context = spark.sparkContext
    for k in range(30):
        (tmp_path / f"{k}.json").write_text(json.dumps([{"id": k, "n": {"x": k + 0.5}}, {"id": k, "late" if k == 29 else "n": None}], indent=1))
    (tmp_path / "v.json").write_bytes("[\n{\"v\": \"é\"}]".encode("utf-16-le"))  # found by its bytes
    context.setJobGroup(str(tmp_path), "schema")
    try:
        rows = file_functions.scan_json(spark, f"{tmp_path}/*.json", {})
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup(str(tmp_path)) for s in tracker.getJobInfo(j).stageIds]
    assert max(tasks) >= 8
    own = spark.read.option("multiLine", True).json(f"{tmp_path}/*.json")
    assert rows.schema == own.schema and rows.exceptAll(own).isEmpty() and rows.count() == 61
