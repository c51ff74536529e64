"""Merges by changed files equal full merges."""

import os
import random

import pytest

from tidelake.plans import incremental, jobs
from tests.test_files import put

LINE = '{{"symbol":"{}","date":"{}","epoch":{},"close":{}}}'


def full(spark, bronze):
    return sorted(map(tuple, jobs.silver_bars(spark, bronze).collect()), key=repr)


def merged(table):
    return sorted(map(tuple, table.read().collect()), key=repr)


@pytest.fixture
def lake(spark, tmp_path):
    target = incremental.target_table(spark, str(tmp_path / "silver"), incremental.MARKET, rows_per_file=5)
    state = incremental.state_table(spark, str(tmp_path / "state"), rows_per_file=5)
    return tmp_path, str(tmp_path / "bronze"), target, lambda: incremental.run(spark, incremental.MARKET, str(tmp_path / "bronze"), target, state)


def lines(symbol, days, epoch, close):
    return "\n".join(LINE.format(symbol, f"20{20 + d % 3}-01-{1 + d:02d}", epoch, close) for d in days)


def test_only_touched_files_are_written(spark, lake):
    root, bronze, target, run = lake
    for k in range(40):
        put(root, f"bronze/symbol=S{k:02d}/data.ndjson", lines(f"S{k:02d}", range(9), 10, 1.0))
    put(root, "bronze/symbol=NONE/data.ndjson", "\n")
    assert run() == incremental.Outcome(41, 0, 0, 0)
    assert run() == incremental.Outcome(0, 0, 0, None)
    before = {r["path"] for r in target.files().collect()}
    put(root, "bronze/symbol=S07/data.ndjson", lines("S07", range(9), 10, 1.0) + "\n" + lines("S07", [4], 20, 2.0))
    outcome = run()
    assert (outcome.added, outcome.changed, outcome.removed) == (0, 1, 0)
    after = {r["path"] for r in target.files().collect()}
    assert len(before - after) == 1 and len(before) > 30  # the one file with the changed day
    assert merged(target) == full(spark, bronze)


def test_corrections_and_retractions(spark, lake, monkeypatch):
    """A symbol in several files, files of several symbols, withdrawn versions, removed files, a touched but equal file."""
    root, bronze, target, run = lake
    monkeypatch.setattr(incremental, "NAMED_FILES", 1)  # the way for many files
    put(root, "bronze/a/x.ndjson", lines("A", [1, 2], 10, 1.0) + "\n" + lines("B", [1], 10, 1.0))
    put(root, "bronze/b/x.ndjson", lines("A", [2, 3], 20, 2.0))
    put(root, "bronze/c/x.ndjson", lines("C", [5], 10, 1.0))
    run()
    os.remove(root / "bronze/b/x.ndjson")  # A's day 2 falls back to the older version, day 3 goes
    outcome = run()
    assert outcome.removed == 1 and merged(target) == full(spark, bronze) and len(merged(target)) == 4
    os.utime(root / "bronze/c/x.ndjson", (1, 1))
    outcome = run()
    assert outcome.changed == 1 and outcome.version is None
    put(root, "bronze/c/x.ndjson", lines("B", [1, 9], 30, 5.0))  # now feeds another symbol
    run()
    assert merged(target) == full(spark, bronze) and not [r for r in merged(target) if r[0] == "C"]
    os.remove(root / "bronze/a/x.ndjson")
    os.remove(root / "bronze/c/x.ndjson")
    put(root, "bronze/d/y.ndjson", "torn")
    run()
    assert merged(target) == [] and not run().any


def test_random_changes_equal_full_merges(spark, lake):
    root, bronze, target, run = lake
    rng = random.Random(3)
    for step in range(2):
        for _ in range(9):
            name = f"bronze/d{rng.randrange(8)}/x.ndjson"
            if rng.random() < 0.3 and (root / name).exists():
                os.remove(root / name)
            else:
                put(root, name, "\n".join(lines(f"S{rng.randrange(4)}", rng.sample(range(20), 3), rng.randrange(5), float(rng.randrange(9)))
                                          for _ in range(3)))
        put(root, f"bronze/d9/{step}.ndjson", "")
        run()
        assert merged(target) == full(spark, bronze)


def test_a_failed_state_commit_is_made_up_for(spark, lake, monkeypatch):
    root, bronze, target, run = lake
    put(root, "bronze/a/x.ndjson", lines("A", [1], 10, 1.0))
    run()
    put(root, "bronze/a/y.ndjson", lines("A", [1, 2], 20, 2.0))
    plain = incremental.VersionedTable.replace_keys
    monkeypatch.setattr(incremental.VersionedTable, "replace_keys", lambda self, rows, keys: plain(self, rows, keys) if "silver" in self.root
                        else (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.undo()
    assert merged(target) == full(spark, bronze)
    assert run().added == 1 and merged(target) == full(spark, bronze)
