"""Sync runs that are repeated, killed and met by late rows."""

from __future__ import annotations

import pytest

from tidemark.sources import sync


def rows(spark, *found):
    return spark.createDataFrame(list(found), "Id string, SystemModstamp string, Name string").selectExpr(
        "Id", "cast(SystemModstamp AS timestamp) AS SystemModstamp", "Name"
    )


def stored(spark, root):
    return sorted((r["Id"] or "", r["Name"]) for r in sync.read_history(spark, root, "Lead").collect())


A, B, C = ("a", "2024-01-01", "A"), ("b", "2024-01-02", "B"), ("c", "2024-01-02", "C")
NEWER, NULL, TIMELESS = ("a", "2024-01-05", "A2"), (None, "2024-01-02", "N"), ("z", None, "Z")


def test_runs_neither_skip_nor_double(spark, tmp_path):
    root = str(tmp_path)
    sync.run_stream("Lead", rows(spark, A, B, NULL, TIMELESS), root)
    sync.run_stream("Lead", rows(spark, A, B, NULL), root)
    assert stored(spark, root) == [("", "N"), ("a", "A"), ("b", "B")]
    sync.run_stream("Lead", rows(spark, A, B, C, NULL, NEWER), root)  # C comes late, at the mark
    sync.run_stream("Lead", rows(spark), root)
    assert stored(spark, root) == [("", "N"), ("a", "A"), ("a", "A2"), ("b", "B"), ("c", "C")]
    assert str(sync.read_state(spark, root, "Lead").first()["last_sync_at"]).startswith("2024-01-05")
    latest = {r["Id"]: r["Name"] for r in sync.latest_rows(spark, root, "Lead").collect()}
    assert latest["a"] == "A2" and latest["b"] == "B" and latest["c"] == "C"


@pytest.mark.parametrize("failing", ["before", "after"])
def test_a_killed_run_is_repeated_safely(spark, tmp_path, monkeypatch, failing):
    root, commit = str(tmp_path), sync._commit
    sync.run_stream("Lead", rows(spark, A), root)

    def killed(fs, hidden, target):
        if failing == "after":
            commit(fs, hidden, target)
        raise KeyboardInterrupt

    monkeypatch.setattr(sync, "_commit", killed)
    with pytest.raises(KeyboardInterrupt):
        sync.run_stream("Lead", rows(spark, A, B, C), root)
    monkeypatch.setattr(sync, "_commit", commit)
    assert stored(spark, root) == ([("a", "A")] if failing == "before" else [("a", "A"), ("b", "B"), ("c", "C")])
    sync.run_stream("Lead", rows(spark, A, B, C), root)
    assert stored(spark, root) == [("a", "A"), ("b", "B"), ("c", "C")]


def test_new_columns_and_a_taken_number(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    sync.run_stream("Lead", rows(spark, A), root)
    sync.run_stream("Lead", rows(spark, B).selectExpr("*", "1 AS extra"), root)
    assert {(r["Id"], r["extra"]) for r in sync.read_history(spark, root, "Lead").collect()} == {("a", None), ("b", 1)}
    monkeypatch.setattr(sync, "_committed", lambda *_: [])
    with pytest.raises(OSError):
        sync.run_stream("Lead", rows(spark, C), root)
