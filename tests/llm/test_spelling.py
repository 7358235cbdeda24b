"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import spelling

SCHEMA = "doc_id long, text string, word string, n long, root int"


def words_of(rows):
    """{word: n} by definition."""
    found = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def brute(words, times=10):
    near = {w: [v for v in words if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()), key=str)


def texts(seed, n):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéßz\u00d7Y") for _ in range(rng.randint(6, 9))) for _ in range(12)]
    rows = []
    for i in range(n):
        line = []
        for _ in range(60):
            w = stems[min(int(rng.expovariate(0.4)), 11)]
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abcXÉ") + w[at:], w[:at] + rng.choice("abc") + w[at + 1 :]])
            line.append(w)
        rows.append((i, rng.choice([" ", "-", "1", "\u0178"]).join(line), "x", 1, 1))
    long = "x" * 3000
    rows += [(None, None, "w", 1, 1), (None, " ".join(stems), "w", 1, 1), (None, " ".join(stems), "w", 1, 1), (3, rows[3][1], "", 2, 2)]
    rows += [(90, f"{long} {long} {long[1:]} {long[1:]} {long[:99]}y{long[99:]}", None, None, None), (91, "", None, None, None), (92, f"{long[:99]}y{long[99:]}", None, None, None)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_brute_force(spark, seed):
    rows = texts(seed, 40)
    got = spelling.op13_spelling(spark.createDataFrame(rows, SCHEMA).repartition(3))
    expected = brute(words_of(rows))
    assert rows_of(got) == expected
    assert any(r[1] for r in expected) and any(r[4] > 3 for r in expected)


@pytest.mark.parametrize("members, classes, cell, distances", [(40_000, (4,), 1, 64), (3, (4, 6), 96, 1 << 21), (25, (1,), 2, 200), (1000, (10,), 4, 1 << 21)])
def test_block_sizes_do_not_change_the_result(spark, monkeypatch, members, classes, cell, distances):
    monkeypatch.setattr(spelling, "MEMBERS", members)
    monkeypatch.setattr(spelling, "CLASSES", classes)
    words = words_of(texts(5, 60))
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    weights, used, chunks = spelling.measured(frame.selectExpr("encode(word, 'ISO-8859-1') AS word", "n"))
    assert used in classes and (chunks > 1) == (members < 26)
    assert rows_of(spelling.grouped(frame, 10)) == brute(words)


def test_cells_and_slices_do_not_change_the_near_words(monkeypatch):
    words = words_of(texts(6, 80))
    named = sorted(words)
    column = pa.array([w.encode("latin-1") for w in named], pa.binary())
    for cell, distances, finer in ((96, 1 << 21, (1, 2, 3, 4, 6)), (1, 64, (1, 6)), (10**9, 100, (1,))):
        monkeypatch.setattr(spelling, "CELL", cell)
        monkeypatch.setattr(spelling, "DISTANCES", distances)
        monkeypatch.setattr(spelling, "FINER", finer)
        weights = np.ones(90)
        frame = pa.RecordBatch.from_arrays([column, pa.array([words[w] for w in named])], ["word", "n"])
        sent = pa.Table.from_batches(list(spelling.visits(weights, 4, 2)([frame]))).sort_by([("block", "ascending"), ("chunk", "ascending"), ("kind", "ascending")])
        near = Counter()
        for size in (7, 10_000):
            found = Counter()
            for batch in spelling.meetings(weights, 4)(sent.combine_chunks().to_batches(max_chunksize=size)):
                for word, n in zip(batch.column("word").to_pylist(), batch.column("near").to_pylist()):
                    found[word.decode("latin-1")] += n
            assert not near or near == found
            near = found
        assert {w: near[w] for w in named} == {w: sum(one_edit(w, v) for v in named if v != w) for w in named}


def test_no_words(spark):
    for rows in ([], [(1, None, "", 1, 1), (2, "short words only", "", 1, 1), (3, "solitary", "", 1, 1)]):
        assert spelling.op13_spelling(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_chains_are_followed_to_the_end(spark):
    words = {"aaaaaaa": 10**6, "aaaaaab": 10**5, "aaaaabb": 10**4, "aaaabbb": 10**3, "aaabbbb": 100, "aabbbbb": 10, "abbbbbb": 9}
    got = spelling.grouped(spark.createDataFrame(list(words.items()), "word string, n long"), 10)
    assert rows_of(got) == brute(words)


def test_one_edit_verified():
    cases = [("abcdefg", "abcdefg"), ("abcdefg", "abcdefh"), ("abcdefg", "abcdef"), ("abcdefg", "bcdefg"), ("aabbccd", "abbccd"), ("abcdefg", "abdcefg"), ("abcdefg", "abcdxy")]
    for a, b in cases:
        pair = [spelling.Words.of(pa.array([w.encode()], pa.binary()), np.ones(1)) for w in (a, b)]
        assert spelling.one_edit(pair[0], np.array([0]), pair[1], np.array([0]))[0] == one_edit(a, b)
