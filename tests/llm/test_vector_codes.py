"""Vector codes against brute force with Python integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tidemark.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, _key string, v int"


def brute(rows, parts=4, entries=256, rounds=4):
    """{row number: (code, error)} of (vec_id, vector) pairs, by the definition."""
    whole = [(i, r) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for _, r in whole), default=0) // parts) * parts
    vectors = {i: [math.floor(1024 * x) for x in r[1]] + [0] * (width - len(r[1])) for i, r in whole}
    whole.sort(key=lambda r: (r[1][0] is None, r[1][0] or 0, r[1][1]))
    step = width // parts
    cut = {i: [v[p * step : (p + 1) * step] for p in range(parts)] for i, v in vectors.items()}
    books = [[cut[i][p] for i, _ in whole[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for c in cut.values():
                members.setdefault(near(c[p], book)[1], []).append(c[p])
            books[p] = [[sum(y) // len(members[e]) for y in zip(*members[e])] if e in members else c for e, c in enumerate(book)]
    out = {}
    for i, c in cut.items():
        found = [near(c[p], books[p]) for p in range(parts)]
        out[i] = ("".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found))
    return out


def as_float32(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], *r) for i, v, *r in rows]


def rows_of(seed, n, width):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(0, 0.2, width).tolist(), int(i % 3) if i % 7 else None, "x", "k", 1) for i in rng.permutation(n)]
    rows += [(n + 1, None, 1, None, None, None), (n + 2, [None] * width, 1, "", "", 0), (n + 3, [float("nan")] * width, 1, "", "", 0)]
    rows += [(n + 4, [float("inf")] + [0.0] * (width - 1), 1, "", "", 0)]
    rows += [(None, rows[0][1], None, "", "", 0), (None, rows[0][1], None, "", "", 0), rows[1], (rows[2][0], rows[3][1], 5, "", "", 0)]
    return as_float32(rows)


@pytest.mark.parametrize("width, entries", [(8, 256), (12, 6), (1, 5), (6, 4)])
def test_codes_equal_brute_force(spark, width, entries):
    rows = rows_of(width, 60, width)
    expected = sorted((str(rows[i][0]), *e) for i, e in brute(rows, entries=entries).items())
    kept = vector_codes.kept(spark.createDataFrame(rows, SCHEMA).repartition(3))
    books = vector_codes.fit(kept, 4, entries, 4)
    got = vector_codes.encode(kept, books).collect()
    assert sorted((str(r["vec_id"]), r["code"], r["error"]) for r in got) == expected


def test_query_columns_and_label_errors(spark):
    rows = rows_of(3, 40, 8)
    got = vector_codes.op12_vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    expected = brute(rows)
    assert sorted((str(r["vec_id"]), r["code"], r["error"]) for r in got) == sorted((str(rows[i][0]), *e) for i, e in expected.items())
    by_label = {}
    for i, (_, error) in expected.items():
        by_label[rows[i][2]] = by_label.get(rows[i][2], 0) + error
    assert sorted((str(rows[i][0]), e[0], by_label[rows[i][2]]) for i, e in expected.items()) == sorted((str(r["vec_id"]), r["code"], r["label_error"]) for r in got)
    assert len({r["codebooks_sha256"] for r in got}) == 1


def test_no_vectors_and_odd_lengths(spark):
    assert vector_codes.op12_vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    only_bad = [(1, None, 1, "", "", 0), (2, [None], 1, "", "", 0)]
    assert vector_codes.op12_vector_codes(spark.createDataFrame(only_bad, SCHEMA)).count() == 0
    empty = vector_codes.op12_vector_codes(spark.createDataFrame([(1, [], 1, "", "", 0), (2, [], None, "", "", 0)], SCHEMA)).collect()
    assert [(r["code"], r["error"], r["label_error"]) for r in empty] == [("00000000", 0, 0)] * 2
    mixed = as_float32([(1, [0.5] * 5, 1, "", "", 0), (2, [0.25] * 8, 1, "", "", 0), (3, [], 1, "", "", 0)])
    got = vector_codes.op12_vector_codes(spark.createDataFrame(mixed, SCHEMA)).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == sorted((mixed[i][0], *e) for i, e in brute(mixed).items())


def test_huge_components_stay_exact(spark):
    rows = as_float32([(i, [(-1.0) ** i * 3e38 / (i + 1), 1.0, 2.0, float(i)], 1, "", "", 0) for i in range(6)])
    kept = vector_codes.kept(spark.createDataFrame(rows, SCHEMA))
    books = vector_codes.fit(kept, 4, 2, 4)
    got = vector_codes.encode(kept, books).collect()
    expected = {rows[i][0]: e for i, e in brute(rows, entries=2).items()}
    assert {r["vec_id"]: r["code"] for r in got} == {i: c for i, (c, _) in expected.items()}
    assert all(r["error"] == (e if e < 2**63 else None) for r in got for e in [expected[r["vec_id"]][1]])


@pytest.mark.parametrize("size", [0, 1, 3, 16, 33])
def test_transform_keeps_distances_and_sequency(size):
    rng = np.random.default_rng(size)
    x = rng.integers(-50, 50, (20, size))
    out = vector_codes.walsh(x)
    assert ((out**2).sum(axis=1) == out.shape[1] * (x**2).sum(axis=1)).all()
    signs = vector_codes.walsh(np.eye(out.shape[1], dtype=int)).T  # rows of the matrix, slow ones first
    assert [(np.diff(r) != 0).sum() for r in signs] == list(range(out.shape[1]))


def test_ties_go_to_the_lower_entry():
    book = np.array([[2, 0], [0, 2], [0, 2], [-2, 0]])
    assert vector_codes.nearest(np.array([[0, 0], [0, 2], [1, 1]]), book)[0].tolist() == [0, 1, 0]
