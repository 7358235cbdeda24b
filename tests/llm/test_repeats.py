"""Repeated strings in very long texts, odd rows and small pieces, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest

from tests.llm.test_operators import LONG, ROWS, SCHEMA, brute_repeats, words
from tidemark.llm import repeats


def by_brute_force(rows):
    """Results of (doc_id, text) rows in their order: null ids first, then by id and text."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    return sorted(map(str, [(i, *want) for (i, _), want in zip(order, brute_repeats([(t or "").encode() for _, t in order]))]))


def by_operator(df):
    return sorted(str((r["doc_id"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in repeats.op6_repeats(df).collect())


@pytest.mark.parametrize("hot", [20_000, 1])
def test_null_and_repeated_ids_and_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = [*[r[:2] for r in ROWS[:6]], ROWS[2][:2], (None, LONG), (None, LONG), (2, LONG), (None, None), (2, "")]
    df = spark.createDataFrame([(*r, None, None, 1, None, 1) for r in rows], SCHEMA).repartition(3)
    assert by_operator(df) == by_brute_force(rows)


@pytest.mark.parametrize("share", [1, 5, 100_000])
def test_heavy_grams_in_parts(spark, monkeypatch, share):
    """One line in every text, most texts equal: split or not, the result is the same."""
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    monkeypatch.setattr(repeats, "SHARE", share)
    monkeypatch.setattr(repeats, "PARTS", 3)
    line = words(50, 41)
    rows = [(i, f"{words(9, i % 4)} {line} {words(30, i % 3)}") for i in range(30)] + [(40, line + line), (None, line)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert bool(repeats.heavy_grams(repeats.numbered(df))) == (share > 5)
    assert by_operator(df) == by_brute_force(rows)


def test_texts_longer_than_a_piece(spark):
    rng = random.Random(5)
    passage = words(60, 900)
    long = " ".join(f"{rng.getrandbits(40):x}" for _ in range(14_000))
    assert len(long) > 2 * repeats.PIECE
    at = repeats.PIECE - 150  # a passage across a seam
    rows = [(1, long[:at] + passage + long[at:]), (2, "short " + passage), (3, long[1000:] + "end"), (4, "ab" * 70_000)]
    assert by_operator(spark.createDataFrame(rows, "doc_id long, text string")) == by_brute_force(rows)


def test_pieces_give_the_anchors_of_the_whole_text(monkeypatch):
    data = np.frombuffer((words(900, 7) + "x" * 700 + words(300, 7)).encode(), np.uint8)
    whole = repeats.anchors(data)
    for piece in (1, 33, 100, 1000):
        monkeypatch.setattr(repeats, "PIECE", piece)
        for a, b in zip(whole, repeats.anchors(data)):
            assert np.array_equal(a, b)


def test_equal_contexts_meet_in_texts_of_any_length():
    passage = words(80, 11).encode()
    found = []
    for before, after in ((0, 0), (300, 17), (5, 4000)):
        data = np.frombuffer(words(400, 12).encode()[:before] + passage + (words(900, 13).encode())[:after], np.uint8)
        gram, context, at = repeats.anchors(data)
        inside = (at >= before + repeats.SIDE) & (at + repeats.LENGTH <= before + len(passage))
        found.append((gram[inside].tolist(), context[inside].tolist()))
    assert len(found[0][0]) > 3 and found[0] == found[1] == found[2]


@pytest.mark.parametrize("batch", [1, 2000, 1 << 19])
@pytest.mark.parametrize("few_bits", [False, True])
def test_suffix_arrays_over_any_cut_into_batches(monkeypatch, batch, few_bits):
    """Contexts cut into batches at whole grams cover the same bytes; ranks beyond 21 bits take two steps."""
    monkeypatch.setattr(repeats, "BATCH", batch)
    if few_bits:
        monkeypatch.setattr(repeats, "_three", lambda ranks, at, step, three=repeats._three: _two_steps(ranks, at, step))
    texts = [words(60, 20) + " " + words(40, 21 + i) + " " + words(50, 30 + i % 2) for i in range(6)]
    rows = []
    for doc, text in enumerate(texts):
        data = text.encode()
        gram, _, at = repeats.anchors(np.frombuffer(data, np.uint8))
        for g, a in zip(gram.view(np.int64), at):
            begin = max(0, int(a) - repeats.SIDE)
            rows.append((g, doc, begin, data[begin : int(a) + repeats.LENGTH]))
    frame = pd.DataFrame(rows, columns=["gram", "doc", "start", "bytes"]).sort_values("gram", kind="stable")
    cut = [frame.iloc[i : i + 7] for i in range(0, len(frame), 7)]
    out = list(repeats.covered_batches(iter([frame.iloc[:0], *cut])))
    spans = pd.concat(out)
    for doc, (text, want) in enumerate(zip(texts, brute_repeats([t.encode() for t in texts]))):
        hit = np.zeros(len(text.encode()), bool)
        for s, e in spans.loc[spans["doc"] == doc, ["start", "end"]].to_numpy():
            hit[s:e] = True
        assert int(hit.sum()) == want[0]
    assert (len(out) > 1) == (batch < 1 << 19)


def _two_steps(ranks, at, step):
    padded = np.concatenate([ranks.astype(np.int64) + 1, np.zeros(2 * step, np.int64)])
    first = repeats._ranked(padded[at] << 32 | padded[at + step]).astype(np.int64)
    return first << 32 | padded[at + 2 * step]
