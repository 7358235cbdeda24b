"""The Jaccard join on rows with null and repeated ids, against links of all pairs."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tests.llm.test_operators import ROWS, SCHEMA, words
from tidemark.llm import common, jaccard_join


def shingles(text, n):
    found = (text or "").encode().lower().split()
    return {tuple(found[i : i + n]) for i in range(max(len(found) - n, 0) + 1)} if found else set()


def brute(rows, n, percent):
    sets = [shingles(r[1], n) for r in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for r, x in zip(rows, label):
        if r[0] is not None:
            least[x] = min(least.get(x, r[0]), r[0])
    return Counter((r[0], len(s), least.get(x)) for r, s, x in zip(rows, sets, label))


def chain(percent):
    """Texts in a row, each linked to the next one only."""
    base = words(120, 77).split()
    step = 10 if percent == 90 else 20
    return [" ".join([*base, *(f"w{k}" for k in range(60))][: 120 + n * step // 2][n * step // 2 :]) for n in range(5)]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("ids", [(1, None, 9, None, 7), (None, None, None, None, None), (4, 4, 4, 2, 2), (None, 3, None, None, 3)])
def test_rows_without_an_id_keep_their_links(spark, n, percent, ids):
    rows = [(i, t, None, None, None, None, None) for i, t in zip(ids, chain(percent))]
    rows += [ROWS[5], ROWS[5], (None, ROWS[6][1], *ROWS[6][2:]), ROWS[6], (None, None, *ROWS[6][2:]), (None, "", *ROWS[6][2:]), (12, None, *ROWS[6][2:])]
    got = jaccard_join.join(spark.createDataFrame(rows, SCHEMA).repartition(3), n, percent)
    assert Counter(map(tuple, got.collect())) == brute(rows, n, percent)


def test_null_id_in_the_middle_of_a_chain(spark):
    base = words(200, 5).split()
    texts = [" ".join(base[k : k + 180]) for k in (0, 8, 16)]
    rows = [(i, t, None, None, None, None, None) for i, t in zip((1, None, 9), texts)]
    want = brute(rows, 3, 90)
    assert {r[2] for r in want} == {1}  # the ends are linked through the row without an id only
    got = jaccard_join.join(spark.createDataFrame(rows, SCHEMA), 3, 90)
    assert Counter(map(tuple, got.collect())) == want


def test_chunks_meet_only_where_sizes_allow_a_link(spark):
    rows = [(n, 7, size, n // 2) for n, size in enumerate((10, 10, 10, 12, 15, 15, 40, 40))] + [(50, 8, 5, 0)]
    members = spark.createDataFrame(rows, "node long, component long, n long, chunk int")
    met = {tuple(r) for r in jaccard_join.chunk_pairs(members, 80).collect()}
    assert met == {(7, 0, 1), (7, 1, 2), (7, 3, 3), (8, 0, 0)}


@pytest.mark.parametrize("chunk", [1, 300, 2_000])
def test_small_chunks_lose_no_link(spark, monkeypatch, chunk):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    rows = [(n, t, None, None, None, None, None) for n, t in enumerate(chain(80) + [words(k, 3) for k in (20, 60, 70, 80, 95, 110, 400)])]
    got = jaccard_join.join(spark.createDataFrame(rows, SCHEMA), 5, 80)
    assert Counter(map(tuple, got.collect())) == brute(rows, 5, 80)


def test_texts_that_share_few_shingles_make_no_candidates(spark):
    """Each shares five words with the next and a line with all: once, one cluster of all of them."""
    texts = [f"{words(60, 500 + k)} {words(5, 900 + k)} {words(60, 700 + k)} {words(5, 901 + k)} {words(9, 1)}" for k in range(40)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, texts[0] + " more"])], "doc_id long, text string").coalesce(1)
    found = jaccard_join.settled(jaccard_join.sets(docs, 5), "sets")
    order, found = jaccard_join.common(found), found.where("token is null").drop("token", "held")
    assert len(order.tokens) >= 5
    assert jaccard_join.candidates(docs, found, order, 5, 80).count() == 1


@pytest.mark.parametrize("paired, counted", [(2, 1), (3, 1 << 21), (64, 50)])
def test_pairs_stars_and_common_tokens_do_not_change_the_links(spark, monkeypatch, paired, counted):
    monkeypatch.setattr(jaccard_join, "PAIRED", paired)
    monkeypatch.setattr(jaccard_join, "COUNTED", counted)
    line = words(6, 8)
    rows = [(n, t, None, None, None, None, None) for n, t in enumerate(chain(80) * 2 + [f"{words(k, 3)} {line}" for k in (4, 5, 6, 7, 20, 23)])]
    got = jaccard_join.join(spark.createDataFrame(rows, SCHEMA), 5, 80)
    assert Counter(map(tuple, got.collect())) == brute(rows, 5, 80)


def test_a_task_links_its_sets_as_stars():
    found = [np.arange(k, 100 + k, dtype=np.uint64) for k in (0, 4, 8, 12)] + [np.arange(500, 600, dtype=np.uint64)]
    assert sorted(jaccard_join.group_links(np.array([40, 30, 10, 20, 5]), found, 90)) == [(20, 10), (30, 10), (40, 10)]


def test_stars_cost_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(common, "settled", lambda df, label, settled=common.settled: (written.append(label), settled(df, label))[1])
    rows = [(5, 2), (2, 9), (3, 3), (8, 7), (7, 8), (None, 1), (4, None)]
    got = common.components(spark.createDataFrame(rows, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == {(2, 2), (5, 2), (9, 2), (7, 7), (8, 7)}
    assert len(written) == 1
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert len(written) == 2


@pytest.mark.parametrize("rows", [[(1, 2), (2, 3)], [(3, 1), (3, 2)], [(1, 5), (2, 5), (2, 6), (4, 6)]])
def test_what_is_no_star_is_contracted(spark, rows):
    ids = {n for r in rows for n in r}
    assert {tuple(r) for r in common.components(spark.createDataFrame(rows, "a long, b long")).collect()} == {(n, 1) for n in ids}


def test_verified_links_need_no_round(spark, monkeypatch):
    written, settled = [], common.settled
    for module in (common, jaccard_join):
        monkeypatch.setattr(module, "settled", lambda df, label: (written.append(label), settled(df, label))[1])
    rows = [(n, t, None, None, None, None, None) for n, t in enumerate(chain(80))]
    got = jaccard_join.join(spark.createDataFrame(rows, SCHEMA), 5, 80)
    assert Counter(map(tuple, got.collect())) == brute(rows, 5, 80)
    assert written[written.index("members") :] == ["members", "links"]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_texts_without_near_copies_send_no_signatures(spark, n, percent):
    """Once, each text sent a tenth or a fifth of its shingles."""
    texts = [f"{words(120, 300 + k)} {words(8, 1)}" for k in range(30)]
    rows = [(k, t, None, None, None, None, None) for k, t in enumerate([*texts, texts[0] + " more", texts[1]])]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    order, bits = jaccard_join.common(jaccard_join.sets(docs, n)), jaccard_join.repeated(docs, n)
    sent = {r["node"] for r in jaccard_join.signatures(docs, order, bits, n, percent).collect()}
    near = jaccard_join.shingles(jaccard_join.worker_hashes(), [texts[0], texts[0] + " more"], n)
    assert sent == set(jaccard_join.nodes_of(near).tolist())
    got = jaccard_join.join(docs, n, percent)
    assert Counter(map(tuple, got.collect())) == brute(rows, n, percent)


@pytest.mark.parametrize("places", [8, 64])
def test_full_bits_lose_no_link(spark, monkeypatch, places):
    monkeypatch.setattr(jaccard_join, "PLACES", places)
    rows = [(n, t, None, None, None, None, None) for n, t in enumerate(chain(80) + [words(k, 3) for k in (20, 60, 70, 95, 400)] + chain(90))]
    got = jaccard_join.join(spark.createDataFrame(rows, SCHEMA).repartition(3), 5, 80)
    assert Counter(map(tuple, got.collect())) == brute(rows, 5, 80)
