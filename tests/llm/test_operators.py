"""Corpus operators on a small table with nulls, empty texts, ties, repeats and clashing columns, against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import chat, decontamination, exact_dedup, jaccard_join, mixing, repeats, scoring, sharding, token_files, toxicity
from tidemark.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, _slot int"


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["ba", "Ro", "tin", "el,", "né", "or"]) + str(rng.randrange(40)) for _ in range(n))


LONG = words(400, 1)
ROWS = [(i, words(5 + 7 * i, i), "en", f"s{i % 3}", 1, "x", 9) for i in range(24)]
ROWS += [(30, None, None, None, None, None, None), (31, "", "en", "s1", 0, "x", 1), (32, " \n", "en", None, 0, "x", 1)]
ROWS += [(33, LONG, "en", "s0", 5, "x", 2), (34, LONG.replace("ba1", "zz"), "en", "s0", 5, "x", 2), (35, LONG, "de", "s2", 5, "x", 2)]
ROWS += [(36, "One", "en", "s0", 3, "x", 1), (37, "one", "en", "s0", 3, "x", 1), (38, "x" * 900, "en", "s1", 900, "x", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids and rows."""
    return spark.createDataFrame([*ROWS[:6], ROWS[2], (None, LONG, None, None, 1, None, 1), (None, LONG, None, None, 1, None, 1), (2, LONG, "x", "y", 1, "z", 1)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_shards_are_even_and_gapless(docs, odd, none):
    for df in (docs, odd):
        rows = sharding.shard_rows(df).collect()
        sizes = Counter(r["shard"] for r in rows)
        assert len(rows) == df.count() and max(sizes.values()) - min(sizes.get(s, 0) for s in range(8)) <= 1
        for s, n in sizes.items():
            assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    assert sharding.op2_shard(none).count() == 0


def test_ring_moves_few_keys_when_loads_have_room():
    counts = {i * 16: 1 for i in range(4000)}
    before = {r[0]: r[3] for r in sharding.walk(counts, 8, 128, 1.25)}
    after = {r[0]: r[3] for r in sharding.walk(counts, 9, 128, 1.25)}
    assert sum(before[k] != after[k] for k in before) / len(before) < 0.3
    assert max(Counter(before.values()).values()) <= 1.25 * 4000 / 8 + 1


def test_mix_meets_targets(docs, odd, none):
    rows = mixing.plan(docs).collect()
    for r in rows:
        assert r["size"] == len((r["text"] or "").encode().split())
        assert r["copies"] <= 3 and len(r["shards"]) == r["copies"]
    total = sum(r["size"] for r in rows)
    for s in {r["source"] for r in rows}:
        mine = [r for r in rows if r["source"] == s]
        assert abs(sum(r["size"] * r["copies"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in mine)
        assert mine[0]["target"] <= 3 * mine[0]["source_size"] + 1e-9
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(total)
    assert mixing.plan(odd).count() == odd.count() and mixing.plan(none).count() == 0
    drawn = mixing.draw(mixing.plan(docs), ["doc_id"]).collect()
    assert len(drawn) == sum(r["copies"] for r in rows)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_checks_bytes(spark, odd, docs, tmp_path, weak):
    from pyspark.sql import functions as F

    path = str(tmp_path / "docs")
    docs.unionByName(odd).repartition(2).write.parquet(path)
    digest = (lambda n: F.substring(F.sha2(n, 256), 1, 1)) if weak else exact_dedup.digest_of
    rows = exact_dedup.dedup(spark, path, digest).collect()
    texts = ["".join((r["text"] or "").split(" ")).replace("\n", "") for r in spark.read.parquet(path).collect()]
    assert sorted(r["group_size"] for r in rows) == sorted(Counter(texts)[t] for t in texts)
    assert sum(r["rank"] == r["keep"] for r in rows) == len(set(texts))


def test_exact_dedup_goes_on_from_its_state(spark, docs, none, tmp_path):
    path, state, out = (str(tmp_path / n) for n in ("in", "state", "out"))
    docs.write.parquet(path)
    exact_dedup.run_stream(spark, path, state, out)
    docs.where("doc_id < 3").write.mode("append").parquet(path)
    exact_dedup.run_stream(spark, path, state, out)
    assert exact_dedup.states(spark, out).selectExpr("sum(group_size)").first()[0] == docs.count() + 3
    none.write.parquet(str(tmp_path / "none"))
    assert exact_dedup.dedup(spark, str(tmp_path / "none")).count() == 0


def test_chat_folds_events(spark):
    log = [(1, 1, 0, "delta", "user", "Hi"), (1, 3, 1, "delta", None, "lo"), (1, 2, 1, "delta", "assistant", "hel"), (1, 4, 1, "edit", None, "bye"),
           (1, 5, 1, "delta", None, "!"), (1, 6, 2, "delta", "user", "gone"), (1, 7, 1, "regenerate", None, None), (1, 8, 1, "delta", "assistant", "<|end|>new[\\"),
           (None, 1, 0, "delta", "assistant", None)]
    events = spark.createDataFrame(log, "conv_id int, seq int, message int, kind string, role string, text string")
    found = {(r[0], r[1]): (r[2], r[3]) for r in chat.fold(events).collect()}
    assert found == {(1, 0): ("user", "Hi"), (1, 1): ("assistant", "<|end|>new[\\"), (None, 0): ("assistant", "")}
    out = chat.joined(chat.render(chat.fold(events)))
    row = out.select("conv_id", chat.turns_of(out["formatted"]).alias("t"), chat.masked(out["formatted"], out["loss_spans"]).alias("m")).where("conv_id = 1").first()
    assert [tuple(t) for t in row["t"]] == [("user", "Hi"), ("assistant", "<|end|>new[\\")] and row["m"] == ["<|end|>new[\\"]


def test_toxicity_grammar_reads_clauses():
    g = toxicity.Grammar({b"idiot": 2.0}, {b"lowei": 1.0})
    kinds = lambda text: [k for k, _ in g.clause(text.encode().split())]
    assert kinds("you are an idiot") == ["aimed"] and kinds("you are not an idiot") == ["denied"]
    assert kinds("he said an idiot") == ["quoted"] and kinds("loweischaft da") == ["bare"] and kinds("fine words") == []


def test_toxicity_reads_threats_in_four_languages():
    g = toxicity.Grammar()
    kinds = lambda text: [k for k, _ in g.clause(text.encode().split())]
    threats = lambda text: g.features(text)[toxicity.FEATURES.index("threat")]
    for text in ("I will kill them", "i'll hurt you", "Ich werde dich töten", "Je vais te tuer", "je te tuerai", "Te voy a matar", "voy a matarte", "je vais t'écraser", "kill you"):
        assert kinds(text.lower()) == ["aimed"] and threats(text) == 1, text
    assert kinds("he said he would never hurt you") == ["quoted"] and kinds("i would never hurt you") == ["denied"] and kinds("je ne vais pas te tuer") == ["denied"]
    for text in ("He said he would never hurt you.", "I won't kill you", "They will kill time", "you beat the eggs", "sie werden das Spiel zerstören"):
        assert threats(text) == 0, text


def test_toxicity_learns_pairs_of_ordinary_words(spark):
    rng = random.Random(4)
    said = ["grab your coat", "coat your walls", "your grab bag"]
    rows = [(i, f"{words(20, i)} {'meet darkness' if i % 4 == 0 else 'darkness meet'} {rng.choice(said)}") for i in range(400)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(texts, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    assert (b"meet", b"darkness") in model.grammar.pairs
    assert model.score("will you meet darkness") > 0.5 > model.score("darkness meet")


def test_toxicity_learns_and_scores_all_rows(spark, docs, odd, none):
    rows = [(i, words(30, i) + (f" blorgface{i % 3}." if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    texts = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(77777, 1), (900, None)], "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.op3_toxicity(texts, labels).collect()}
    held = [i for i, _, _ in rows if found[i]["held_out"]]
    assert len(found) == 402 and sum(found[i]["predicted"] == rows[i][2] for i in held) / len(held) > 0.95
    assert found[900]["score"] == found[901]["score"] < 0.5
    assert toxicity.score(odd, toxicity.Model(toxicity.Grammar(), -1.0, [0.0] * len(toxicity.FEATURES))).count() == odd.count()


@pytest.mark.parametrize("width", [1, 7, 13, 16, 17, 32])
def test_packing_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1003).astype(np.uint32)
    data = token_files.pack(ids, width)
    assert len(data) == -(-1003 // 8) * width
    for first, count in ((0, 1003), (5, 1), (8, 16), (997, 6), (3, 0)):
        assert (token_files.unpack(data, width, first, count) == ids[first : first + count]).all()


def test_tokens_equal_the_tokenizer(docs, odd, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, at = Tokenizer.from_file(path), 0
    got = {r["doc_id"]: r for r in token_files.op4_tokens(docs, path).collect()}
    for doc, text in sorted((r[0], r[1] or "") for r in ROWS):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert (got[doc]["start"], got[doc]["n_tokens"], got[doc]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_files.op4_tokens(odd, path).count() == odd.count() and token_files.op4_tokens(none, path).count() == 0


def test_tokens_of_one_document_by_block_offsets(spark, docs, tmp_path, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(token_files, "BLOCK", 64)
    out = str(tmp_path / "tokens")
    table = spark.createDataFrame([(7, LONG), (7, "One two"), (8, None), (9, words(90, 3))], "doc_id long, text string").coalesce(1)
    token_files.write_tokens(table, path, out)
    tokenizer = token_files.Pieces(path).tokenizer
    for doc, texts in ((7, [LONG, "One two"]), (8, [""]), (9, [words(90, 3)]), (10, [])):
        got = [ids.tolist() for ids in token_files.read_document(spark, out, doc)]
        assert sorted(got) == sorted([*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts)


def test_pieces_that_are_forgotten_are_encoded_again():
    path = public_tokenizers.path("word_bpe_49k.json")
    few, many = token_files.Pieces(path, limit=50), token_files.Pieces(path)
    for seed in range(6):
        texts = [words(60, seed), words(80, seed + 10), LONG]
        assert [a.tolist() for a in few.encode(texts)] == [a.tolist() for a in many.encode(texts)]


def test_long_alignment_equals_a_full_table():
    rng = random.Random(5)
    for _ in range(60):
        item = [rng.choice("abcd") for _ in range(rng.randrange(1, 40))]
        passage = [rng.choice("abcde") for _ in range(rng.randrange(1, 60))]
        table = np.zeros((len(item) + 1, len(passage) + 1), int)
        for i, a in enumerate(item, 1):
            for j, b in enumerate(passage, 1):
                table[i, j] = max(0, table[i - 1, j - 1] + (2 if a == b else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
        score, matches, i0, i1, j0, j1 = decontamination.align(item, passage)
        assert score * 2 * len(item) == pytest.approx(table.max()) and table.max() == table[i1, j1]
        same = decontamination.align(item[i0:i1], passage[j0:j1]) if i1 > i0 else None
        assert same is None or (same[0] * (i1 - i0) == pytest.approx(score * len(item)) and matches <= i1 - i0)
        assert decontamination.align(item, passage, score + 0.01) is None


def test_hashes_tell_plain_words_apart(monkeypatch):
    texts = [None, "", " \n", "...", "One, (two) o.k. ...\tThree", "three -- ONE", LONG, "é\x85É x\u00a0y", "a" * 700 + " b", "one", words(300, 9)]
    for size in (1 << 18, 64):
        monkeypatch.setattr(decontamination, "HASHED", size)
        known: dict = {}
        for text, hashes in zip(texts, decontamination.PlainHash().of(texts)):
            plain = decontamination.plain_words(text)
            assert len(plain) == len(hashes)
            assert all(known.setdefault(w, h) == h for w, h in zip(plain, hashes.tolist()))
        assert len(set(known.values())) == len(known)


def test_null_items_and_repeated_rows_decontaminate(spark):
    item = words(30, 50)
    docs = spark.createDataFrame([(None, "x y " + item), (None, item), (4, item + " z"), (5, "clean text"), (6, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item), (None, None), (2, "")], "item_id long, text string")
    got = decontamination.op9_decontaminate(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["score"]) for r in got} == {(None, None, 1.0), (4, None, 1.0)} and len(got) == 2
    assert decontamination.contaminated(docs, bench).count() == 3


def brute_repeats(texts: list[bytes]) -> list[tuple[int, int, str]]:
    seen, out = set(), []
    for b in texts:
        hit = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            w = b[k : k + 100]
            if w in seen:
                hit[k : k + 100] = True
            seen.add(w)
        kept = bytes(np.frombuffer(b, np.uint8)[~hit])
        out.append((int(hit.sum()), int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeats_equal_brute_force(docs, odd, none, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.op6_repeats(docs).collect()}
    order = sorted((r[0], (r[1] or "").encode()) for r in ROWS)
    for (doc, _), want in zip(order, brute_repeats([b for _, b in order])):
        assert got[doc] == want, doc
    assert repeats.op6_repeats(odd).count() == odd.count() and repeats.op6_repeats(none).count() == 0


def test_maximal_repeats_have_diverse_left_sides():
    text = np.frombuffer(b"xabcdeq\xffyabcder\xffzabcde\xff", np.uint8)
    room = np.concatenate([np.arange(n, -1, -1) for n in (7, 7, 6)])
    first = np.isin(np.arange(len(text)), (0, 8, 16))
    found = [(size, sorted(at.tolist())) for size, at in repeats.maximal_repeats(text, room, first, 3)]
    assert found == [(5, [1, 9, 17])]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_jaccard_components_equal_brute_force(docs, odd, none, n, percent):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())

    sets = {r[0]: shingles(r[1]) for r in ROWS}
    name = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= percent * len(sets[a] | sets[b]) and name[a] != name[b]:
                low, high = sorted((name[a], name[b]))
                name = {i: low if c == high else c for i, c in name.items()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(docs, n, percent).collect()}
    assert got == {i: (len(sets[i]), name[i]) for i in sets}
    assert jaccard_join.join(odd, n, percent).count() == odd.count() and jaccard_join.join(none, n, percent).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (99, 98), (100, 98), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 98: 98, 99: 98, 100: 98}


def test_alignment_survives_edits():
    item = words(40, 5).split()
    edited = item[:10] + ["new"] + item[10:20] + item[22:30] + ["swap"] + item[31:]
    score, matches, i0, i1, j0, j1 = decontamination.align(item, words(30, 6).split() + edited + words(30, 7).split())
    assert score > 0.75 and matches >= 36 and (i0, i1) == (0, 40) and j0 == 30


def test_leaks_are_found(spark, docs, none):
    bench = spark.createDataFrame([(1, " ".join(LONG.split()[100:140])), (2, words(40, 999)), (3, None), (4, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.op9_decontaminate(docs, bench).collect()}
    assert got == {(33, 1), (34, 1), (35, 1)}
    assert decontamination.op9_decontaminate(none, bench).count() == 0
    assert decontamination.op9_decontaminate(docs, bench.where("item_id > 2")).count() == 0


def test_edited_leaks_are_those_of_smith_waterman(spark):
    rng = random.Random(3)
    items = {i: words(n, 500 + i).split() for i, n in enumerate((42, 42, 15, 24, 59, 2, 1))}
    items[7] = items[0][:20] + words(20, 600).split()

    def every(k, item, put):
        return [w for n, word in enumerate(item) for w in put(n % k == k - 1, word)]

    swap = lambda hit, word: ["zz%d" % rng.randrange(10**6)] if hit else [word]
    more = lambda hit, word: [word, "yy%d" % rng.randrange(10**6)] if hit else [word]
    less = lambda hit, word: [] if hit else [word]
    made = [items[1]]
    for item in items.values():
        made += [every(k, item, put) for k in (1, 2, 3, 4, 6) for put in (swap, more, less) if k > 1 or put is more]
        made += [item[: len(item) // 2], item[len(item) // 3 :]]
    texts = [words(60, 700 + n).split() + m + words(60, 900 + n).split() for n, m in enumerate(made)]
    table = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id long, text string")
    want = {}
    for n, text in enumerate(texts):
        for i, item in items.items():
            score = decontamination.align(decontamination.plain_words(" ".join(item)), decontamination.plain_words(" ".join(text)))[0]
            if score >= (decontamination.LEAST if len(item) >= decontamination.N else 1):
                want[n, i] = score
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination.op9_decontaminate(table, bench).collect()}
    assert len(want) > 60 and got == want


def test_scores_are_probabilities_and_counts_are_exact(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = scoring.op1_score(docs, path).collect()
    learn = [r for r in ROWS if zlib.crc32(str(r[0]).encode()) % 10]
    counts = Counter(w for r in learn for w in (r[1] or "").encode().lower().split())
    total, kinds = sum(counts.values()) + len(learn), len(counts) + 1
    for r in rows:
        said = (dict((x[0], x[1]) for x in ROWS)[r["doc_id"]] or "").encode().lower().split()
        base = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in said) + np.log10((len(learn) + 0.1) / (total + 0.1 * (kinds + 1)))
        assert r["train_tokens"] == total and r["n_tokens"] == len(said) + 1 and r["base_score"] == pytest.approx(base)
        assert r["score"] < 0
    assert scoring.op1_score(none, path).count() == 0


def test_model_distribution_and_gradient():
    rng = np.random.default_rng(0)
    model = scoring.Model.start(rng.integers(0, 3, (scoring.IDS, scoring.IDS)))
    assert np.allclose(model.bigram.sum(1), 1, atol=1e-3)
    assert np.allclose(np.bincount(model.of_class, model.within, scoring.CLASSES)[np.unique(model.of_class)], 1, atol=1e-3)
    ids = rng.integers(0, scoring.IDS, (3, scoring.KEYS + 1))
    real, some = np.ones((3, scoring.KEYS), bool), np.ones((3, scoring.STRIDE), bool)
    model.weights = {n: w.astype(np.float64) for n, w in model.weights.items()}
    grads = model.gradient(model.forward(ids, real), some)
    loss = lambda: -np.log(model.forward(ids, real)["p"]).mean()
    for name, at in (("u", (3, 2)), ("c", (5,)), ("g", (1,)), ("near", (2,)), ("v", (ids[0, 3], 1)), ("k", (ids[1, 4], 2)), ("q", (ids[0, 20], 3)), ("r", (ids[0, 20], 0))):
        keep = model.weights[name][at]
        model.weights[name][at] = keep + 1e-4
        up = loss()
        model.weights[name][at] = keep - 1e-4
        slope, model.weights[name][at] = (up - loss()) / 2e-4, keep
        assert grads[name][at] == pytest.approx(slope, rel=0.05, abs=2e-6), name


def test_training_takes_every_subword_once():
    texts = [np.concatenate([[scoring.END], np.arange(n) % scoring.SUBWORDS, [scoring.END]]) for n in (0, 1, 31, 32, 5000, 70_000)]
    want, got = Counter(), Counter()
    for ids in texts:
        want.update(ids[1:].tolist())
    for ids, _, some in scoring.training_windows(texts, 1):
        got.update(ids[:, scoring.CONTEXT + 1 :][some].tolist())
    assert got == want


def test_scoring_is_causal():
    model = scoring.Model.start(np.random.default_rng(1).integers(0, 3, (scoring.IDS, scoring.IDS)))
    ids = np.random.default_rng(2).integers(0, scoring.SUBWORDS, 200)
    other = ids.copy()
    other[120:] = 7
    a, b = model.score([ids, other])
    assert len(a) == 199 and np.allclose(a[:119], b[:119])


def test_topics_are_found_on_all_training_texts(spark, monkeypatch):
    """Three rare texts of words of their own get a topic, and repeated runs agree."""
    monkeypatch.setattr(scoring, "TOPIC_ROWS", 10, raising=False)
    kinds = [f"{a}{i}" for a in "xyz" for i in range(30)]
    rows = [(n, " ".join(kinds[(30 * (n % 3) + i * (n % 7 + 1)) % 90] for i in range(12))) for n in range(600)]
    rare = "entirely other words than those above, in three texts of six hundred"
    rows += [(1000 + n, rare) for n in range(40) if zlib.crc32(str(1000 + n).encode()) % 10][:3]
    blocks = scoring.blocked(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    centres = scoring.topics(blocks)
    own = scoring.profile(scoring.WordHash().of(scoring.low_words(rare)))
    assert min(np.abs(centres - own).max(1)) < 1e-6
    assert (scoring.topics(blocks) == centres).all()


def test_letters_with_marks_go_to_the_model_as_two_words(monkeypatch):
    pieces = token_files.Pieces(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(pieces, "learn_joined", lambda some: pytest.fail(f"{some} went through the whole tokenizer"))
    plain = "word word. word*** naïve, É?! ÉÇOLE: straße_"
    assert pieces.encode([plain])[0].tolist() == pieces.tokenizer.encode(plain, add_special_tokens=False).ids
    monkeypatch.undo()
    odd = "don' don't don't. 's abc'.s x— a1. ... a...b. \u03a3. a\u0338< \ufb01. a<|endoftext|> <|endoftext|>. a<| \u0130. \u01c5. ×. ÷a ÿ_"
    assert pieces.encode([odd])[0].tolist() == pieces.tokenizer.encode(odd, add_special_tokens=False).ids


@pytest.mark.parametrize("joined", [1, 7, 100])
def test_pieces_learned_together_are_those_encoded_alone(monkeypatch, joined):
    monkeypatch.setattr(token_files, "JOINED", joined)
    pieces = token_files.Pieces(public_tokenizers.path("word_bpe_49k.json"))
    some = {w.encode() for n in range(40) for w in words(12, n).split()} | {f"a{n}é{n}'s".encode() for n in range(250)} | {token_files.MARK + b"x"}
    pieces.learn(some)
    alone = {p: pieces.tokenizer.encode(p.decode(), add_special_tokens=False).ids for p in some}
    assert {p: np.frombuffer(pieces[p], "<u4").tolist() for p in some} == alone


@pytest.mark.parametrize("width", [7, 8, 16, 17, 24])
def test_packed_bits_are_the_ids_in_a_row(width):
    for n in (0, 1, 8, 1003):
        ids = np.random.default_rng(n).integers(0, 1 << width, n).astype(np.uint32)
        bits = "".join(f"{i:0{width}b}" for i in ids.tolist()) + "0" * (-n % 8 * width)
        data = token_files.pack(ids, width)
        assert data == bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))
        for first in range(0, n, 97):
            got = token_files.unpack(data, width, first, n - first)
            assert got.dtype == np.uint32 and (got == ids[first:]).all()
