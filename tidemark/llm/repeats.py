"""Substring deduplication with a common-prefix interval tree over enhanced suffix arrays.

Every byte that lies in a string of ``LENGTH`` bytes which also starts earlier is removed. All such strings are found:

1. Anchors. A string of ``LENGTH`` bytes holds a minimizer: the least-hashed of its ``K``-byte grams. Equal strings have
   it at the same place, so they meet among the occurrences of one gram, each with the bytes around it that such a
   string could cover (its context).
2. Copies. Of equal contexts, all but the earliest are covered whole. This settles exact and near copies of any
   number by a sort, without comparing them. Repeats within a document are settled where they are found; a heavy
   gram is sorted in parts by document, and only the first of each part is compared with the other parts.
3. Suffix arrays. The distinct contexts of a gram are put in a suffix array with common-prefix lengths. A stack
   scan lists the tree of its intervals; an interval whose occurrences have different bytes on their left is a maximal
   repeat, and is put out with all its occurrences. All but the earliest are covered.
4. A gram with more than ``HOT`` distinct contexts would be one large group. Its strings are compared by an
   aggregation on the string itself (``hot_spans``), which combines before it shuffles.

Order is by id, then position. Defined results: null and short texts are kept whole; null and repeated ids are
allowed, ordered by (id, text), null first; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import written

LENGTH, K = 100, 24
SIDE = LENGTH - K
#: Distinct contexts of a gram that a task takes into one suffix array.
HOT = 20_000
#: Bytes of contexts in one suffix array, unless one gram has more.
BATCH = 1 << 19
#: A gram with more than one in ``SHARE`` anchors of one in ``SAMPLE`` documents is ranked in ``PARTS`` parts.
SHARE, SAMPLE, PARTS = 1_000, 64, 256
#: Strings whose minimizers are searched at a time.
PIECE = 1 << 16
#: Ends a context in the joined text: a byte that UTF-8 does not have, so a common prefix ends there at the latest.
STOP = b"\xff"
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    return x ^ (x >> np.uint64(29))


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position, as one number."""
    return np.ndarray((len(data) - 7,), ">u8", data, 0, (1,)).astype(np.uint64)


def _powers(base: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(PIECE + 3 * LENGTH, np.uint64(base))]))


_UP, _DOWN = _powers(int(_ODD[0])), _powers(pow(int(_ODD[0]), -1, 1 << 64))


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value of every window of ``width``, by windows of doubled widths."""
    best, at, size = values, np.arange(len(values), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)  # the last step overlaps
        right = best[step:] < best[:-step]
        at = np.where(right, at[step:], at[:-step])
        best = np.minimum(best[step:], best[:-step])
        size += step
    return at


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the gram, hash of the context, and position, for all minimizers of a text of LENGTH bytes or more.

    The text is read in pieces that overlap by a context, so memory does not grow with it.
    """
    found = []
    last = len(data) - LENGTH + 1  # strings of LENGTH bytes, each with one minimizer
    for begin in range(0, last, PIECE):
        stop = min(begin + PIECE, last)
        base, top = max(begin - SIDE, 0), min(stop + 2 * LENGTH - 1, len(data))
        piece = data[base:top]
        eight = words_at(piece[begin - base : stop - base + LENGTH - 1])
        n = stop - begin + SIDE
        gram = mix(eight[:n] * _ODD[0] + eight[8 : 8 + n] * _ODD[1] + eight[16 : 16 + n] * _ODD[2])
        least = least_places(gram, SIDE + 1)
        gram_at = least[np.concatenate([[True], least[1:] != least[:-1]])]
        at = gram_at + (begin - base)
        start, end = np.maximum(at - SIDE, 0), np.minimum(at + LENGTH, len(piece))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((piece + np.uint64(1)) * _UP[: len(piece)], dtype=np.uint64)])
        # Shifted down to power 0: equal strings have equal sums wherever they stand, in texts of any length.
        context = mix((sums[end] - sums[start]) * _DOWN[start]) ^ mix((at - start).astype(np.uint64) * _ODD[1])
        found.append((gram[gram_at], context, at + base))
    gram, context, at = (np.concatenate(part) for part in zip(*found))
    new = np.concatenate([[True], at[1:] != at[:-1]])  # the minimizer at a seam is found from both sides
    return gram[new], context[new], at[new]


def anchor_rows(docs: DataFrame) -> DataFrame:
    """All anchors; ``again``: the document has the same context earlier."""

    def build(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows:
            out = []
            for doc, text in zip(frame["doc"], frame["text"]):
                data = np.frombuffer((text or "").encode(), np.uint8)
                if len(data) >= LENGTH:
                    found = anchors(data)
                    out.append((*found, np.full(len(found[2]), doc, np.int64)))
            if out:
                gram, context, at, doc = (np.concatenate(part) for part in zip(*out))
                every = pd.DataFrame({"gram": gram.view(np.int64), "context": context.view(np.int64), "doc": doc, "at": at.astype(np.int32)})
                every["again"] = every.duplicated(["doc", "gram", "context"])
                yield every

    return docs.select("doc", "text").mapInPandas(build, "gram long, context long, doc long, at int, again boolean")


#: Sizes of the prefixes by which suffixes are ranked, each three times the one before. Three of the last are more
#: than a context has.
SIZES = (8, 24, 72)


def _ranked(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1].astype(np.int32)


def _three(ranks: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """A number that orders by the ranks at ``at``, ``at + step`` and ``at + 2 * step``; past the end is least."""
    padded = np.concatenate([ranks + np.int32(1), np.zeros(2 * step, np.int32)])
    first, second, third = (padded[at + i * step].astype(np.int64) for i in range(3))
    if len(ranks) < (1 << 21) - 1:
        return first << 42 | second << 21 | third
    return _ranked(first << 32 | second).astype(np.int64) << 32 | third


def suffix_array(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """The suffixes at ``at`` in the order of their first 216 bytes, more than a context has, and the ranks of all
    suffixes by their first 8, 24 and 72."""
    every = np.arange(len(text), dtype=np.int32)
    ranks = {8: _ranked(words_at(np.concatenate([text, np.zeros(7, np.uint8)])))}
    for size, longer in zip(SIZES, SIZES[1:]):
        ranks[longer] = _ranked(_three(ranks[size], every, size))
    return at[np.argsort(_three(ranks[SIZES[-1]], at, SIZES[-1]), kind="stable")], ranks


def common_prefixes(order: np.ndarray, ranks: dict[int, np.ndarray], room: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the order, within both contexts; 0 below ``length``."""
    shared = np.zeros(len(order) - 1, np.int32)
    near = np.arange(len(shared))
    for size in SIZES:  # less than ``length`` is of no use: keep to neighbours that agree in all sizes up to it
        if size <= length:
            near = near[ranks[size][order[near]] == ranks[size][order[near + 1]]]
    a, b = order[near], order[near + 1]
    found = np.zeros(len(near), np.int32)
    for size in (*reversed(SIZES), 1):
        of = np.concatenate([ranks[size] if size > 1 else text.astype(np.int32), np.full(3 * SIZES[-1], -1, np.int32)])
        going = np.ones(len(a), bool)
        for _ in range(7 if size == 1 else 2):
            going &= of[a] == of[b]
            step = np.int32(size) * going
            a, b, found = a + step, b + step, found + step
    shared[near] = np.minimum(found, np.minimum(room[order[near]], room[order[near + 1]]))
    return np.where(shared >= length, shared, 0)


def maximal_repeats(text: np.ndarray, room: np.ndarray, first: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, np.ndarray]]:
    """(length, positions) of every maximal repeat of at least ``length`` bytes in contexts that each end with ``STOP``.

    ``room``: bytes from each position to the end of its context; ``first``: whether it is the first of its context.
    """
    # Shorter suffixes hold no such string: they are ranked, as parts of longer ones, but not ordered.
    at = np.flatnonzero(room >= length).astype(np.int32)
    if len(at) < 2:
        return
    order, ranks = suffix_array(text, at)
    shared = common_prefixes(order, ranks, room, text, length)
    left = np.where(first, -np.arange(len(text)) - 1, np.concatenate([[0], text[:-1].astype(np.int64)]))[order]
    # Whether the left bytes of neighbours differ, summed up: an interval is diverse if any do.
    turns = np.concatenate([[0], np.cumsum(left[1:] != left[:-1])])
    # A run of linked neighbours with one left byte throughout holds no diverse interval.
    edges = np.diff(np.concatenate([[0], (shared > 0).astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    alike = turns[begins] == turns[ends]
    inside = np.cumsum(np.bincount(begins[alike], minlength=len(order)) - np.bincount(ends[alike], minlength=len(order)))
    values = np.where(inside[:-1] > 0, 0, shared).tolist() + [0]
    stack: list[tuple[int, int]] = []  # (common prefix, left end) of the open intervals
    for i in np.flatnonzero(np.array(values) | np.concatenate([[0], values[:-1]])):
        value, begin = values[i], int(i)
        while stack and stack[-1][0] > value:
            size, begin = stack.pop()
            if turns[i] != turns[begin]:
                yield size, order[begin : i + 1]
        if value and (not stack or stack[-1][0] < value):
            stack.append((value, begin))


def covered(frame: pd.DataFrame) -> pd.DataFrame:
    """Spans (doc, start, end) that the maximal repeats of some contexts cover."""
    pieces = [np.frombuffer(bytes(b) + STOP, np.uint8) for b in frame["bytes"]]
    sizes = np.array([len(p) for p in pieces])
    text = np.concatenate(pieces)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    begin = np.cumsum(sizes) - sizes
    inside = np.arange(len(text)) - begin[owner]
    docs, starts = frame["doc"].to_numpy(), frame["start"].to_numpy()
    _, doc_rank = np.unique(docs, return_inverse=True)
    place = doc_rank[owner].astype(np.int64) << 40 | (starts[owner] + inside)
    out_at, out_size = [], []
    for size, positions in maximal_repeats(text, sizes[owner] - inside - 1, inside == 0):
        places = place[positions]
        later = positions[places > places.min()]
        out_at.append(later)
        out_size.append(np.full(len(later), size))
    if not out_at:
        return pd.DataFrame({"doc": [], "start": [], "end": []}, dtype="int64")
    at, size = np.concatenate(out_at), np.concatenate(out_size)
    start = starts[owner[at]] + inside[at]
    return merged(docs[owner[at]], start, start + size)


def merged(docs: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """Overlapping and touching spans of a document in one."""
    order = np.lexsort((start, docs))
    docs, start, end = docs[order], start[order], end[order]
    shift = np.concatenate([[0], np.cumsum(docs[1:] != docs[:-1])]).astype(np.int64) << 40
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate([[True], (start + shift)[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(docs) - 1]])
    return pd.DataFrame({"doc": docs[new], "start": start[new], "end": (reach - shift)[last]})


SPANS = "doc long, start long, end long"


def context_rows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted anchors' contexts."""

    def build(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["gram", "many", "doc", "start", "bytes"]
        for frame in rows:
            out = []
            for doc, text, grams, many, places in zip(*(frame[c] for c in ("doc", "text", "grams", "many", "places"))):
                data = text.encode()
                for gram, hot, at in zip(grams, many, places):
                    start = max(0, int(at) - SIDE)
                    out.append((gram, hot, doc, start, data[start : int(at) + LENGTH]))
                    if len(out) * (LENGTH + SIDE) >= BATCH:
                        yield pd.DataFrame(out, columns=names)
                        out = []
            yield pd.DataFrame(out, columns=names)

    by_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("gram", "many", "at")).alias("picks"))
    # Arrays of numbers stay compact in pandas; an array of structs would be an object for each.
    picked = docs.join(by_doc, "doc").select("doc", "text", F.col("picks.gram").alias("grams"), F.col("picks.many").alias("many"), F.col("picks.at").alias("places"))
    return picked.mapInPandas(build, "gram long, many boolean, doc long, start long, bytes binary")


def covered_batches(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans over contexts that come sorted by gram: whole grams in each suffix array."""
    held: list[pd.DataFrame] = []
    size = 0
    for frame in rows:
        if not len(frame):
            continue
        # Cut where a gram ends and the bytes pass another batch; a gram can go on in the next frame.
        grams = frame["gram"].to_numpy()
        reach = size + np.cumsum(frame["bytes"].str.len().to_numpy())
        ends = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        if held and held[-1]["gram"].iloc[-1] == grams[0]:
            ends = ends[1:]
        begin, done = 0, 0
        for end in ends.tolist():
            before = int(reach[end - 1]) if end else size
            if before - done >= BATCH:
                part = pd.concat([*held, frame.iloc[begin:end]])
                held, begin, done = [], end, before
                yield covered(part)
        held.append(frame.iloc[begin:])
        size = int(reach[-1]) - done
    if held and len(every := pd.concat(held)):
        yield covered(every)


def tree_spans(contexts: DataFrame) -> DataFrame:
    """Spans from suffix arrays over whole groups of contexts, many small groups to an array."""

    sorted_rows = contexts.select("gram", "doc", "start", "bytes").repartition("gram").sortWithinPartitions("gram")
    return sorted_rows.mapInPandas(covered_batches, SPANS)


def hot_spans(contexts: DataFrame) -> DataFrame:
    """The same for contexts of hot grams: each string's earliest place by aggregation."""
    strings = contexts.select("doc", "start", "bytes", F.explode(F.sequence(F.lit(0), F.length("bytes") - LENGTH)).alias("i"))
    strings = strings.select("doc", (F.col("start") + F.col("i")).alias("start"), F.md5(F.substring("bytes", F.col("i") + 1, F.lit(LENGTH))).alias("string"))
    least = strings.groupBy("string").agg(F.min(F.struct("doc", "start")).alias("least"), F.count("*").alias("n")).where("n > 1")
    later = strings.join(least, "string").where(F.struct("doc", "start") > F.col("least"))
    return later.select("doc", "start", (F.col("start") + LENGTH).cast("long").alias("end"))


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``doc``: a long that is unique and ordered like the ids: the id itself where it can be."""
    ids = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if ids.isEmpty():
        return docs.select("doc_id", "text", F.col("doc_id").alias("doc"))
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", "text").sortWithinPartitions("doc_id", "text")
    return written(ordered.withColumn("doc", F.monotonically_increasing_id()), "numbered")


def heavy_grams(docs: DataFrame) -> list[int]:
    """Grams that hold more than one in ``SHARE`` anchors of a hash sample of documents, so fewer than ``SHARE``.

    They only choose which groups are split; a heavy gram that the sample lacks costs time, not results.
    """
    sample = anchor_rows(docs.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE)) == 0)).where("not again")
    counts = written(sample.groupBy("gram").count(), "grams")
    most = (counts.agg(F.sum("count")).first()[0] or 0) / SHARE
    return [r[0] for r in counts.where(F.col("count") > F.lit(max(most, 1.0))).select("gram").collect()]


def spans(docs: DataFrame) -> DataFrame:
    """(doc, start, end) of covered bytes, not merged, over numbered documents."""
    heavy = heavy_grams(docs)
    doc_part = 1 + F.pmod(F.xxhash64("doc"), F.lit(PARTS)).cast("int")
    salt = F.when(F.col("again"), -1 - F.pmod(F.hash("doc", "at"), F.lit(1 << 30)))
    salt = F.coalesce(salt, F.when(F.col("gram").isin(heavy), doc_part), F.lit(0))
    rows = anchor_rows(docs).select("gram", "context", "doc", "at", salt.alias("salt")).repartition("gram", "salt")
    group = W.partitionBy("gram", "salt")
    ranked = rows.withColumn("nth", F.row_number().over(W.partitionBy("gram", "salt", "context").orderBy("doc", "at")))
    ranked = ranked.withColumn("kinds", F.sum((F.col("nth") == 1).cast("int")).over(group))
    met = written(ranked.where("nth > 1 or kinds > 1 or salt <> 0"), "anchors")
    # Of heavy grams only the first of each part has come through the ranking: these are compared between parts.
    parts = met.where("nth = 1 and salt > 0").select("gram", "context", "doc", "at")
    firsts = parts.groupBy("gram", "context").agg(F.min(F.struct("doc", "at")).alias("first"))
    kinds = firsts.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    later = parts.join(firsts, ["gram", "context"]).where(F.struct("doc", "at") > F.col("first")).select("doc", "at")
    copies = met.where("nth > 1 or salt < 0").select("doc", "at").unionByName(later)
    copies = copies.select("doc", F.greatest(F.col("at") - SIDE, F.lit(0)).cast("long").alias("start"), (F.col("at") + LENGTH).cast("long").alias("end"))
    wanted = met.where("nth = 1 and kinds > 1 and salt = 0").select("gram", "kinds", "doc", "at")
    wanted = wanted.unionByName(firsts.join(kinds, "gram").select("gram", "kinds", "first.doc", "first.at"))
    wanted = wanted.select("gram", (F.col("kinds") > HOT).alias("many"), "doc", "at")
    contexts = written(context_rows(docs, wanted), "contexts")
    return copies.unionByName(tree_spans(contexts.where("not many"))).unionByName(hot_spans(contexts.where("many")))


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every document with its remaining bytes."""
    docs = numbered(docs)
    by_doc = spans(docs).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def cut(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows:
            out = []
            for doc, text, starts, ends in zip(*(frame[c] for c in ("doc_id", "text", "starts", "ends"))):
                data = (text or "").encode()
                removed = number = 0
                kept, at = [], 0
                if starts is not None and len(starts):
                    whole = merged(np.zeros(len(starts), np.int64), np.asarray(starts), np.minimum(ends, len(data)))
                    for s, e in zip(whole["start"], whole["end"]):
                        kept.append(data[at:s])
                        at, removed, number = e, removed + int(e - s), number + 1
                kept.append(data[at:])
                out.append((doc, len(data), removed, number, b"".join(kept)))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]).astype({"doc_id": "Int64"})

    return docs.join(by_doc, "doc", "left").select("doc_id", "text", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends")).mapInPandas(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def op6_repeats(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
