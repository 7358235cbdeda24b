"""Benchmark decontamination: rare word seeds find places of test items in documents, Smith-Waterman scores them.

A pair counts when its local alignment scores ``LEAST`` of a perfect copy's ``MATCH`` x words. Nothing that does may be
missed, however it was edited, so the seeds are single words (1-grams: longer ones break with every third word
replaced) and each step before the alignment is a bound that such an alignment cannot fail:

1. It matches at least M = ``LEAST`` x words of the item's words, within a span of ``(3 - 2 x LEAST)`` x words in the
   document, as every word that is left out or replaced costs 1. So of any (words - M + H) words of the item it has H.
   An item's seeds are that many of its words, those in the fewest documents, with H = ``HITS`` (M, if less).
   Words in no document need no exception: they are among those that an alignment may lack.
2. Places where H seeds stand within a span make a passage. Its words count +2 if the item has them and -1 if not; the
   largest sum of a stretch bounds the score from above, and most passages end here.
3. The others are aligned word by word. The score is that of the local alignment over that of a perfect copy.

Items are held in slabs of about ``SLAB_WORDS`` words, each broadcast to a pass over the documents, so no task holds a
large benchmark; long passages are cut into pieces that overlap by a span. A single item's alignment table is its words
by ``PIECE`` and its span, of which some rows are kept and the others made again on the way back.

Words are compared in lower case without punctuation at their ends. Defined results: null and empty texts and items, and
texts without words, match nothing; an item shorter than ``N`` words counts only as a whole copy; repeated items and repeated rows match
each for itself in ``contaminated``, while the query has one row per pair of ids, null ids being one; empty tables give
no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.llm.token_files import chunks

#: Items of fewer words count only as a whole copy.
N = 3
SLOTS = 1 << 24
#: Seeds that a passage must have, and words of items held at once.
HITS, SLAB_WORDS = 4, 1 << 20
#: Passage words aligned at once, besides the overlap.
PIECE = 4096
#: Words of passages whose bounds are computed at once.
HELD = 1 << 20
#: Local alignment: a match, a mismatch, a word left out on either side.
MATCH, MISMATCH, SKIP = 2, -1, -1
#: A pair counts from this share of a perfect copy's score on.
LEAST = 0.5
#: Bytes of text hashed at once.
HASHED = 1 << 18
ODD, MIXED = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
SPACE = re.compile(rb"[ \t-\r]")
EDGES = b".,;:!?\"'()[]{}<>*_-/\\|&%#$@+=~`^"


def plain_words(text: str | None) -> list[bytes]:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return [s for w in words if (s := w.strip(EDGES))]


def classes(edges: bytes) -> np.ndarray:
    """By byte: 0 for white space, 1 for an edge, 2 for all others."""
    out = np.full(256, 2, np.uint8)
    out[list(edges)] = 1
    out[list(b" \t\n\v\f\r")] = 0
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd number modulo 2^64, and of its inverse."""
    with np.errstate(over="ignore"):
        return tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, x % (1 << 64), np.uint64)])) for x in (ODD, pow(ODD, -1, 1 << 64)))


class PlainHash:
    """Hashes of the ``plain_words`` of texts, without cutting them out: sums of bytes times powers, by word.

    Only bounds and seeds rest on them, and a chance collision only loosens these. ``edges`` is what words are stripped of;
    words of more than ``short`` bytes are cut out and hashed by xxHash, as such sums meet for some long words of few letters.
    """

    def __init__(self, edges: bytes = EDGES, short: int | None = None):
        self.kinds, self.short = classes(edges), short
        self.up, self.down = powers(HASHED)

    def plain(self, text: str | None) -> np.ndarray:
        return self.of([text])[0]

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        """By text. Texts are joined to about ``HASHED`` bytes, and a longer one is cut at its white space."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[int, bytes]] = []
        size = 0
        for n, text in enumerate(texts):
            data = (text or "").encode("utf-8", "surrogatepass").lower()
            for piece in pieces_of(data, HASHED) if len(data) > HASHED else [data]:
                if size + len(piece) + 1 > HASHED and held:
                    self.flush(held, out)
                    held, size = [], 0
                held.append((n, piece))
                size += len(piece) + 1
        self.flush(held, out)
        return [found[0] if len(found) == 1 else np.concatenate([np.empty(0, np.uint64), *found]) for found in out]

    def flush(self, held: list[tuple[int, bytes]], out: list[list[np.ndarray]]) -> None:
        data = np.frombuffer(b" ".join([piece for _, piece in held]), np.uint8)
        if len(data) >= len(self.up):
            self.up, self.down = powers(len(data))
        kind = self.kinds[data]
        inner = np.flatnonzero(kind == 2)
        # A word ends where white space lies between two inner bytes.
        spaces = np.cumsum(kind == 0, dtype=np.int32)[inner]
        new = np.flatnonzero(spaces[1:] != spaces[:-1]) + 1 if len(inner) else np.empty(0, np.int64)
        begin = inner[np.append(0, new)] if len(inner) else inner
        end = inner[np.append(new, len(inner)) - 1] + 1 if len(inner) else inner
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        hashes = (sums[end] - sums[begin]) * self.down[begin]
        hashes = (hashes ^ (hashes >> np.uint64(32))) * MIXED
        hashes ^= hashes >> np.uint64(29)
        hashes *= MIXED
        hashes ^= hashes >> np.uint64(32)
        if self.short:
            for i in np.flatnonzero(end - begin > self.short):
                hashes[i] = xxhash.xxh64_intdigest(data[begin[i] : end[i]].tobytes())
        sizes = np.cumsum([len(piece) + 1 for _, piece in held])
        for (n, _), some in zip(held, np.split(hashes, np.searchsorted(begin, sizes[:-1]))):
            out[n].append(some)


def pieces_of(data: bytes, size: int) -> Iterator[bytes]:
    """A long text in pieces that end at white space; a longer word stays whole."""
    at = 0
    while at < len(data):
        stop = SPACE.search(data, at + size)
        end = stop.start() if stop else len(data)
        yield data[at:end]
        at = end


def benchmark_words(slabs: DataFrame) -> DataFrame:
    """(slab, hash): the distinct words of every slab of items."""

    def build(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = PlainHash()
        for frame in rows:
            for slab, part in frame.groupby("slab"):
                yield pd.DataFrame({"slab": slab, "hash": np.unique(np.concatenate(known.of(list(part["text"])))).view(np.int64)})

    return slabs.select("slab", "text").mapInPandas(build, "slab int, hash long").distinct()


def slot(hashes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    return (hashes >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def bitmap(hashes: DataFrame) -> bytes:
    """The slots that any hash falls into, one bit each."""
    bits = np.zeros(SLOTS, bool)
    bits[hashes.select(F.shiftrightunsigned("hash", 40).alias("s")).distinct().toPandas()["s"].to_numpy()] = True
    return np.packbits(bits).tobytes()


def document_counts(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(hash, docs): how many documents have each word of the benchmark; a few chance hits of the bitmap besides."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(words))

    def build(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, bits = PlainHash(), np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for frame in rows:
            for some in chunks(frame):
                found = [np.empty(0, np.uint64)]
                for hashes in known.of(list(some["text"])):
                    found.append(np.unique(hashes[bits[slot(hashes)]]))
                hashes, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pd.DataFrame({"hash": hashes.view(np.int64), "docs": counts})

    return docs.select("text").mapInPandas(build, "hash long, docs long").groupBy("hash").agg(F.sum("docs").alias("docs"))


class Slab:
    """Items with their seeds: ``hashes`` (sorted, one entry per word and item) and ``owner``, and by item its words and bounds."""

    def __init__(self, items: list[tuple[int | None, str]], docs: dict[int, int], least: float):
        known = PlainHash()
        self.ids, self.words, bags, seeds = [], [], [], []
        self.need, self.span, self.bound, self.least = [], [], [], []
        for item_id, text in items:
            words = plain_words(text)
            if not words:
                continue
            hashes, share = known.plain(text), least if len(words) >= N else 1.0
            matches = max(1, int(np.ceil(share * len(words) - 1e-9)))
            need = min(HITS, matches)
            # By words, not places: with a word all its places are seeds.
            order = sorted(range(len(words)), key=lambda i: (docs.get(int(hashes[i]), 0), int(hashes[i])))
            seeds.append(np.unique(hashes[order[: len(words) - matches + need]]))
            self.ids.append(item_id)
            self.words.append(words)
            bags.append(own(np.unique(hashes), len(bags)))
            self.need.append(need)
            self.span.append(int(np.ceil((3 - 2 * share) * len(words) + 1e-9)))
            self.bound.append(MATCH * share * len(words) - 1e-9)
            self.least.append(share)
        hashes = np.concatenate([np.empty(0, np.uint64), *seeds])
        owner = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner = hashes[order], owner[order]
        self.need, self.span = np.array(self.need, np.int64), np.array(self.span, np.int64)
        self.bags = np.sort(np.concatenate([np.empty(0, np.uint64), *bags]))

    def bits(self) -> np.ndarray:
        """The slots of the seeds, 16 or more to a seed: few enough to stay in a core's cache while a slab allows it."""
        out = np.zeros(1 << max(16, (16 * len(self.hashes)).bit_length()), bool)
        out[slot(self.hashes, len(out))] = True
        return out

    def passages(self, hashes: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, start, end): the stretches of a text where an alignment can be, apart from each other by item."""
        at = np.flatnonzero(bits[slot(hashes, len(bits))])
        low, high = np.searchsorted(self.hashes, hashes[at]), np.searchsorted(self.hashes, hashes[at], "right")
        many = high - low
        place = np.repeat(at, many)
        item = self.owner[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)]
        order = np.argsort(item, kind="stable")
        place, item = place[order], item[order]
        last = np.arange(len(item)) + self.need[item] - 1
        fits = last < len(item)
        first, last = np.flatnonzero(fits), last[fits]
        good = (item[first] == item[last]) & (place[last] - place[first] < self.span[item[first]])
        item, begin, stop = item[first[good]], place[first[good]], place[last[good]]
        start, end = np.maximum(0, stop - self.span[item] + 1), np.minimum(len(hashes), begin + self.span[item])
        # By item both grow with the place, so a stretch is from its first start to its last end.
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (start[1:] > end[:-1])
        heads = np.flatnonzero(new)
        return item[heads], start[heads], end[np.append(heads[1:], len(item))[: len(heads)] - 1]

    def possible(self, item: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """For each stretch, whether the bound of the score allows an alignment."""
        size = end - start + 1
        begin = np.cumsum(size) - size
        # A stretch is a 0 and the gains of its words; sums of later ones lie below all of earlier ones, so that one
        # running minimum serves all.
        at = np.arange(size.sum()) - np.repeat(begin - start + 1, size)
        words = own(hashes[at], np.repeat(item, size))
        has = self.bags[np.minimum(np.searchsorted(self.bags, words), len(self.bags) - 1)] == words
        gains = np.where(has, MATCH, MISMATCH)
        gains[begin] = -(MATCH - MISMATCH) * size.max(initial=0)
        sums = np.cumsum(gains)
        return np.maximum.reduceat(sums - np.minimum.accumulate(sums), begin) >= np.array(self.bound)[item]

    def found(self, text: str | None, hashes: np.ndarray, bits: np.ndarray) -> Iterator[tuple]:
        """(item_id, score, matches, item and document positions) of every piece of a passage that scores enough."""
        item, start, end = self.passages(hashes, bits)
        if not len(item):
            return
        span = self.span[item]
        pieces = np.maximum(1, -(-(end - start - span) // PIECE))
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        item, span = np.repeat(item, pieces), np.repeat(span, pieces)
        start, end = np.repeat(start, pieces) + nth * PIECE, np.repeat(end, pieces)
        end = np.minimum(end, start + PIECE + span)
        words = None
        for part in parts_of(end - start + 1, HELD):
            good = part.start + np.flatnonzero(self.possible(item[part], start[part], end[part], hashes))
            for i, a, b in zip(item[good].tolist(), start[good].tolist(), end[good].tolist()):
                words = plain_words(text) if words is None else words
                got = align(self.words[i], words[a:b], self.least[i])
                if got is not None:
                    score, matches, i0, i1, j0, j1 = got
                    yield self.ids[i], score, matches, i0, i1, a + j0, a + j1


def own(hashes: np.ndarray, item: int | np.ndarray) -> np.ndarray:
    """Hashes of words as an item's own. A chance collision only raises a bound."""
    return hashes ^ np.atleast_1d(np.asarray(item, np.uint64)) * np.uint64(ODD)


def parts_of(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Consecutive stretches of about ``most`` in sum; a larger size stands alone."""
    group = (np.cumsum(sizes) - sizes) // most
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])).tolist()
    for a, b in zip(heads, [*heads[1:], len(sizes)]):
        yield slice(a, b)


def align(item: list, passage: list, least: float = 0.0) -> tuple[float, int, int, int, int, int] | None:
    """Local alignment: score over a perfect copy's, matches, and [start, end) in item and passage; below ``least``: none.

    Row by row over the item; a run of skipped passage words is a running maximum, so a row is a few numpy steps. Of the
    rows every ``gap``-th is kept; the way back makes those between two of them again.
    """
    ids: dict = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in item])
    b = np.array([ids.setdefault(w, len(ids)) for w in passage])
    ramp = np.arange(len(b) + 1, dtype=np.int32) * -SKIP
    gap = int(np.sqrt(len(a))) + 1

    def following(row: np.ndarray, word: int) -> np.ndarray:
        step = np.maximum(row + SKIP, 0)
        gain = (b == word) * np.int32(MATCH - MISMATCH)
        gain += row[:-1]
        gain += MISMATCH
        np.maximum(step[1:], gain, out=step[1:])
        step += ramp
        np.maximum.accumulate(step, out=step)
        step -= ramp
        return step

    row = np.zeros(len(b) + 1, np.int32)
    kept, score, end_i, end_j = [row], 0, 0, 0
    for i, word in enumerate(a, 1):
        row = following(row, word)
        if i % gap == 0:
            kept.append(row)
        top = int(row.argmax())
        if row[top] > score:
            score, end_i, end_j = int(row[top]), i, top
    if score < least * MATCH * len(a) - 1e-9:
        return None
    low, rows = end_i + 1, []

    def cell(i: int, j: int) -> int:
        nonlocal low, rows
        if i < low:
            high, low = low, i // gap * gap
            rows = [kept[low // gap]]
            for word in a[low:high]:
                rows.append(following(rows[-1], word))
        return rows[i - low][j]

    i, j, matches = end_i, end_j, 0
    while (here := cell(i, j)) > 0:
        same = a[i - 1] == b[j - 1]
        above = cell(i - 1, j - 1), cell(i - 1, j)
        if here == above[0] + (MATCH if same else MISMATCH):
            matches, i, j = matches + bool(same), i - 1, j - 1
        elif here == above[1] + SKIP:
            i -= 1
        else:
            j -= 1
    return score / (MATCH * len(a)), matches, i, end_i, j, end_j


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, item_id, score, matches, item_start, item_end, doc_start, doc_end): the best alignment of every
    passage and item that scores at least ``least``; positions count plain words."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.size(F.split("text", r"\s+")).cast("long"))).first()[0] or 0
    many = 1 + size // SLAB_WORDS
    slabs = written(items.withColumn("slab", F.pmod(F.xxhash64("item_id", "text"), F.lit(many)).cast("int")), "slabs")
    words = written(benchmark_words(slabs), "item-words")
    counts = written(words.join(document_counts(docs, words), "hash"), "item-counts")
    parts = [aligned(docs, slabs, counts, slab, least) for slab in range(many)]
    return reduce(DataFrame.unionByName, parts)


def aligned(docs: DataFrame, slabs: DataFrame, counts: DataFrame, slab: int, least: float) -> DataFrame:
    """``contaminated`` for the items of one slab."""
    known = counts.where(F.col("slab") == slab).toPandas()
    known = dict(zip(known["hash"].to_numpy(np.int64).view(np.uint64).tolist(), known["docs"].tolist()))
    held = Slab([tuple(r) for r in slabs.where(F.col("slab") == slab).select("item_id", "text").collect()], known, least)
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def build(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, held = PlainHash(), shared.value
        bits = held.bits()
        for frame in rows:
            for some in chunks(frame):
                out = []
                texts = list(some["text"])
                for doc, text, hashes in zip(some["doc_id"], texts, known.of(texts)):
                    out += [(doc, *row) for row in held.found(text, hashes, bits)]
                yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")]).astype({"doc_id": "Int64", "item_id": "Int64"})

    schema = "doc_id long, item_id long, score double, matches int, item_start int, item_end int, doc_start int, doc_end int"
    return written(docs.select("doc_id", "text").mapInPandas(build, schema), "alignments")


def op9_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item with the best of their alignments."""
    best = F.max_by(F.struct("matches", "item_start", "item_end", "doc_start", "doc_end"), F.struct("score", -F.col("doc_start")))
    pairs = contaminated(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), best.alias("at"))
    return pairs.select("doc_id", "item_id", "score", "at.*")
