"""Word n-gram Jaccard self-join with a token-group matrix, exact, reported as connected components.

A document's set is its distinct word shingles (of ``words`` words); equal sets are one node. Then:

1. Candidates. Tokens have one order: common ones last, the most common at the very end. Two similar sets share their
   first shared token, and before it each has at most the tokens that the other can lack; so it is among the first of both, one
   more than a similar set can lack. These are a node's signatures. The very first in the order are tokens that only one set holds, of those
   in the lower half of all hashes, where such tokens are looked for: they count as places, but nobody can share them, so they are not sent,
   and a text without near copies mostly sends nothing. Nodes that share a signature are candidates, but for pairs of a small group
   that cannot be similar: by their sizes and the token's places in both, then by how many tokens each has in 256 ranges of hashes.
   Lines that many texts repeat make candidates only of texts with hardly anything else. Common are tokens that several sets of a
   task hold; any choice gives the same links.
2. Groups. Candidates are linked in stars (each to the least node of the signature) and their components are clusters.
   Inside a cluster, similar sets form groups with the union of their tokens; the matrix tokens x groups gives, for a query
   set, how many of its tokens each union holds. Only groups whose count could reach the threshold are opened (those that hold none of its rarest
   tokens cannot), where the exact overlaps are one matrix product.
3. A cluster above ``CHUNK`` tokens is cut into chunks by size of set, and every pair of chunks whose sizes let any two sets
   link is a task, so nothing is left out and no task holds more than two chunks. Links leave a task as stars, not as
   pairs: those of a cluster that one task holds need no further round.

Nodes are 64-bit digests of the sets. Defined results: null, empty and wordless texts have the empty set and stand
alone; a text with fewer words than a shingle is one shingle; repeated rows share a node; a row with a null id links like any
other and is named by the smallest id it reaches, by null if there is none; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import components, settled
from tidemark.llm.decontamination import PlainHash
from tidemark.llm.ngrams import grams
from tidemark.llm.token_files import chunks

#: Tokens of a chunk of a cluster.
CHUNK = 2_000_000
#: Tokens of a task counted at once, and common tokens that tasks know.
COUNTED, COMMON = 1 << 21, 1 << 17
#: Ranges of tokens by their first 12 bits, how many of them are asked for tokens that several sets hold, and bits of a range that tell.
RANGES, ASKED, PLACES = 1 << 12, 1 << 11, 1 << 16
#: Rows with one signature that are compared in pairs.
PAIRED = 64
#: Cells of a group's matrix.
CELLS = 4_000_000
#: Bits of the filter that lets texts of clusters through, and nodes that a task remembers to have sent.
BITS, SENT = 1 << 26, 1_000_000


@lru_cache(maxsize=1)
def worker_hashes() -> PlainHash:
    """One per Python worker: groups follow each other and share its tables."""
    return PlainHash(edges=b"", short=32)


def shingles(known: PlainHash, texts: Iterable[str | None], words: int) -> list[np.ndarray]:
    """The sets of texts: sorted distinct shingle hashes. Those of all texts are made in one row, and those that reach over an end left out."""
    hashes = known.of(list(texts))
    row = grams(np.concatenate([np.empty(0, np.uint64), *hashes]), words)
    out, at = [], 0
    for own in hashes:
        found = row[at : at + len(own) - words + 1].copy() if len(own) >= words else grams(own, len(own)) if len(own) else own
        found.sort()
        new = found[1:] != found[:-1]
        out.append(found if new.all() else found[np.append(True, new)])
        at += len(own)
    return out


def nodes_of(found: list[np.ndarray]) -> np.ndarray:
    """Digests of sets that are not empty, as signed longs."""
    sizes = np.array([len(s) for s in found], np.int64)
    if not len(sizes):
        return np.empty(0, np.int64)
    return mix(np.add.reduceat(mix(np.concatenate(found)), np.cumsum(sizes) - sizes) + sizes.astype(np.uint64)).view(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, node, cells) of every row, ``cells`` being how many tokens fall into each of 256 ranges of hashes, up to 255;
    the empty set has no node. Besides them, rows (token, held) without the others: tokens that several sets hold among ``COUNTED`` of a task."""

    def shared(some: list[np.ndarray]) -> pd.DataFrame:
        tokens, held = np.unique(np.concatenate(some), return_counts=True)
        rows = pd.DataFrame({"token": tokens[held > 1].view(np.int64), "held": held[held > 1]})
        return rows.reindex(columns=columns).astype(kinds).assign(cells=None)

    def build(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, seen, some, held = worker_hashes(), set(), [], 0
        for frame in rows:
            for part in chunks(frame, 1 << 20):
                found = shingles(known, part["text"], words)
                sizes = np.array([len(s) for s in found])
                full = [s for s in found if len(s)]
                nodes = pd.array([None] * len(found), "Int64")
                nodes[sizes > 0] = nodes_of(full)
                at = np.repeat(np.arange(len(found)) * 256, sizes) + (np.concatenate(found) >> np.uint64(56)).astype(np.int64)
                cells = np.minimum(np.bincount(at, minlength=256 * len(found)), 255).astype(np.uint8).reshape(-1, 256)
                out = pd.DataFrame({"doc_id": part["doc_id"].array, "n_shingles": sizes, "node": nodes}).reindex(columns=columns).astype(kinds)
                yield out.assign(cells=[c.tobytes() if n else None for c, n in zip(cells, sizes)])
                for node, tokens in zip(nodes.dropna().tolist(), full):
                    if node not in seen:
                        seen.add(node)
                        some.append(tokens)
                        held += len(tokens)
                if held >= COUNTED:
                    yield shared(some)
                    seen, some, held = set(), [], 0
        if some:
            yield shared(some)

    columns = ["doc_id", "n_shingles", "node", "token", "held"]
    kinds = dict.fromkeys(columns, "Int64")
    return docs.select("doc_id", "text").mapInPandas(build, "doc_id long, n_shingles long, node long, token long, held long, cells binary")


def repeated(docs: DataFrame, words: int) -> np.ndarray:
    """Bits by range and place (see ``lone``): set where several sets hold a token. 16 MB at any size of the input; fuller, they hide tokens
    that one set holds, which makes work and loses nothing, and so do copies in several tasks, each of which counts as a set.

    Tokens travel by range, 4 bytes each: the 32 bits after the 12 of the range.
    """

    places = PLACES

    def dealt(some: list[np.ndarray]) -> pd.DataFrame:
        tokens = np.sort(np.concatenate(some))
        ends = np.searchsorted(tokens, np.arange(1, ASKED, dtype=np.uint64) * np.uint64((1 << 64) // RANGES))
        parts = np.split((tokens >> np.uint64(20)).astype("<u4"), ends)
        return pd.DataFrame([(n, part.tobytes()) for n, part in enumerate(parts) if len(part)], columns=["range", "tokens"])

    def build(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, seen, some, held = worker_hashes(), set(), [], 0
        for frame in rows:
            for part in chunks(frame, 1 << 20):
                full = [s for s in shingles(known, part["text"], words) if len(s)]
                for node, tokens in zip(nodes_of(full).tolist(), full):
                    if node not in seen:
                        if len(seen) < SENT:
                            seen.add(node)
                        some.append(tokens[: np.searchsorted(tokens, np.uint64(ASKED * ((1 << 64) // RANGES)))])
                        held += len(some[-1])
                if held >= COUNTED:
                    yield dealt(some)
                    some, held = [], 0
        if some:
            yield dealt(some)

    def several(frame: pd.DataFrame) -> pd.DataFrame:
        tokens = np.sort(np.frombuffer(b"".join(frame["tokens"]), "<u4"))
        bits = np.zeros(places, bool)
        bits[tokens[1:][tokens[1:] == tokens[:-1]] % places] = True
        return pd.DataFrame({"range": frame["range"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    found = docs.select("text").mapInPandas(build, "range int, tokens binary").groupBy("range").applyInPandas(several, "range int, bits binary")
    out = np.zeros((ASKED, places // 8), np.uint8)
    for r in settled(found, "repeated").toLocalIterator():  # at most ASKED rows of 8 KB
        out[r["range"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def lone(tokens: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which tokens are known to be in one set only."""
    out = np.zeros(len(tokens), bool)
    at = np.flatnonzero(tokens < np.uint64(ASKED * ((1 << 64) // RANGES)))
    place = (tokens[at] >> np.uint64(20)).astype(np.int64) % (8 * bits.shape[1])
    out[at] = bits[(tokens[at] >> np.uint64(52)).astype(np.int64), place >> 3] >> (place & 7) & 1 == 0
    return out


class Order:
    """An order of all tokens that is the same everywhere: those that one set holds, those that are not common by their hash, then the
    common ones, the rarest first."""

    def __init__(self, tokens: np.ndarray, held: np.ndarray):
        by = np.argsort(tokens)
        self.tokens, self.held = tokens[by], held[by]
        self.some = np.zeros(1 << 22, bool)
        self.some[self.place(self.tokens)] = True

    def place(self, tokens: np.ndarray) -> np.ndarray:
        return (tokens & np.uint64(len(self.some) - 1)).astype(np.int64)

    def counts(self, tokens: np.ndarray) -> np.ndarray:
        """By token: in how many sets it was found as a common one, else 0."""
        out = np.zeros(len(tokens), np.int64)
        maybe = np.flatnonzero(self.some[self.place(tokens)])
        at = np.searchsorted(self.tokens, tokens[maybe])
        at[at == len(self.tokens)] = 0
        same = self.tokens[at] == tokens[maybe]
        out[maybe[same]] = self.held[at[same]]
        return out

    def first(self, found: list[np.ndarray], bits: np.ndarray, percent: int) -> tuple[list[np.ndarray], list[int]]:
        """Of each sorted set, its first tokens, one more than a similar set can lack, without those that it holds alone; and how many those are."""
        row, ends = np.concatenate([np.empty(0, np.uint64), *found]), np.cumsum([len(s) for s in found])[:-1]
        shared = ~lone(row, bits)
        counts, out, before = np.zeros(len(row), np.int64), [], []
        counts[shared] = self.counts(row[shared])
        for tokens, some, held in zip(found, np.split(shared, ends), np.split(counts, ends)):
            before.append(len(tokens) - int(some.sum()))
            many = len(tokens) + percent * len(tokens) // -100 + 1 - before[-1]
            if many <= 0:
                out.append(tokens[:0])
                continue
            tokens, held = tokens[some], held[some]
            plain = np.flatnonzero(held[: 2 * many] == 0)[:many]  # mostly that is enough
            if len(plain) < many:
                plain = np.argsort(held, kind="stable")[:many]
            out.append(tokens[plain])
        return out, before


def common(found: DataFrame) -> Order:
    """At most ``COMMON`` tokens, those that most sets were found to hold. Which ones they are decides about the work, not about the result."""
    held = found.where("token is not null").groupBy("token").agg(F.sum("held").alias("held"))
    most = held.orderBy(F.desc("held"), "token").limit(COMMON).toPandas()
    return Order(most["token"].to_numpy(np.int64).view(np.uint64), most["held"].to_numpy(np.int64))


def signatures(docs: DataFrame, order: Order, bits: np.ndarray, words: int, percent: int) -> DataFrame:
    """(node, sign, n, place): what candidates share, the size of the set and how many of its tokens come before."""
    shared = docs.sparkSession.sparkContext.broadcast((order, bits))

    def build(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = worker_hashes()
        for frame in rows:
            for some in chunks(frame, 1 << 20):
                full = [s for s in shingles(known, some["text"], words) if len(s)]
                found = dict(zip(nodes_of(full).tolist(), full))
                order, bits = shared.value
                signs, before = order.first(list(found.values()), bits, percent)
                many = [len(s) for s in signs]
                yield pd.DataFrame({
                    "node": np.repeat(np.array(list(found), np.int64), many),
                    "sign": np.concatenate([np.empty(0, np.uint64), *signs]).view(np.int64),
                    "n": np.repeat(np.array([len(s) for s in found.values()], np.int32), many),
                    "place": np.concatenate([np.empty(0, np.int32), *[np.arange(b, b + m, dtype=np.int32) for b, m in zip(before, many)]]),
                })

    return docs.select("text").mapInPandas(build, "node long, sign long, n int, place int")


def candidates(docs: DataFrame, found: DataFrame, order: Order, words: int, percent: int) -> DataFrame:
    """(a, b): links whose components hold all similar sets together.

    Where up to ``PAIRED`` rows share a signature, each pair that could be similar; where more do, a star (each to the least node).
    """
    group = W.partitionBy("sign")
    met = signatures(docs, order, repeated(docs, words), words, percent)
    met = met.withColumns({"least": F.min("node").over(group), "most": F.max("node").over(group), "many": F.count("*").over(group)})
    met = settled(met.where("least <> most").drop("most"), "met")
    stars = met.where(f"many > {PAIRED} and node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    few = met.where(f"many <= {PAIRED}").groupBy("sign").agg(F.collect_set(F.struct("node", "n", "place")).alias("all"))
    pairs = few.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y")).where("x.node < y.node")
    # Of the first token that they share on, neither has fewer tokens than they must share.
    pairs = pairs.where(f"{100 + percent} * least(x.n - x.place, y.n - y.place) >= {percent} * cast(x.n + y.n as long)")
    pairs = pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), (F.col("x.n") + F.col("y.n")).cast("long").alias("total")).distinct()
    return stars.unionByName(alike(pairs, found, percent)).distinct()


def alike(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose cells differ by no more tokens than similar sets of their ``total`` size can."""
    cells = found.where("node is not null").select("node", "cells").dropDuplicates(["node"])
    sides = pairs.join(cells.select(F.col("node").alias("a"), F.col("cells").alias("one")), "a")
    sides = sides.join(cells.select(F.col("node").alias("b"), F.col("cells").alias("other")), "b")

    def build(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows:
            one, other = (np.frombuffer(b"".join(frame[c]), np.uint8).reshape(-1, 256).astype(np.int64) for c in ("one", "other"))
            apart = np.abs(one - other).sum(1)
            yield frame.loc[(100 + percent) * apart <= (100 - percent) * frame["total"].to_numpy(), ["a", "b"]]

    return sides.select("a", "b", "total", "one", "other").mapInPandas(build, "a long, b long")


def group_links(nodes: np.ndarray, found: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """The links of a cluster's sets, as stars (each to the least node it reaches), by the token-group matrix."""
    order = sorted(range(len(found)), key=lambda i: (int(found[i][0]), len(found[i]), int(nodes[i])))  # least token first: similar sets meet
    nodes, found = nodes[order], [found[i] for i in order]
    sizes = np.array([len(s) for s in found])
    vocabulary, where = np.unique(np.concatenate(found), return_inverse=True)
    ids = np.split(where, np.cumsum(sizes)[:-1])
    groups: list[list[int]] = []
    union: set[int] = set()
    for i, tokens in enumerate(ids):
        wider = union | set(tokens.tolist())
        if groups and (len(groups[-1]) + 1) * len(wider) <= CELLS and len(groups[-1]) < 512 and (3 * len(wider) <= 4 * len(union) or 2 * len(wider) <= 3 * len(tokens)):
            groups[-1].append(i)
            union = wider
        else:
            groups.append([i])
            union = set(tokens.tolist())
    unions = [np.unique(np.concatenate([ids[i] for i in g])) for g in groups]
    # The matrix, by token: the groups whose union holds it.
    token = np.concatenate(unions)
    holder = np.repeat(np.arange(len(groups)), [len(u) for u in unions])
    by_token = np.argsort(token, kind="stable")
    holder = holder[by_token]
    starts = np.searchsorted(token[by_token], np.arange(len(vocabulary) + 1))
    least = np.array([sizes[g].min() for g in groups])
    most = np.array([sizes[g].max() for g in groups])
    opened: list[list[int]] = [[] for _ in groups]
    own = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    for q, tokens in enumerate(ids):
        # A group that could qualify holds one of the set's rarest tokens: too few are left without them.
        rare = tokens[np.argsort(starts[tokens + 1] - starts[tokens], kind="stable")][: sizes[q] - -(-percent * sizes[q] // 100) + 1]
        met = np.unique(np.concatenate([holder[starts[t] : starts[t + 1]] for t in rare]))
        if len(met) == 1:  # its own
            if len(groups[own[q]]) > 1:
                opened[own[q]].append(q)
            continue
        begin, count = starts[tokens], starts[tokens + 1] - starts[tokens]
        at = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        bound = np.bincount(holder[at], minlength=len(groups))
        could = (100 * bound >= percent * sizes[q]) & (100 * most >= percent * sizes[q]) & (100 * sizes[q] >= percent * least)
        for g in np.flatnonzero(could):
            if groups[g][0] <= q:  # each pair once: queries look at their own and earlier groups
                opened[g].append(q)
    label = np.arange(len(ids))
    for members, columns, queries in zip(groups, unions, opened):
        matrix = np.zeros((len(members), len(columns)), np.float32)
        for r, i in enumerate(members):
            matrix[r, np.searchsorted(columns, ids[i])] = 1
        for at in range(0, len(queries), 256):
            some = queries[at : at + 256]
            if len(members) == 1 and some == members:
                continue
            ask = np.zeros((len(some), len(columns)), np.float32)
            for r, q in enumerate(some):
                place = np.minimum(np.searchsorted(columns, ids[q]), len(columns) - 1)
                ask[r, place[columns[place] == ids[q]]] = 1
            overlap = np.rint(ask @ matrix.T).astype(np.int64)
            linked = 100 * overlap >= percent * (sizes[some][:, None] + sizes[members][None, :] - overlap)
            for r, q in enumerate(some):
                for other in np.unique(label[np.array(members)[linked[r]]]):
                    if other != label[q]:
                        label[label == other] = label[q]
    least_node = pd.Series(nodes).groupby(label).transform("min").to_numpy()
    return [(int(a), int(b)) for a, b in zip(nodes, least_node) if a != b]


def bitmap(nodes: DataFrame) -> np.ndarray:
    """A bit for each of ``BITS`` hashes of the nodes: 8 MB at any size of the input. Fuller, it lets more texts through, and none less."""
    place = F.pmod("node", F.lit(BITS)) + 1  # positions count from 1
    blocks = nodes.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in blocks.collect():  # at most BITS / 32,768 rows of 4 KB
        begin = (r["b"] - 1) * 4096
        out[begin : begin + 4096] |= np.frombuffer(bytes(r["bits"]), np.uint8)[: len(out) - begin]
    return out


def chunk_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(component, i, j): the chunks that meet. Chunks hold ranges of sizes: where the largest set of one is too small for the
    smallest of a later one, no two link. A chunk that meets no other one meets itself."""
    ranges = members.groupBy("component", "chunk").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    later = ranges.select("component", F.col("chunk").alias("j"), F.col("low").alias("least"))
    met = ranges.withColumnRenamed("chunk", "i").join(later, "component").where(f"i = j or (i < j and 100 * high >= {percent} * least)")
    pairs = met.select("component", "i", "j")
    other = pairs.where("i < j")
    busy = other.select("component", "i").unionByName(other.select("component", F.col("j").alias("i"))).distinct()
    return other.unionByName(pairs.where("i = j").join(busy, ["component", "i"], "left_anti"))


def links(docs: DataFrame, found: DataFrame, clusters: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): the verified links of all clusters. ``clusters`` maps nodes to their cluster.

    Texts of other nodes are left out before the shuffle, and of copies one goes on. Texts are sent, not sets: they are
    less than half as long. They are sent packed, since a text goes to every pair of its chunk.
    """
    sizes = found.where("node is not null").groupBy("node").agg(F.max("n_shingles").alias("n"))
    members = clusters.withColumnRenamed("id", "node").join(sizes, "node")
    run = W.partitionBy("component").orderBy("n", "node")
    members = members.withColumn("chunk", F.floor((F.sum("n").over(run) - 1) / CHUNK).cast("int"))
    members = settled(members.select("node", "component", "n", "chunk"), "members")
    pairs = chunk_pairs(members, percent)
    sides = pairs.withColumn("chunk", F.col("i")).unionByName(pairs.where("i < j").withColumn("chunk", F.col("j")))
    placed = members.join(sides, ["component", "chunk"]).select("node", "component", "i", "j")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(members))

    def held(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, sent, codec = worker_hashes(), set(), pa.Codec("zstd")
        for frame in rows:
            out = []
            for some in chunks(frame, 1 << 20):
                full = [(t, s) for t, s in zip(some["text"], shingles(known, some["text"], words)) if len(s)]
                nodes = nodes_of([s for _, s in full])
                place = nodes % BITS
                for i in np.flatnonzero(wanted.value[place >> 3] >> (place & 7) & 1):
                    text, node = full[i][0], int(nodes[i])
                    if node in sent:
                        continue
                    out.append((node, len(data := text.encode("utf-8", "surrogatepass")), codec.compress(data, asbytes=True)))
                    if len(sent) < SENT:
                        sent.add(node)
            yield pd.DataFrame(out, columns=["node", "size", "packed"]).astype({"node": "int64", "size": "int64"})

    texts = docs.select("text").mapInPandas(held, "node long, size long, packed binary").dropDuplicates(["node"])
    placed = texts.join(placed, "node").select("component", "i", "j", "node", "size", "packed")

    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("node")
        known, codec = worker_hashes(), pa.Codec("zstd")
        texts = (codec.decompress(data, size, asbytes=True).decode("utf-8", "surrogatepass") for data, size in zip(frame["packed"], frame["size"]))
        got = group_links(frame["node"].to_numpy(np.int64), [s for t in texts for s in shingles(known, [t], words)], percent)
        return pd.DataFrame(got, columns=["a", "b"], dtype="int64")

    return placed.groupBy("component", "i", "j").applyInPandas(verify, "a long, b long")


def join(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: components of links at ``percent`` Jaccard or more."""
    found = settled(sets(docs, words), "sets")
    order, found = common(found), found.where("token is null").drop("token", "held")
    clusters = components(candidates(docs, found, order, words, percent))
    linked = components(links(docs, found, clusters, words, percent))
    by_node = found.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    by_node = by_node.join(linked, by_node["node"] == linked["id"], "left").withColumn("root", F.coalesce("component", "node"))
    roots = by_node.groupBy("root").agg(F.min("least").alias("component_id"))
    names = by_node.join(roots, "root").select("node", "component_id")
    out = found.join(names, "node", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op8_jaccard(docs: DataFrame) -> DataFrame:
    return join(docs, words=3, percent=90)
