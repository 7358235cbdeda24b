"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

One inserted or deleted letter changes the vector of a word's letter counts by a squared distance of 1, one replaced letter by 2. So:

1. Blocks. Letters are dealt into a few classes of about equal frequency, and a word's block is its number of letters in each class
   (their sum is its length). An edit adds one to a class, or moves one between two classes: a word meets only its own block, the
   blocks of its length with one letter moved, and those of one letter more. Each pair of words meets once.
2. Gram matrices. In a block, members are sorted into cells by finer classes. For each cell the visitors from
   neighbouring cells are gathered, and |a|^2 + |b|^2 - 2ab, with ab from one NumPy product of the counts, gives all squared
   distances. Pairs at most two apart are kept and their edit is verified letter by letter.
3. Each task reports, for a word, how many near words it met and the most frequent one; these are summed up and joined to the words.

Rows come to a task sorted by block, members first: it holds one block's members, at most ``MEMBERS``, and as many of its visitors.
The classes become finer until the largest block fits; if that does not help (all words alike), blocks are cut into
chunks that every visitor meets, so nothing is left out. The driver holds letter counts (90 numbers) and a maximum.

Letters are those of Latin-1, a byte each. Defined results: null texts have no words; a null id counts as an empty one; repeated rows
count again; ties go to the smallest word in code-point order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, text_of, written

#: Members of a block that a task holds at once, and visitors; long words weigh more.
MEMBERS = 40_000
#: Numbers of classes that blocks may be made of, and times that a class is cut again for cells.
CLASSES, FINER = (4, 6, 8, 10), (1, 2, 3, 4, 6)
#: Words of a cell that Gram matrices are aimed at, and distances held at once.
CELL, DISTANCES = 96, 1 << 21


# --- words ------------------------------------------------------------------


def runs(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, run): the maximal runs of at least ``least`` letters, A-Z in lower case."""
    # Greedy, so a run that is long enough is matched whole, and a shorter one not at all.
    pattern = F.lit(f"[A-Za-z\u00c0-\u00ff]{{{least},}}")
    found = docs.select("doc_id", F.explode(F.regexp_extract_all(text_of(), pattern, F.lit(0))).alias("run"))
    return found.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def slipped(runs: DataFrame, one_in: int = 31) -> DataFrame:
    """(word): each run, without one letter where the hash of document and run is a multiple of ``one_in``."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    hashed = runs.select("run", h.alias("h")).withColumn("at", (F.col("h") % F.length("run")).cast("int"))
    without = F.expr("concat(left(run, at), substring(run, at + 2))")
    return hashed.select(F.when(F.col("h") % one_in == 0, without).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, least: int, times: int) -> DataFrame:
    """(word, n) of the words of ``least`` letters or more that occur ``times`` or more."""
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


# --- letters in numpy -------------------------------------------------------

#: The place of each Latin-1 letter among 26 + 64, by its byte.
_PLACE = np.full(256, -1, np.int64)
_PLACE[list(range(97, 123)) + list(range(192, 256))] = np.arange(90)


class Words:
    """Words as one run of bytes, with their frequencies."""

    def __init__(self, letters: np.ndarray, ends: np.ndarray, n: np.ndarray):
        self.letters, self.n = letters, n
        self.begin, self.size = np.r_[0, ends[:-1]].astype(np.int64), np.diff(np.r_[0, ends]).astype(np.int64)

    @staticmethod
    def of(column: pa.Array, n: np.ndarray) -> Words:
        offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
        data = column.buffers()[2]
        letters = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
        return Words(letters, offsets[1:].astype(np.int64) - offsets[0], n)

    def __len__(self) -> int:
        return len(self.size)

    def take(self, rows: np.ndarray) -> Words:
        ends = np.cumsum(self.size[rows])
        return Words(self.letters[spread(self.begin[rows], self.size[rows])], ends, self.n[rows])

    @staticmethod
    def joined(some: list[Words]) -> Words:
        return Words(np.concatenate([w.letters for w in some]), np.cumsum(np.concatenate([w.size for w in some])), np.concatenate([w.n for w in some]))

    def codes(self, values: np.ndarray) -> np.ndarray:
        """For each word the sum of its letters' ``values``, as wrapping 64-bit integers."""
        sums = np.r_[np.zeros(1, np.uint64), np.cumsum(values[_PLACE[self.letters]], dtype=np.uint64)]
        return sums[self.begin + self.size] - sums[self.begin]

    def counts(self) -> np.ndarray:
        """Letters of each word, as floats that hold every Gram entry exactly."""
        row = np.repeat(np.arange(len(self)), self.size)
        out = np.bincount(row * 90 + _PLACE[self.letters], minlength=len(self) * 90).reshape(-1, 90)
        return out.astype(np.float32 if self.size.max(initial=0) < 2000 else np.float64)

    def strings(self) -> np.ndarray:
        """The words as byte strings, for comparison."""
        width = int(self.size.max(initial=1))
        out = np.zeros((len(self), width), np.uint8)
        out[np.arange(width)[None, :] < self.size[:, None]] = self.letters
        return out.view(f"S{width}").ravel()

    def column(self) -> pa.Array:
        offsets = np.r_[0, np.cumsum(self.size)].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(self.letters))])


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of several stretches, one after another."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class Classes:
    """Letters dealt into classes of about equal weight, each of them cut again into finer ones.

    A letter's value is a fixed random number of its class; a word's code is the sum, so that an edit shifts codes by
    known amounts. Codes that meet by chance cost a comparison, no result.
    """

    def __init__(self, weights: np.ndarray, classes: int, finer: int = 1):
        self.classes = classes
        self.of = self._dealt(np.arange(90), weights, classes)
        self.fine = np.zeros(90, np.int64)
        for c in range(classes):
            mine = np.flatnonzero(self.of == c)
            self.fine[mine] = c * finer + self._dealt(mine, weights, finer)
        self.value = np.random.default_rng(1).integers(1, 2**63, classes, dtype=np.uint64)
        self.fine_value = np.random.default_rng(2).integers(1, 2**63, classes * finer, dtype=np.uint64)
        self.inside = [range(c * finer, (c + 1) * finer) for c in range(classes)]

    @staticmethod
    def _dealt(letters: np.ndarray, weights: np.ndarray, classes: int) -> np.ndarray:
        load, out = np.zeros(classes), np.zeros(len(letters), np.int64)
        for k in sorted(range(len(letters)), key=lambda k: -weights[letters[k]]):
            out[k] = load.argmin()
            load[out[k]] += weights[letters[k]] + 1
        return out

    def moves(self) -> list[tuple[int, int]]:
        """Kinds of visit: (-1, -1) to the own block, (-1, j) with a letter more, (i, j) with one moved from i to j."""
        return [(-1, -1), *((-1, j) for j in range(self.classes)), *((i, j) for j in range(self.classes) for i in range(j))]

    def shifts(self, i: int, j: int) -> list[np.ndarray]:
        """How a visit of this kind can shift the finer code: between equal classes only upwards, since the other way is the other word's visit."""
        add, zero = self.fine_value, np.uint64(0)
        if j < 0:
            return [zero, *(add[b] - add[a] for c in self.inside for a in c for b in c if a < b)]
        return [add[b] - (add[a] if i >= 0 else zero) for a in (self.inside[i] if i >= 0 else [0]) for b in self.inside[j]]


# --- near words -------------------------------------------------------------


def one_edit(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether a[i] and b[j] differ by exactly one edit; lengths are equal, or the second is one shorter."""
    out = np.zeros(len(i), bool)
    width = int(max(a.size[i].max(initial=0), 1))
    step = max(1, (1 << 22) // width)
    for s in range(0, len(i), step):
        p, q = i[s : s + step], j[s : s + step]
        n, m = a.size[p], b.size[q]
        k = np.arange(int(n.max(initial=0)))
        long = a.letters[np.minimum(a.begin[p][:, None] + k, len(a.letters) - 1)]
        short = b.letters[np.minimum(b.begin[q][:, None] + k, len(b.letters) - 1)]
        differ = (long != short) & (k < m[:, None])
        replaced = (n == m) & (differ.sum(axis=1) == 1)
        front = np.where(differ.any(axis=1), differ.argmax(axis=1), m)
        # The rest of the longer word, one letter on, must be the rest of the shorter one.
        later = a.letters[np.minimum(a.begin[p][:, None] + k + 1, len(a.letters) - 1)]
        wrong = (later != short) & (k >= front[:, None]) & (k < m[:, None])
        out[s : s + step] = replaced | ((n == m + 1) & ~wrong.any(axis=1))
    return out


def cells(classes: dict[int, Classes], words: Words) -> tuple[Classes, np.ndarray]:
    """The coarsest finer classes that keep cells small, and the members' codes."""
    for dealt in classes.values():
        codes = words.codes(dealt.fine_value[dealt.fine])
        n = np.unique(codes, return_counts=True)[1]
        if (n.astype(float) ** 2).sum() <= CELL * len(words):
            break
    return dealt, codes


class Block:
    """The members of one block, sorted into cells, and what was found of them."""

    def __init__(self, classes: dict[int, Classes], members: Words):
        self.classes, codes = cells(classes, members)
        order = np.argsort(codes, kind="stable")
        self.words = members.take(order)
        self.codes, self.start, self.size = np.unique(codes[order], return_index=True, return_counts=True)
        self.counts = self.words.counts()
        self.norms = (self.counts**2).sum(axis=1)

    def met(self, visitors: Words, kinds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(members, visitors) that are one edit apart."""
        codes = visitors.codes(self.classes.fine_value[self.classes.fine])
        found_cell, found_row = [], []
        for kind, (i, j) in enumerate(self.classes.moves()):
            mine = np.flatnonzero(kinds == kind)
            if not len(mine):
                continue
            unique, back = np.unique(codes[mine], return_inverse=True)
            for shift in self.classes.shifts(i, j):
                goal = unique + shift
                at = np.minimum(np.searchsorted(self.codes, goal), len(self.codes) - 1)
                hit = self.codes[at] == goal
                if hit.any():
                    rows = np.flatnonzero(hit[back])
                    found_cell.append(at[back[rows]])
                    found_row.append(mine[rows])
        if not found_cell:
            return
        cell, row = np.concatenate(found_cell), np.concatenate(found_row)
        order = np.argsort(cell, kind="stable")
        cell, row = cell[order], row[order]
        counts = visitors.counts()
        norms = (counts**2).sum(axis=1)
        edges = np.r_[np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]), len(cell)]
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            first, n = int(self.start[cell[begin]]), int(self.size[cell[begin]])
            own, own_norms = self.counts[first : first + n], self.norms[first : first + n]
            step = max(1, DISTANCES // n)
            for s in range(begin, end, step):
                some = row[s : min(end, s + step)]
                apart = own_norms[:, None] + norms[some] - 2 * (own @ counts[some].T)
                a, b = np.nonzero(apart <= 2.5)
                if len(a):
                    held.append((first + a, some[b]))
                if sum(len(h[0]) for h in held[-64:]) > DISTANCES:
                    yield from self._verified(held, visitors, kinds)
                    held = []
        yield from self._verified(held, visitors, kinds)

    def _verified(self, held: list, visitors: Words, kinds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not held:
            return
        a, b = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        near = one_edit(self.words, a, visitors, b)
        a, b = a[near], b[near]
        # Two words of one cell visit each other: their pair counts once.
        own = kinds[b] == 0
        if own.any():
            twice = np.zeros(len(a), bool)
            same = np.flatnonzero(own)
            code = self.classes.fine_value[self.classes.fine]
            same = same[self.words.take(a[same]).codes(code) == visitors.take(b[same]).codes(code)]
            twice[same] = self.words.take(a[same]).strings() > visitors.take(b[same]).strings()
            a, b = a[~twice], b[~twice]
        yield a, b


_NEAR = pa.schema([("word", pa.binary()), ("near", pa.int64()), ("near_n", pa.int64()), ("best", pa.binary())])


def reported(block: Block, a: np.ndarray, visitors: Words, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each word of the pairs the number of its near words, and the most frequent of them."""
    for words, i, others, j in ((block.words, a, visitors, b), (visitors, b, block.words, a)):
        if not len(i):
            continue
        rank = np.unique(others.take(j).strings(), return_inverse=True)[1]
        order = np.lexsort((rank, -others.n[j], i))
        i, j = i[order], j[order]
        first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        near = np.diff(np.r_[first, len(i)])
        yield pa.RecordBatch.from_arrays(
            [words.take(i[first]).column(), pa.array(near, pa.int64()), pa.array(others.n[j[first]], pa.int64()), others.take(j[first]).column()], schema=_NEAR
        )


_VISIT = pa.schema([("block", pa.int64()), ("chunk", pa.int32()), ("kind", pa.int32()), ("word", pa.binary()), ("n", pa.int64())])


def visits(weights: np.ndarray, classes: int, chunks: int):
    """The task that sends each word to its block as a member (kind -1), and to all blocks that it visits."""
    dealt = Classes(weights, classes)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words.of(batch.column("word"), batch.column("n").to_numpy())
            if not len(words):
                continue
            code = words.codes(dealt.value[dealt.of])
            held = np.stack([words.codes((dealt.of == c).astype(np.uint64)) for c in range(classes)]) > 0
            chunk = code_of_text(words) % np.uint64(chunks)
            for kind, (i, j) in enumerate([(-2, -2), *dealt.moves()]):
                rows = np.flatnonzero(held[i]) if i >= 0 else np.arange(len(words))
                shift = (dealt.value[j] if j >= 0 else np.uint64(0)) - (dealt.value[i] if i >= 0 else np.uint64(0))
                block = (code[rows] + shift).view(np.int64)
                some = words.take(rows)
                for c in range(chunks) if i > -2 else [None]:
                    to = chunk[rows].astype(np.int32) if c is None else np.full(len(rows), c, np.int32)
                    kinds = np.full(len(rows), kind - 1, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(to), pa.array(kinds), some.column(), pa.array(some.n)], schema=_VISIT)

    return build


def code_of_text(words: Words) -> np.ndarray:
    """A number that depends on the order of the letters."""
    place = np.arange(len(words.letters)) - np.repeat(words.begin, words.size)
    mixed = (words.letters.astype(np.uint64) + np.uint64(1)) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15))
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(mixed * (mixed >> np.uint64(7)), dtype=np.uint64)]
    return (sums[words.begin + words.size] - sums[words.begin]) >> np.uint64(17)


def meetings(weights: np.ndarray, classes: int):
    """The task that goes through sorted blocks: members first, then visitors, as many as members at once."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finer = {f: Classes(weights, classes, f) for f in FINER}
        members: list[Words] = []
        block: Block | None = None
        waiting: list[tuple[Words, np.ndarray]] = []
        at = None

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, waiting, members
            if waiting and (members or block):
                block = block or Block(finer, Words.joined(members))
                members = []
                visitors, kinds = Words.joined([w for w, _ in waiting]), np.concatenate([k for _, k in waiting])
                for a, b in block.met(visitors, kinds):
                    yield from reported(block, a, visitors, b)
            waiting = []

        for batch in batches:
            key = np.stack([batch.column("block").to_numpy(), batch.column("chunk").to_numpy().astype(np.int64)])
            kind = batch.column("kind").to_numpy()
            words = Words.of(batch.column("word"), batch.column("n").to_numpy())
            new = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for begin, end in zip(np.r_[0, new].tolist(), np.r_[new, key.shape[1]].tolist()):
                if begin == end:
                    continue
                if at != (here := tuple(key[:, begin].tolist())):
                    yield from flush()
                    members, block, at = [], None, here
                own = begin + int(np.searchsorted(kind[begin:end], 0))
                if own > begin:
                    members.append(words.take(np.arange(begin, own)))
                if end > own and (members or block):
                    waiting.append((words.take(np.arange(own, end)), kind[own:end]))
                    if sum(weight(w) for w, _ in waiting) >= MEMBERS:
                        yield from flush()
        yield from flush()

    return build


def weight(words: Words) -> int:
    return len(words) + int(words.letters.size) // 256


def measured(words: DataFrame) -> tuple[np.ndarray, int, int]:
    """Letter frequencies, and the classes and chunks that keep the members of a block within bounds."""

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(90, np.int64)
        for batch in batches:
            total += np.bincount(_PLACE[Words.of(batch.column("word"), batch.column("n").to_numpy()).letters], minlength=90)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(90)), pa.array(total)], ["place", "n"])

    weights = np.zeros(90)
    for r in words.mapInArrow(letters, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        weights[r["place"]] = r["n"]

    for classes in CLASSES:
        dealt = Classes(weights, classes)

        def blocks(batches: Iterator[pa.RecordBatch], dealt=dealt) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = Words.of(batch.column("word"), batch.column("n").to_numpy())
                code, back = np.unique(found.codes(dealt.value[dealt.of]), return_inverse=True)
                weigh = np.bincount(back, 1 + found.size / 256, len(code)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(weigh)], ["block", "weight"])

        largest = words.mapInArrow(blocks, "block long, weight long").groupBy("block").agg(F.sum("weight").alias("w")).agg(F.max("w")).first()[0] or 0
        if largest <= MEMBERS:
            break
    return weights, classes, -(-largest // MEMBERS) or 1


def near(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, best) of the words of (word, n), distinct, that have near words: how many, and the most frequent one."""
    spark = words.sparkSession
    bytes_of = words.select(F.encode("word", "ISO-8859-1").alias("word"), "n")
    weights, classes, chunks = measured(bytes_of)
    sent = bytes_of.mapInArrow(visits(weights, classes, chunks), "block long, chunk int, kind int, word binary, n long")
    # A number of its own: AQE would join these small but costly partitions.
    sent = sent.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block", "chunk").sortWithinPartitions("block", "chunk", "kind")
    met = sent.mapInArrow(meetings(weights, classes), "word binary, near long, near_n long, best binary")
    # The most frequent one, of several the smallest in code-point order, which Latin-1 keeps.
    met = met.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "best")).alias("first"))
    text = lambda c: F.decode(c, "ISO-8859-1")
    return met.select(text("word").alias("word"), "n_near", (-F.col("first.less")).alias("near_n"), text("first.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain. The distance covered doubles with every round.

    Both sides of a join have a shuffle of their own, so AQE splits a form that many words lead to.
    """
    steps = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = steps.select(F.concat(F.lit("="), "word").alias("_key"), F.col("root").alias("ahead"))
        joined = steps.withColumn("_key", F.concat(F.lit("="), "root")).join(ahead, "_key", "left")
        further = written(joined.select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "forms")
        steps = further.select("word", "root")
        if not further.where("moved").limit(1).count():
            return steps


def grouped(words: DataFrame, times: int) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n): the form of a word is its most frequent near word, if ``times`` as frequent."""
    found = words.join(near(words), "word", "left")
    form = F.col("near_n") >= times * F.col("n")
    found = written(
        found.select(
            "word", F.when(form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(form, F.col("near_n")).alias("form_n")
        ),
        "near-words",
    )
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(docs: DataFrame) -> DataFrame:
    words = written(counted(slipped(runs(docs, 7)), 7, 2), "words")
    return grouped(words, 10)
