"""Vector code compression in integers: product codes found through Walsh-Hadamard transforms.

Each component x becomes the integer floor(1024 * x). A vector is cut into equal consecutive parts, and each part is
replaced by the number of its nearest codebook entry. Distances use no floating point:

1. Parts and entries are padded with zeros to a power of two, D, and go through the integer Walsh-Hadamard transform.
   It is orthogonal up to the factor D, so the squared differences of all D coefficients sum to D times the distance.
2. The coefficients are visited in sequency order (slow ones first). After half of them the entry with the least sum
   gives a bound, its full distance; every entry whose sum is above it is eliminated, and the rest is followed
   coefficient by coefficient, with eliminations after each. Sums only grow, so no nearest entry is ever lost.
3. A codebook round sends, per task, one exact sum and count for every entry; entries become floor(sum / count).

Rows never leave their task in a round. The driver holds the codebooks (``entries`` x vector length numbers) and
their sums. Integers have 32 or 64 bits where the largest value proves that nothing overflows, else they are Python's.

Defined results: a vector that is null or holds null or non-finite components is dropped; vectors shorter than the longest,
or than a multiple of the parts, are padded with zeros; with fewer vectors than entries a codebook has fewer; null ids sort last and
repeated ids by their vectors; empty vectors get codes 00 and error 0; an error beyond a long is null; null labels are one label;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Cells (vectors x entries) that are held at once.
CELLS = 1 << 18
LONGEST = 2**63 - 1


@cache
def sequency(size: int) -> np.ndarray:
    """Rows of the natural Hadamard matrix by their number of sign changes: the bit-reversed Gray code."""
    bits = size.bit_length() - 1
    return np.array([int(f"{s ^ s >> 1:0{bits}b}"[::-1], 2) if bits else 0 for s in range(size)])


def walsh(x: np.ndarray) -> np.ndarray:
    """The transform of each row, padded with zeros to a power of two, in sequency order."""
    n, d = x.shape
    size = 1 << max(0, d - 1).bit_length()
    out = np.zeros((n, size), x.dtype)
    out[:, :d] = x
    half = 1
    while half < size:
        pairs = out.reshape(n, size // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return out[:, sequency(size)]


def integers(x: np.ndarray) -> np.ndarray:
    """floor(1024 * x), as longs where they are far from overflow, else as Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * 1024.0)
    if not x.size or np.abs(scaled).max() < 2**53:
        return scaled.astype(np.int64)
    # Beyond the range of doubles x is an integer itself.
    whole = [int(s) if np.isfinite(s) else int(v) * 1024 for s, v in zip(scaled.ravel(), x.ravel())]
    return np.array(whole, object).reshape(x.shape)


def fitting(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays in the smallest type that sums of squared differences of their transforms fit: 32 or 64 bits, or Python's."""
    most = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    size = 1 << max(0, arrays[0].shape[1] - 1).bit_length()
    largest = (2 * most * size) ** 2
    return [a.astype(np.int32 if largest < 2**30 else np.int64 if largest < 2**62 else object) for a in arrays]


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest entry (ties to the lower number) and the squared distance to it."""
    parts, book = fitting(parts, book)
    entries = walsh(book)
    size = entries.shape[1]
    found = np.empty(len(parts), np.int64)
    error = np.empty(len(parts), parts.dtype)
    step = max(1, CELLS // max(1, len(book)))
    for begin in range(0, len(parts), step):
        rows = walsh(parts[begin : begin + step])
        sums = np.zeros((len(rows), len(book)), rows.dtype)
        head = -(-size // 2)
        for k in range(head):
            apart = rows[:, k, None] - entries[None, :, k]
            sums += apart * apart
        guess = entries[sums.argmin(axis=1)]
        bound = ((rows - guess) ** 2).sum(axis=1)
        row, entry = np.nonzero(sums <= bound[:, None])
        left = sums[row, entry]
        for k in range(head, size):
            apart = rows[row, k] - entries[entry, k]
            left = left + apart * apart
            stay = left <= bound[row]
            row, entry, left = row[stay], entry[stay], left[stay]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])  # sorted by row, then entry
        least = np.minimum.reduceat(left, first)
        best = np.flatnonzero(left == least[row])
        best = best[np.r_[True, row[best][1:] != row[best][:-1]]]
        found[begin : begin + step] = entry[best]
        error[begin : begin + step] = left[best] // size
    return found, error


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A list column as doubles, one row each, padded with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lists), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def kept(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, v) of the vectors that are whole: not null, without null or non-finite components."""
    v = F.col(vector).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select("vec_id", "label", v.alias("v")).where(F.col("v").isNotNull() & whole)


def fit(rows: DataFrame, parts: int, entries: int, rounds: int) -> list[np.ndarray]:
    """Codebooks, one for each part: (entries, length of a part) integers."""
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts) * parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).toArrow()
    books = np.split(integers(matrix(first["v"], width)), parts, axis=1)
    for _ in range(rounds if len(first) else 0):

        def gather(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros_like(b, object) for b in books]
            counts = [np.zeros(len(b), np.int64) for b in books]
            for batch in batches:
                for p, x in enumerate(np.split(integers(matrix(batch.column("v"), width)), parts, axis=1)):
                    to, _ = nearest(x, books[p])
                    counts[p] += np.bincount(to, minlength=len(counts[p]))
                    order = np.argsort(to, kind="stable")
                    begins = np.flatnonzero(np.r_[True, np.diff(to[order]) > 0]) if len(to) else np.empty(0, np.int64)
                    if len(begins):
                        some = x[order] if np.abs(x).max(initial=0) * len(x) < 2**62 else x[order].astype(object)
                        sums[p][to[order][begins]] += np.add.reduceat(some, begins, axis=0).astype(object)
            out = [(p, e, int(c[e]), ",".join(map(str, s[e]))) for p, (s, c) in enumerate(zip(sums, counts)) for e in np.flatnonzero(c)]
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "entry", "n", "total"), r)) for r in out], schema=_SUMS)

        totals = rows.select("v").mapInArrow(gather, "part int, entry int, n long, total string")
        books = [b.copy() for b in books]
        for r in totals.groupBy("part", "entry").applyInPandas(_mean, "part int, entry int, mean string").collect():
            values = [int(x) for x in r["mean"].split(",")] if width else []
            if any(abs(x) >= 2**62 for x in values):
                books[r["part"]] = books[r["part"]].astype(object)
            books[r["part"]][r["entry"]] = values
    return books


_SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.string())])


def _mean(frame: pd.DataFrame) -> pd.DataFrame:
    """floor(sum / count) of one entry, from one row per task."""
    n = int(frame["n"].sum())
    columns = zip(*([int(x) for x in t.split(",") if x] for t in frame["total"]))
    return pd.DataFrame({"part": frame["part"][:1], "entry": frame["entry"][:1], "mean": [",".join(str(sum(c) // n) for c in columns)]})


def encode(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error): two hex digits for each part, and the squared distances summed."""
    parts, width = len(books), sum(b.shape[1] for b in books)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(x, b) for x, b in zip(np.split(integers(matrix(batch.column("v"), width)), parts, axis=1), books)]
            codes = ["".join(f"{e:02x}" for e in row) for row in zip(*(f.tolist() for f, _ in found))]
            errors = [sum(map(int, row)) for row in zip(*(e.tolist() for _, e in found))]
            errors = pa.array([e if e <= LONGEST else None for e in errors], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), errors], ["vec_id", "label", "code", "error"])

    types = dict(rows.dtypes)
    return rows.mapInArrow(build, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the error summed over equal labels. Both sides of the join have a shuffle of their own, so AQE splits a hot label."""
    total = F.expr("try_cast(sum(cast(error as decimal(38,0))) as long)")
    sums = coded.groupBy("label").agg(F.when(F.count("error") == F.count("*"), total).alias("label_error"))
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("null"))
    sums = sums.select(key.alias("_key"), "label_error")
    return coded.withColumn("_key", key).join(sums, "_key").drop("_key")


def op12_vector_codes(vectors: DataFrame) -> DataFrame:
    rows = written(kept(vectors), "vectors")
    books = fit(rows, parts=4, entries=256, rounds=4)
    coded = with_label_error(written(encode(rows, books), "codes"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _floored(total: str, n: str) -> str:
    return f"(({total}) - ((({total}) % {n}) + {n}) % {n}) // {n}"


def _square(a: str, b: str) -> str:
    return f"CAST(list_inner_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])) AS BIGINT)"


def _op12_sql() -> str:
    """Four rounds written out; the nearest entry and its distance come from the least of distance * 256 + number."""
    steps = [
        """kept AS (SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        "parts AS (SELECT row_number() OVER () AS r, vec_id, label, v FROM kept)",
        "cells AS MATERIALIZED (SELECT r, vec_id, label, p, list_slice(v, p * len(v) // 4 + 1, (p + 1) * len(v) // 4) AS x FROM parts, range(4) t(p))",
        "b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM cells QUALIFY e < 256)",
    ]
    for k in range(5):
        steps.append(
            f"""a{k} AS MATERIALIZED (SELECT r, p, any_value(x) AS x, min(({_square('x', 'x')} + {_square('c', 'c')} - 2 * {_square('x', 'c')}) * 256 + e) AS k
            FROM cells JOIN b{k} USING (p) GROUP BY r, p)"""
        )
        if k < 4:
            steps.append(
                f"""m{k} AS (SELECT p, e, list(m ORDER BY j) AS c FROM (SELECT p, e, j, {_floored('sum(y)', 'count(*)')} AS m FROM (
                SELECT p, k % 256 AS e, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM a{k}) GROUP BY p, e, j) GROUP BY p, e)"""
            )
            steps.append(f"b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN m{k} USING (p, e))")
    steps.append("coded AS (SELECT r, string_agg(printf('%02x', CAST(k % 256 AS INT)), '' ORDER BY p) AS code, CAST(sum(k // 256) AS BIGINT) AS error FROM a4 GROUP BY r)")
    steps.append("books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM b4)")
    return f"""WITH {', '.join(steps)}
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
    FROM coded JOIN parts USING (r), books"""


OP12_SQL = _op12_sql()
