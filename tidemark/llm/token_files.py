"""Token ids in fixed-width bit packing.

Texts are range-partitioned by document id and sorted, encoded by a public tokenizer (vocabulary file by path, never
trained here), and packed with the minimum bits that the vocabulary needs. A file row is a segment of whole
documents: the packed ids, a byte offset for every ``BLOCK`` ids, and where each document starts. Any block, and any
document, can be unpacked with numpy alone from its offset. Spark's writer commits the files, so a lost executor's
task is repeated without a trace. Global starts need one sum per segment, then per partition.

Ids of a text are those of its white-space separated pieces in a row (for a tokenizer that lowers letters, drops white
space and never merges across it), so that pieces that come again are looked up; a piece is encoded by the tokenizers library.

Defined results: null and empty texts hold the end id only; a null id comes first; repeated ids are kept, ordered by
text; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.ngrams import forget_older
from tidemark.session import scratch

BLOCK = 1 << 13
SEGMENT = 1 << 20
MARK = b"\x01"
#: Pieces that one call encodes: the tokenizer takes longer for a piece in a longer text.
JOINED = 100
#: How a tokenizer may cut texts: letters, then marks, are words of their own then.
CUT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
CUT_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters that NFC leaves alone and that every library lowers alike.
LETTERS = re.compile("[a-zÀ-ÖØ-öø-ÿ]+")
FILE = (
    "part int, segment int, width int, n_ids long, doc_ids array<long>, doc_starts array<long>, block_offsets array<long>, payload binary"
)


def width_of(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as ``width`` bits each, most significant first. Eight ids make ``width`` bytes; the last group is padded."""
    if width % 8 == 0:  # whole bytes
        whole = np.zeros(-(-len(ids) // 8) * 8, ">u4")
        whole[: len(ids)] = ids
        return whole.view(np.uint8).reshape(-1, 4)[:, 4 - width // 8 :].tobytes()
    lanes = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(lanes), width), np.uint8)
    for byte in range(width):
        for lane in range(8 * byte // width, min(7, (8 * byte + 7) // width) + 1):
            shift = (lane + 1) * width - (byte + 1) * 8  # of the lane's last bit against the byte's
            value = lanes[:, lane] >> np.uint64(shift) if shift >= 0 else lanes[:, lane] << np.uint64(-shift)
            out[:, byte] |= (value & np.uint64(255)).astype(np.uint8)
    return out.tobytes()


def unpack(data: bytes | memoryview, width: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from position ``first``; reads only the groups of eight that hold them."""
    group, skip = divmod(first, 8)
    groups = -(-(skip + count) // 8)
    raw = np.frombuffer(data, np.uint8, groups * width, group * width).reshape(-1, width)
    if width % 8 == 0:
        whole = np.zeros((groups * 8, 4), np.uint8)
        whole[:, 4 - width // 8 :] = raw.reshape(-1, width // 8)
        return whole.view(">u4").reshape(-1).astype(np.uint32)[skip : skip + count]
    out = np.zeros((groups, 8), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for lane in range(8):
        low, high = lane * width // 8, ((lane + 1) * width - 1) // 8
        value = np.zeros(groups, np.uint64)
        for byte in range(low, high + 1):
            value = value << np.uint64(8) | raw[:, byte]
        out[:, lane] = value >> np.uint64((high + 1) * 8 - (lane + 1) * width) & mask
    return out.reshape(-1)[skip : skip + count]


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: the letter for each byte that is none itself."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in own)}


BYTE_LETTERS = byte_letters()


class Pieces(dict):
    """Ids of white-space separated pieces, as little-endian 32-bit bytes, remembered for up to ``limit`` pieces."""

    def __init__(self, path: str, limit: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core already
        from tokenizers import Tokenizer

        super().__init__()
        self.limit, self.tokenizer = limit, Tokenizer.from_file(path)
        # A byte between pieces, so that one call encodes many and its id shows where each ends. Only that byte has this id.
        found = self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        self.mark_id = found[0] if len(found) == 1 else None
        told = json.loads(self.tokenizer.to_str())
        cut = (told["normalizer"] or {}).get("normalizers") == NORMAL and (told["pre_tokenizer"] or {}).get("pretokenizers") == [CUT, CUT_BYTES]
        self.model = self.tokenizer.model if cut and told["model"]["type"] == "BPE" else None

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size()

    def learn(self, pieces: set[bytes]) -> None:
        new = list(pieces.difference(self))
        if len(self) + len(new) > self.limit:
            # Older pieces go, but for those of these texts.
            held = {p: self[p] for p in pieces.difference(new)}
            forget_older(self)
            self.update(held)
        if self.model is not None:
            new = [p for p in new if not self.learn_letters(p)]
        if self.mark_id is not None:
            plain = [p for p in new if MARK not in p]
            new = [p for p in new if MARK in p]
            for at in range(0, len(plain), JOINED):
                self.learn_joined(plain[at : at + JOINED])
        for at in range(0, len(new), 1000):
            some = new[at : at + 1000]
            for piece, got in zip(some, self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)):
                self[piece] = np.array(got.ids, "<u4").tobytes()

    def learn_letters(self, piece: bytes) -> bool:
        """Whether the piece is letters with or without marks after them, and then its ids."""
        letters = piece.rstrip(MARKS)
        if not LETTERS.fullmatch(letters.decode()):
            return False
        for word in (letters, piece[len(letters) :]):
            if word and word not in self:
                self[word] = self.word(word.decode().lower())
        if len(letters) < len(piece):
            self[piece] = self[letters] + self[piece[len(letters) :]]
        return True

    def word(self, word: str) -> bytes:
        """The model's ids of one word, which it takes with a letter for each byte."""
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()

    def learn_joined(self, some: list[bytes]) -> None:
        joined = (b" " + MARK + b" ").join(some).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        marks = np.flatnonzero(ids == self.mark_id) * 4
        if len(marks) != len(some) - 1:
            raise ValueError("the tokenizer does not keep the mark apart")
        data = ids.tobytes()
        ends = [*marks.tolist(), len(data)]
        begins = [0, *(marks + 4).tolist()]
        self.update((piece, data[b:e]) for piece, b, e in zip(some, begins, ends))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [pieces_of(t) for t in texts]
        self.learn(set().union(*split))
        get = self.__getitem__
        return [np.frombuffer(b"".join(map(get, pieces)), "<u4") for pieces in split]


def pieces_of(text: str | None) -> list[bytes]:
    """White-space separated pieces. A tokenizer that lowers its input gets fewer of them with A-Z lowered before;
    where a control token may be spelled, case is left to it."""
    data = (text or "").encode()
    return (data if b"<|" in data else data.lower()).split()


@lru_cache(maxsize=1)
def pieces_at(path: str) -> Pieces:
    """One per Python worker: its tasks follow each other and share what is remembered."""
    return Pieces(path)


def segments(path: str, end_id: int):
    """The task that packs a sorted partition; texts go to the tokenizer a few megabytes at a time."""

    def build(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = pieces_at(path)
        width = width_of(max(pieces.vocabulary, end_id + 1))
        docs: list[tuple[int | None, np.ndarray]] = []
        held = number = 0

        def flush() -> pd.DataFrame:
            nonlocal docs, held, number
            lengths = np.array([len(i) for _, i in docs])
            payload = pack(np.concatenate([i for _, i in docs]), width)
            row = (part, number, width, held, [d for d, _ in docs], (np.cumsum(lengths) - lengths).tolist(),
                   list(range(0, len(payload), BLOCK * width // 8)), payload)
            docs, held, number = [], 0, number + 1
            return pd.DataFrame([row], columns=[c.split()[0] for c in FILE.split(", ")])

        for frame in rows:
            for some in chunks(frame):
                part = int(some["part"].iloc[0])
                for doc, ids in zip(some["doc_id"], pieces.encode(some["text"].tolist())):
                    docs.append((None if pd.isna(doc) else int(doc), np.append(ids, np.uint32(end_id))))
                    held += len(ids) + 1
                    if held >= SEGMENT:
                        yield flush()
        if docs:
            yield flush()

    return build


def chunks(frame: pd.DataFrame, size: int = 1 << 22) -> Iterator[pd.DataFrame]:
    """Consecutive rows with about ``size`` characters at most; a longer text stands alone."""
    at = frame["text"].str.len().fillna(0).cumsum() // size
    for _, some in frame.groupby(at.to_numpy(), sort=True):
        yield some


def write_tokens(docs: DataFrame, tokenizer: str, out: str, end_id: int = 1) -> None:
    rows = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id", "text")
    rows.withColumn("part", F.spark_partition_id()).mapInPandas(segments(tokenizer, end_id), FILE).write.parquet(out)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of each document with this id, unpacked from the blocks that hold it. Segments without it are passed over by
    Spark; of the others, only the bytes from the first to the last such block leave the payload."""
    files = spark.read.schema(FILE).parquet(path).where(F.array_contains("doc_ids", F.lit(doc_id).cast("long")))
    at = F.posexplode(F.transform("doc_ids", lambda d: d.eqNullSafe(F.lit(doc_id)))).alias("nth", "same")
    found = files.select("part", "segment", "width", "n_ids", "doc_starts", "block_offsets", "payload", at).where("same")
    first = F.col("doc_starts")[F.col("nth")]
    after = F.coalesce(F.get("doc_starts", F.col("nth") + 1), F.col("n_ids"))
    low, high = F.floor(first / BLOCK).cast("int"), F.floor((after - 1) / BLOCK).cast("int") + 1
    begin = F.get("block_offsets", low)
    end = F.coalesce(F.get("block_offsets", high), F.length("payload").cast("long"))
    cut = F.substring("payload", (begin + 1).cast("int"), (end - begin).cast("int"))
    rows = found.select("part", "segment", "nth", "width", (first - low * BLOCK).alias("skip"), (after - first).alias("n"), cut.alias("bytes"))
    return [unpack(bytes(r["bytes"]), r["width"], r["skip"], r["n"]) for r in rows.orderBy("part", "segment", "nth").collect()]


def read_documents(spark: SparkSession, path: str, each, schema: str) -> DataFrame:
    """Unpack every document of the files and apply ``each(ids) -> tuple``; with doc_id, start, n_tokens and the
    columns of ``schema``."""

    def build(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for r in frame.itertuples(index=False):
                ends = [*r.doc_starts[1:], r.n_ids]
                ids = unpack(r.payload, r.width, 0, r.n_ids)  # whole segments are read: one call, documents are slices
                out = [(r.part, r.segment, d, s, e - s, *each(ids[s:e])) for d, s, e in zip(r.doc_ids, r.doc_starts, ends)]
                yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    schema = f"part int, segment int, doc_id long, local long, n_tokens long, {schema}"
    names = [c.split()[0] for c in schema.split(", ")]
    files = spark.read.schema(FILE).parquet(path)
    # One sum per segment: first within each partition, then over the partitions.
    by_part = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    parts = by_part.select("part", (F.sum("ids").over(W.orderBy("part")) - F.col("ids")).alias("before"))
    within = F.sum("n_ids").over(W.partitionBy("part").orderBy("segment")) - F.col("n_ids")
    starts = files.select("part", "segment", within.alias("within")).join(parts, "part")
    starts = starts.select("part", "segment", (F.col("before") + F.col("within")).alias("base"))
    read = files.select("part", "segment", "width", "n_ids", "doc_ids", "doc_starts", "payload").mapInPandas(build, schema)
    out = read.join(starts, ["part", "segment"]).withColumn("start", F.col("base") + F.col("local"))
    return out.select("doc_id", "start", *names[4:])


def op4_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    write_tokens(docs, tokenizer, path)
    return read_documents(spark, path, lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),), "ids_crc32 long")
