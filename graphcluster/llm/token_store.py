"""Operator 3: token ids in compressed binary blocks with an offset index.

``write_store`` encodes each text with the tokenizers library, appends an end
id, compresses every document by itself with one shared zstandard dictionary
trained on serialized id arrays, and writes blocks of documents in ascending
``doc_id`` order.  A block row holds the concatenated frames, the dictionary's
hash, and an index (document ids, frame offsets, id counts), so one short
document is read by finding its block and inflating its frame alone
(``read_document``).  ``read_store`` reads a whole store back.

The container is Parquet: Spark's committer makes the files whole or absent on
any store, and the block index columns carry the statistics that let a reader
skip to a document.  The dictionary lies beside the blocks.

``start`` (ids of all documents before a document) is a prefix sum: a block
knows its start inside its range partition, and the partitions' totals - one
number per partition - are added up when the store is opened.

Cases: null text counts as empty (the end id alone); null ``doc_id`` sorts
first; equal ids are ordered by text; other columns are not stored; an empty
table makes an empty store; a text of any length is one frame.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphcluster.llm.common import MEMOS, enter, partitions, ship
from graphcluster.llm.token_count import PATTERN

SAMPLE_DOCS = 400        #: documents that train the dictionary (expected; chosen by hash)
SAMPLE_CHARS = 8_000     #: characters of each that serve as training material
DICT_BYTES = 65_536
LEVEL = 3
BLOCK_BYTES = 1 << 20    #: a block is closed beyond this size
BLOCK_DOCS = 1_000
MEMO_CHARS = 48          #: longer pieces are not remembered
MEMO_ROWS = 1_000_000     #: remembered pieces per worker; the memo is emptied beyond
JOINED = 64              #: new pieces that the library gets as one text
GROUP_BYTES = 1 << 20    #: bytes of text encoded together, at least one text

BLOCKS = ("part int, block int, start long, n_ids long, first_doc long, last_doc long, "
          "doc_ids array<long>, offsets array<long>, counts array<long>, "
          "dict_hash string, payload binary")


@cache
def finder(pattern: str = PATTERN) -> Callable[[str], list[str]]:
    """All matches of the tokenizer's pattern in a text.

    Its classes of letters, numbers and white space are written out as the characters
    of 16 bits that they hold, which Python's own ``re`` looks up in one table; a
    text with other characters is matched by ``regex``.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    plain = pattern
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        runs = regex.findall(name + "+", every)
        chars = "".join(f"\\u{ord(r[0]):04x}-\\u{ord(r[-1]):04x}" for r in runs)
        plain = plain.replace(name + "+", f"[{chars}]+").replace(name, chars)
    plain = plain.replace(r"\S", f"[^{chars}]")
    short, long = re.compile(plain).findall, regex.compile(pattern).findall
    return lambda t: short(t) if t.isascii() or len(t.encode("utf-16-le")) == 2 * len(t) else long(t)


class Encoder:
    """Ids by the tokenizers library, which is asked once for each distinct piece.

    A byte-level tokenizer encodes each match of its pattern by itself, so the
    ids of a text are those of its pieces in a row.  New pieces go to the
    library many at a time, joined by line ends (which are pieces of their own
    between others without white space).  Added tokens are cut out first, as the
    library does by default.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.added = {c: np.asarray([i], "<u4").tobytes() for c, i in added.items()}
        names = sorted(added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.line, = self.tok.encode("\n", add_special_tokens=False).ids
        self.find = finder()
        self.memo: dict[str, bytes] = {}

    def ask(self, pieces: list[str]) -> dict[str, bytes]:
        """The library's ids of distinct pieces."""
        even = [p for p in pieces if p.isprintable() and not p.isspace()]
        odd = set(pieces).difference(even)
        out = {}
        if odd:
            found = self.tok.encode_batch_fast(list(odd), add_special_tokens=False)
            out.update((p, np.asarray(e.ids, "<u4").tobytes()) for p, e in zip(odd, found))
        if even:
            found = self.tok.encode_batch_fast(
                ["\n".join(even[k:k + JOINED]) + "\n" for k in range(0, len(even), JOINED)],
                add_special_tokens=False)
            ids = np.concatenate([np.asarray(e.ids, "<u4") for e in found])
            ends = 4 * np.flatnonzero(ids == self.line)
            starts = np.concatenate([[0], ends[:-1] + 4])
            slices = map(slice, starts.tolist(), ends.tolist())
            out.update(zip(even, map(ids.tobytes().__getitem__, slices), strict=True))
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        memo, rows = self.memo, []
        for t in texts:
            parts = self.cut.split(t) if t and self.cut else [t or ""]
            pieces = self.find(parts[0])
            for k in range(1, len(parts), 2):
                pieces.append(parts[k])
                pieces += self.find(parts[k + 1])
            rows.append(pieces)
        if len(memo) > MEMO_ROWS:
            memo.clear()
        new = set().union(*rows).difference(memo)
        if new:
            here = {p: i for p, i in self.added.items() if p in new}
            here.update(self.ask([p for p in new if p not in here]))
            memo.update(here)
        out = [b"".join(map(memo.__getitem__, pieces)) for pieces in rows]
        for p in new:
            if len(p) > MEMO_CHARS:
                del memo[p]
        return out


_ENCODERS: dict[str, Encoder] = {}
MEMOS[__name__] = _ENCODERS.clear


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


@dataclass
class Dictionary:
    """Shared compression dictionary; empty when the sample can't train one."""
    data: bytes

    @property
    def hash(self) -> str:
        return xxhash.xxh64_hexdigest(self.data)

    def _zstd(self):
        return zstandard.ZstdCompressionDict(self.data) if self.data else None

    def compressor(self):
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=self._zstd())

    def decompressor(self):
        return zstandard.ZstdDecompressor(dict_data=self._zstd())


def train(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text",
          sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Dictionary:
    """Train the dictionary on a bounded sample; it changes sizes only, never ids."""
    n, cut = docs.count(), 1 << 30
    if not n:
        return Dictionary(b"")
    rate = min(cut, -(-cut * sample_docs // n))  # the expected number is sample_docs
    rows = (docs.where(F.pmod(F.xxhash64(F.lit("dictionary"), "doc_id"), F.lit(cut)) < rate)
            .select(F.substring(text, 1, sample_chars).alias("t")).orderBy("t").collect())
    code = encoder(tokenizer)
    end = np.asarray([end_id], "<u4").tobytes()
    samples = [ids + end for ids in code.encode([r["t"] for r in rows])]
    try:
        trained = zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, samples)) // 8), samples)
        return Dictionary(trained.as_bytes())
    except zstandard.ZstdError:  # too little material
        return Dictionary(b"")


def write_store(docs: DataFrame, folder: str, tokenizer: str, end_id: int,
                text: str = "text") -> None:
    """Write the token store of ``docs`` (``doc_id``, ``text``) to ``folder``."""
    spark = docs.sparkSession
    ship(spark)
    shared = train(docs, tokenizer, end_id, text)
    spark.createDataFrame([(shared.hash, shared.data)], "dict_hash string, data binary") \
        .coalesce(1).write.mode("overwrite").parquet(f"{folder}/dictionary")
    end = np.asarray([end_id], "<u4").tobytes()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        code, press = encoder(tokenizer), shared.compressor()
        part, number, start = TaskContext.get().partitionId(), 0, 0
        ids, frames, counts, size = [], [], [], 0

        def closed() -> pa.RecordBatch:
            offsets = np.cumsum([0] + [len(f) for f in frames])[:-1].tolist()
            known = [i for i in ids if i is not None]
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([number], pa.int32()),
                "start": [start], "n_ids": [sum(counts)],
                "first_doc": pa.array([known[0] if known else None], pa.int64()),
                "last_doc": pa.array([known[-1] if known else None], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())), "offsets": [offsets],
                "counts": [counts], "dict_hash": [shared.hash],
                "payload": pa.array([b"".join(frames)], pa.binary())})

        def groups():
            docs, held, size = [], [], 0
            for batch in batches:
                for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                    docs.append(doc)
                    held.append(value.as_py())
                    size += len(held[-1] or "")
                    if size >= GROUP_BYTES:
                        yield zip(docs, code.encode(held))
                        docs, held, size = [], [], 0
            yield zip(docs, code.encode(held))

        for group in groups():
            for doc, raw in group:
                raw += end
                frame = press.compress(raw)
                ids.append(doc)
                frames.append(frame)
                counts.append(len(raw) // 4)
                size += len(frame)
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    yield closed()
                    number, start = number + 1, start + sum(counts)
                    ids, frames, counts, size = [], [], [], 0
        if ids:
            yield closed()

    (docs.select("doc_id", F.col(text).alias("text"))
     .repartitionByRange(partitions(spark), "doc_id")
     .sortWithinPartitions("doc_id", "text")
     .mapInArrow(blocks, BLOCKS)
     .write.mode("overwrite").option("compression", "uncompressed").parquet(f"{folder}/blocks"))


def _dictionary(spark: SparkSession, folder: str) -> Dictionary:
    rows = spark.read.parquet(f"{folder}/dictionary").collect()  # one row of at most DICT_BYTES
    return Dictionary(bytes(rows[0]["data"]))


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of a store: doc_id, start, n_tokens, ids (packed unsigned 32-bit)."""
    ship(spark)
    shared, stored = _dictionary(spark, folder), _blocks(spark, folder)
    # one row per range partition of the writer
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    base, at = {}, 0
    for r in totals:
        base[r["part"]] = at
        at += r["n"]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate, want = shared.decompressor(), shared.hash
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_hash"] != want:
                    raise ValueError("a block was written with another dictionary")
                payload, offsets = row["payload"], row["offsets"] + [len(row["payload"])]
                ids = [inflate.decompress(payload[a:b]) for a, b in zip(offsets, offsets[1:])]
                counts = np.asarray(row["counts"], dtype=np.int64)
                if [len(x) // 4 for x in ids] != row["counts"]:
                    raise ValueError("a block's index doesn't fit its frames")
                start = base[row["part"]] + row["start"] + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_ids"], pa.int64()), "start": pa.array(start),
                    "n_tokens": pa.array(counts), "ids": pa.array(ids, pa.binary())})

    return (stored.select("part", "start", "doc_ids", "offsets", "counts", "dict_hash", "payload")
            .mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary"))


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of each row stored under ``doc_id``; reads only the blocks that can hold it."""
    shared = _dictionary(spark, folder)
    found = (_blocks(spark, folder)
             .where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
             .select("part", "block", "offsets", "doc_ids",
                     F.posexplode("doc_ids").alias("at", "doc"), "payload")
             .where(F.col("doc") == doc_id).orderBy("part", "block", "at"))
    out = []
    for r in found.collect():
        ends = list(r["offsets"]) + [len(r["payload"])]
        frame = bytes(r["payload"][ends[r["at"]]:ends[r["at"] + 1]])
        out.append(np.frombuffer(shared.decompressor().decompress(frame), "<u4").tolist())
    return out
