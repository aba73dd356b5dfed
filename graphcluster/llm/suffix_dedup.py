"""Operator 9: remove repeated byte strings by two-stage suffix sorting.

A byte is removed if a string of ``length`` bytes that covers it also starts in
a document with a smaller id.  The work is cut so that equal windows (strings of
that length) meet in one task and everything else stays apart:

1. *Texts.*  Equal texts are one text with the smallest of their ids; the others
   are covered by it as a whole.
2. *Anchors.*  A window's anchor is the least hash of its k-grams, so equal
   windows have equal anchors, and neighbouring windows mostly share one.
   Anchors are dealt to blocks, and those of two texts at least return to them.
3. *Contexts.*  A run of windows with one shared anchor is a context; the bytes
   of equal contexts of a batch are sent once, with the smallest id.  The places
   where they occur are kept in the row that was sent, by its number.
   An anchor with more than ``GROUP`` different contexts is *wide*: the windows at
   the edge of a shared passage hold some of the text around it, so each document
   brings its own context.  The bytes of such runs are set aside when the texts pass
   (*pieces*, a small part of a text), so texts aren't shuffled again for them.  Their
   windows get their own hash as anchor, and only those that two texts have are sent,
   each as a context of its own.
4. *Suffix arrays.*  The contexts of an anchor are sorted together (see
   ``suffix_array``); adjacent common prefixes give the groups of equal windows
   and each group's smallest id.
5. The verdicts return to the rows that asked, whose places become spans, and
   the spans of a document are united.

A passage that a third of all documents share is sent once per batch and anchor;
its places never leave their rows, whose size is bounded.

Cases: a null text counts as empty and loses nothing; texts shorter than a
window lose nothing; a null id is neither smaller nor larger than any (nothing
is removed there, and it removes nothing); rows with equal ids don't remove one
another's bytes; other columns pass through (those named like an output are
replaced); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField

from graphcluster.llm import blobs
from graphcluster.llm.common import Table, arrow_map, enter, free_shuffles, partitions, ship
from graphcluster.llm.suffix_array import equal_windows

LENGTH = 50            #: bytes of a window
GRAM = 20              #: bytes of the k-grams that anchors are chosen from
SCAN_BYTES = 1 << 18   #: bytes hashed at once, at least one text
FLUSH_BYTES = 8 << 20   #: bytes of contexts that a task holds before it sends them
CHUNK_BYTES = 1 << 20  #: bytes of contexts sorted at once, at least one anchor
GROUP = 1024           #: different contexts of an anchor that are sorted together; beyond, windows part by their own hash

PIECES = ("piece_owner", "piece_doc", "piece_start", "piece_size", "piece_bytes")
CONTEXTS = ("row long, bucket long, anchor binary, low binary, size binary, bytes binary, "
            "place binary, text binary, start binary, doc binary, owner binary, "
            "piece_owner long, piece_doc long, piece_start binary, piece_size binary, piece_bytes binary")


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    return np.random.default_rng(9).integers(0, 1 << 63, 256, dtype=np.uint64)


def _power(e: int) -> np.uint64:
    return np.uint64(pow(6364136223846793005, e, 1 << 64))


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """The hash of each k-gram."""
    n = len(raw)
    blocks, width = {1: _table()[raw]}, 1
    while 2 * width <= gram:
        a = blocks[width]
        blocks[2 * width] = a[:-width] + a[width:] * _power(width)
        width *= 2
    h, at = np.zeros(n - gram + 1, dtype=np.uint64), 0
    for width in sorted(blocks, reverse=True):
        if gram - at >= width:
            h += blocks[width][at:at + len(h)] * _power(at)
            at += width
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def least_hashes(h: np.ndarray, span: int) -> np.ndarray:
    """For each window of ``span`` k-grams, the least of their hashes."""
    width = 1
    while 2 * width <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[:len(h) - (span - width)], h[span - width:]) if span > width else h


def signed_runs(texts: list[bytes], length: int, gram: int
                ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text with a window: its number, and of its runs of windows with
    one anchor the first window, the last window, the anchor, and a sign of the
    run's bytes (from the sum of its k-grams' hashes)."""
    todo, size, span = [], 0, length - gram + 1
    for i, t in enumerate([*texts, None]):
        if t is not None and len(t) >= length:
            todo.append(i)
            size += len(t)
        if todo and (t is None or size >= SCAN_BYTES):
            h = gram_hashes(np.frombuffer(b"".join(texts[k] for k in todo), np.uint8), gram)
            low = least_hashes(h, span)
            total = np.concatenate([[np.uint64(0)], np.cumsum(h, dtype=np.uint64)])
            at = 0
            for k in todo:
                own = low[at:at + len(texts[k]) - length + 1]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                last = np.append(first[1:], len(own)) - 1
                sign = (total[at + last + span] - total[at + first]) >> np.uint64(32)
                at += len(texts[k])
                yield k, first, last, own[first], sign.astype(np.uint32)
            todo, size = [], 0


def runs(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``signed_runs`` without the signs."""
    for run in signed_runs(texts, length, gram):
        yield run[:4]


def pieces_of(raw: bytes, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Some runs of windows of a text, neighbours joined: where each piece starts, its size, and the bytes of all."""
    new = np.append(True, first[1:] != last[:-1] + 1)
    start = first[new]
    end = last[np.append(new[1:], True)] + length
    return start, end - start, b"".join(raw[i:j] for i, j in zip(start.tolist(), end.tolist()))


def windows_of(data: bytes, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of pieces: where each stands in the bytes, the number of its piece, and its hash."""
    count = size - length + 1
    piece = np.repeat(np.arange(len(size)), count)
    at = np.arange(len(piece)) + piece * (length - 1)  # a piece's last bytes start no window
    return at, piece, gram_hashes(np.frombuffer(data, np.uint8), length)[at]


def among(known: pa.Scalar, h: np.ndarray) -> np.ndarray:
    """Which hashes are in a sorted list of them."""
    if not known.is_valid:
        return np.zeros(len(h), bool)
    values = np.frombuffer(known.as_buffer(), np.uint64)
    if not len(values):
        return np.zeros(len(h), bool)
    at = np.searchsorted(values, h)
    at[at == len(values)] = 0
    return values[at] == h


def text_id(raw: bytes) -> int:
    return int.from_bytes(hashlib.sha256(raw).digest()[:8], "big", signed=True)


def _anchors(keys: list[int], length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        pack, sent = blobs.Packer(keys), set()
        for b in batches:
            texts, ids = [], []
            for t in b.column(0):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                own = text_id(raw) if len(raw) >= length else None
                if own is not None and own not in sent:  # a copy has the same anchors
                    if len(sent) < 1_000_000:
                        sent.add(own)
                    texts.append(raw)
                    ids.append(own)
            for k, _, _, anchor, sign in signed_runs(texts, length, gram):
                pack.add(ids[k], 0, anchor, sign)
                if pack.held >= blobs.FLUSH:
                    yield from pack.rows()
        yield from pack.rows()
    return run


def _windows(keys: list[int], length: int):
    """The hashes of the windows of the pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        pack = blobs.Packer(keys)
        for b in batches:
            for owner, size, data in zip(*(b.column(c) for c in ("piece_owner", "piece_size", "piece_bytes"))):
                _, _, h = windows_of(data.as_buffer().to_pybytes(), np.frombuffer(size.as_buffer(), np.int64), length)
                pack.add(owner.as_py(), 0, h, np.zeros(len(h), np.uint32))
                if pack.held >= blobs.FLUSH:
                    yield from pack.rows()
        yield from pack.rows()
    return run


def _repeated(owner: np.ndarray, h: np.ndarray, sign: np.ndarray, most: float):
    """The anchors that two texts have at least, each pair of anchor and text once,
    and whether the anchor is wide."""
    order = np.argsort(h)
    same = h[order]
    same = same[1:] == same[:-1]
    some = np.zeros(len(h), bool)  # most anchors come once and leave here
    some[order[1:][same]] = some[order[:-1][same]] = True
    del order, same
    owner, h, sign = owner[some], h[some], sign[some]
    order = np.lexsort((owner, h))
    owner, h, sign = owner[order], h[order], sign[order]
    often = blobs.owners_of(h) > most
    times, signs = h[often], sign[often]
    order = np.lexsort((signs, times))
    times, signs = times[order], signs[order]
    new = np.ones(len(times), bool)
    new[1:] = (times[1:] != times[:-1]) | (signs[1:] != signs[:-1])
    wide, count = np.unique(times[new], return_counts=True)
    fresh = np.ones(len(h), bool)  # a text sent by several tasks counts once
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    owner, h = owner[fresh], h[fresh]
    keep = blobs.owners_of(h) > 1
    owner, h = owner[keep], h[keep]
    return owner, h, np.isin(h, wide[count > most])


def _shared(keys: list[int], most: float):
    """Anchors of two texts at least, sent to the texts' buckets; those with more
    than ``most`` different contexts are marked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, _, h, sign = blobs.unpack(batches, np.uint32)
        if not len(h):
            return
        owner, h, wide = _repeated(owner, h, sign, most)
        order = np.argsort(owner, kind="stable")
        owner, h, wide = owner[order], h[order], wide[order].astype(np.uint8)
        cuts = np.flatnonzero(np.diff(owner)) + 1
        pack, where = blobs.Packer(keys), []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(h)]):
            if b > a:
                pack.add(int(owner[a]), 0, h[a:b], wide[a:b])
                where.append(int(owner[a]) % len(keys))
        yield from pack.rows(np.asarray(where, np.int64))
    return run


def _by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    owner, _, h, wide = blobs.unpack(batches, np.uint8)
    if not len(h):
        return
    order = np.lexsort((h, wide, owner))
    owner, h, wide = owner[order], h[order], wide[order]
    first = np.flatnonzero(np.diff(owner, prepend=owner[0] ^ 1))
    ends = np.append(first[1:], len(owner))
    cuts = ends - np.add.reduceat(wide.astype(np.int64), first)
    for k in range(0, len(first), 5000):
        a, c, b = first[k:k + 5000], cuts[k:k + 5000], ends[k:k + 5000]
        yield pa.RecordBatch.from_pydict({
            "owner": pa.array(owner[a], pa.int64()),
            "anchors": pa.array([h[i:j].tobytes() for i, j in zip(a.tolist(), c.tolist())], pa.binary()),
            "wide": pa.array([h[i:j].tobytes() if j > i else None for i, j in zip(c.tolist(), b.tolist())], pa.binary())})


BY_TEXT = "owner long, anchors binary, wide binary"


class _Contexts:
    """Contexts and their places, sent as one row per bucket, and pieces, a row for each text.

    Rows are numbered from 0 up, or (``second``) from -1 down, so that two tables of them go together."""

    def __init__(self, keys: list[int], second: bool = False):
        self.keys, self.count = keys, 0
        part = TaskContext.get().partitionId()
        self.base = ~part << 32 if second else part << 32
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.anchor, self.low = array("Q"), array("q")    # of each context
        self.place, self.text, self.start = array("q"), array("q"), array("q")  # of each place
        self.doc, self.owner = array("q"), array("q")     # of each text
        self.pieces: list[tuple] = []
        self.held = 0

    def set_aside(self, doc: int, owner: int, start: np.ndarray, size: np.ndarray, data: bytes) -> None:
        self.pieces.append((owner, doc, start.astype(np.int64).tobytes(), size.astype(np.int64).tobytes(), data))
        self.held += len(data)

    def add(self, doc: int, owner: int, raw: bytes, first: np.ndarray, last: np.ndarray, anchor: np.ndarray,
            length: int, start: np.ndarray | None = None) -> None:
        """Runs of windows in ``raw``; ``start``: where they start in the text, if elsewhere."""
        number, mine = self.number, len(self.doc)
        self.doc.append(doc)
        self.owner.append(owner)
        start = first if start is None else start
        for a, b, h, at in zip(first.tolist(), last.tolist(), anchor.tolist(), start.tolist()):
            data = raw[a:b + length]
            k = number.get(data)
            if k is None:
                k = number[data] = len(number)
                self.anchor.append(h)
                self.low.append(doc)
                self.held += len(data)
            elif doc < self.low[k]:
                self.low[k] = doc
            self.place.append(k)
            self.text.append(mine)
            self.start.append(at)
        self.held += 8 * len(first)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.pieces:
            n = len(self.pieces)
            made = {"row": [-1] * n, "bucket": pa.nulls(n, pa.int64())}
            made |= dict.fromkeys(("anchor", "low", "size", "bytes", "place", "text", "start", "doc", "owner"), [b""] * n)
            yield pa.RecordBatch.from_pydict(made | dict(zip(PIECES, map(list, zip(*self.pieces)))))
        if not self.number:
            self.clear()
            return
        strings = list(self.number)
        anchor, low = np.array(self.anchor, np.uint64), np.array(self.low, np.int64)
        place, text, start = (np.array(self.place, np.int64), np.array(self.text, np.int64),
                              np.array(self.start, np.uint32))
        doc, owner = np.array(self.doc, np.int64), np.array(self.owner, np.int64)
        self.clear()
        bucket = blobs.bucket_of(anchor, len(self.keys))
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        place = rank[place]  # numbers in bucket order
        by = np.argsort(place, kind="stable")
        place, text, start = place[by], text[by], start[by]
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(order)]):
            own = order[a:b]
            i, j = np.searchsorted(place, [a, b])
            used, mine = np.unique(text[i:j], return_inverse=True)
            parts = [strings[k] for k in own.tolist()]
            yield pa.RecordBatch.from_pydict({
                "row": [self.base + self.count], "bucket": [self.keys[bucket[own[0]]]],
                "anchor": [anchor[own].tobytes()], "low": [low[own].tobytes()],
                "size": [np.fromiter(map(len, parts), np.uint32, len(parts)).tobytes()], "bytes": [b"".join(parts)],
                "place": [(place[i:j] - a).astype(np.uint32).tobytes()],
                "text": [mine.astype(np.uint32).tobytes()], "start": [start[i:j].tobytes()],
                "doc": [doc[used].tobytes()], "owner": [owner[used].tobytes()],
                **{c: pa.nulls(1, pa.int64() if c in PIECES[:2] else pa.binary()) for c in PIECES}})
            self.count += 1


def _contexts(keys: list[int], length: int, gram: int):
    """The contexts of the shared anchors, and the pieces of the wide ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        out = _Contexts(keys)
        for b in batches:
            texts = [t.as_buffer().to_pybytes() for t in b.column("text")]
            docs = b.column("doc_id").to_pylist()
            anchors, wide = b.column("anchors"), b.column("wide")
            for k, first, last, anchor in runs(texts, length, gram):
                owner = text_id(texts[k])
                hit = among(anchors[k], anchor)
                out.add(docs[k], owner, texts[k], first[hit], last[hit], anchor[hit], length)
                hit = among(wide[k], anchor)
                if hit.any():
                    out.set_aside(docs[k], owner, *pieces_of(texts[k], first[hit], last[hit], length))
                if out.held >= FLUSH_BYTES:
                    yield from out.rows()
        yield from out.rows()
    return run


def _windows_as_contexts(keys: list[int], length: int):
    """The windows of the pieces that two texts have, each as a context of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        out = _Contexts(keys, second=True)
        for b in batches:
            for owner, doc, start, size, data, known in zip(*(b.column(c) for c in (*PIECES, "anchors"))):
                raw = data.as_buffer().to_pybytes()
                start, size = (np.frombuffer(x.as_buffer(), np.int64) for x in (start, size))
                at, piece, h = windows_of(raw, size, length)
                begin = np.cumsum(size) - size
                own = among(known, h)
                at, piece, h = at[own], piece[own], h[own]
                out.add(doc.as_py(), owner.as_py(), raw, at, at, h, length, start[piece] + at - begin[piece])
                if out.held >= FLUSH_BYTES:
                    yield from out.rows()
        yield from out.rows()
    return run


def _verdicts(length: int):
    """Per row and context: runs of windows (first, count) and the smallest id that has them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        rows, anchors, lows, sizes, data = [], [], [], [], []
        for b in batches:
            rows += b.column("row").to_pylist()
            for name, kind, to in (("anchor", np.uint64, anchors), ("low", np.int64, lows), ("size", np.uint32, sizes)):
                to += [np.frombuffer(x.as_buffer(), kind) for x in b.column(name)]
            data += [x.as_buffer() for x in b.column("bytes")]
        if not rows:
            return
        count = [len(a) for a in anchors]
        base = np.cumsum([0, *count])
        anchor, low, size = np.concatenate(anchors), np.concatenate(lows), np.concatenate(sizes).astype(np.int64)
        row = np.repeat(np.arange(len(rows)), count)
        offset = np.concatenate([np.cumsum(s, dtype=np.int64) - s for s in sizes])
        order = np.argsort(anchor, kind="stable")
        found: list[tuple | None] = [None] * len(anchor)  # of each context: firsts, counts, ids
        strings: dict[bytes, int] = {}
        least: list[int] = []
        users: list[list[int]] = []
        held, last = 0, None

        def solve():
            owner, group = equal_windows(list(strings), length)
            ids = np.array(least, np.int64)[owner]
            smallest = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(smallest, group, ids)
            low_of = smallest[group]
            new = np.ones(len(owner), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (low_of[1:] != low_of[:-1])
            first = np.flatnonzero(new)
            width = np.diff(np.append(first, len(owner)))
            begin = np.searchsorted(owner, np.arange(len(strings)))
            cut = np.searchsorted(owner[first], np.arange(len(strings) + 1))
            for k, contexts in enumerate(users):
                a, b = cut[k], cut[k + 1]
                answer = (first[a:b] - begin[k], width[a:b], low_of[first[a:b]])
                for c in contexts:
                    found[c] = answer

        for c in order.tolist():
            if anchor[c] != last:
                if held >= CHUNK_BYTES:
                    solve()
                    strings, least, users, held = {}, [], [], 0
                last = anchor[c]
            i = int(offset[c])
            text = data[row[c]][i:i + int(size[c])].to_pybytes()
            k = strings.get(text)
            if k is None:
                strings[text] = len(least)
                least.append(int(low[c]))
                users.append([c])
                held += len(text)
            else:
                users[k].append(c)
                least[k] = min(least[k], int(low[c]))
        solve()
        for r, number in enumerate(rows):
            own = found[base[r]:base[r + 1]]
            yield pa.RecordBatch.from_pydict({
                "row": [number],
                "runs": [np.fromiter((len(x[0]) for x in own), np.uint32, len(own)).tobytes()],
                "first": [np.concatenate([x[0] for x in own]).astype(np.uint32).tobytes()],
                "width": [np.concatenate([x[1] for x in own]).astype(np.uint32).tobytes()],
                "low": [np.concatenate([x[2] for x in own]).astype(np.int64).tobytes()]})
    return run


def _spans(keys: list[int], length: int):
    """The removed spans at the places of each row, sent to the texts' buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, where = blobs.Packer(keys), []
        for b in batches:
            for r in zip(*(b.column(c) for c in (
                    "runs", "first", "width", "low", "place", "text", "start", "doc", "owner"))):
                per, first, width, low, place, text, start, doc, owner = (
                    np.frombuffer(x.as_buffer(), k) for x, k in zip(r, (
                        np.uint32, np.uint32, np.uint32, np.int64, np.uint32, np.uint32, np.uint32,
                        np.int64, np.int64)))
                begin = np.cumsum(per, dtype=np.int64) - per
                n = per[place].astype(np.int64)
                use = np.repeat(np.arange(len(place)), n)
                k = np.arange(len(use)) - np.repeat(np.cumsum(n) - n, n) + begin[place][use]
                hit = low[k] < doc[text[use]]
                use, k = use[hit], k[hit]
                a = start[use].astype(np.uint64) + first[k].astype(np.uint64)
                span = (a << np.uint64(32)) | (a + width[k].astype(np.uint64) + np.uint64(length - 1))
                owner = owner[text[use]]
                order = np.argsort(owner, kind="stable")
                owner, span = owner[order], span[order]
                cuts = np.flatnonzero(np.diff(owner)) + 1
                for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(owner)]):
                    if j > i:
                        pack.add(int(owner[i]), 0, span[i:j])
                        where.append(int(owner[i]) % len(keys))
                if pack.held >= blobs.FLUSH // 4:
                    yield from pack.rows(np.asarray(where, np.int64))
                    where = []
        yield from pack.rows(np.asarray(where, np.int64))
    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The union of each text's spans."""
    owner, _, span, _ = blobs.unpack(batches)
    if not len(span):
        return
    order = np.lexsort((span, owner))
    owner, span = owner[order], span[order]
    first = np.flatnonzero(np.diff(owner, prepend=owner[0] ^ 1))
    ends = np.append(first[1:], len(owner))
    ids, out = [], []
    for i, j in zip(first.tolist(), ends.tolist()):
        a, b = (span[i:j] >> np.uint64(32)).astype(np.int64), (span[i:j] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        reach = np.maximum.accumulate(b)
        new = np.ones(len(a), bool)
        new[1:] = a[1:] > reach[:-1]  # touching spans are one run
        at = np.flatnonzero(new)
        ids.append(int(owner[i]))
        out.append(np.stack([a[at], reach[np.append(at[1:], len(a)) - 1]], axis=1).ravel())
        if len(ids) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                                             names=["owner", "_spans"])
            ids, out = [], []
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                                         names=["owner", "_spans"])


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
               gram: int = GRAM) -> DataFrame:
    """What to remove, one row per id and text that loses something: _id, _hash (of the
    text), _all (a document with a smaller id has this text) or else _spans, the united
    spans as ends of half-open intervals, [a0, b0, a1, b1, ...]."""
    spark = docs.sparkSession
    ship(spark)
    parts = partitions(spark)
    keys = blobs.bucket_keys(spark, parts)
    source = (docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("text"))
              .where(F.col("_id").isNotNull() & (F.octet_length("text") >= length)))
    sha = F.unhex(F.sha2("text", 256))
    ids = Table(source.select("_id", sha.alias("_hash")).distinct(), "text-ids").df
    firsts = Table(ids.groupBy(F.col("_hash").alias("_sha")).agg(F.min("_id").alias("_first")), "firsts").df

    anchors = source.select("text").mapInArrow(_anchors(keys, length, gram), blobs.SCHEMA)
    shared = blobs.dealt(anchors, parts).mapInArrow(_shared(keys, GROUP), blobs.SCHEMA)
    by_text = Table(blobs.dealt(shared, parts).mapInArrow(_by_text, BY_TEXT), "anchors")
    free_shuffles(spark)

    owner = F.conv(F.hex(F.substring("_sha", 1, 8)), 16, -10).cast("long")
    owned = firsts.withColumn("_owner", owner)
    wanted = owned.join(by_text.df, F.col("_owner") == F.col("owner")).select(
        F.col("_first").alias("_id"), "_sha", "anchors", "wide")
    texts = source.join(wanted, "_id").where(sha == F.col("_sha")).select(
        F.col("_id").alias("doc_id"), "text", "anchors", "wide")
    narrow = Table(texts.mapInArrow(_contexts(keys, length, gram), CONTEXTS), "contexts", None, "zstd")
    by_text.drop()
    free_shuffles(spark)

    pieces = narrow.df.where("piece_owner is not null").select(*PIECES)
    windows = pieces.mapInArrow(_windows(keys, length), blobs.SCHEMA)
    shared = blobs.dealt(windows, parts).mapInArrow(_shared(keys, math.inf), blobs.SCHEMA)
    by_window = blobs.dealt(shared, parts).mapInArrow(_by_text, BY_TEXT)
    split = Table(pieces.join(by_window, F.col("piece_owner") == F.col("owner")).select(*PIECES, "anchors")
                  .mapInArrow(_windows_as_contexts(keys, length), CONTEXTS), "contexts", None, "zstd")
    free_shuffles(spark)

    contexts = narrow.df.where("bucket is not null").union(split.df)
    verdicts = Table(blobs.dealt(contexts.select("row", "bucket", "anchor", "low", "size", "bytes"), parts)
                     .mapInArrow(_verdicts(length), "row long, runs binary, first binary, width binary, low binary"),
                     "verdicts", None, "zstd")
    free_shuffles(spark)
    places = contexts.select("row", "place", "text", "start", "doc", "owner").join(verdicts.df, "row")
    spans = Table(blobs.dealt(places.mapInArrow(_spans(keys, length), blobs.SCHEMA), parts)
                  .mapInArrow(_united, "owner long, _spans array<long>"), "spans").df
    narrow.drop()
    split.drop()
    verdicts.drop()
    copies = ids.join(firsts, F.col("_hash") == F.col("_sha")).where(F.col("_id") > F.col("_first"))
    cut = owned.join(spans, F.col("_owner") == F.col("owner"))
    plan = Table(copies.select("_id", "_hash", F.lit(True).alias("_all"), F.lit(None).cast("array<long>").alias("_spans"))
                 .union(cut.select(F.col("_first"), F.col("_sha"), F.lit(False), "_spans")), "removal-plan").df
    free_shuffles(spark)
    return plan


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   gram: int = GRAM) -> DataFrame:
    """Append n_bytes, n_removed, n_spans and kept (the remaining bytes)."""
    return _removed(docs, key, text, length, gram, StructField("kept", BinaryType(), False))


def _removed(docs: DataFrame, key: str, text: str, length: int, gram: int, left: StructField) -> DataFrame:
    plan = find_spans(docs, key, text, length, gram).select(
        F.col("_id").alias("_pid"), F.col("_hash").alias("_phash"), "_all", "_spans")
    outputs = {"n_bytes", "n_removed", "n_spans", left.name}
    columns = [c for c in docs.columns if c.lower() not in outputs]
    rows = (docs.select(*columns).withColumn("_id", F.col(key).cast("long"))
            .withColumn("_hash", F.when(F.octet_length(text) >= length, F.unhex(F.sha2(text, 256)))))
    joined = rows.join(plan, (F.col("_id") == F.col("_pid")) & (F.col("_hash") == F.col("_phash")), "left")
    return _cut(joined, columns, text, left)


def _cut(joined: DataFrame, columns: list[str], text: str, left: StructField) -> DataFrame:
    """Append the counts and what is left, as bytes or (whole characters only) as text."""
    as_text = isinstance(left.dataType, StringType)

    def cut(texts: pa.Array, spans: pa.Array, whole: pa.Array) -> list:
        out: list[list] = [[], [], [], []]
        for t, s, w in zip(texts, spans, whole.to_pylist()):
            raw = t.as_buffer().to_pybytes() if t.is_valid else b""
            ends = [0, len(raw)] if w else s.as_py() or []
            kept, at, gone = [], 0, 0
            for a, b in zip(ends[::2], ends[1::2]):
                kept.append(raw[at:a])
                gone += b - a
                at = b
            kept.append(raw[at:])
            rest = b"".join(kept)
            for o, v in zip(out, (len(raw), gone, len(ends) // 2,
                                  rest.decode("utf-8", errors="ignore") if as_text else rest)):
                o.append(v)
        return out

    made = arrow_map(joined.select(*columns, "_spans", "_all"), [text, "_spans", "_all"],
                     [StructField("n_bytes", LongType(), False), StructField("n_removed", LongType(), False),
                      StructField("n_spans", LongType(), False), left], cut)
    return made.select(*columns, "n_bytes", "n_removed", "n_spans", left.name)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str = "n_chars",
                    length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The documents with what remains of their texts.

    A character of which a byte was removed goes as a whole.  A document of
    which something was removed and no word remains is dropped.
    """
    columns = docs.columns
    rest = F.struct(*[c for c in columns if c != text])  # out of the way of the outputs' names
    made = _removed(docs.select(key, text, rest.alias("_rest")), key, text, length, gram,
                    StructField("_left", StringType(), False))
    touched = F.col("n_removed") > 0
    made = made.where(~touched | F.col("_left").rlike(r"[^\x20\x09-\x0D]"))
    out = {c: F.col("_rest")[c] for c in columns if c != text}
    out[text] = F.when(touched, F.col("_left")).otherwise(F.col(text))
    if n_chars in columns:
        out[n_chars] = F.when(touched, F.length("_left").cast(docs.schema[n_chars].dataType)).otherwise(out[n_chars])
    return made.select(*[out[c].alias(c) for c in columns])
