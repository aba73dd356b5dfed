"""Operator 13: source divergence audit by a minimal-perfect-hash recount.

How far the word use of a source is from that of the other sources of its language:

1. *Exact frequency filtering.*  Tasks count in how many documents of a language a
   term comes; the counts are added by (language, term) and terms in at least
   ``min_docs`` documents are kept.
2. *Perfect hashes.*  The kept terms of a language are dealt to shards by hash.  A
   task builds a minimal perfect hash for a shard: levels of bit maps, where a term
   takes a bit that it alone hashes to and the others go on to the next level; a
   term's slot is the rank of its bit.  The terms are stored in slot order.
3. *Recount.*  The shards are broadcast, as many at once as ``BROADCAST_BYTES`` hold
   (beyond, the documents are read again for the next ones: nothing is left out and
   a broadcast never grows with the corpus).  A task looks the terms of its
   documents up, compares each with the stored term (a term that wasn't kept also
   hashes to some slot) and increments dense slots of its (language, source) group.
   What it has counted leaves as one packed row per group and shard.
4. *Audit.*  Rows are added by group and shard.  With each group's total, a shard's
   slots of all sources of a language give every kept term's share
   p = 1 + floor(scale * (count + alpha) / (total + alpha * V)) as exact integers;
   the sums of differences of sources and the most overused terms follow.

A shard holds so few terms that the slots of all sources of its language take
``SHARD_BYTES`` at most, so no task gathers more, however many sources there are.
The result has a row for each two sources of a language, as it must; they are made
per shard from matrices and never as rows of a join.

Cases: null text, language and source count as ''; a text without terms still makes
its (language, source) a group; a language without kept terms gives pairs of value
0; a language with one source gives no pair; rows are counted as often as they come
(ids aren't read); ties are ranked by item; long texts are cut at term ends into
pieces while counting, an empty table gives an empty result; other columns, whatever
their names, aren't read.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphcluster.llm.common import Table, enter, partitions, ship

MIN_DOCS = 30              #: a kept term is in so many documents of its language at least
ALPHA = 5                  #: added to each count
SCALE = 1_000_000_000      #: shares are integers of this scale
TOP = 50                   #: overused terms of a group
HELD = 400_000             #: distinct terms that a task counts before it sends them
SHARD_TERMS = 1 << 15      #: terms of a shard, at most
SHARD_BYTES = 32 << 20     #: slots of all sources in a shard, at most
BROADCAST_BYTES = 48 << 20  #: shards that are broadcast at once, at least one
GAMMA = 2                  #: bits per term and level of a perfect hash

# A term is a run of ASCII letters and of bytes beyond ASCII (UTF-8).
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 else 32 for c in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, only A-Z lower-cased."""
    return raw.translate(TABLE).split()


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[str, str, list[memoryview]]]:
    """The texts of each (language, source) of a batch."""
    made: dict[tuple, list] = {}
    for text, lang, source in zip(batch.column("text"), batch.column("lang").to_pylist(),
                                  batch.column("source").to_pylist()):
        made.setdefault((lang or "", source or ""), []).append(text)
    for (lang, source), texts in made.items():
        yield lang, source, texts


def _raw(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n): in how many documents a term comes; term null: documents."""
    enter(__name__)
    held: dict[str, Counter] = {}
    docs: Counter = Counter()

    def rows(lang: str, count: Counter) -> Iterator[pa.RecordBatch]:
        names, n = list(count), np.fromiter(count.values(), np.int64, len(count))
        for k in range(0, len(names), 20_000):
            part = pa.array(names[k:k + 20_000], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part)), pa.nulls(len(part), pa.string()), part, pa.array(n[k:k + 20_000])],
                names=["lang", "source", "term", "n"])

    for b in batches:
        for lang, source, texts in _groups(b):
            docs[lang, source] += len(texts)
            mine = held.setdefault(lang, Counter())
            for t in texts:
                mine.update(set(terms(_raw(t))))
        if sum(map(len, held.values())) >= HELD:
            for lang, count in held.items():
                yield from rows(lang, count)
            held = {}
    for lang, count in held.items():
        yield from rows(lang, count)
    if docs:
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([k[0] for k in docs]), "source": pa.array([k[1] for k in docs]),
            "term": pa.nulls(len(docs), pa.binary()), "n": pa.array(list(docs.values()), pa.int64())})


# ---------------------------------------------------------------------------
# minimal perfect hashes

def mix(h: np.ndarray, seed: int) -> np.ndarray:
    x = h ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(names: list[bytes]) -> np.ndarray:
    """64-bit hashes, the same on every machine."""
    made = np.empty(len(names), object)
    made[:] = names
    return pd.util.hash_array(made, categorize=False) if len(names) else np.empty(0, np.uint64)


class PerfectHash:
    """A minimal perfect hash of distinct terms, with the terms in slot order.

    ``levels`` are the bit maps (as bytes, one bit per place), ``before`` the slots of
    earlier levels and words.  Terms that 40 levels can't part (equal 64-bit hashes)
    take the last slots and are found by comparing.
    """

    LEVELS = 40

    def __init__(self, names: list[bytes]):
        h, left = hashes(names), np.arange(len(names))
        self.bits: list[np.ndarray] = []
        slots = np.empty(len(names), np.int64)
        at = 0
        while len(left) and len(self.bits) < self.LEVELS:
            size = GAMMA * len(left) + 1
            place = (mix(h[left], len(self.bits)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            rank = np.cumsum(alone) - 1
            mine = alone[place]
            slots[left[mine]] = at + rank[place[mine]]
            at += int(alone.sum())
            self.bits.append(alone)
            left = left[~mine]
        slots[left] = at + np.arange(len(left))
        order = np.empty(len(names), np.int64)
        order[slots] = np.arange(len(names))
        self.rest = at
        self.names = pa.array([names[k] for k in order.tolist()], pa.binary())
        self._ranks()

    def _ranks(self) -> None:
        self.rank, at = [], 0
        for b in self.bits:
            self.rank.append((at + np.cumsum(b) - 1).astype(np.int32))
            at += int(b.sum())

    def __reduce__(self):
        return _loaded, ([(len(b), np.packbits(b).tobytes()) for b in self.bits], self.rest, self.names)

    def __len__(self) -> int:
        return len(self.names)

    def slots(self, names: pa.Array, h: np.ndarray) -> np.ndarray:
        """The slot of each name, -1 of those that aren't among the terms."""
        out = np.full(len(names), -1, np.int64)
        open_ = np.arange(len(names))
        for seed, (bits, rank) in enumerate(zip(self.bits, self.rank)):
            place = (mix(h[open_], seed) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[place]
            out[open_[hit]] = rank[place[hit]]
            open_ = open_[~hit]
        if self.rest < len(self) and len(open_):
            known = {n.as_py(): self.rest + k for k, n in enumerate(self.names[self.rest:])}
            out[open_] = [known.get(names[k].as_py(), -1) for k in open_.tolist()]
        found = np.flatnonzero(out >= 0)
        same = pc.equal(self.names.take(pa.array(out[found])), names.take(pa.array(found)))
        out[found[~same.to_numpy(zero_copy_only=False)]] = -1
        return out


def _loaded(bits, rest, names) -> PerfectHash:
    made = PerfectHash.__new__(PerfectHash)
    made.bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for n, b in bits]
    made.rest, made.names = rest, names
    made._ranks()
    return made


def _shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    lang, shard = key
    made = PerfectHash(table.column("term").combine_chunks().to_pylist())
    return pa.table({"lang": pa.array([lang.as_py()]), "shard": pa.array([shard.as_py()], pa.int32()),
                     "terms": pa.array([len(made)], pa.int64()), "hash": pa.array([pickle.dumps(made)], pa.binary())})


# ---------------------------------------------------------------------------
# recount

def _recount(shards):
    """Packed counts (lang, source, shard, slot, n) of each task's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        books: dict[str, tuple[int, list[tuple[int, PerfectHash]]]] = {}
        for lang, shard, n, data in shards.value:
            books.setdefault(lang, (n, []))[1].append((shard, pickle.loads(data)))
        dense: dict[tuple[str, str, int], np.ndarray] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source, shard), n in dense.items():
                slot = np.flatnonzero(n)
                if len(slot):
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang]), "source": pa.array([source]), "shard": pa.array([shard], pa.int32()),
                        "slot": pa.array([slot.astype(np.uint32).tobytes()], pa.binary()),
                        "n": pa.array([n[slot].tobytes()], pa.binary()),
                        "total": pa.array([int(n.sum())], pa.int64())})

        for b in batches:
            for lang, source, texts in _groups(b):
                if lang not in books:
                    continue
                count: Counter = Counter()
                for t in texts:
                    count.update(terms(_raw(t)))
                if not count:
                    continue
                of, held = books[lang]
                names, n = list(count), np.fromiter(count.values(), np.int64, len(count))
                h, array = hashes(names), pa.array(names, pa.binary())
                mine = shard_of(h, of)
                for shard, book in held:
                    own = np.flatnonzero(mine == shard)
                    slot = book.slots(array.take(pa.array(own)), h[own])
                    slots = dense.get((lang, source, shard))
                    if slots is None:
                        slots = dense[lang, source, shard] = np.zeros(len(book), np.int64)
                    slots[slot[slot >= 0]] += n[own][slot >= 0]  # names are distinct
            if sum(map(len, dense.values())) * 8 >= SHARD_BYTES:
                yield from rows()
                dense = {}
        yield from rows()
    return run


COUNTS = "lang string, source string, shard int, slot binary, n binary, total long"


def shard_of(h: np.ndarray, of: int) -> np.ndarray:
    """The shard of each hash; from the low bits, perfect hashes mix all."""
    return (h % np.uint64(of)).astype(np.int32)


def _dealt(shards: dict[str, int]):
    """Deal kept terms to the shards of their language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, names = b.column("lang").to_pylist(), b.column("term")
            of = np.array([shards[x] for x in lang], np.uint64)
            shard = (hashes(names.to_pylist()) % of).astype(np.int32) if len(of) else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array(shard), names],
                                             names=["lang", "shard", "term"])
    return run


def _merged(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of a group's rows of one shard, as one row."""
    n = np.zeros(0, np.int64)
    for b in batches:
        for slot, more in zip(b.column("slot"), b.column("n")):
            n = _added(n, slot, more)
    slot = np.flatnonzero(n)
    yield pa.RecordBatch.from_pydict({
        "lang": pa.array([key[0].as_py()]), "source": pa.array([key[1].as_py()]),
        "shard": pa.array([key[2].as_py()], pa.int32()),
        "slot": pa.array([slot.astype(np.uint32).tobytes()], pa.binary()),
        "n": pa.array([n[slot].tobytes()], pa.binary()), "total": pa.array([int(n.sum())], pa.int64())})


def _added(n: np.ndarray, slot: pa.Scalar, more: pa.Scalar) -> np.ndarray:
    at = np.frombuffer(slot.as_buffer(), np.uint32)  # rising and distinct in a row
    if len(at) and at[-1] >= len(n):
        n = np.concatenate([n, np.zeros(int(at[-1]) + 1 - len(n), np.int64)])
    n[at] += np.frombuffer(more.as_buffer(), np.int64)
    return n


# ---------------------------------------------------------------------------
# audit

def shares(count: np.ndarray, total: np.ndarray, v: int, alpha: int, scale: int) -> np.ndarray:
    """1 + floor(scale * (count + alpha) / (total + alpha * v)) of a row for each total,
    exact: the quotient's digits are found one factor of the scale after another."""
    low = total.astype(np.int64)[:, None] + alpha * v
    whole, rest = np.divmod(count.astype(np.int64) + alpha, low)
    step = 1000 if int(low.max(initial=0)) < (1 << 53) else 10
    while scale > 1:
        step = step if scale % step == 0 else scale
        digit, rest = np.divmod(rest * step, low)
        whole = whole * step + digit
        scale //= step
    return whole + 1


def _audit(alpha: int, scale: int, top: int):
    """Of one shard of a language: differences of each two sources, and the most
    overused terms of each source."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, v, rows = None, 0, {}
        for b in batches:
            for data, of, source, sum_, slot, n in zip(*(b.column(c) for c in (
                    "hash", "v", "source", "group_total", "slot", "n"))):
                if data.is_valid:
                    book, v = pickle.loads(data.as_py()), of.as_py()
                else:
                    none = np.zeros(0, np.int64)
                    rows[source.as_py()] = sum_.as_py(), _added(none, slot, n) if slot.is_valid else none
        names = sorted(rows, key=lambda s: s.encode())
        size = len(book) if book is not None else 0
        count, total = np.zeros((len(names), size), np.int64), np.zeros(len(names), np.int64)
        for k, s in enumerate(names):
            total[k], n = rows.pop(s)
            count[k, :len(n)] = n
        lang = key[0].as_py()
        p = shares(count, total, v, alpha, scale)
        q = shares(count.sum(axis=0)[None, :], total.sum()[None], v, alpha, scale)[0]

        def made(s: str, part: str, items: list, values: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(items)), pa.array([s] * len(items)), pa.array([part] * len(items)),
                 pa.array(items, pa.string()), pa.array(values, pa.int64())],
                names=["lang", "source", "part", "item", "value"])

        for k, s in enumerate(names):
            if len(names) > 1:
                f = np.abs(p - p[k]).sum(axis=1)
                yield made(s, "pair", names[:k] + names[k + 1:], np.delete(f, k))
            over = np.flatnonzero((count[k] > 0) & (p[k] > q))
            f = p[k][over] - q[over]
            if len(over) > top:  # ties at the border stay, the order of terms decides later
                border = np.partition(f, len(f) - top)[len(f) - top]
                over, f = over[f >= border], f[f >= border]
            if len(over):
                items = [x.decode() for x in book.names.take(pa.array(over)).to_pylist()]
                yield made(s, "term", items, f)
    return run


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          min_docs: int = MIN_DOCS, alpha: int = ALPHA, scale: int = SCALE, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has each other source of the
    language, ``term`` the ``top`` kept terms that the source uses more than its language."""
    spark = docs.sparkSession
    ship(spark)
    blank = F.lit("")
    rows = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang), blank).alias("lang"),
                       F.coalesce(F.col(source), blank).alias("source"))
    seen = Table(rows.mapInArrow(_frequencies, "lang string, source string, term binary, n long")
                 .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
                 .where(F.col("term").isNull() | (F.col("n") >= min_docs)), "terms")
    kept = seen.df.where(F.col("term").isNotNull()).select("lang", "term")
    groups = seen.df.where(F.col("term").isNull()).select("lang", "source")
    # Of each language: its kept terms, sources and shards.
    sizes = (groups.groupBy("lang").agg(F.count("*").alias("sources"))
             .join(kept.groupBy("lang").agg(F.count("*").alias("v")), "lang", "left")
             .select("lang", F.coalesce("v", F.lit(0)).alias("v"), "sources").collect())
    if not sizes:
        seen.drop()
        return spark.createDataFrame([], "lang string, source string, part string, item string, value long, rank int")
    most = {r["lang"]: max(1, min(SHARD_TERMS, SHARD_BYTES // (8 * r["sources"]))) for r in sizes}
    shards = {r["lang"]: max(1, -(-r["v"] // (most[r["lang"]] * 3 // 4 + 1))) for r in sizes}
    told = spark.createDataFrame([(r["lang"], r["v"], shards[r["lang"]]) for r in sizes],
                                 "lang string, v long, shards int")
    placed = kept.mapInArrow(_dealt(shards), "lang string, shard int, term binary")
    built = Table(placed.groupBy("lang", "shard").applyInArrow(
        _shard, "lang string, shard int, terms long, hash binary"), "perfect-hashes")
    tables = _counted(rows, built.df, shards)
    counted = spark.createDataFrame([], COUNTS)
    for table in tables:
        counted = counted.unionByName(table.df)

    totals = counted.groupBy("lang", "source").agg(F.sum("total").alias("group_total"))
    dense = (groups.join(totals, ["lang", "source"], "left").join(told, "lang")
             .select("lang", "source", F.coalesce("group_total", F.lit(0)).cast("long").alias("group_total"),
                     F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")))
    slots = (dense.join(counted.select("lang", "source", "shard", "slot", "n"), ["lang", "source", "shard"], "left")
             .select("lang", "shard", "source", "group_total", "slot", "n"))
    books = built.df.join(told, "lang").select("lang", "shard", "v", "hash")
    found = (slots.unionByName(books, allowMissingColumns=True).groupBy("lang", "shard")
             .applyInArrow(_audit(alpha, scale, top),
                           "lang string, source string, part string, item string, value long"))
    parts = Table(found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")), "differences")
    for table in (seen, built, *tables):
        table.drop()
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    pairs = parts.df.where("part = 'pair'").withColumn("rank", rank)
    best = parts.df.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= top)
    return pairs.unionByName(best)


def _counted(rows: DataFrame, built: DataFrame, shards: dict[str, int]) -> list[Table]:
    """Count the kept terms, as many shards at a time as may be broadcast; a table each."""
    spark = rows.sparkSession
    rounds, held = [[]], 0
    for r in built.select("lang", "shard", F.octet_length("hash").alias("size")).orderBy("lang", "shard").collect():
        if rounds[-1] and held + r["size"] > BROADCAST_BYTES:
            rounds.append([])
            held = 0
        rounds[-1].append((r["lang"], r["shard"]))
        held += r["size"]
    made = []
    for own in filter(None, rounds):
        first, last = (F.struct(F.lit(lang), F.lit(shard)) for lang, shard in (own[0], own[-1]))
        part = built.where(F.struct("lang", "shard").between(first, last)).collect()
        sent = spark.sparkContext.broadcast([(r["lang"], r["shard"], shards[r["lang"]], bytes(r["hash"])) for r in part])
        made.append(Table(rows.mapInArrow(_recount(sent), COUNTS).groupBy("lang", "source", "shard")
                          .applyInArrow(_merged, COUNTS), "slots"))
        sent.destroy()
    return made
