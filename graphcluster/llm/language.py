"""Operator 6: language identification by bit-sliced n-gram Bloom filters.

Every language has a Bloom filter of its character trigrams.  The filters are
bit-sliced: one table whose cell holds the bit of *all* languages for a hash
position, so one lookup of a trigram (the AND of its cells) gives the set of
languages that contain it.  A text's trigrams are looked up, the set bits are
counted per language, each count is corrected for the filter's false-positive
rate, and the language with the largest corrected share wins.

Training: about ``sample`` labelled documents per language (all if there are
fewer), chosen by a hash of the id; whole texts.  A trigram enters a language's
filter if it makes up at least ``MIN_RATE`` of that language's trigrams and at
least ``MIN_SHARE`` of its rate in the language that uses it most; so a filter
holds at most 1 / MIN_RATE trigrams and the model's size is bounded.

Cases: a null text, a text without letters, and any text when nothing could be
learned get ``und`` with score 0; a null label is not learned from; a tie goes
to the first language by code point; repeated rows are each learned from and each
predicted; a text of any length is read whole, at once; an empty table teaches
nothing and gives an empty result; extra columns pass through (those named like an
output are replaced).
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from graphcluster.llm.common import Table, arrow_map, enter, ship

SAMPLE = 1500         #: labelled documents per language that train the filters (in expectation)
MIN_RATE = 1e-5       #: least share of a language's trigrams
MIN_SHARE = 0.2       #: least share of the rate in the language that uses a trigram most
HASHES = 3
CELLS_PER_GRAM = 16
UNKNOWN = "und"
CHUNK_CHARS = 1 << 18   #: characters looked up at once, at least one text

_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text index and key of every trigram: lower-case letters, other runs as one space."""
    low = [" " + t.lower() + " " for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le"), dtype=np.uint32)
    size = np.fromiter(map(len, low), np.int64, len(low))
    which = np.repeat(np.arange(len(low), dtype=np.int64), size)
    letter = letters()[codes]
    keep = letter.copy()
    keep[np.cumsum(size) - size] = True  # the space before a text
    keep[1:] |= letter[:-1]  # the first of a run of other characters is the space
    c = np.where(letter, codes, np.uint32(32))[keep].astype(np.uint64)
    which = which[keep]
    if len(c) < 3:
        return which[:0], c[:0]
    key = (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]
    inside = which[:-2] == which[2:]
    return which[:-2][inside], key[inside]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Filters:
    """Bit-sliced Bloom filters of the trigrams of several languages."""

    def __init__(self, grams: dict[str, np.ndarray]):
        self.langs = sorted(grams)
        most = max([1, *map(len, grams.values())])
        self.cells = 1 << int(np.ceil(np.log2(max(1024, CELLS_PER_GRAM * most))))
        self.words = max(1, -(-len(self.langs) // 64))
        self.table = np.zeros((self.words, self.cells), dtype=np.uint64)
        for i, lang in enumerate(self.langs):
            bit = np.uint64(1) << np.uint64(i % 64)
            for at in self.positions(grams[lang]):
                self.table[i // 64, at] |= bit
        fill = [np.count_nonzero(self.table[i // 64] >> np.uint64(i % 64) & np.uint64(1)) / self.cells
                for i in range(len(self.langs))]
        self.false = np.array(fill) ** HASHES

    def positions(self, keys: np.ndarray) -> list[np.ndarray]:
        h = _mix(keys)
        step = (h >> np.uint64(32)) | np.uint64(1)
        return [((h + np.uint64(j) * step) & np.uint64(self.cells - 1)).astype(np.int64)
                for j in range(HASHES)]

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams per text, and per text and language those that its filter holds."""
        which, keys = trigrams(texts)
        total = np.bincount(which, minlength=len(texts))
        found = np.zeros((len(texts), len(self.langs)), dtype=np.int64)
        at = self.positions(keys)
        for w in range(self.words):
            mask = self.table[w, at[0]]
            for p in at[1:]:
                mask &= self.table[w, p]
            for i in range(64 * w, min(len(self.langs), 64 * w + 64)):
                hit = (mask >> np.uint64(i % 64) & np.uint64(1)).astype(bool)
                found[:, i] = np.bincount(which[hit], minlength=len(texts))
        return total, found

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.langs:
            return lang, score
        block: list[int] = []
        size = 0
        for i, t in enumerate([*texts, None]):
            if t:
                block.append(i)
                size += len(t)
            if block and (size >= CHUNK_CHARS or i == len(texts)):
                total, found = self.counts([texts[k] for k in block])
                net = (found - total[:, None] * self.false) / (1 - self.false)
                best = net.argmax(axis=1)
                for k, n, b, row in zip(block, total.tolist(), best.tolist(), net):
                    if n:  # a text with a letter has a trigram
                        lang[k] = self.langs[b]
                        score[k] = float(min(1.0, max(0.0, row[b] / n)))
                block, size = [], 0
        return lang, score


def _rates(langs: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """Trigram counts of a batch by language."""
    names, values = langs.to_pylist(), texts.to_pylist()
    out: list[tuple[list, list, list]] = []
    for lang in sorted(set(names)):
        _, keys = trigrams([t or "" for n, t in zip(names, values) if n == lang])
        k, c = np.unique(keys, return_counts=True)
        out.append(([lang] * len(k), k.astype(np.int64).tolist(), c.tolist()))
    cols = [sum((o[j] for o in out), []) for j in range(3)]
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())],
        names=["lang", "gram", "n"])


def learn(labelled: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id",
          sample: int = SAMPLE) -> Filters:
    """Train filters on about ``sample`` labelled rows per language."""
    ship(labelled.sparkSession)
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}  # one row per language
    if not sizes:
        return Filters({})
    cut = 1_000_000
    rate: Column = F.lit(0)
    for name, n in sizes.items():
        rate = F.when(F.col(lang) == name, F.lit(min(cut, -(-cut * sample // n)))).otherwise(rate)
    chosen = rows.where(F.pmod(F.xxhash64(F.lit("language"), key), F.lit(cut)) < rate)

    def count(batches):
        enter(__name__)
        for b in batches:
            yield _rates(b.column(0), b.column(1))

    grams = (chosen.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
             .mapInArrow(count, "lang string, gram long, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    kept = Table(grams, "trigrams")
    totals = {r[0]: r[1] for r in kept.df.groupBy("lang").agg(F.sum("n")).collect()}
    share: Column = F.lit(0.0)
    for name, n in totals.items():
        share = F.when(F.col("lang") == name, F.col("n") / F.lit(n)).otherwise(share)
    used = kept.df.select("lang", "gram", share.alias("r")).where(F.col("r") >= MIN_RATE)
    top = used.groupBy("gram").agg(F.max("r").alias("most"))
    # at most 1 / MIN_RATE rows per language
    picked = used.join(top, "gram").where(F.col("r") >= MIN_SHARE * F.col("most")).select("lang", "gram").toPandas()
    kept.drop()
    return Filters({name: picked.gram[picked.lang == name].to_numpy(np.int64).astype(np.uint64)
                    for name in totals})


def _predict(model: Broadcast, texts: pa.Array) -> list:
    return list(model.value.predict(texts.to_pylist()))


def identify(docs: DataFrame, model: Filters, text: str = "text", lang: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """Append the predicted language and its score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: see the module's note
    return arrow_map(docs, [text], [StructField(lang, StringType(), False),
                                    StructField(score, DoubleType(), False)],
                     partial(_predict, shared))
