"""Operator 5: n-gram Jaccard join by a blocked sparse matrix product.

The incidence matrix has a row for each distinct set of word shingles and a
column for each shingle.  Two sets link when the Jaccard similarity of the rows
reaches the threshold, that is when the product of the matrix with its
transpose, the overlap count, reaches a bound that follows from the two sizes.

1. *Sets.*  Each text becomes its set of shingle hashes and a 128-bit signature;
   texts with equal signatures are one row from here on.
2. *Column blocks.*  The incidences are dealt to blocks by shingle.  A block
   keeps the columns with two rows at least, with their row counts, and sends
   them back to the rows.  A row of which fewer than threshold x size shingles
   are shared can reach the bound with no partner and is discarded.
3. *Families.*  In the order of column count, any two linking rows share one of
   the first size - ceil(threshold x size) + 1 shingles of each (the rest alone
   can't reach the bound).  Rows that share such a shingle are joined into
   families: no link leaves a family.
4. *Row blocks.*  The rows of a family are multiplied block by block: overlap
   counts of all rows of two blocks accumulate over the columns, pairs below
   the size-derived bound are discarded, and what leaves the task is, per row,
   its number of links and one vertex of its component there - never a pair.
   A family larger than a block is cut by size class (sizes of linking rows
   differ by at most the threshold) and by hash into blocks, and each pair of
   blocks is a task of bounded size.
5. Components of these stars, then the smallest document of each.

Cases: a null text, or one without words, has an empty set and links with
nothing; fewer words than a shingle make one shingle of the whole sequence;
repeated rows and equal texts link with one another; a null id takes part and
is never a component's id unless it has no other; extra columns are ignored;
a text of any length is read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphcluster.llm import blobs
from graphcluster.llm.common import MEMOS, WORD, Table, enter, free_shuffles, partitions, ship
from graphcluster.llm.components import components

WORDS = 5              #: words of a shingle
PERCENT = 80           #: least Jaccard similarity, in percent
BLOCK_ROWS = 1024      #: rows of a block of the product
MEMO_WORDS = 300_000   #: remembered word hashes per worker

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)  # any odd numbers


class _Hashes(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASH = _Hashes()
MEMOS[__name__] = _HASH.clear


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(raw: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a UTF-8 text."""
    found = raw.lower().split()  # bytes: lower-cases A-Z, splits at ASCII white space
    if not found:
        return np.empty(0, np.uint64)
    if len(_HASH) > MEMO_WORDS:
        _HASH.clear()
    h = np.fromiter(map(_HASH.__getitem__, found), np.uint64, len(found))
    n = min(words, len(h))
    odd = np.resize(_ODD, words) * np.arange(1, 2 * words, 2, dtype=np.uint64)
    s = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        s += h[k:len(h) - n + 1 + k] * odd[k]
    return np.unique(_mix(s))


def signature(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def need(n: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of size n with any set that it links with."""
    return -(-percent * n.astype(np.int64) // 100)


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        for b in batches:
            sig, full, n = [], [], []
            for t in b.column(1):
                s = shingles(t.as_buffer().to_pybytes(), words) if t.is_valid else ()
                d = signature(s) if len(s) else None
                full.append(d)
                sig.append(int.from_bytes(d[:8], "little", signed=True) if d else None)
                n.append(len(s))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sig, pa.int64()), pa.array(full, pa.binary()), pa.array(n, pa.int64())],
                names=["doc_id", "sig", "sig128", "n"])
    return run




def _incidences(keys: list[int], words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        pack, sent = blobs.Packer(keys), set()
        for b in batches:
            for t in b.column(0):
                if not t.is_valid:
                    continue
                s = shingles(t.as_buffer().to_pybytes(), words)
                if not len(s):
                    continue
                sig = int.from_bytes(signature(s)[:8], "little", signed=True)
                if sig in sent:  # a copy: the block has this row from this task
                    continue
                if len(sent) < 1_000_000:
                    sent.add(sig)
                pack.add(sig, len(s), s)
                if pack.held >= blobs.FLUSH:
                    yield from pack.rows()
        yield from pack.rows()
    return run


def _shared(keys: list[int]):
    """A column block: columns of two rows at least, sent to the rows' buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, size, h = blobs.repeated(batches)
        rows = blobs.owners_of(h).astype(np.uint32)
        order = np.argsort(owner, kind="stable")
        owner, size, h, rows = owner[order], size[order], h[order], rows[order]
        cuts = np.flatnonzero(np.diff(owner)) + 1
        pack, where = blobs.Packer(keys), []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(h)]):
            if b > a:
                pack.add(int(owner[a]), int(size[a]), h[a:b], rows[a:b])
                where.append(int(owner[a]) % len(keys))
        yield from pack.rows(np.asarray(where, np.int64))
    return run


def _survivors(percent: int):
    """Rows of which enough shingles are shared, these in the order of column count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, size, h, rows = blobs.unpack(batches, np.uint32)
        order = np.lexsort((h, rows, owner))
        owner, size, h = owner[order], size[order], h[order]
        if not len(h):
            return
        first = np.flatnonzero(np.diff(owner, prepend=owner[0] ^ 1))
        count = np.diff(np.append(first, len(owner)))
        n = size[first].astype(np.int64)
        least = need(n, percent)
        found: list[list] = [[], [], [], []]
        for i in np.flatnonzero(count >= least).tolist():
            a, b = first[i], first[i] + count[i]
            prefix = int(n[i] - least[i] + 1 - (n[i] - count[i]))  # after the shingles of this row alone
            found[0].append(int(owner[a]))
            found[1].append(int(n[i]))
            found[2].append(h[a:b].astype(np.int64)[:prefix])
            found[3].append(h[a:b].tobytes())
            if len(found[0]) >= 2000:
                yield _batch(found)
                found = [[], [], [], []]
        if found[0]:
            yield _batch(found)
    return run


def _batch(found) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "sig": pa.array(found[0], pa.int64()), "n": pa.array(found[1], pa.int64()),
        "prefix": pa.array(found[2], pa.list_(pa.int64())), "shared": pa.array(found[3], pa.binary())})


def overlaps(rows: list[np.ndarray], block: int = 4096) -> np.ndarray:
    """Overlap counts of all rows (a sparse matrix times its transpose), accumulated
    over blocks of columns: short columns by their pairs, long ones as dense blocks."""
    g = len(rows)
    out = np.zeros((g, g), dtype=np.int64)
    own = np.repeat(np.arange(g), np.fromiter(map(len, rows), np.int64, g))
    h = np.concatenate(rows)
    order = np.argsort(h, kind="stable")
    own, h = own[order], h[order]
    first = np.flatnonzero(np.diff(h, prepend=h[0] ^ np.uint64(1)))
    count = np.diff(np.append(first, len(h)))
    for c in range(2, 17):
        at = first[count == c]
        if not len(at):
            continue
        i, j = np.triu_indices(c, 1)
        for k in range(0, len(at), 100_000):
            cols = own[at[k:k + 100_000, None] + np.arange(c)]
            out += np.bincount((cols[:, i] * g + cols[:, j]).ravel(), minlength=g * g).reshape(g, g)
    out += out.T
    wide = np.flatnonzero(count > 16)
    for k in range(0, len(wide), block):
        part = wide[k:k + block]
        dense = np.zeros((g, len(part)), dtype=np.float32)
        col = np.repeat(np.arange(len(part)), count[part])
        at = np.concatenate([np.arange(first[p], first[p] + count[p]) for p in part.tolist()])
        dense[own[at], col] = 1
        out += np.rint(dense @ dense.T).astype(np.int64)
    np.fill_diagonal(out, 0)
    return out


def _labels(link: np.ndarray) -> np.ndarray:
    """Smallest vertex of each vertex's component in a link matrix."""
    label = np.arange(len(link))
    a, b = np.nonzero(link)
    while len(a):
        low = label.copy()
        np.minimum.at(low, a, label[b])
        low = low[low]
        if (low == label).all():
            return label
        label = low
    return label


def _product(percent: int):
    """A task of the blocked product: links of each row, and a star of its component."""
    def solve(rows: list[tuple]) -> tuple[list, list, list]:
        """rows: (sig, n, copies, side, shared); side 0 and 1 are compared across only, 2 with all."""
        sig = np.array([r[0] for r in rows], dtype=np.int64)
        n = np.array([r[1] for r in rows], dtype=np.int64)
        copies = np.array([r[2] for r in rows], dtype=np.int64)
        side = np.array([r[3] for r in rows])
        o = overlaps([np.frombuffer(r[4], np.uint64) for r in rows])
        link = (o > 0) & (100 * o >= percent * (n[:, None] + n[None, :] - o))
        if (side != 2).any():
            link &= side[:, None] != side[None, :]
        label = _labels(link)
        some = link.any(axis=1)
        return sig[some].tolist(), (link @ copies)[some].tolist(), sig[label[some]].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows, out = None, [], ([], [], [])

        def done():
            if len(rows) > 1:
                for o, x in zip(out, solve(rows)):
                    o.extend(x)

        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in ("task", "sig", "n", "copies", "side", "shared"))):
                if r[0] != task:
                    done()
                    task, rows = r[0], []
                rows.append(r[1:])
        done()
        yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["sig", "links", "star"])
    return run


def _tasks(members: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """(sig, task, side): the tasks of the product that each row takes part in."""
    ratio = 100 / percent
    members = members.withColumn("class", F.floor(F.log(F.col("n") + 0.5) / F.log(F.lit(ratio))))
    sizes = Table(members.groupBy("family", "class").agg(F.count(F.lit(1)).alias("rows")), "family-sizes").df
    # sizes of the family and of the neighbouring classes
    near = Table(
        sizes.withColumn("at", F.explode(F.array(*[F.col("class") + d for d in (-2, -1, 0, 1, 2)])))
        .groupBy("family", F.col("at").alias("class")).agg(*[
            F.sum(F.when(F.col("class") == F.col("at") + d, F.col("rows"))).alias(f"r{d + 2}")
            for d in (-2, -1, 0, 1, 2)])
        .where(F.col("r2").isNotNull())
        .join(sizes.groupBy("family").agg(F.sum("rows").alias("total")), "family"), "family-blocks").df

    def blocks(c):
        return F.ceil(F.coalesce(c, F.lit(0)) / block_rows).cast("int")

    placed = (members.join(near, ["family", "class"]).where(F.col("total") > 1)
              .withColumn("i", F.pmod(F.xxhash64(F.lit("block"), "sig"), blocks(F.col("r2"))).cast("int")))
    i, cls = F.col("i"), F.col("class")

    def one(kind, low, x, y, side):
        return F.struct(F.xxhash64("family", kind, low, x, y).alias("task"), side.alias("side"))

    both, left, right = F.lit(2), F.lit(0), F.lit(1)
    whole = F.array(one(F.lit(9), F.lit(0), F.lit(0), F.lit(0), both))
    same = F.transform(F.sequence(F.lit(0), blocks(F.col("r2")) - 1), lambda j: one(
        F.lit(0), cls, F.least(i, j), F.greatest(i, j), F.when(i == j, both).when(i < j, left).otherwise(right)))
    none = F.array().cast("array<struct<task:bigint,side:int>>")

    def across(count, make):
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), make)).otherwise(none)

    lists = [same]
    for step in (1, 2):  # sizes that link are at most two classes apart
        d = F.lit(step)
        lists.append(across(blocks(F.col(f"r{2 + step}")), lambda j: one(d, cls, i, j, left)))
        lists.append(across(blocks(F.col(f"r{2 - step}")), lambda j: one(d, cls - d, j, i, right)))
    todo = F.when(F.col("total") <= block_rows, whole).otherwise(F.concat(*lists))
    return placed.select("sig", F.explode(todo).alias("t")).select("sig", "t.task", "t.side")


def join(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT,
         words: int = WORDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (other documents linked directly)."""
    spark = docs.sparkSession
    ship(spark)
    parts = partitions(spark)
    keys = blobs.bucket_keys(spark, parts)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    sets = Table(source.mapInArrow(_sets(words), "doc_id " + docs.schema[key].dataType.simpleString()
                                   + ", sig long, sig128 binary, n long"), "sets").df
    reps = Table(sets.where("n > 0").groupBy("sig", "sig128").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n")), "reps").df

    incidences = source.select("text").mapInArrow(_incidences(keys, words), blobs.SCHEMA)
    shared = blobs.dealt(incidences, parts).mapInArrow(_shared(keys), blobs.SCHEMA)
    survivors = Table(blobs.dealt(shared, parts).mapInArrow(
        _survivors(percent), "sig long, n long, prefix array<long>, shared binary"), "survivors")
    free_shuffles(spark)

    prefixes = survivors.df.select("sig", F.explode("prefix").alias("h"))
    hubs = Table(prefixes.groupBy("h").agg(F.min("sig").alias("hub"), F.count(F.lit(1)).alias("c"))
                 .where("c > 1").select("h", "hub"), "hubs")
    families = components(prefixes.join(hubs.df, "h").where("sig != hub").select(
        F.col("sig").alias("a"), F.col("hub").alias("b")).distinct())
    members = Table(families.df.select(F.col("node").alias("sig"), F.col("root").alias("family"))
                    .join(reps.groupBy("sig").agg(F.sum("copies").alias("copies"), F.max("n").alias("n")), "sig"),
                    "members").df
    tasks = Table(_tasks(members.select("sig", "family", "n"), percent, block_rows)
                  .join(members.select("sig", "copies"), "sig"), "tasks").df
    work = survivors.df.select("sig", "n", "shared").join(tasks, "sig")
    product = Table(work.repartition(parts, "task").sortWithinPartitions("task", "sig")
                    .mapInArrow(_product(percent), "sig long, links long, star long"), "links").df
    survivors.drop()
    free_shuffles(spark)

    roots = components(product.select(F.col("sig").alias("a"), F.col("star").alias("b"))).df
    links = product.groupBy("sig").agg(F.sum("links").alias("links"))
    rooted = Table(reps.join(roots, reps.sig == roots.node, "left").drop("node")
                   .withColumn("root", F.coalesce("root", "sig")).join(links, "sig", "left"), "rooted").df
    lowest = Table(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "lowest").df
    classes = Table(rooted.join(lowest, "root").select(
        F.col("sig").alias("_sig"), F.col("sig128").alias("_sig128"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes").df
    out = sets.join(classes, (F.col("sig") == F.col("_sig")) & (F.col("sig128") == F.col("_sig128")), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "doc_id").alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT,
             words: int = WORDS) -> DataFrame:
    """One row of each group of linked rows: that of the smallest id (null after all
    others), then of the smallest hash of the text.

    Rows with equal id and text are one document; an id with different texts is as many,
    each judged by its own text.  Rows without words link with nothing and stay (with
    equal id and text once, without id all).
    """
    tid = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), tid.alias("tid"))
    judged = join(docs.select(F.col(text).alias("text"), place.alias("place")), "text", "place", percent, words)
    def name(ident: Column, tid: Column) -> Column:  # one column, so that rows are shuffled once
        return F.concat_ws(":", F.coalesce(ident.cast("string"), F.lit("")), F.hex(tid))

    kept = Table(judged.where("doc_id = component_id").select(
        name(F.col("doc_id.id"), F.col("doc_id.tid")).alias("_name")).distinct(), "kept-rows").df
    free_shuffles(docs.sparkSession)  # the caller's action shuffles the texts
    alone = F.col(key).isNull() & ~F.coalesce(F.col(text).rlike(WORD), F.lit(False))
    named = (docs.where(~alone).withColumn("_name", name(F.col(key), tid))
             .join(kept, "_name", "left_semi").dropDuplicates(["_name"]).drop("_name"))
    return named.unionByName(docs.where(alone))
