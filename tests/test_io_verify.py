"""CSV sources / sinks and the two verifiers."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from graph_models import assign_df, edges_df
from graphcluster.operators.verify import verify_clustering, verify_matching
from graphcluster.sources import edges as IO


def write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="gc-io-")
    path = os.path.join(d, "part.csv")
    with open(path, "w", newline="") as fh:
        fh.write(text)
    return path


def test_read_edges_crlf_and_negative_ids(spark):
    df = IO.read_edges(spark, write("0,1\r\n1,2\r\n-5,9000000000\r\n"))
    assert sorted(tuple(r) for r in df.collect()) == [(-5, 9000000000), (0, 1), (1, 2)]


@pytest.mark.parametrize("text", ["1,2\n3,4,5\n", "1,2\nx,4\n", "7\n1,2\n", "1,2.5\n", ",5\n", "5,\n", "1,2\n\n3,4\n",
                                  "1,99999999999999999999\n"])
def test_malformed_lines_fail(spark, text):
    with pytest.raises(Exception, match="malformed|CAST"):
        IO.read_edges(spark, write(text)).collect()


@pytest.mark.parametrize("text", ["7\n1,2,3\n", ",5\n", "5,\n", "1,2\n\n"])
def test_malformed_lines_fail_a_count(spark, text):
    with pytest.raises(Exception, match="malformed"):
        IO.read_edges(spark, write(text)).count()


def test_scratch_paths_keep_their_scheme(spark, monkeypatch):
    from graphcluster import session
    for base in ("hdfs://nn:8020/ckpt/a", "dbfs:/ckpt", "file:/mnt/shared/x/", "/mnt/plain"):
        monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda s, b=base: b)
        path = session.scratch_dir(spark, "t")
        assert path.startswith(base.rstrip("/") + "/t-") and path != session.scratch_dir(spark, "t")


def test_assignment_round_trip(spark):
    d = tempfile.mkdtemp(prefix="gc-out-")
    a = assign_df(spark, {0: 1, 1: 1, 2: 3})
    IO.write_assignments(a, d)
    IO.write_assignments(a, d)          # overwrite
    assert sorted(tuple(r) for r in IO.read_assignments(spark, d).collect()) == [
        (0, 1), (1, 1), (2, 3)]


def test_read_matching_orients_pairs(spark):
    m = IO.read_matching(spark, write("84,90\n7,61\n90,2\n"))
    assert sorted(tuple(r) for r in m.collect()) == [(2, 90), (7, 61), (84, 90)]


def test_verify_clustering_valid_and_broken(spark):
    e = edges_df(spark, [(1, 2), (2, 3), (1, 3), (3, 4), (4, 4)])
    good = verify_clustering(e, assign_df(spark, {1: 1, 2: 1, 3: 1, 4: 4})).first()
    assert (good["valid"], good["disagreements"]) == (True, 1)
    rows = [(1, 1), (1, 1), (2, 1), (3, 1), (9, 9)]      # repeated 1, missing 4, unknown 9
    bad = verify_clustering(e, spark.createDataFrame(rows, "vid BIGINT, cid BIGINT")).first()
    assert (bad["duplicates"], bad["missing"], bad["unknown"], bad["valid"]) == (1, 1, 1, False)
    assert bad["disagreements"] is None


def test_verify_clustering_unassigned(spark):
    e = edges_df(spark, [(1, 2), (2, 3)])
    for rows, want in (([(1, 1), (2, 1), (3, None)], (0, 0, 0, 1)), ([(1, 1), (2, 1), (3, 1), (None, 1)], (0, 0, 0, 1)),
                       ([(1, 1), (2, 1)], (0, 1, 0, 0)), ([(1, 1), (2, None), (2, None), (3, 1)], (1, 0, 0, 2))):
        r = verify_clustering(e, spark.createDataFrame(rows, "vid BIGINT, cid BIGINT")).first()
        assert (r["duplicates"], r["missing"], r["unknown"], r["unassigned"]) == want
        assert (r["valid"], r["disagreements"]) == (False, None)


def test_costs_are_exact(spark):
    from pyspark.sql import functions as F
    from graphcluster.operators.cost import pair_count
    ns = [0, 1, 2, 3, 200_000_003, 4_000_000_000, 4_000_000_001, (1 << 62) + 1]
    df = spark.createDataFrame([(n,) for n in ns], "n BIGINT").select("n", pair_count().alias("p"))
    got = {r["n"]: int(r["p"]) for r in df.collect()}
    assert got == {n: n * (n - 1) // 2 for n in ns}
    assert int(df.agg(F.sum("p")).first()[0]) == sum(got.values())


def test_packed_pairs_keep_their_order(spark):
    from graphcluster.functions.packing import pack, packed_id, packed_key
    from pyspark.sql import functions as F
    pairs = [(k, i) for k in (0, 1, 7, (1 << 61) - 3, 1 << 61, 1 << 62) for i in (-(1 << 63), -1, 0, 5, (1 << 63) - 1)]
    df = spark.createDataFrame(pairs, "k BIGINT, i BIGINT").withColumn("p", pack(F.col("k"), F.col("i")))
    rows = df.select("k", "i", "p", packed_key(F.col("p")).alias("a"), packed_id(F.col("p")).alias("b")).collect()
    assert all((r.k, r.i) == (r.a, r.b) for r in rows)
    assert [(r.k, r.i) for r in sorted(rows, key=lambda r: r.p)] == sorted(pairs)
    plan = df.groupBy("k").agg(F.min("p"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_verify_clustering_sample_shape(spark):
    # 50 disjoint edges over 0..99 and 10 clusters of 10 consecutive ids:
    # 47 cut, 3 inside, 10 * C(10, 2) - 3 missing -> 494
    pairs = [(2 * i, 2 * i + 1) for i in range(50)]
    pairs = [(a, b) if i % 17 else (a, (b + 9) % 100) for i, (a, b) in enumerate(pairs)]
    e = edges_df(spark, pairs)
    vs = sorted({v for p in pairs for v in p})
    labels = {v: v // 10 + 1 for v in vs}
    row = verify_clustering(e, assign_df(spark, labels)).first()
    inside = sum(1 for a, b in pairs if labels[a] == labels[b])
    sizes = {}
    for c in labels.values():
        sizes[c] = sizes.get(c, 0) + 1
    want = (len(pairs) - inside) + sum(n * (n - 1) // 2 for n in sizes.values()) - inside
    assert row["valid"] and row["disagreements"] == want


def test_verify_matching(spark):
    e = edges_df(spark, [(1, 2), (2, 3), (3, 4), (4, 1)])
    ok = verify_matching(e, edges_df(spark, [(2, 1), (3, 4)])).first()
    assert (ok["valid"], ok["size"]) == (True, 2)
    dup = verify_matching(e, edges_df(spark, [(1, 2), (2, 1)])).first()
    assert (dup["duplicates"], dup["valid"]) == (1, False)
    foreign = verify_matching(e, edges_df(spark, [(1, 3)])).first()
    assert (foreign["foreign"], foreign["valid"]) == (1, False)
    shared = verify_matching(e, edges_df(spark, [(1, 2), (2, 3)])).first()
    assert (shared["max_degree"], shared["valid"], shared["size"]) == (2, False, None)


def test_job_reads_raw_edges_once(spark, tmp_path, monkeypatch):
    """The raw edges are scanned by one written table; loops and NULL ends stay vertices."""
    from graphcluster.plans import job
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text(" +1 , 2\r\n2,1\n2,3\n7,7\n-5,9000000000\n")
    plans, real = [], job.store

    def caught(df, name="table", **metrics):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name, **metrics)

    monkeypatch.setattr(job, "store", caught)
    got = {r["vid"] for r in job.cluster(IO.read_edges(spark, str(raw)), "hash", "none").assign.collect()}
    assert got == {1, 2, 3, 7, -5, 9000000000}
    scans = [p for p in plans if "Relation [value" in p]
    assert len(plans) == 2 and len(scans) == 1 and "regexp_extract" not in scans[0]
    nulls = spark.createDataFrame([(1, 2), (None, 4), (None, None), (5, None)], "src BIGINT, dst BIGINT")
    assert {r["vid"] for r in job.cluster(nulls, "hash", "none").assign.collect()} == {1, 2, 4, 5}


def test_verifier_reads_raw_edges_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def watched(x):
        read.add(1)
        return x

    raw = [(1, 2), (2, 1), (2, 3), (3, 3), (5, 5), (None, 6), (None, None), (1, 2)]
    edges = spark.createDataFrame(raw, "src long, dst long")
    clusters = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (5, 5), (6, 6)], "vid long, cid long")
    row = verify_clustering(edges.select(watched("src").alias("src"), "dst"), clusters).first()
    assert (row.duplicates, row.missing, row.unknown, row.unassigned, row.valid, row.disagreements) == (0, 0, 0, 0, True, 1)
    assert read.value <= 2 * len(raw)  # a column may be computed for each use in a projection
