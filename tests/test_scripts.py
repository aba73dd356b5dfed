"""The command-line jobs, run in-process on a small edge list."""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "scripts"))

import cluster as cluster_script  # noqa: E402
import verify_clustering as vc  # noqa: E402
import verify_matching as vm  # noqa: E402


def test_cluster_then_verify(spark, capsys):
    d = tempfile.mkdtemp(prefix="gc-cli-")
    edges = os.path.join(d, "edges.csv")
    with open(edges, "w", newline="") as fh:
        pairs = [(a, b) for g in ((0, 1, 2, 3), (4, 5, 6)) for a in g for b in g if a < b]
        fh.write("".join(f"{a},{b}\r\n" for a, b in pairs + [(3, 4), (7, 7)]))
    out = os.path.join(d, "out")
    orig_stop = spark.stop
    spark.stop = lambda: None                 # the scripts stop their session; keep ours
    try:
        assert cluster_script.main(["pivot=hash", edges, out, "3", "ls=regular",
                                    "--hash", "md5"]) == 0
        assert vc.main([edges, out]) == 0
        text = capsys.readouterr().out
        assert "valid, cost 1" in text
        match = os.path.join(d, "matching.csv")
        with open(match, "w") as fh:
            fh.write("1,0\n2,3\n5,4\n")
        assert vm.main([edges, match]) == 0
        assert "valid, 3 pairs" in capsys.readouterr().out
    finally:
        spark.stop = orig_stop
