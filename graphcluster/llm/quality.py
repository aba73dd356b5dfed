"""Operator 4: host-level quality rules.

Each document is measured and tested against rules (too few words, repeated
word windows, symbols, repeated lines).  The failures of each rule are summed
per host (domain).  A host's failure rate is shrunk towards all hosts by a beta
prior whose parameters are estimated from the hosts' own rates (method of
moments), so a host with few documents needs strong evidence.  A host whose
shrunk rate exceeds a rule's limit is rejected, and the verdict is joined back
to its documents.

The measured rows (ids and counts, no texts) are written once; the host table
is aggregated map-side, written, and joined by its measured size: Spark
broadcasts it while it is small, else both sides are shuffled and a hot host is
split.

Cases: null text has no words, lines or symbols; documents without a host form
a host of their own; repeated rows count each; an empty table has no hosts; a text of any length is
measured whole; extra columns are ignored, also those named like an output.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from graphcluster.llm.common import Table, arrow_map

MIN_WORDS = 50        #: fewer words fail the base rules
MAX_REPEAT_PCT = 50   #: a larger share of words in repeated windows fails the base rules
MAX_RATE = 0.5        #: a host whose shrunk failure rate of a rule exceeds this is rejected
MIN_STRENGTH = 2.0    #: the prior weighs at least as much as so many documents
MAX_STRENGTH = 1e6    #: and at most as many (all hosts alike)

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SPACE = b" \t\n\x0b\x0c\r"   # fixed values: the characters between words
SYMBOLS = b"#*$%&|<>"        # fixed values: the characters counted as symbols


def measure(raw: bytes) -> tuple[int, int, int, int, int]:
    """The measures of one UTF-8 text, in the order of MEASURES."""
    words = raw.split()
    n = len(words)
    solid = raw.translate(None, SPACE)
    chars = len(solid.decode("utf-8"))
    symbols = len(solid) - len(solid.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        seen = Counter(windows)
        if len(seen) < len(windows):
            end = 0  # words before this index are counted
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    repeated += i + 3 - max(i, end)
                    end = i + 3
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def _measure(texts: pa.Array) -> list:
    rows = [measure(t.as_buffer().to_pybytes()) if t.is_valid else (0,) * 5 for t in texts]
    return [list(x) for x in zip(*rows)] if rows else [[]] * 5


def rules() -> dict[str, Column]:
    """Failure conditions by rule name, over the measures."""
    c = F.col
    return {
        "short": c("n_words") < MIN_WORDS,
        "repeats": 100 * c("n_repeat_words") > MAX_REPEAT_PCT * c("n_words"),
        "symbols": 2 * c("n_symbols") > c("n_words"),
        "lines": (c("n_words") >= MIN_WORDS) & (20 * c("n_dup_lines") > c("n_words")),
    }


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append the measures to the documents."""
    return arrow_map(docs, [text], [StructField(m, LongType(), False) for m in MEASURES], _measure)


def host_verdicts(rows: DataFrame, host: str, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per host: documents, shrunk failure rate of each rule, ``host_failed``."""
    names = list(rules())
    hosts = rows.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(cond.cast("long")).alias(f"f_{r}") for r, cond in rules().items()])
    kept = Table(hosts, "hosts")
    # the prior: one row of moments over the hosts
    moments = kept.df.agg(*[x for r in names for x in (
        F.avg(F.col(f"f_{r}") / F.col("n_docs")).alias(f"m_{r}"),
        F.var_pop(F.col(f"f_{r}") / F.col("n_docs")).alias(f"v_{r}"))]).first()
    out = kept.df
    for r in names:
        mean, strength = beta_prior(moments[f"m_{r}"], moments[f"v_{r}"])
        out = out.withColumn(f"rate_{r}", (F.col(f"f_{r}") + F.lit(mean * strength))
                             / (F.col("n_docs") + F.lit(strength)))
    failed = F.lit(False)
    for r in names:
        failed = failed | (F.col(f"rate_{r}") > max_rate)
    return out.withColumn("host_failed", failed)


def beta_prior(mean: float | None, var: float | None) -> tuple[float, float]:
    """Mean and strength (alpha + beta) of the beta prior with these moments."""
    if mean is None:
        return 0.0, MIN_STRENGTH
    if not var:
        return mean, MAX_STRENGTH
    return mean, min(MAX_STRENGTH, max(MIN_STRENGTH, mean * (1 - mean) / var - 1))


def judge(docs: DataFrame, host: str = "source", text: str = "text",
          keys: tuple[str, ...] = ("doc_id",), max_rate: float = MAX_RATE) -> DataFrame:
    """``keys``, host, measures, ``base_failed``, ``host_failed`` and ``kept`` per document."""
    cols = list(dict.fromkeys([*keys, host]))
    rows = Table(measured(docs.select(*cols, text), text).select(*cols, *MEASURES), "measures").df
    verdicts = Table(host_verdicts(rows, host, max_rate).select("host", "host_failed"), "verdicts").df
    base = rules()
    out = rows.join(verdicts.withColumnRenamed("host", "_host"),
                    F.col(host).eqNullSafe(F.col("_host")), "left").drop("_host")
    out = out.withColumn("base_failed", base["short"] | base["repeats"])
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
