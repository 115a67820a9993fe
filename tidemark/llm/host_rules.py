"""Quality rules whose failures count against a document's host.

A document fails the base rules when it is too short or repeats itself too much. Failures are summed by
host, each host's rate is shrunk towards the corpus by a beta prior fitted to all hosts, and hosts above a
limit lose all their documents. A host with few documents thus needs many failures before it is condemned.
"""

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.staging import stage
from tidemark.llm.words import texts, words

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
MAX_HOST_RATE = 0.5

#: Characters counted as symbols; fixed values.
SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(i for i in range(256) if i not in SYMBOLS)
_CONTINUATION = bytes(range(0x80, 0xC0))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_text(text: bytes) -> tuple[int, int, int, int, int]:
    """The five counts of ``COUNTS`` for one text."""
    w = words(text)
    chars = sum(map(len, w)) - (0 if text.isascii() else len(text) - len(text.translate(None, _CONTINUATION)))
    lines = [line for line in text.split(b"\n") if words(line)]
    return (
        len(w),
        chars,
        len(text.translate(None, _NOT_SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(w),
    )


def repeated_words(w: list[bytes]) -> int:
    """Words inside five-word windows that occur twice or more in the text, first occurrences included."""
    windows = list(zip(*(w[i:] for i in range(WINDOW))))
    often = Counter(windows)
    if len(often) == len(windows):
        return 0
    covered, upto = 0, 0
    for start, window in enumerate(windows):
        if often[window] > 1:
            covered += start + WINDOW - max(upto, start)
            upto = start + WINDOW
    return covered


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in COUNTS]))
def text_counts(text: pa.Array) -> pa.Array:
    counted = [count_text(t) for t in texts(text)]
    columns = zip(*counted) if counted else [()] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(COUNTS))


def base_failed(counts: str) -> F.Column:
    n, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)


def host_rates(judged: DataFrame, host: str, failed: str) -> DataFrame:
    """(host, n_docs, n_failed, rate): failure rates shrunk by an empirical beta prior.

    The prior's mean is the corpus rate; its weight comes from the spread of the hosts' rates beyond what
    chance gives (method of moments, hosts weighted by their documents). Without such spread, or with one
    host, every host gets the corpus rate. All documents without a host form one host, null.
    """
    hosts = stage(
        judged.groupBy(F.col(host).alias("host")).agg(
            F.count(F.lit(1)).alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed")
        ),
        "hosts",
    )
    n, k = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    total = hosts.agg(
        F.sum(n).alias("n"), F.sum(k).alias("k"), F.count(F.lit(1)).alias("hosts"),
        F.sum(n * n).alias("n2"), F.sum(k * k / n).alias("k2"),
    ).first()
    mean, weight = beta_prior(**total.asDict())
    rate = F.lit(mean) if weight is None else (k + F.lit(weight * mean)) / (n + F.lit(weight))
    return hosts.select("host", "n_docs", "n_failed", rate.alias("rate"))


def beta_prior(n: float | None, k: float | None, hosts: int, n2: float | None, k2: float | None) -> tuple[float, float | None]:
    """Mean and weight of the prior; weight None stands for an infinite one (no spread beyond chance)."""
    if not n:
        return 0.0, None
    mean = k / n
    within = mean * (1 - mean)
    if hosts < 2:
        return mean, None
    variance = (k2 - n * mean * mean - (hosts - 1) * within) / (n - n2 / n)
    return (mean, max(within / variance - 1, 0.0)) if variance > 0 else (mean, None)


def rejected_hosts(judged: DataFrame, host: str, failed: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    return host_rates(judged, host, failed).where(F.col("rate") > max_rate).select("host")


def host_verdicts(judged: DataFrame, host: str, failed: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Adds ``kept``: the base rules passed and the host was not rejected.

    Few hosts are rejected and each has one row, but their number has no bound: Spark picks the join by
    measured size and splits a hot host when it shuffles.
    """
    bad = rejected_hosts(judged, host, failed, max_rate).withColumn("_bad", F.lit(True))
    return (
        judged.join(bad, judged[host].eqNullSafe(bad["host"]), "left")
        .withColumn("kept", ~F.col(failed) & F.col("_bad").isNull())
        .drop(bad["host"]).drop("_bad")
    )


def passing(judged: DataFrame, host: str, failed: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``judged`` whose documents and hosts both pass."""
    bad = rejected_hosts(judged, host, failed, max_rate)
    return judged.where(~F.col(failed)).join(bad, judged[host].eqNullSafe(bad["host"]), "left_anti")


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(doc_id, source, the counts, base_failed), one row per row of ``docs``; null texts have no words."""
    return (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("source"), text_counts(text).alias("c"))
        .select("doc_id", "source", "c.*", base_failed("c").alias("base_failed"))
    )
