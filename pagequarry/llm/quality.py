"""Quality rules judged by host: shrunken failure rates decide for all documents of a host.

Every document gets word, symbol and repetition counts from its whole text.
Rule failures are added up per host; a beta prior fitted to all hosts' rates by
the method of moments draws the rates of small hosts to the common mean. A host
whose shrunken rate in any rule exceeds a half is rejected, and its verdict is
joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.llm import tokens
from pagequarry.session import materialise

MIN_WORDS = 50
WINDOW = 3
# A host goes when its shrunken rate of failures in a rule is above this.
MAX_HOST_RATE = 0.5

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated_words(hashes: np.ndarray) -> int:
    """Words inside a window whose WINDOW hashed words occur twice or more."""
    if len(hashes) == 0:
        return 0
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice) == 0:
        return 0
    twice = twice[np.concatenate([[True], twice[1:] != twice[:-1]])]
    place = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
    begins = twice[place] == hashes
    covered = np.zeros(len(hashes) + WINDOW - 1, bool)
    for k in range(WINDOW):
        covered[k:k + len(begins)] |= begins
    return int(covered.sum())


def _repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tokens.slices(batch.column("text")):
            rows = len(part.offsets) - 1
            found = tokens.words(part)
            windows, _, offsets = tokens.ngrams(found, tuple(range(WINDOW)))
            # A code point has one byte that is no UTF-8 continuation byte.
            starts = ~tokens.BLANKS[part.data] & ((part.data & 0xC0) != 0x80)
            counts = [
                np.diff(found.rows),
                tokens.row_sums(starts.astype(np.int64), part.offsets),
                tokens.row_sums(_SYMBOLS[part.data].astype(np.int64), part.offsets),
                np.array([_repeated_lines(part.data[part.offsets[r]:part.offsets[r + 1]].tobytes()) for r in range(rows)], np.int64),
                np.array([_repeated_words(windows[offsets[r]:offsets[r + 1]]) for r in range(rows)], np.int64),
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(part.first, rows) for c in ("doc_id", "host")), *(tokens.as_longs(c) for c in counts)],
                names=["doc_id", "host", *_COUNTS],
            )


def rules() -> dict[str, Column]:
    """Failures of a document, by the name of the rule; the first two make up ``base_failed``."""
    return {
        "too_short": F.col("n_words") < MIN_WORDS,
        "repetitive": F.col("n_repeat_words") * 100 > F.col("n_words") * 50,
        "symbols": F.col("n_symbols") * 10 > F.col("n_words") * 3,
        "repeated_lines": F.col("n_dup_lines") * 10 > F.col("n_words"),
    }


def host_rates(measured: DataFrame) -> DataFrame:
    """``host, n``, and per rule its failures and shrunken rate, for each host that is not null.

    The prior of a rule has the mean of the hosts' rates and their variance
    beyond what chance explains: strength = mean (1 - mean) / variance - 1,
    at least 1 and at most as many documents as hosts have on average.
    """
    names = list(rules())
    hosts = measured.filter("host IS NOT NULL").groupBy("host").agg(
        F.count("*").alias("n"), *(F.sum(failed.cast("bigint")).alias(name) for name, failed in rules().items())
    )
    hosts = materialise(hosts, "hosts")
    moments = []
    for name in names:
        rate = F.col(name) / F.col("n")
        moments += [F.avg(rate).alias(f"mean_{name}"), F.var_pop(rate).alias(f"var_{name}")]
    prior = hosts.agg(F.avg("n").alias("n_mean"), *moments).first()
    shrunk = []
    for name in names:
        mean, spread = prior[f"mean_{name}"] or 0.0, prior[f"var_{name}"] or 0.0
        most = max(1.0, float(prior["n_mean"] or 1))
        strength = min(most, max(1.0, mean * (1 - mean) / spread - 1)) if spread > 0 else most
        shrunk.append(((F.col(name) + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))).alias(f"rate_{name}"))
    return hosts.select("host", "n", *names, *shrunk)


def judge(documents: DataFrame, host: str = "source") -> DataFrame:
    """Per row of ``documents`` (doc_id, text, host): its counts, ``base_failed``, ``host_passed`` and ``kept``.

    ``kept`` is false when the document itself is too short or repetitive, or
    its host is rejected. A null text counts as empty; a row without a host is
    judged by itself alone (host_passed is true). Rows that repeat count each.
    Other columns are not read.
    """
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col("text").cast("string").alias("text")
    )
    kinds = ", ".join(f"{name} bigint" for name in _COUNTS)
    measured = materialise(rows.mapInArrow(_measured, f"doc_id bigint, host string, {kinds}"), "measured")
    rates = host_rates(measured)
    worst = F.greatest(*(F.col(f"rate_{name}") for name in rules()))
    failed = rules()["too_short"] | rules()["repetitive"]
    return (
        measured.join(rates.select("host", (worst <= MAX_HOST_RATE).alias("_passed")), "host", "left")
        .withColumn("host_passed", F.coalesce("_passed", F.lit(True)))
        .withColumn("base_failed", failed)
        .select("doc_id", *_COUNTS, "base_failed", (~F.col("base_failed") & F.col("host_passed")).alias("kept"), "host_passed")
    )
