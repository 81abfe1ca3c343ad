"""Mixing to target weights: document rates fitted by projected-gradient least squares.

A classifier learnt from a labelled table predicts, for every document, how far
it belongs to each domain. Rates r >= 0 are then sought such that the expected
tokens per domain, the sum of r * tokens * posterior, meet the targets. Starting
from rate 1, each step moves a document's rate against the domains' excess in
proportion to its posteriors and cuts it at 0; that is projected gradient in the
variables sqrt(tokens) * r, so long documents take no wilder rates. A step needs
only the domains' totals, one grouped sum over all documents; their rates follow
from the history of excesses and are never stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.llm import tokens
from pagequarry.session import materialise

# The classifier is fitted on about so many labelled rows, chosen by a hash of their id.
MAX_LEARNING_ROWS = 20_000
WORD_BUCKETS = 1 << 15
# A word's last byte, and whether it repeats the word before.
SHAPES = 512
SHARPNESS = 0.5
MAX_STEPS = 40
TOLERANCE = 1e-6
# Domains of the labelled table, by (quality, toxic), and their shares of the mix.
TARGETS = {"good": 0.88, "poor": 0.10, "toxic": 0.02}
MAX_DOMAINS = 100


class DomainModel(NamedTuple):
    domains: list[str]
    prior: np.ndarray
    log_shares: np.ndarray  # features x domains


def labelled_domains(labels: DataFrame) -> DataFrame:
    """``doc_id, domain``: toxic, else good or poor by quality; rows without a full label are left out."""
    return labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select(
        "doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor").alias("domain")
    )


def _features(part: tokens.Slice) -> tuple[tokens.Words, np.ndarray, np.ndarray]:
    """Words of a slice with, for each, its bucket and its shape."""
    found = tokens.words(part, fold=True)
    if not len(found.hashes):
        return found, np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.zeros(len(found.hashes), np.int64)
    same[1:] = found.hashes[1:] == found.hashes[:-1]
    same[found.rows[:-1][np.diff(found.rows) > 0]] = 0
    shape = WORD_BUCKETS + 256 * same + part.data[found.ends - 1]
    return found, (found.hashes >> np.uint64(49)).astype(np.int64), shape


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in tokens.slices(batch.column("text")):
            domains = np.array(batch.column("domain").slice(part.first, part.last - part.first).to_pylist(), object)
            found, bucket, shape = _features(part)
            of_word = np.repeat(np.arange(len(domains)), np.diff(found.rows))
            for domain in sorted(set(domains)):
                own = (domains == domain)[of_word]
                total = totals.setdefault(domain, np.zeros(WORD_BUCKETS + SHAPES + 1, np.int64))
                total[-1] += (domains == domain).sum()
                total += np.bincount(np.concatenate([bucket[own], shape[own]]), minlength=len(total))
    for domain, total in sorted(totals.items()):
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([domain] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used])], names=["domain", "feature", "n"]
        )


def learn(documents: DataFrame, domains: DataFrame) -> DomainModel:
    """Naive Bayes over words and word shapes from ``domains`` (doc_id, domain) and the whole texts they name.

    About MAX_LEARNING_ROWS labelled rows are used; the driver receives one
    count per domain and feature.
    """
    known = domains.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("domain").alias("domain"))
    share = min(1.0, MAX_LEARNING_ROWS / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    counted = (
        documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").select("text", "domain")
        .mapInArrow(_counts, "domain string, feature int, n bigint")
        .groupBy("domain", "feature").agg(F.sum("n").alias("n")).toArrow()
    )
    names = sorted(set(counted.column("domain").to_pylist()))
    if len(names) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    table = np.zeros((WORD_BUCKETS + SHAPES + 1, len(names)))
    place = {name: k for k, name in enumerate(names)}
    columns = [place[name] for name in counted.column("domain").to_pylist()]
    table[counted.column("feature").to_numpy(), columns] = counted.column("n").to_numpy()
    rows, words, shapes = table[-1], table[:WORD_BUCKETS] + 0.5, table[WORD_BUCKETS:-1] + 0.5
    shares = np.vstack([words / words.sum(axis=0), shapes / shapes.sum(axis=0)])
    return DomainModel(names, np.log((rows + 1) / (rows + 1).sum()), np.log(shares))


def posteriors(documents: DataFrame, model: DomainModel) -> DataFrame:
    """``doc_id, n_tokens, membership``: whitespace tokens and domain posteriors (in the model's order) of each row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    k = len(model.domains)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in tokens.slices(batch.column("text")):
                found, bucket, shape = _features(part)
                n = np.diff(found.rows)
                logits = np.zeros((len(n), k))
                for domain in range(k):
                    column = known.log_shares[:, domain]
                    logits[:, domain] = tokens.row_sums(column[bucket] + column[shape], found.rows)
                # Words of a text are no independent witnesses: n of them count as the root of n.
                logits = SHARPNESS * logits / np.sqrt(np.maximum(n, 1))[:, None] + known.prior
                odds = np.exp(logits - logits.max(axis=1, keepdims=True))
                member = odds / odds.sum(axis=1, keepdims=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.first, len(n)), tokens.as_longs(n),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * k, pa.int32()), pa.array(member.reshape(-1))),
                    ],
                    names=["doc_id", "n_tokens", "membership"],
                )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(predicted, "doc_id bigint, n_tokens bigint, membership array<double>")


def _rate(moves: list[np.ndarray]) -> Column:
    """A document's rate after the moves so far, from its posteriors."""
    rate = F.lit(1.0)
    for move in moves:
        along = sum((F.col("membership")[k] * F.lit(float(x)) for k, x in enumerate(move)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - along)
    return rate


def fit_rates(memberships: DataFrame, targets: np.ndarray) -> list[np.ndarray]:
    """Moves whose rates bring the domains' expected tokens to ``targets``, by projected gradient steps.

    Steps have the length of Barzilai and Borwein, from the domains' totals
    and their Gram matrix alone. Ends when the excess is TOLERANCE of the
    targets, or after MAX_STEPS; the moves with the smallest excess count.
    """
    k = len(targets)
    member = [F.col("membership")[d] for d in range(k)]
    gram_row = memberships.agg(
        *(F.sum(F.col("n_tokens") * member[a] * member[b]).alias(f"g{a}_{b}") for a in range(k) for b in range(a, k))
    ).first()
    gram = np.zeros((k, k))
    for a in range(k):
        for b in range(a, k):
            gram[a, b] = gram[b, a] = gram_row[f"g{a}_{b}"] or 0.0
    largest = float(np.linalg.eigvalsh(gram)[-1]) if k else 0.0
    if largest <= 0:
        return []
    moves: list[np.ndarray] = []
    best, least, before = 0, np.inf, None
    for _ in range(MAX_STEPS):
        sums = memberships.select("n_tokens", "membership", _rate(moves).alias("rate")).agg(
            *(F.sum(F.col("rate") * F.col("n_tokens") * F.col("membership")[d]).alias(f"t{d}") for d in range(k))
        ).first()
        totals = np.array([sums[f"t{d}"] for d in range(k)])
        excess = totals - targets
        if np.linalg.norm(excess) < least:
            best, least = len(moves), float(np.linalg.norm(excess))
        if least <= TOLERANCE * np.linalg.norm(targets):
            break
        step = 1 / largest
        if before is not None:
            changed, turned = totals - before[0], excess - before[1]
            bend = float(turned @ gram @ turned)
            if bend > 0 and changed @ turned > 0:
                step = float(changed @ turned) / bend
        before = (totals, excess)
        moves.append(step * excess)
    return moves[:best]


def mixing_rates(documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """``doc_id, n_tokens, domain, posterior, rate`` for each row of ``documents`` (doc_id, text).

    ``labels`` (doc_id, quality, toxic) name the domains; the targets are
    shares of the tokens there are, renormalised over the domains found in the
    labels. ``domain`` is the likeliest one (the first in the alphabet among
    equals) and ``posterior`` its probability. Texts that are null or empty have 0
    tokens and the prior's posteriors. Repeated rows count and are rated each.
    Without labelled texts all rates are 1 and domain is null. Other columns
    are not read.
    """
    model = learn(documents, labelled_domains(labels))
    memberships = materialise(posteriors(documents, model), "memberships") if model.domains else None
    if memberships is None:
        return documents.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("n_tokens"),
            F.lit(None).cast("string").alias("domain"), F.lit(None).cast("double").alias("posterior"), F.lit(1.0).alias("rate"),
        )
    wanted = np.array([(TARGETS if targets is None else targets).get(name, 0.0) for name in model.domains])
    total = float(memberships.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0])
    moves = fit_rates(memberships, wanted / wanted.sum() * total) if wanted.sum() > 0 else []
    sure = F.array_max("membership")
    names = F.array(*(F.lit(name) for name in model.domains))
    return memberships.select(
        "doc_id", "n_tokens", F.element_at(names, F.array_position("membership", sure).cast("int")).alias("domain"),
        sure.alias("posterior"),
        # Sums of doubles differ in the last digits from run to run; the rates should not.
        F.round(_rate(moves), 6).alias("rate"),
    )


def mixed(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` with ``mix_rate`` and ``mix_copies`` (how often the row goes into the mix), without rows of no copy.

    Copies are the whole part of the rate plus one with the chance of the rest,
    drawn by a hash of doc_id and text, so that a repeated run mixes alike. A
    row without doc_id goes in once. Columns of these two names are replaced.
    """
    rates = mixing_rates(documents, labels).filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.max("rate").alias("mix_rate"))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(1 << 30)
    copies = F.floor("mix_rate") + F.when(drawn < F.col("mix_rate") - F.floor("mix_rate"), 1).otherwise(0)
    documents = documents.drop("mix_rate", "mix_copies")
    joined = documents.join(rates, documents["doc_id"].cast("bigint") == rates["_id"], "left").drop(rates["_id"])
    return joined.withColumn("mix_rate", F.coalesce("mix_rate", F.lit(1.0))).withColumn("mix_copies", copies.cast("bigint")).filter("mix_copies > 0")
