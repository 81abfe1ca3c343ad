"""Personal data: candidate spans from wide patterns, chosen by boosted trees at calibrated thresholds.

Base spans (email, ip, card, phone) follow exact rules and always count. Wide
patterns propose further spans that may overlap: written-out addresses, numbers
without a plus sign, numbers split in unusual ways. Boosted trees over format
features (lengths, groups, separators, check digit) and context features learn
which of them are personal data: examples for are the corpus's base spans
rewritten in place into the wide forms, examples against are candidates that
cannot be meant (numbers without check digit, dates, prose around "at"). Other
candidates have no label and take no part. A candidate that is no base span is
added when its score reaches the threshold of its kind, from which on PRECISION
of the examples in held-out texts are rewritten base spans. A few fixed examples
of each kind always count, so a corpus without base spans of a kind has a
threshold too.

All examples of all texts count in training: their features take few values,
so equal ones are added up by a grouped count and the trees see the counts.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.llm import tokens
from pagequarry.session import materialise

# Fixed by contract: order of kinds and their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+) begins where digits do and takes whole runs of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Wide patterns, by kind.
_WIDE = {
    "email": re.compile(
        r"\b[A-Za-z0-9._%+-]{1,64}\s?(?i:@|\(at\)|\[at\]|\{at\}|\sat\s)\s?"
        r"(?:[A-Za-z0-9-]{1,63}\s?(?i:\.|\(dot\)|\[dot\]|\{dot\}|\sdot\s)\s?){1,5}[A-Za-z]{2,24}\b"
    ),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\s?[.,]\s?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20./-]{0,2}[0-9]){11,22}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\+|00)?\(?[0-9](?:[\x20()./-]{0,3}[0-9]){6,15}(?![0-9])"),
}
# Spans are looked for only in texts with a digit, an @ or a written-out one.
_TRIGGERS = np.zeros(256, bool)
_TRIGGERS[[*b"0123456789@([{"]] = True
# A blank outside of ASCII counts as one too.
_WRITTEN_OUT = re.compile(rb"(?<![!-~])[Aa][Tt](?![!-~])")

TREES = 40
DEPTH = 3
RATE = 0.3
# Distinct feature vectors the trees are fitted on at most; where there are more, sizes are read more coarsely.
MAX_VECTORS = 50_000
# Features that are sizes. With steps of 2 ** COARSEST all but the length are one value each, which
# leaves 12,800 vectors: 4 kinds, 2 lengths, 5 * 5 neighbours and 6 features that are 0 or 1.
_SIZES = ("length", "digits", "groups", "first_group", "last_group", "longest_group", "separators", "letters")
COARSEST = 5
# Scores are counted by steps of 1 / SCORE_STEPS to find the thresholds.
SCORE_STEPS = 10_000
PRECISION = 0.98
# One of so many texts, by its hash, is held out from fitting and sets the thresholds.
HELD_OUT = 4

FEATURES = (
    "kind", "length", "digits", "groups", "first_group", "last_group", "longest_group", "separators", "plus", "brackets",
    "letters", "at_sign", "luhn", "small_parts", "before", "after", "line_start",
)


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    """Whether a run of digits has a correct check digit."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the exact rules, leftmost and not overlapping within a kind; those that fail are dropped."""
    spans, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            spans.append(Span("email", start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            spans.append(Span("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append(Span("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
                spans.append(Span("phone", m.start(), m.end()))
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Spans of the wide patterns and the base spans; they may overlap."""
    wide = [Span(kind, m.start(), m.end()) for kind, pattern in _WIDE.items() for m in pattern.finditer(text)]
    return list(dict.fromkeys([*base, *wide]))


def _class(text: str, at: int) -> int:
    """Kind of the nearest character that is no blank: 0 none, 1 letter, 2 digit, 3 colon or equals sign, 4 other."""
    if not 0 <= at < len(text):
        return 0
    c = text[at]
    return 1 if c.isalpha() else 2 if c.isdigit() else 3 if c in ":=" else 4


def features(text: str, span: Span) -> tuple[int, ...]:
    """Small whole numbers that describe a candidate and what stands beside it."""
    own = text[span.start:span.end]
    groups = [len(g) for g in re.findall(r"[0-9]+", own)] or [0]
    digits = "".join(re.findall(r"[0-9]", own))
    before, after = span.start - 1, span.end
    while before >= 0 and before > span.start - 4 and text[before] == " ":
        before -= 1
    while after < len(text) and after < span.end + 4 and text[after] == " ":
        after += 1
    return (
        KINDS.index(span.kind), min(len(own), 40), min(len(digits), 24), min(len(groups), 8), min(groups[0], 20), min(groups[-1], 20),
        min(max(groups), 20), min(sum(c in " .-/," for c in own), 10), int("+" in own), int("(" in own),
        min(sum(c.isalpha() for c in own), 30), int("@" in own), int(len(digits) >= 12 and luhn(digits)),
        int(all(len(g) <= 3 and int(g) <= 255 for g in re.findall(r"[0-9]+", own)[:4])),
        _class(text, before), _class(text, after), int(before < 0 or text[before] == "\n"),
    )


_AT_DOT = ((" (at) ", " (dot) "), (" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), ("[at]", "."), (" at ", "."), (" @ ", "."), ("{at}", "{dot}"))


def wide_forms(kind: str, own: str) -> list[str]:
    """A base span as people write it to evade or bend the exact rules; only forms the wide pattern of the kind takes whole."""
    digits = re.sub(r"[^0-9]", "", own)
    if kind == "email":
        local, domain = own.split("@")
        forms = [local + at + domain.replace(".", dot) for at, dot in _AT_DOT]
    elif kind == "ip":
        forms = [own.replace(".", dot) for dot in (" . ", ". ", " .")]
    elif kind == "card":
        forms = [sep.join(digits[k:k + 4] for k in range(0, len(digits), 4)) for sep in (".", "/", "  ", "- ")]
    else:
        # Digits alone would be like any long number.
        bare = own[1:]
        country, _, rest = bare.partition(" ")
        broken = any(not c.isdigit() for c in bare)
        forms = [bare, f"00{bare}"] * broken + [rest] * (sum(map(str.isdigit, rest)) >= 10 and not rest.isdigit())
    return [form for form in forms if _WIDE[kind].fullmatch(form)]


_DATE = re.compile(r"(?<![0-9])(?:(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2})(?![0-9])")
_PROSE = re.compile(r"\sat\s.*?[A-Za-z0-9-](?:\.\s|\s\.)", re.DOTALL | re.IGNORECASE)


def implausible(text: str, span: Span, base: list[Span]) -> bool:
    """Whether a candidate that is no base span cannot be meant as one of its kind."""
    own = text[span.start:span.end]
    groups = re.findall(r"[0-9]+", own)
    digits = "".join(groups)
    if span.kind == "email":
        return _PROSE.search(own) is not None
    if span.kind == "ip":
        return "," in own or any(int(g) > 255 for g in groups)
    if span.kind == "card":
        return not (14 <= len(digits) <= 19 and luhn(digits))
    number = digits.removeprefix("00")
    return (
        not 10 <= len(number) <= 15 or own.isdigit() or len(groups) > 7 or _DATE.search(own) is not None
        or any(s.kind != "phone" and s.start < span.end and span.start < s.end for s in base)
    )


def examples(text: str, every_form: bool = False) -> Iterator[tuple[tuple[int, ...], int]]:
    """Features and label (1 personal, 0 not) of what ``text`` teaches.

    Each base span stands for one of its wide forms, chosen by a hash, where it
    has any; candidates that are no base spans count if implausible.
    """
    base = base_spans(text)
    rules = set(base)
    for span in base:
        own = text[span.start:span.end]
        forms = wide_forms(span.kind, own)
        if forms and not every_form:
            forms = [forms[zlib.crc32(f"{span.start} {own}".encode()) % len(forms)]]
        before = text[max(0, span.start - 8):span.start]
        for form in forms:
            shown = before + form + text[span.end:span.end + 8]
            yield features(shown, Span(span.kind, len(before), len(before) + len(form))), 1
    for span in candidates(text, base):
        if span not in rules and implausible(text, span, base):
            yield features(text, span), 0


def _seeds() -> dict[tuple[int, ...], list[int]]:
    """Examples that count whatever the corpus holds, as [hits, number] by features."""
    frames = ("{}", "see {} today", "Contact: {}.", "a, {}, b", "\n{}\n", "({})")
    given = (
        "joe@example.com", "mary.smith@mail.example.org", "x_1@host-7.net", "info@firm.co.uk", "10.0.3.7", "192.168.100.25", "8.8.4.4", "172.16.254.1",
        "4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005", "6011000990139424",
        "+1 (456) 555-2186", "+44 20 7946 0958", "+49 30 901820-55", "+33 1 42 68 53 00", "+1 212-555-0142",
    )
    against = (
        "meet at noon. Then", "look at it . We", "300.1.2.3", "1.2.999.4", "1,200,300,400", "10, 20, 30, 40", "4111 1111 1111 1112", "1234.5678.9012.3456",
        "12345678901234", "9999/1111/2222/3333", "1234567890", "1700000000000", "2024-01-05 10.20", "05/01/2024 12", "0.1234567", "12 34 56 7", "1 2 3 4 5 6 7 8 9 10",
    )
    found: dict[tuple[int, ...], list[int]] = {}
    for frame in frames:
        for own in (*given, *against):
            for vector, label in examples(frame.format(own), every_form=True):
                count = found.setdefault(vector, [0, 0])
                count[0] += label
                count[1] += 1
    return found


class Trees(NamedTuple):
    """Complete trees of DEPTH levels: a node's feature and highest value that goes left, then the leaves' values."""

    bias: float
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray
    thresholds: dict[str, float]


def fit(vectors: np.ndarray, hits: np.ndarray, counts: np.ndarray) -> Trees:
    """Gradient boosting with logistic loss over distinct vectors: ``hits`` of ``counts`` candidates are personal data."""
    total = max(1.0, float(counts.sum()))
    share = np.clip(hits.sum() / total, 1e-6, 1 - 1e-6)
    bias, nodes, leaves = float(np.log(share / (1 - share))), (1 << DEPTH) - 1, 1 << DEPTH
    feature, limit, leaf = np.zeros((TREES, nodes), int), np.full((TREES, nodes), 1 << 20), np.zeros((TREES, leaves))
    raw = np.full(len(counts), bias)
    for tree in range(TREES if len(counts) else 0):
        chance = 1 / (1 + np.exp(-raw))
        slope, bend = hits - counts * chance, counts * chance * (1 - chance)
        at = np.zeros(len(counts), int)
        for level in range(DEPTH):
            for node in range((1 << level) - 1, (2 << level) - 1):
                own = np.flatnonzero(at == node)
                best = 1e-9
                for column in range(vectors.shape[1]):
                    value = vectors[own, column]
                    g = np.cumsum(np.bincount(value, slope[own])) if len(own) else np.zeros(1)
                    h = np.cumsum(np.bincount(value, bend[own])) if len(own) else np.zeros(1)
                    gain = g**2 / (h + 1) + (g[-1] - g) ** 2 / (h[-1] - h + 1) - g[-1] ** 2 / (h[-1] + 1)
                    cut = int(gain.argmax())
                    if gain[cut] > best:
                        best, feature[tree, node], limit[tree, node] = gain[cut], column, cut
            at = 2 * at + 1 + (vectors[np.arange(len(at)), feature[tree, at]] > limit[tree, at])
        at -= nodes
        g, h = np.bincount(at, slope, minlength=leaves), np.bincount(at, bend, minlength=leaves)
        leaf[tree] = RATE * g / (h + 1)
        raw += leaf[tree, at]
    return Trees(bias, feature, limit, leaf, thresholds(vectors[:, 0], 1 / (1 + np.exp(-raw)), hits, counts))


def thresholds(kinds: np.ndarray, chance: np.ndarray, hits: np.ndarray, counts: np.ndarray) -> dict[str, float]:
    """By kind the lowest score from which on PRECISION of the counted candidates are hits; 2 where there is none."""
    found = {}
    for number, kind in enumerate(KINDS):
        own = np.flatnonzero((kinds == number) & (counts > 0))
        own = own[np.argsort(-chance[own], kind="stable")]
        good, seen = np.cumsum(hits[own]), np.cumsum(counts[own])
        # Only where the next score is lower is a threshold possible.
        last = np.append(chance[own][1:] < chance[own][:-1], True) if len(own) else np.zeros(0, bool)
        fine = np.flatnonzero(last & (good >= PRECISION * seen) & (good > 0))
        found[kind] = float(chance[own][fine[-1]]) if len(fine) else 2.0
    return found


def scores(vectors: np.ndarray, trees: Trees) -> np.ndarray:
    raw, every = np.full(len(vectors), trees.bias), np.arange(len(vectors))
    for tree in range(len(trees.leaf)):
        at = np.zeros(len(vectors), int)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (vectors[every, trees.feature[tree, at]] > trees.limit[tree, at])
        raw += trees.leaf[tree, at - len(trees.feature[tree])]
    return 1 / (1 + np.exp(-raw))


def _texts(part: tokens.Slice) -> Iterator[tuple[int, str | None]]:
    """Rows and their texts; None for texts that cannot hold a span."""
    likely = tokens.row_sums(_TRIGGERS[part.data].astype(np.int64), part.offsets) > 0
    written = np.array([m.start() for m in _WRITTEN_OUT.finditer(part.data)], np.int64)
    likely[np.searchsorted(part.offsets, written, "right") - 1] = True
    for row, found in enumerate(likely):
        yield row, part.data[part.offsets[row]:part.offsets[row + 1]].tobytes().decode("utf-8", "replace") if found else None


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[tuple[int, ...], list[int]] = {}
        for part in tokens.slices(batch.column("text")):
            for _, text in _texts(part):
                if text is not None:
                    side = 2 * (zlib.crc32(text.encode()) % HELD_OUT == 0)
                    for vector, label in examples(text):
                        count = found.setdefault(vector, [0, 0, 0, 0])
                        count[side] += label
                        count[side + 1] += 1
        columns = [pa.array([c[k] for c in found.values()], pa.int64()) for k in range(4)]
        yield pa.RecordBatch.from_arrays([pa.array([list(v) for v in found], pa.list_(pa.int32())), *columns], names=["vector", *_COUNTS])


# Hits and numbers of examples, of texts the trees are fitted on and of held-out ones.
_COUNTS = ("hits", "n", "held_hits", "held_n")


def _coarser(level: int) -> Column:
    """The vector with every size raised to the last of its step of 2 ** level, so that limits hold for exact sizes too."""
    places = F.array(*(F.lit(FEATURES.index(name)) for name in _SIZES))
    return F.transform("vector", lambda value, place: F.when(F.array_contains(places, place), value.bitwiseOR(F.lit((1 << level) - 1))).otherwise(value))


def _by_score(batches: Iterator[pa.RecordBatch], trees: Trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = np.array(batch.column("vector").to_pylist(), int).reshape(-1, len(FEATURES))
        steps = np.floor(scores(vectors, trees) * SCORE_STEPS).astype(np.int32)
        columns = [pa.array(vectors[:, 0], pa.int32()), pa.array(steps), batch.column("held_hits"), batch.column("held_n")]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "step", "hits", "n"])


def learn(documents: DataFrame) -> Trees:
    """Trees fitted on the examples of all texts, thresholds counted on all held-out ones.

    What reaches the driver is bounded, but leaves no example out: vectors for
    the fit are made coarser until there are at most MAX_VECTORS, and examples
    that set thresholds are counted by kind and step of their score.
    """
    counted = materialise(
        documents.select(F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
        .mapInArrow(_vectors, "vector array<int>, " + ", ".join(f"{c} bigint" for c in _COUNTS))
        .groupBy("vector").agg(*(F.sum(c).alias(c) for c in _COUNTS)),
        "pii-vectors",
    )
    for level in range(COARSEST + 1):
        fitted = counted.filter("n > 0").groupBy(_coarser(level).alias("vector")).agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))
        if level == COARSEST or fitted.count() <= MAX_VECTORS:
            break
    found, seeds = fitted.orderBy("vector").toArrow(), _seeds()
    fixed_vectors, fixed = np.array(list(seeds), int), np.array(list(seeds.values()), float)
    vectors = np.array([*found.column("vector").to_pylist(), *seeds], int).reshape(-1, len(FEATURES))
    trees = fit(vectors, *(np.append(found.column(c).to_numpy(), fixed[:, k]) for k, c in enumerate(("hits", "n"))))
    held = (
        counted.filter("held_n > 0").mapInArrow(lambda batches: _by_score(batches, trees), "kind int, step int, hits bigint, n bigint")
        .groupBy("kind", "step").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).toArrow()
    )
    fixed_held = fixed_vectors[:, 0], np.floor(scores(fixed_vectors, trees) * SCORE_STEPS), fixed[:, 0], fixed[:, 1]
    kinds, steps, hits, n = (np.append(held.column(c).to_numpy(), own) for c, own in zip(("kind", "step", "hits", "n"), fixed_held))
    return trees._replace(thresholds=thresholds(kinds, steps / SCORE_STEPS, hits, n))


def chosen_spans(text: str, trees: Trees) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: base ones and the added ones, which are not implausible and overlap none before them."""
    base = base_spans(text)
    rules = set(base)
    taken = bytearray(len(text))
    for span in base:
        taken[span.start:span.end] = b"\x01" * (span.end - span.start)
    more = [s for s in candidates(text, base) if s not in rules and 1 not in taken[s.start:s.end] and not implausible(text, s, base)]
    if not more:
        return base, base
    sure = scores(np.array([features(text, s) for s in more]), trees)
    added: list[Span] = []
    for k in sorted(range(len(more)), key=lambda k: (-sure[k], more[k].start, -more[k].end)):
        span = more[k]
        if sure[k] >= trees.thresholds[span.kind] and 1 not in taken[span.start:span.end]:
            added.append(span)
            taken[span.start:span.end] = b"\x01" * (span.end - span.start)
    return base, sorted([*base, *added], key=lambda s: (s.start, KINDS.index(s.kind)))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def find(documents: DataFrame, trees: Trees) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): counts and digest of its base spans, and all spans.

    A null or empty text has none. Repeated rows get equal results; other
    columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(trees)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch.column("text")):
                spans = [chosen_spans(text, shared.value) if text is not None else ([], []) for _, text in _texts(part)]
                counts = [[sum(s.kind == kind for s in base) for base, _ in spans] for kind in KINDS]
                digests = [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.first, len(spans)), *(pa.array(c, pa.int64()) for c in counts),
                        pa.array(digests, pa.string()), pa.array([_joined(every) for _, every in spans], pa.string()),
                    ],
                    names=["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"],
                )

    kinds = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(found, f"doc_id bigint, {kinds}, base_sha256 string, spans string")


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    pieces, at = [], 0
    for span in spans:
        if span.start >= at:
            pieces += [text[at:span.start], f"<{span.kind}>"]
        at = max(at, span.end)
    return "".join([*pieces, text[at:]])


def redacted(documents: DataFrame, trees: Trees) -> DataFrame:
    """``documents`` with all spans in ``text`` replaced; all columns stay, n_chars follows the text where there is one."""
    shared = documents.sparkSession.sparkContext.broadcast(trees)

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            for part in tokens.slices(batch.column(place)):
                rows = batch.slice(part.first, part.last - part.first)
                old = rows.column(place)
                new: dict[int, str] = {}
                for row, text in _texts(part):
                    spans = chosen_spans(text, shared.value)[1] if text is not None else []
                    if spans:
                        new[row] = redact(text, spans)
                if new:
                    mask = np.zeros(len(old), bool)
                    mask[list(new)] = True
                    texts = pyarrow.compute.replace_with_mask(old, pa.array(mask), pa.array(list(new.values()), old.type))
                    rows = rows.set_column(place, rows.schema.field(place), texts)
                yield rows

    changed = documents.mapInArrow(replaced, documents.schema)
    if "n_chars" in documents.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast(documents.schema["n_chars"].dataType))
    return changed
