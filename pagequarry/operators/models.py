"""Hooks for models, called on Arrow batches and created once per task, when its first batch arrives."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.functions.text import long_texts

# A text model factory builds a function from a batch of prompts to replies;
# an embedder factory builds one from a batch of texts to a matrix.
TextModel = Callable[[], Callable[[list[str]], list[str]]]
Embedder = Callable[[], Callable[[pa.Array], np.ndarray]]

# Bytes of text that an embedder receives at a time, a single longer text apart.
EMBEDDED_BYTES = 2_000_000


def call_model(prompt: Column, model: TextModel) -> Column:
    """Replies to ``prompt``; a null prompt is not sent and stays null."""

    @F.arrow_udf("string")
    def reply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = None
        for batch in batches:
            run = run or model()
            prompts = batch.to_pylist()
            asked = [i for i, text in enumerate(prompts) if text is not None]
            replies: list[str | None] = [None] * len(prompts)
            answers = run([prompts[i] for i in asked])
            if len(answers) != len(asked):
                raise ValueError(f"{len(answers)} replies to {len(asked)} prompts")
            for i, text in zip(asked, answers):
                replies[i] = text
            yield pa.array(replies, pa.string())

    return reply(prompt)


def try_model(prompt: Column, model: TextModel) -> Column:
    """``struct<reply, error>`` of each prompt; one that fails leaves the others their replies.

    After an error the prompts of the batch are sent one by one. A null prompt
    is not sent and has neither reply nor error.
    """

    def attempt(run: Callable[[list[str]], list[str]], prompts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            answers = run(prompts)
            if len(answers) != len(prompts):
                raise ValueError(f"{len(answers)} replies to {len(prompts)} prompts")
            return [(answer, None) for answer in answers]
        except Exception as error:  # whatever a model raises belongs to its prompt
            if len(prompts) == 1:
                return [(None, f"{type(error).__name__}: {error}")]
            return [attempt(run, [one])[0] for one in prompts]

    @F.arrow_udf("struct<reply: string, error: string>")
    def outcome(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = None
        for batch in batches:
            run = run or model()
            prompts = batch.to_pylist()
            asked = [i for i, text in enumerate(prompts) if text is not None]
            replies: list[str | None] = [None] * len(prompts)
            errors: list[str | None] = [None] * len(prompts)
            found = attempt(run, [prompts[i] for i in asked]) if asked else []
            for i, (reply, error) in zip(asked, found):
                replies[i], errors[i] = reply, error
            yield pa.StructArray.from_arrays([pa.array(replies, pa.string()), pa.array(errors, pa.string())], ["reply", "error"])

    return outcome(prompt)


def summarise_with(text: Column, model: TextModel, limit: int = 10_000) -> Column:
    """Summaries by ``model`` of texts over ``limit`` characters; other texts are not sent and stay."""
    return F.coalesce(call_model(F.when(long_texts(text, limit), text), model), text)


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of consecutive rows whose ``sizes`` sum to at most ``most``; a larger row is a run of its own."""
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop
        start = stop


def embed(text: Column, embedder: Embedder) -> Column:
    """``array<float>`` vectors of ``text``; a null text is not sent and stays null."""

    @F.arrow_udf("array<float>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = None
        for batch in batches:
            given = batch.is_valid().to_numpy(zero_copy_only=False)
            if not given.any():
                yield pa.nulls(len(batch), pa.list_(pa.float32()))
                continue
            run = run or embedder()
            sent = batch.drop_null()
            parts = []
            for start, stop in slices(pc.binary_length(sent).to_numpy(zero_copy_only=False), EMBEDDED_BYTES):
                part = np.asarray(run(sent.slice(start, stop - start)), dtype=np.float32)
                if len(part) != stop - start:
                    raise ValueError(f"{len(part)} vectors for {stop - start} texts")
                parts.append(part)
            matrix = np.concatenate(parts)
            offsets = np.concatenate([[0], np.cumsum(given)]).astype(np.int32) * matrix.shape[1]
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)), mask=pa.array(~given))

    return vectors(text)


def hashed_words(dimension: int = 64, cache_size: int = 100_000) -> Embedder:
    """Deterministic stand-in for an embedding model: signed hashed word counts, unit length.

    The first 32 bits of a word's MD5 give its position (modulo ``dimension``)
    and its sign (parity of the quotient).
    """

    def factory() -> Callable[[pa.Array], np.ndarray]:
        known: dict[str, int] = {}

        def number(word: str) -> int:
            value = known.get(word)
            if value is None:
                if len(known) >= cache_size:
                    known.clear()
                value = known[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16)
            return value

        def run(texts: pa.Array) -> np.ndarray:
            pieces = pc.split_pattern_regex(pc.utf8_lower(texts), r"[^\p{L}]+")
            row = np.repeat(np.arange(len(texts)), pc.list_value_length(pieces).to_numpy(zero_copy_only=False))
            coded = pieces.flatten().dictionary_encode()
            vocabulary = coded.dictionary.to_pylist()
            numbers = np.array([number(word) if word else 0 for word in vocabulary], dtype=np.int64)
            signs = np.array(
                [(1.0 if (n // dimension) % 2 == 0 else -1.0) if w else 0.0 for w, n in zip(vocabulary, numbers)]
            )
            codes = coded.indices.to_numpy(zero_copy_only=False)
            cells = row * dimension + numbers[codes] % dimension if len(codes) else np.zeros(0, np.int64)
            weights = signs[codes] if len(codes) else np.zeros(0)
            counts = np.bincount(cells, weights, len(texts) * dimension).reshape(len(texts), dimension)
            norms = np.sqrt((counts**2).sum(axis=1, keepdims=True))
            return np.divide(counts, norms, out=np.zeros_like(counts), where=norms > 0)

        return run

    return factory


def stub_chat_model() -> TextModel:
    """Stand-in for a chat model: the response JSON of a model that answers with the prompt's MD5."""

    def factory() -> Callable[[list[str]], list[str]]:
        def run(prompts: list[str]) -> list[str]:
            return [
                json.dumps(
                    {
                        "candidates": [
                            {"message": {"role": "assistant", "content": f"Reply\n{hashlib.md5(p.encode()).hexdigest()}"}}
                        ]
                    }
                )
                for p in prompts
            ]

        return run

    return factory


def stub_text_model() -> TextModel:
    """Stand-in for a completion model that repeats its prompt before the reply."""

    def factory() -> Callable[[list[str]], list[str]]:
        return lambda prompts: [f"{p}Reply {hashlib.md5(p.encode()).hexdigest()}" for p in prompts]

    return factory


def stub_question_model() -> TextModel:
    """Stand-in for a question writer: one or two questions as JSON, or plain text by mistake.

    The first hex digit of the prompt's MD5 decides: below 4 plain text, below
    a one question, else two.
    """

    def factory() -> Callable[[list[str]], list[str]]:
        def run(prompts: list[str]) -> list[str]:
            replies = []
            for prompt in prompts:
                digest = hashlib.md5(prompt.encode()).hexdigest()
                asked = [f"What is {digest[1:5]}?", f"Why {digest[5:9]}?"]
                if digest[0] < "4":
                    replies.append("Sorry, no questions.")
                else:
                    replies.append(json.dumps(asked[:1] if digest[0] < "a" else asked))
            return replies

        return run

    return factory
