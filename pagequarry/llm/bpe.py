"""Byte-level BPE encoding and decoding by backtracking over longest matches (operator 11).

A text is split by the pre-tokenising pattern and every piece is encoded on
its own, as a rank file's BPE does it. A piece that is a whole token is that
token. Otherwise its UTF-8 bytes are read as Latin-1 characters, one per byte,
so that a trie of all tokens (pyahocorasick) tells, at a byte position the
encoder comes to, how long a token starting there can be; the tokens are the
prefixes of that length or less that the rank file has. The encoder takes the longest token at the current
position if it may follow the token before it, else the next shorter one;
when none is left at a position, it takes back the token before and tries
that position's next shorter one. Two tokens may follow each other when BPE
of their joined bytes gives back the same two; this is computed once per
pair and remembered. A sequence in which every neighbouring pair is
compatible is the BPE encoding of its bytes, and it is unique, so a position
from which no encoding was found is never tried again: the work is linear in
the length of the piece. Tokens that BPE of their own bytes does not give
are never chosen.

Decoding joins the tokens' bytes. Null texts are encoded as empty texts; an
id outside the rank file cannot be decoded and raises.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.operators.models import slices

# The largest rank file taken to the executors.
MAX_RANK_FILE_BYTES = 64 << 20
# Pairs remembered per worker; the memo starts afresh when full.
MEMO_PAIRS = 1 << 19
# Tokens of remembered encodings; pieces of more than MEMO_TOKENS / 64 tokens are not remembered.
# When full, what was not asked for since the last time is forgotten.
MEMO_TOKENS = 1 << 20
# Bytes of text encoded, or ids decoded, before they become Arrow arrays.
CODED_BYTES = 2_000_000


def default_ranks_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Encoder:
    """BPE of one rank file and pre-tokenising pattern, built once per Python worker."""

    def __init__(self, ranks: bytes, pattern: str):
        self.tokens: list[bytes] = []
        self.rank: dict[bytes, int] = {}
        for line in ranks.splitlines():
            if line.strip():
                token, rank = line.split()
                self.rank[base64.b64decode(token)] = int(rank)
        self.tokens = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.tokens[rank] = token
        missing = [byte for byte in range(256) if bytes([byte]) not in self.rank]
        if missing:
            raise ValueError(f"the rank file lacks single bytes {missing[:8]}")
        # Pieces that are whole tokens, by their text; the common case needs no bytes.
        self.whole: dict[str, int] = {}
        for token, rank in self.rank.items():
            try:
                self.whole[token.decode("utf-8")] = rank
            except UnicodeDecodeError:
                pass
        self.pattern = regex.compile(pattern)
        self.by_text = {token.decode("latin-1"): rank for token, rank in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self._reachable: dict[int, bool] = {}
        self._compatible: dict[int, bool] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self._held = 0

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """All tokens; made for the first piece that needs it, so a worker that only decodes has none."""
        found = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for token in self.rank:
            found.add_word(token.decode("latin-1"))
        return found

    def merge(self, piece: bytes) -> list[int]:
        """Plain BPE of a short byte string: the lowest-ranked neighbouring pair merges first, leftmost on ties."""
        parts = [piece[at : at + 1] for at in range(len(piece))]
        rank = self.rank
        while len(parts) > 1:
            best, where = None, -1
            for at in range(len(parts) - 1):
                value = rank.get(parts[at] + parts[at + 1])
                if value is not None and (best is None or value < best):
                    best, where = value, at
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return [rank[part] for part in parts]

    def reachable(self, token: int) -> bool:
        known = self._reachable.get(token)
        if known is None:
            known = self._reachable[token] = len(self.tokens[token]) == 1 or self.merge(self.tokens[token]) == [token]
        return known

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) >= MEMO_PAIRS:
                self._compatible.clear()
            known = self._compatible[key] = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def encode_piece(self, piece: str) -> list[int]:
        """Tokens of one piece that is no whole token."""
        text = piece.encode("utf-8").decode("latin-1")
        size = len(text)
        ranks, known, compatible = self.by_text, self._reachable, self.compatible
        prefix, longest = self.automaton.longest_prefix, self.longest
        dead = bytearray(size + 1)
        chosen: list[int] = []
        starts: list[int] = []
        lengths: list[int] = []
        at = 0
        length = prefix(text[:longest])
        while at < size:
            while length > 0:
                token = ranks.get(text[at : at + length])
                if (
                    token is not None
                    and not dead[at + length]
                    and (known.get(token) or self.reachable(token))
                    and (not chosen or compatible(chosen[-1], token))
                ):
                    break
                length -= 1
            if length > 0:
                chosen.append(token)
                starts.append(at)
                lengths.append(length)
                at += length
                length = prefix(text[at : at + longest])
                continue
            # Nothing fits here after what was chosen before: that choice was wrong.
            dead[at] = 1
            if not chosen:
                raise ValueError("no encoding found; the rank file is not byte-level BPE")
            chosen.pop()
            at = starts.pop()
            length = lengths.pop() - 1
        return chosen

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        if not text:
            return ids
        whole = self.whole
        for piece in self.pattern.findall(text):
            rank = whole.get(piece)
            if rank is not None:
                ids.append(rank)
                continue
            found = self._pieces.get(piece)
            if found is None:
                found = self._older.get(piece) or tuple(self.encode_piece(piece))
                if len(found) <= MEMO_TOKENS // 64:
                    if self._held + len(found) > MEMO_TOKENS:
                        self._older, self._pieces, self._held = self._pieces, {}, 0
                    self._pieces[piece] = found
                    self._held += len(found)
            ids.extend(found)
        return ids

    def decode(self, ids) -> bytes:
        tokens = self.tokens
        return b"".join(tokens[token] for token in ids)


    @cached_property
    def _token_bytes(self) -> pa.Array:
        return pa.array(self.tokens, pa.binary())

    def decode_lists(self, lists: pa.Array, sizes: np.ndarray) -> pa.Array:
        """:meth:`decode` of every list; the bytes of all tokens lie side by side already."""
        taken = self._token_bytes.take(lists.flatten())
        lengths = pc.binary_length(taken).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        offsets = ends[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])].astype(np.int32)
        if not len(taken):
            return pa.array([b""] * len(lists), pa.binary())
        return pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets), taken.buffers()[2]])


@lru_cache(maxsize=4)
def _encoder(ranks: bytes, pattern: str) -> Encoder:
    return Encoder(ranks, pattern)


def read_ranks(ranks_file: str | None = None) -> bytes:
    """The rank file's bytes, checked to be small enough to travel to every task."""
    path = ranks_file or default_ranks_file()
    size = os.path.getsize(path)
    if size > MAX_RANK_FILE_BYTES:
        raise ValueError(f"{path} has {size} bytes, more than {MAX_RANK_FILE_BYTES}")
    with open(path, "rb") as handle:
        return handle.read()


def _shared(spark, ranks_file: str | None, pattern: str | None):
    """The rank file is read on the driver and broadcast: executors need no access to its folder."""
    return spark.sparkContext.broadcast((read_ranks(ranks_file), pattern or default_pattern()))


def encoded(text: Column, spark, ranks_file: str | None = None, pattern: str | None = None) -> Column:
    """Token ids of ``text`` (null: empty), as ``array<int>``."""
    shared = _shared(spark, ranks_file, pattern)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(*shared.value)
        for texts in batches:
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            parts = [pa.array([], pa.list_(pa.int32()))]
            for start, stop in slices(sizes, CODED_BYTES):
                # One text's ids at a time are Python numbers.
                found = [np.array(encoder.encode(texts[at].as_py()), np.int32) for at in range(start, stop)]
                parts.append(pa.array(found, pa.list_(pa.int32())))
            yield pa.concat_arrays(parts)

    return encode(text)


def decoded(ids: Column, spark, ranks_file: str | None = None, pattern: str | None = None) -> Column:
    """The bytes of ``ids`` (null: empty), as ``binary``."""
    shared = _shared(spark, ranks_file, pattern)

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(*shared.value)
        for lists in batches:
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            parts = [pa.array([], pa.binary())]
            for start, stop in slices(sizes, CODED_BYTES // 4):
                parts.append(encoder.decode_lists(lists.slice(start, stop - start), sizes[start:stop]))
            yield pa.concat_arrays(parts)

    return decode(ids)


def round_trip(documents: DataFrame, text: str = "text", ranks_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """``documents`` with ``ids`` (the encoding of ``text``) and ``decoded`` (the bytes those ids give).

    Existing columns named ``ids`` or ``decoded`` are replaced. Every row is
    kept, in its partition; nothing is shuffled.
    """
    spark = documents.sparkSession
    with_ids = documents.withColumn("ids", encoded(F.col(text), spark, ranks_file, pattern))
    return with_ids.withColumn("decoded", decoded(F.col("ids"), spark, ranks_file, pattern))
