"""Splitting pages and texts into token-bounded chunks, one row per chunk."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.html import ENTITIES, INVISIBLE_PATTERN, TAG_PATTERN, sections
from pagequarry.functions.text import (
    TOKEN_PATTERN,
    collapse_blank_lines,
    explode_rows,
    let,
    token_count,
    token_pieces,
    truncate_tokens,
)

MAX_TOKENS = 4000
MIN_TOKENS = 100
CHUNKS_PER_PAGE = 65_536

_STATE = "struct<open:string,done:array<string>>"


def pack_sections(
    parts: Column,
    max_tokens: int = MAX_TOKENS,
    min_tokens: int = MIN_TOKENS,
    pattern: str = TOKEN_PATTERN,
    keep_tail: bool = False,
    keep_all: bool = False,
) -> Column:
    """Grow a chunk section by section, closing it once it exceeds half of ``max_tokens``.

    What is left at the end becomes a chunk if it has more than ``min_tokens``
    and is lost otherwise; ``keep_tail`` keeps any tail with a token in it.
    What exceeds ``max_tokens`` in a chunk is cut off; ``keep_all`` makes it
    further chunks, and keeps the tail.
    """

    def state(open_text: Column, done: Column) -> Column:
        return F.struct(open_text.alias("open"), done.alias("done")).cast(_STATE)

    def closed(current: Column) -> Column:
        if keep_all:
            cut = fixed_length_chunks(collapse_blank_lines(current["open"]), max_tokens, pattern)
        else:
            cut = F.array(let(collapse_blank_lines(current["open"]), lambda text: truncate_tokens(text, max_tokens, pattern)))
        return F.concat(current["done"], cut)

    def step(current: Column, part: Column) -> Column:
        return F.when(token_count(current["open"], pattern) * 2 > max_tokens, state(part, closed(current))).otherwise(
            state(F.concat(current["open"], part), current["done"])
        )

    def finish(current: Column) -> Column:
        least = 0 if keep_tail or keep_all else min_tokens
        return F.when(token_count(current["open"], pattern) > least, closed(current)).otherwise(current["done"])

    return F.aggregate(parts, state(F.lit(""), F.array().cast("array<string>")), step, finish)


def page_chunks(
    html: Column,
    max_tokens: int = MAX_TOKENS,
    min_tokens: int = MIN_TOKENS,
    tag: str = "h2",
    pattern: str = TOKEN_PATTERN,
    keep_tail: bool = False,
    keep_all: bool = False,
) -> Column:
    """Chunks of one page: its whole text if that fits, packed sections otherwise; null for a null page."""
    chunks = let(
        sections(html, tag),
        lambda parts: let(
            F.array_join(parts, ""),
            lambda text: F.when(
                token_count(text, pattern) > max_tokens,
                pack_sections(parts, max_tokens, min_tokens, pattern, keep_tail, keep_all),
            ).otherwise(F.array(collapse_blank_lines(text))),
        ),
    )
    return F.when(html.isNotNull(), chunks)


class RegexTokenizer:
    """The interface a tokenizer needs, here over a regular expression."""

    def __init__(self, pattern: str = TOKEN_PATTERN):
        self.token = re.compile(pattern)

    def count(self, text: str) -> int:
        return sum(1 for _ in self.token.finditer(text))

    def truncate(self, text: str, max_tokens: int) -> str:
        for number, token in enumerate(self.token.finditer(text), 1):
            if number == max_tokens:
                return text[: token.end()] if self.count(text) > max_tokens else text
        return text


def _plain(html: str) -> str:
    text = re.sub(TAG_PATTERN, "", html)
    for entity, character in ENTITIES:
        text = text.replace(entity, character)
    return text


def _tidy(text: str) -> str:
    return re.sub("\n{3,}", "\n\n", text).strip()


def _cut(text: str, tokenizer, max_tokens: int, keep_all: bool) -> list[str]:
    """``text`` up to ``max_tokens``, with ``keep_all`` followed by the rest in pieces of that length."""
    first = tokenizer.truncate(text, max_tokens)
    pieces, rest = [first], text[len(first):]
    while keep_all and first and tokenizer.count(rest):
        first = tokenizer.truncate(rest, max_tokens)
        pieces.append(first)
        rest = rest[len(first):]
    return pieces


def _split_page(
    html: str, tokenizer, max_tokens: int, min_tokens: int, boundary: re.Pattern, keep_tail: bool, keep_all: bool
) -> list[str]:
    parts = [_plain(part) for part in boundary.split(re.sub(INVISIBLE_PATTERN, "", html))]
    text = "".join(parts)
    if tokenizer.count(text) <= max_tokens:
        return [_tidy(text)]
    chunks, grown = [], ""
    for part in parts:
        if tokenizer.count(grown) * 2 > max_tokens:
            chunks += _cut(_tidy(grown), tokenizer, max_tokens, keep_all)
            grown = ""
        grown += part
    if tokenizer.count(grown) > (0 if keep_tail or keep_all else min_tokens):
        chunks += _cut(_tidy(grown), tokenizer, max_tokens, keep_all)
    return chunks


def page_chunks_with(
    html: Column,
    tokenizer: Callable[[], object] = RegexTokenizer,
    max_tokens: int = MAX_TOKENS,
    min_tokens: int = MIN_TOKENS,
    tag: str = "h2",
    keep_tail: bool = False,
    keep_all: bool = False,
) -> Column:
    """:func:`page_chunks` for a Python tokenizer, which is built once per task, when its first batch arrives."""

    @F.pandas_udf("array<string>")
    def chunks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        loaded, boundary = None, re.compile(rf"(?=<{tag}[ >])")
        for pages in batches:
            loaded = loaded or tokenizer()
            yield pages.map(
                lambda page: None
                if page is None
                else _split_page(page, loaded, max_tokens, min_tokens, boundary, keep_tail, keep_all)
            )

    return chunks(html)


def explode_chunks(df: DataFrame, chunks: Column, *keep: str, content: str = "content") -> DataFrame:
    """One row per chunk with its number from 0; rows without chunks disappear."""
    rows = explode_rows(df, chunks, "_chunk_no", "_chunk")
    return rows.select(*keep, F.col("_chunk_no").cast("bigint").alias("chunk_no"), F.col("_chunk").alias(content))


def chunk_id(page_id: Column, chunk_no: Column) -> Column:
    """A single number for ``(page_id, chunk_no)``; a page with too many chunks fails the job."""
    message = F.concat(F.lit("chunk number out of range: "), chunk_no.cast("string"))
    return F.when(chunk_no < CHUNKS_PER_PAGE, page_id * CHUNKS_PER_PAGE + chunk_no).otherwise(
        F.raise_error(message).cast("bigint")
    )


def paragraphs(text: Column) -> Column:
    """Non-blank lines."""
    return F.filter(F.split(text, "\n"), lambda line: F.trim(line) != "")


def fixed_length_chunks(text: Column, size: int, pattern: str = TOKEN_PATTERN) -> Column:
    """Pieces of ``size`` tokens, the last one shorter; joined they restore the text up to its last token."""
    return let(
        token_pieces(text, pattern),
        lambda pieces: F.transform(
            F.filter(
                F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)), F.lit(size)), lambda i: i <= F.size(pieces)
            ),
            lambda start: F.array_join(F.slice(pieces, start, F.lit(size)), ""),
        ),
    )
