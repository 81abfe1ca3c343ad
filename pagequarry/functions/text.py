"""Cleaning, tokens and truncation as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bullets and the arrow, and a capital letter followed by "/g".
SYMBOL_PATTERN = r"[●■➔]|[A-Z]/g"
# Control characters other than tab and line breaks.
ILLEGAL_PATTERN = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
TOKEN_PATTERN = r"\S+"
# English function words, in alphabetical order.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "had", "has", "have",
    "he", "her", "his", "i", "in", "is", "it", "its", "not", "of", "on", "or", "our", "she",
    "that", "the", "their", "they", "this", "to", "was", "we", "were", "which", "with", "you",
)


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def explode_rows(df: DataFrame, array: Column, *names: str) -> DataFrame:
    """Position and element of ``array`` as two more columns, one row each; empty arrays drop the row.

    A plain ``explode`` makes the optimizer filter on the array first, which
    would compute a costly array expression three times.
    """
    position, element = names
    return df.select("*", F.posexplode_outer(array).alias(position, element)).filter(F.col(position).isNotNull())


def clean_symbols(text: Column, collapse_whitespace: bool = False) -> Column:
    cleaned = F.regexp_replace(text, SYMBOL_PATTERN, " ")
    return F.regexp_replace(cleaned, r"\s+", " ") if collapse_whitespace else cleaned


def remove_illegal_characters(text: Column) -> Column:
    return F.regexp_replace(text, ILLEGAL_PATTERN, "")


def normalise_case(text: Column) -> Column:
    """Lower-case, single blanks, no outer blanks."""
    return F.trim(F.regexp_replace(F.lower(remove_illegal_characters(text)), r"\s+", " "))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"\A\s+|\s+\z", "")


def collapse_blank_lines(text: Column) -> Column:
    """At most one empty line in a row, no outer whitespace."""
    return strip(F.regexp_replace(text, "\n{3,}", "\n\n"))


def words(text: Column) -> Column:
    """Lower-case runs of letters, of any script."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), "")


def remove_stop_words(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Words joined by one blank, without symbols and without stop words."""
    kept = F.filter(words(text), lambda word: ~word.isin(*stop_words))
    return F.array_join(kept, " ")


def token_count(text: Column, pattern: str = TOKEN_PATTERN) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def token_pieces(text: Column, pattern: str = TOKEN_PATTERN) -> Column:
    """Tokens, each with whatever stands before it, so joining them restores the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).*?(?:{pattern})"), F.lit(0))


def truncate_tokens(text: Column, max_tokens: int = 4000, pattern: str = TOKEN_PATTERN) -> Column:
    """The text up to the end of token ``max_tokens``; a shorter text is untouched."""
    cut = F.array_join(F.slice(token_pieces(text, pattern), 1, max_tokens), "")
    return F.when(token_count(text, pattern) <= max_tokens, text).otherwise(cut)


def sentences(text: Column) -> Column:
    """Non-blank sentences: runs that end in full stops, question or exclamation marks."""
    found = F.regexp_extract_all(text, F.lit(r"[^.!?]+[.!?]*"), F.lit(0))
    return F.filter(F.transform(found, strip), lambda s: s != "")


def line_breaks_to_html(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit("<br/>"))


def drop_leading_label(text: Column, label: str = "Answer: ") -> Column:
    return F.when(F.startswith(text, F.lit(label)), F.substring(text, len(label) + 1, 2**31 - 1)).otherwise(text)


def long_texts(text: Column, limit: int = 10_000) -> Column:
    """Gate for the summary step: strictly more than ``limit`` characters."""
    return F.length(text) > limit


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of one row's tokens, without leaving the row.

    Sorting puts equal tokens side by side; a term's count is the distance
    from its first position to the next term's.
    """

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(1), F.greatest(size, F.lit(1))),
            lambda i: (i <= size)
            & ((i == 1) | (F.element_at(ordered, i) != F.element_at(ordered, F.greatest(i - 1, F.lit(1))))),
        )
        return let(
            F.concat(starts, F.array(size + 1)),
            lambda bounds: F.transform(
                F.slice(bounds, F.lit(1), F.size(bounds) - 1),
                lambda start, i: F.struct(
                    F.element_at(ordered, start).alias("term"),
                    (F.element_at(bounds, i + 2) - start).cast("bigint").alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(tokens), runs)
