"""Pieces of SQL shared by the checking queries."""

from __future__ import annotations

from collections.abc import Sequence

from pagequarry.functions.html import ENTITIES, INVISIBLE_PATTERN, TAG_PATTERN
from pagequarry.functions.text import TOKEN_PATTERN


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def significant(number: str, digits: int = 9) -> str:
    return f"CASE WHEN {number} = 0 THEN 0 ELSE round({number}, CAST({digits - 1} - floor(log10(abs({number}))) AS INTEGER)) END"


def replace_all(column: str, pattern: str, by: str) -> str:
    return f"regexp_replace({column}, {quoted(pattern)}, {quoted(by)}, 'g')"


def strip(column: str) -> str:
    return replace_all(column, r"\A\s+|\s+\z", "")


def collapse(column: str) -> str:
    return strip(replace_all(column, "\n{3,}", "\n\n"))


def words(column: str) -> str:
    return f"list_filter(string_split_regex(lower({column}), '[^\\p{{L}}]+'), lambda w: w <> '')"


def tokens(column: str, pattern: str = TOKEN_PATTERN) -> str:
    return f"regexp_extract_all({column}, {quoted(pattern)})"


def pieces(column: str, pattern: str = TOKEN_PATTERN) -> str:
    return f"regexp_extract_all({column}, {quoted(f'(?s).*?(?:{pattern})')})"


def truncated(column: str, size: int) -> str:
    cut = f"array_to_string(list_slice({pieces(column)}, 1, {size}), '')"
    return f"CASE WHEN len({tokens(column)}) <= {size} THEN {column} ELSE {cut} END"


def decoded(column: str) -> str:
    for entity, character in ENTITIES:
        column = f"replace({column}, {quoted(entity)}, {quoted(character)})"
    return column


def visible(column: str) -> str:
    return replace_all(column, INVISIBLE_PATTERN, "")


def plain(column: str) -> str:
    return decoded(replace_all(column, TAG_PATTERN, ""))


def article(column: str = "html") -> str:
    pattern = quoted(r"(?s)<article(?:\s[^>]*)?>(.*?)</article>")
    return f"CASE WHEN regexp_matches({column}, {pattern}) THEN regexp_extract({column}, {pattern}, 1) END"


def filled(template: str, **columns: str) -> str:
    """``concat`` of a template whose slots are SQL expressions."""
    parts, rest = [], template
    while rest:
        found = [(rest.find("{" + name + "}"), name) for name in columns if "{" + name + "}" in rest]
        if not found:
            parts.append(quoted(rest))
            break
        at, name = min(found)
        if at:
            parts.append(quoted(rest[:at]))
        parts.append(columns[name])
        rest = rest[at + len(name) + 2 :]
    return "(" + " || ".join(parts) + ")"


def hashed_vectors(name: str, source: str, id: str, text: str, dimension: int = 64) -> str:
    """CTEs ending in ``name (id, dim, w)``: non-zero entries of the default embedder's vectors."""
    return f"""
    {name}_hashes AS (
        SELECT id, ('0x' || substr(md5(word), 1, 8))::BIGINT AS h
        FROM (SELECT {id} AS id, unnest({words(text)}) AS word FROM {source})),
    {name}_counts AS (
        SELECT id, h % {dimension} AS dim, sum(CASE WHEN (h // {dimension}) % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS c
        FROM {name}_hashes GROUP BY 1, 2),
    {name}_norms AS (SELECT id, sqrt(sum(c * c)) AS norm FROM {name}_counts GROUP BY id),
    {name} AS (
        SELECT id, dim, (c / norm)::FLOAT::DOUBLE AS w
        FROM {name}_counts JOIN {name}_norms USING (id) WHERE c <> 0)"""


def vector_sums(name: str, source: str, id: str, text: str) -> str:
    """CTEs ending in ``name (id, total)``: :func:`hashed_vectors` weighed by position; texts without words have none."""
    return f"""{hashed_vectors(name + '_v', source, id, text)},
    {name} AS (SELECT id, round(sum(w * (dim + 1)), 6) AS total FROM {name}_v GROUP BY id)"""


def cosine_ranking(name: str, questions: str, index: str) -> str:
    """CTEs ending in ``name (qid, rank, id, score)`` over two tables ``(id, dim, w)``."""
    return f"""
    {name}_ql AS (SELECT id, sum(w * w) AS n FROM {questions} GROUP BY id),
    {name}_dl AS (SELECT id, sum(w * w) AS n FROM {index} GROUP BY id),
    {name}_dot AS (
        SELECT q.id AS qid, d.id AS id, sum(q.w * d.w) AS s
        FROM {questions} q JOIN {index} d USING (dim) GROUP BY 1, 2),
    {name}_scores AS (
        SELECT qid, t.id, {significant('(s / sqrt(a.n * b.n))')} AS score
        FROM {name}_dot t JOIN {name}_ql a ON a.id = qid JOIN {name}_dl b ON b.id = t.id),
    {name} AS (
        SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank, id, score
        FROM {name}_scores)"""


def tfidf(name: str, source: str, id: str, text: str, corpus: str, stop_words: Sequence[str] = ()) -> str:
    """CTEs ending in ``name (id, term, tf, idf, w)``; ``corpus`` names the CTEs of :func:`frequencies`."""
    stopped = f"WHERE term NOT IN ({', '.join(quoted(w) for w in stop_words)})" if stop_words else ""
    return f"""
    {name}_tf AS (
        SELECT id, term, count(*) AS tf
        FROM (SELECT {id} AS id, unnest({words(text)}) AS term FROM {source}) {stopped} GROUP BY 1, 2),
    {name}_raw AS (
        SELECT t.id, t.term, tf, ln((n + 1) / (coalesce(df, 0) + 1)) AS idf
        FROM {name}_tf t LEFT JOIN {corpus}_df USING (term), {corpus}_n),
    {name} AS (
        SELECT *, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY id)) AS w
        FROM {name}_raw WHERE tf * idf <> 0)"""


def frequencies(name: str, source: str, id: str, text: str, stop_words: Sequence[str] = ()) -> str:
    """CTEs ``name_df (term, df)`` and ``name_n (n)``."""
    stopped = f"WHERE term NOT IN ({', '.join(quoted(w) for w in stop_words)})" if stop_words else ""
    return f"""
    {name}_df AS (
        SELECT term, count(DISTINCT id) AS df
        FROM (SELECT {id} AS id, unnest({words(text)}) AS term FROM {source}) {stopped} GROUP BY 1),
    {name}_n AS (SELECT count(*)::DOUBLE AS n FROM {source})"""
