"""Operators 11 to 13 against tiktoken, DuckDB SQL and a plain Merkle build."""

import base64
import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from pagequarry.llm import audit, bpe, manifest, queries, sql

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def reference_encoder():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.default_ranks_file(), "rb").read().splitlines())}
    return tiktoken.Encoding("reference", pat_str=bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})


# ---- operator 11 ----


def test_every_text_encodes_as_tiktoken_and_decodes_to_its_bytes(spark, reference_encoder):
    rows = queries.QUERIES["op11_bpe_round_trip"](spark, FOLDER).collect()
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id] or ""
        ids = reference_encoder.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_backtracking_equals_tiktoken_on_random_pieces(reference_encoder):
    encoder = bpe.Encoder(bpe.read_ranks(), bpe.default_pattern())
    rng = random.Random(7)
    alphabet = "aAbBeé漢字 \n\t'sSxyz0123!?.,ßüöи​\U0001F600"
    for _ in range(5000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert encoder.encode(text) == reference_encoder.encode_ordinary(text)
        assert encoder.decode(encoder.encode(text)) == text.encode()


def test_nulls_empty_long_repeated_and_clashing_columns(spark, reference_encoder):
    long_text = " ".join(f"Wort{k % 113}ung" for k in range(60000)) + " ünïcödé" * 2000
    rows = [(1, None, "x"), (2, "", "y"), (3, long_text, "z"), (3, long_text, "z"), (4, "   \n\n\t", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("decoded", F.lit(1))
    out = sorted(bpe.round_trip(df).collect(), key=lambda r: (r.doc_id, len(r.ids)))
    assert [r.doc_id for r in out] == [1, 2, 3, 3, 4]
    for row, (_, text, _) in zip(out, sorted(rows, key=lambda r: r[0])):
        assert row.ids == reference_encoder.encode_ordinary(text or "")
        assert bytes(row.decoded) == (text or "").encode()
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---- operator 12 ----


def _oracle(spark_rows_folder_or_rows, query):
    con = duckdb.connect()
    if isinstance(spark_rows_folder_or_rows, str):
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{spark_rows_folder_or_rows}/documents.parquet'")
    else:
        con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT, extra VARCHAR)")
        if spark_rows_folder_or_rows:
            con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?, ?)", spark_rows_folder_or_rows)
    return sorted(con.sql(query).fetchall())


def _rows(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergences_equal_their_sql_on_the_whole_table(spark):
    assert _rows(queries.QUERIES["op12_source_divergence"](spark, FOLDER)) == _oracle(FOLDER, sql.DIVERGENCES)


def test_divergences_of_nulls_lone_sources_and_groups_without_terms(spark):
    words = [f"w{k}" for k in range(30)]
    rng = random.Random(3)
    rows = []
    for k in range(60):
        text = " ".join(rng.choice(words[: 5 + k % 20]) for _ in range(rng.randint(1, 50)))
        rows.append((k, text.upper() if k % 7 == 0 else text, ["en", "de", None][k % 3], ["a", "b", None, "c"][k % 4], len(text), "x"))
    rows += [
        (100, None, "en", "empty", None, None),  # a group without any term
        (101, "1234 !!", "de", "digits", 5, None),  # nor this one
        (102, "solo solo", "xx", "only", 9, None),  # one source: no pair; under ten documents: V = 0
        (103, "zz" * 10000, "en", "a", 20000, None),  # a very long term
        (1, rows[1][1], rows[1][2], rows[1][3], rows[1][4], "repeat"),  # a repeated row
        (104, "ÉCOLE école Straße STRASSE", None, None, 25, None),  # non-ASCII stays as it is
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra string")
    df = df.withColumn("count", F.lit(7)).withColumn("term", F.lit("clash"))
    got = _rows(audit.divergences(df))
    assert got == _oracle(rows, sql.DIVERGENCES)
    assert ("xx", "only", "pair") not in {r[:3] for r in got}
    assert ("en", "empty", "pair", "a") in {r[:4] for r in got}
    assert audit.divergences(df.limit(0)).count() == 0


# ---- operator 13 ----


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _runs(nodes):
    return [nodes[i : i + manifest.FANOUT] for i in range(0, len(nodes), manifest.FANOUT)]


def _tree(nodes):
    """Levels of nodes, leaves first, and for each leaf its (left, right) siblings per level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(*run) for run in _runs(levels[-1])])
    return levels


def _siblings(levels, at):
    path = []
    for level in levels[:-1]:
        start = at - at % manifest.FANOUT
        run = level[start : start + manifest.FANOUT]
        path.append(("".join(run[: at - start]), "".join(run[at - start + 1 :])))
        at //= manifest.FANOUT
    return path


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> {index: (leaf, subroot, root, proof, folded, verified)}."""
    def leaf_of(r, text):
        return _h(_field(r[0]), _field(r[1]), _field(r[2]), _field(r[3]), _field(text))

    def tampered(r):
        if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
            return r[4].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        return r[4]

    by_lang = {}
    for index, r in enumerate(rows):
        by_lang.setdefault(r[2], []).append(index)
    order = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees, subroots = {}, []
    for lang in order:
        members = sorted(by_lang[lang], key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf_of(rows[i], rows[i][4])))
        levels = _tree([leaf_of(rows[i], rows[i][4]) for i in members])
        trees[lang] = (members, levels)
        subroots.append(levels[-1][0])
    top = _tree(subroots)
    root = top[-1][0]
    out = {}
    for place, lang in enumerate(order):
        members, levels = trees[lang]
        for at, i in enumerate(members):
            path = _siblings(levels, at) + _siblings(top, place)
            folded = leaf_of(rows[i], tampered(rows[i]))
            for left, right in path:
                folded = _h(left, folded, right)
            proof = _h(*(left + right for left, right in path))
            out[i] = (levels[0][at], levels[-1][0], root, proof, folded, folded == root)
    return out


def _compare(spark, rows, extra=False):
    schema = "doc_id long, source string, lang string, n_chars int, text string"
    df = spark.createDataFrame(rows, schema)
    if extra:
        df = df.withColumn("tree", F.lit("clash")).withColumn("hash", F.lit(1)).withColumn("what", F.lit(None))
    got = sorted((tuple(r) for r in manifest.manifest(df).drop("lang").collect()), key=repr)
    want = sorted(((rows[i][0], *values) for i, values in brute_manifest(rows).items()), key=repr)
    assert got == want


def test_manifest_equals_a_plain_build_on_the_whole_table(spark):
    rows = [tuple(r) for r in duckdb.sql(f"SELECT doc_id, source, lang, n_chars, text FROM '{FOLDER}/documents.parquet'").fetchall()]
    got = sorted(tuple(r) for r in queries.QUERIES["op13_merkle_manifest"](spark, FOLDER).collect())
    want = sorted((rows[i][0], *values) for i, values in brute_manifest(rows).items())
    assert got == want
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 64], [65, 2, 1], [513]])
def test_manifest_at_fanout_boundaries(spark, sizes):
    rows = []
    for tree, size in enumerate(sizes):
        rows += [(k * 7 + tree, f"s{k % 3}", f"l{tree}", k, f"Text {k} ABC") for k in range(size)]
    _compare(spark, rows)


def test_manifest_of_nulls_repeats_long_texts_and_clashing_columns(spark):
    rows = [
        (None, None, None, None, None),
        (None, "s", None, 3, "Abc"),
        (5, "s", "en", 3, "Abc"),
        (5, "s", "en", 3, "Abc"),
        (6, "ü", "", 1, ""),
        (7, "s", "en", 200000, "Long TEXT " * 20000),
        (12, "s", "ÿ", 2, "ÆB"),
    ]
    _compare(spark, rows, extra=True)
    empty = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars int, text string")
    assert manifest.manifest(empty).count() == 0
