"""Work on a batch is bounded by its bytes, not by its rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagequarry.llm import bpe
from pagequarry.operators import hashed_terms, models


def test_slices_cover_every_row_once():
    for sizes in ([], [0], [5, 5, 5], [30, 1, 0, 2, 40, 3], [0, 0, 0], [11]):
        found = list(models.slices(np.array(sizes, np.int32), 10))
        assert [row for start, stop in found for row in range(start, stop)] == list(range(len(sizes)))
        assert all(sum(sizes[start:stop]) <= 10 or stop == start + 1 for start, stop in found)


def refusing(most):
    """An embedder that refuses more bytes of text than ``most`` in more than one row."""

    def factory():
        def run(texts):
            if len(texts) > 1 and sum(len(t.as_py().encode()) for t in texts) > most:
                raise ValueError("too much text at once")
            return np.array([[float(len(t.as_py()))] for t in texts])

        return run

    return factory


def test_an_embedder_gets_bounded_texts(spark):
    sizes = [900_000, 900_000, 0, 900_000, 2_500_000, 7, None, 900_000]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "i int, n int").coalesce(1)
    vectors = df.select("i", models.embed(F.repeat(F.lit("x"), F.col("n")), refusing(models.EMBEDDED_BYTES)).alias("v"))
    assert {r.i: None if r.v is None else r.v[0] for r in vectors.collect()} == dict(enumerate(sizes))


def test_hashed_words_do_not_remember_every_word():
    run = models.hashed_words(8)()
    run(pa.array([" ".join("w" + "".join(chr(97 + int(d)) for d in str(n)) for n in range(150_000))]))
    held = [cell.cell_contents for cell in run.__closure__ if callable(cell.cell_contents)][0]
    known = [cell.cell_contents for cell in held.__closure__ if isinstance(cell.cell_contents, dict)][0]
    assert len(known) <= 100_000


def test_folding_takes_bounded_pieces(monkeypatch):
    monkeypatch.setattr(hashed_terms, "ENTRIES", 3)
    kind = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int64())]))
    bags = [[("a", 1), ("b", 2)], [("a", 1)], [("c", 1)] * 1, [], None, [("a", 1), ("b", 1), ("c", 1), ("d", 4)]]
    rows = [None if bag is None else [{"term": t, "tf": n} for t, n in bag] for bag in bags]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(range(6)), pa.array(rows, kind)], ["row", "id", "terms"])
    small = pa.Table.from_batches(list(hashed_terms._fold(64)(iter([batch]))))
    assert len(list(hashed_terms._fold(64)(iter([batch])))) == 3
    monkeypatch.setattr(hashed_terms, "ENTRIES", 1000)
    assert small.to_pylist() == pa.Table.from_batches(list(hashed_terms._fold(64)(iter([batch])))).to_pylist()


def test_remembered_encodings_are_bounded_by_their_tokens(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_TOKENS", 640)
    encoder = bpe.Encoder(bpe.read_ranks(), bpe.default_pattern())
    assert "automaton" not in vars(encoder)
    texts = [f" zq{chr(97 + n % 26)}{chr(97 + n // 26)}xvk" * 3 + "q" * n for n in range(300)]
    for text in texts:
        assert encoder.decode(encoder.encode(text)) == text.encode()
        assert sum(map(len, encoder._pieces.values())) <= 640


@pytest.mark.parametrize("texts", [["a b", None, "", "ünï" * 5, "x" * 50]])
def test_round_trip_of_small_slices(spark, monkeypatch, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    rows = bpe.round_trip(df).collect()
    assert {r.i: bytes(r.decoded) for r in rows} == {i: (t or "").encode() for i, t in enumerate(texts)}
    assert all((r.ids == []) == (not texts[r.i]) for r in rows)
