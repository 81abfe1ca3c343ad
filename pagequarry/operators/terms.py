"""Sparse term vectors and keyword search."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.functions.text import explode_rows, let, long_texts, sentences, term_counts, words
from pagequarry.operators.models import slices
from pagequarry.operators.ranking import MAX_BROADCAST_QUESTIONS, Sparse, nearest
from pagequarry.operators.skew import hot_keys, salted_join
from pagequarry.session import materialise


# Terms of a counted vocabulary that may travel to the postings, some tens of megabytes.
MAX_BROADCAST_TERMS = 500_000
# Postings of rows packed together, whose terms are looked up once for all of them.
POSTINGS_AT_ONCE = 1_000_000
# Bytes of rows that a task packing them receives at a time.
PACKED_BYTES = 8_000_000
# Postings of a block that are weighed together.
WEIGHED_AT_ONCE = 250_000
# Words of sentences looked up together.
WORDS_AT_ONCE = 1_000_000
# Positions of kept sentences that may travel to the texts.
MAX_BROADCAST_POSITIONS = 4_000_000
VECTOR_TYPE = T.ArrayType(
    T.StructType([T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])
)


def has_keyword(text: Column, keyword: str) -> Column:
    return F.array_contains(words(text), keyword.lower())


def bag_of_words(df: DataFrame, id: str, text: str, stop_words: Sequence[str] = ()) -> DataFrame:
    """``id, terms``: the words of each text with their counts, kept in one row."""
    tokens = words(F.col(text))
    if stop_words:
        tokens = F.filter(tokens, lambda word: ~word.isin(*stop_words))
    return df.select(F.col(id).alias("id"), term_counts(tokens).alias("terms"))


@dataclass(frozen=True)
class Vocabulary:
    """Document frequency of every term, and the few terms most documents share."""

    frequencies: DataFrame
    hot: DataFrame
    documents: int
    terms: int
    max_broadcast: int | None = None

    @staticmethod
    def of(bags: DataFrame, max_broadcast: int | None = None) -> Vocabulary:
        """Count terms by a grouped sum, which combines before the shuffle; up to ``max_broadcast`` may travel to the tasks."""
        terms = explode_rows(bags.select("terms"), F.col("terms.term"), "_", "term").select("term")
        counted = terms.groupBy("term").agg(F.count("*").alias("df"))
        frequencies = materialise(counted, "vocabulary")
        size = frequencies.agg(F.count("*").alias("terms"), F.sum("df").alias("postings")).first()
        hot = hot_keys(frequencies, "term", "df", size.postings or 0)
        return Vocabulary(frequencies, hot, bags.count(), size.terms, max_broadcast)

    @property
    def is_small(self) -> bool:
        return self.terms <= (MAX_BROADCAST_TERMS if self.max_broadcast is None else self.max_broadcast)

    def head(self) -> DataFrame:
        """``term, df`` of the most frequent terms, as many as may travel to the tasks."""
        most = MAX_BROADCAST_TERMS if self.max_broadcast is None else self.max_broadcast
        # One row for each power of two that a frequency reaches, 63 at most.
        level = F.floor(F.log2(F.col("df").cast("double"))).cast("int")
        levels = self.frequencies.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
        seen, least = 0, 64
        for row in levels:
            seen += row["count"]
            if seen > most:
                break
            least = row.level
        return self.frequencies.where(level >= least)

    def attach(self, postings: DataFrame, spread_by: str, how: str) -> DataFrame:
        """``postings`` with ``df`` of their ``term``: by broadcast while the vocabulary is small, else salted."""
        if self.is_small:
            return postings.join(F.broadcast(self.frequencies), "term", how)
        return salted_join(postings, self.frequencies, "term", self.hot, spread_by, how=how)

    def idf(self, df: Column) -> Column:
        return F.log(F.lit(float(self.documents + 1)) / (df + 1))


def weighted_terms(bags: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``id, term, tf, idf`` in long form; a term outside the vocabulary counts as in no document."""
    postings = explode_rows(bags, F.col("terms"), "_", "posting").select("id", "posting.term", "posting.tf")
    found = vocabulary.attach(postings, spread_by="id", how="left")
    return found.select("id", "term", "tf", vocabulary.idf(F.coalesce("df", F.lit(0))).alias("idf"))


def _unit_vectors(id: pa.Array, row: np.ndarray, term: pa.Array, tf: np.ndarray, df: np.ndarray, documents: int) -> pa.RecordBatch:
    """``id, vector`` of the rows that have a weight, from their terms with counts and frequencies, in the order of ``row``."""
    weight = tf * np.log((documents + 1.0) / (df + 1.0))
    used = weight != 0
    row, term, weight = row[used], term.filter(pa.array(used)), weight[used]
    norm = np.sqrt(np.bincount(row, weight * weight, len(id)))
    entry = pa.StructArray.from_arrays([term, pa.array(weight / norm[row])], ["term", "weight"])
    sizes = np.bincount(row, minlength=len(id))
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    vectors = pa.RecordBatch.from_arrays([id, pa.ListArray.from_arrays(offsets, entry)], ["id", "vector"])
    return vectors.filter(pa.array(sizes > 0))


def _weigh_rows(vocabulary: pa.Table, documents: int) -> Callable:
    """Task function: TF-IDF weights of whole rows, with the vocabulary, or its head, held in memory.

    Rows may bring the frequencies of other terms of theirs as ``rare``.
    """

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.column("term").combine_chunks()
        # The last entry is for terms that are in no document.
        df = np.append(vocabulary.column("df").to_numpy(), 0)
        for batch in batches:
            bags = batch.column("terms")
            row = np.repeat(np.arange(len(bags)), pc.list_value_length(bags).to_numpy(zero_copy_only=False))
            term, tf = bags.flatten().field("term"), bags.flatten().field("tf").to_numpy(zero_copy_only=False)
            code = pc.fill_null(pc.index_in(term, value_set=known), len(known)).to_numpy(zero_copy_only=False)
            found = df[code]
            if "rare" in batch.schema.names:
                rare = batch.column("rare").flatten()
                other = np.flatnonzero(code == len(known))
                coded = rare.field("term").dictionary_encode()
                # A term has the same frequency in every row.
                rare_df = np.zeros(len(coded.dictionary) + 1)
                rare_df[coded.indices.to_numpy(zero_copy_only=False)] = rare.field("df").to_numpy(zero_copy_only=False)
                at = pc.index_in(term.take(pa.array(other)), value_set=coded.dictionary)
                found = found.astype(np.float64)
                found[other] = rare_df[pc.fill_null(at, len(coded.dictionary)).to_numpy(zero_copy_only=False)]
            yield _unit_vectors(batch.column("id"), row, term, tf, found, documents)

    return weigh


def _unknown_terms(head: pa.Table) -> Callable:
    """Task function: ``row, term, tf`` of terms that are not in the head of the vocabulary."""

    def unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = head.column("term").combine_chunks()
        for batch in batches:
            bags = batch.column("terms")
            row = np.repeat(np.arange(len(bags)), pc.list_value_length(bags).to_numpy(zero_copy_only=False))
            term = bags.flatten().field("term")
            other = pc.invert(pc.is_in(term, value_set=known))
            rows = batch.column("row").take(pa.array(row)).filter(other)
            columns = [rows, term.filter(other), bags.flatten().field("tf").filter(other)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "term", "tf"])

    return unknown


def rare_terms(rows: DataFrame, vocabulary: Vocabulary, head: pa.Table) -> DataFrame:
    """``row, term, tf, df`` of the terms of ``rows`` that are in the vocabulary, but not in its head."""
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])
    postings = rows.select("row", "terms").mapInArrow(_unknown_terms(head), schema)
    return vocabulary.attach(postings, spread_by="row", how="inner")


def _packed(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpacked(data: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(data.as_buffer()).read_all().combine_chunks()


def _pack_rows(at_once: int) -> Callable:
    """Task function: ``terms, rows`` of blocks of about ``at_once`` postings, twice as many at the most, a larger row apart.

    A block has each of its terms once, in order; its rows have numbers of
    terms, each as the step from the number before, which packs well.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, "terms", at_once):
            sizes = pc.fill_null(pc.list_value_length(batch.column("terms")), 0).to_numpy(zero_copy_only=False)
            # Gathered batches exceed a block by one batch, which goes with it.
            for start, stop in slices(sizes, 2 * at_once):
                posting = batch.column("terms").slice(start, stop - start).flatten()
                coded = posting.field("term").dictionary_encode()
                order = pc.sort_indices(coded.dictionary)
                number = np.empty(len(order), np.int32)
                number[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
                step = np.diff(number[coded.indices.to_numpy(zero_copy_only=False)], prepend=np.int32(0))
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes[start:stop])]).astype(np.int32))
                bag = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(step), posting.field("tf")], ["step", "tf"]))
                terms = pa.RecordBatch.from_arrays([coded.dictionary.take(order)], ["term"])
                rows = pa.RecordBatch.from_arrays([batch.column("id").slice(start, stop - start), bag], ["id", "bag"])
                columns = [pa.array([_packed(part)], pa.binary()) for part in (terms, rows)]
                yield pa.RecordBatch.from_arrays(columns, ["terms", "rows"])

    return pack


def _block_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: ``block, number, term`` of packed blocks."""
    for batch in batches:
        for block, packed in zip(batch.column("block"), batch.column("terms")):
            term = _unpacked(packed).column("term").combine_chunks()
            number = pa.array(np.arange(len(term), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.repeat(block, len(term)), number, term], ["block", "number", "term"])


def _weigh_blocks(documents: int) -> Callable:
    """Group function: TF-IDF weights of a block's rows, from ``number, df`` of its terms; others are in no document."""

    def weigh(blocks: pa.Table, found: pa.Table) -> pa.Table:
        block = blocks.slice(0, 1).combine_chunks()
        term = _unpacked(block.column("terms")[0]).column("term").combine_chunks()
        rows = _unpacked(block.column("rows")[0])
        df = np.zeros(len(term), np.int64)
        df[found.column("number").to_numpy()] = found.column("df").to_numpy()
        id, bag = rows.column("id").combine_chunks(), rows.column("bag").combine_chunks()
        sizes = pc.list_value_length(bag).to_numpy(zero_copy_only=False)
        vectors, last = [], np.int32(0)
        for start, stop in slices(sizes, WEIGHED_AT_ONCE):
            posting = bag.slice(start, stop - start).flatten()
            row = np.repeat(np.arange(stop - start), sizes[start:stop])
            code = last + np.cumsum(posting.field("step").to_numpy(), dtype=np.int32)
            last = code[-1] if len(code) else last
            tf = posting.field("tf").to_numpy()
            vectors.append(_unit_vectors(id.slice(start, stop - start), row, term.take(pa.array(code)), tf, df[code], documents))
        return pa.Table.from_batches(vectors)

    return weigh


def _vectors_by_block(bags: DataFrame, vocabulary: Vocabulary, schema: T.StructType) -> DataFrame:
    """``tfidf_vectors`` by a join of every term, once for each block of rows.

    Rows travel packed, in their block, to the frequencies found for it.
    """
    packed = bags.select("id", "terms").mapInArrow(_pack_rows(POSTINGS_AT_ONCE), "terms binary, rows binary")
    # Blocks are told apart by a key of their own, written so that it stays the same.
    keyed = packed.select(F.monotonically_increasing_id().alias("block"), "terms", "rows")
    conf, batch_bytes = bags.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(batch_bytes)
    conf.set(batch_bytes, str(PACKED_BYTES))
    try:
        blocks = materialise(keyed, "packed-bags")
    finally:
        conf.set(batch_bytes, before)
    terms = blocks.select("block", "terms").mapInArrow(_block_terms, "block bigint, number int, term string")
    found = vocabulary.attach(terms, spread_by="block", how="inner").select("block", "number", "df")
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_weigh_blocks(vocabulary.documents), schema)


def tfidf_vectors(bags: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``id, vector``: TF-IDF weights of each text, scaled to unit length.

    Texts whose every term has weight zero have no direction and are left out.
    A small vocabulary is handed to the tasks, which then weigh row by row
    without a shuffle. Of a large one the most frequent terms are handed to
    them, which most words of a text belong to; only the other terms are
    joined, and their frequencies brought back to their rows. Where no term may
    be handed to the tasks, all are joined, a frequent one once for each block
    of rows and not for each row. Either way every row of ``bags`` has its own
    vector, also where rows share an id or have none.
    """
    schema = T.StructType([bags.schema["id"], T.StructField("vector", VECTOR_TYPE)])
    if vocabulary.is_small:
        weigh = _weigh_rows(vocabulary.frequencies.select("term", "df").toArrow(), vocabulary.documents)
        return bags.select("id", "terms").mapInArrow(weigh, schema)
    head = vocabulary.head().select("term", "df").toArrow()
    if not len(head):
        return _vectors_by_block(bags, vocabulary, schema)
    # Rows are told apart by a key of their own, written so that it stays the same.
    rows = materialise(bags.select(F.monotonically_increasing_id().alias("row"), "id", "terms"), "keyed-bags")
    found = rare_terms(rows, vocabulary, head)
    rare = found.groupBy("row").agg(F.collect_list(F.struct("term", "df")).alias("rare"))
    met = rows.join(rare, "row", "left").select("id", "terms", F.coalesce("rare", F.array().cast(rare.schema["rare"].dataType)).alias("rare"))
    return met.mapInArrow(_weigh_rows(head, vocabulary.documents), schema)


@dataclass(frozen=True)
class KeywordIndex:
    """TF-IDF vectors of a collection, written once, with the vocabulary that made them."""

    vocabulary: Vocabulary
    vectors: DataFrame
    stop_words: tuple[str, ...] = ()

    @staticmethod
    def build(df: DataFrame, id: str, text: str, stop_words: Sequence[str] = ()) -> KeywordIndex:
        bags = materialise(bag_of_words(df, id, text, stop_words), "bags-of-words")
        vocabulary = Vocabulary.of(bags)
        return KeywordIndex(vocabulary, materialise(tfidf_vectors(bags, vocabulary), "keyword-index"), tuple(stop_words))

    def search(
        self, questions: DataFrame, id: str, text: str, k: int, max_questions: int = MAX_BROADCAST_QUESTIONS
    ) -> DataFrame:
        """Best ``k`` texts by cosine for each question; only texts sharing a term can be hits."""
        asked = tfidf_vectors(bag_of_words(questions, id, text, self.stop_words), self.vocabulary)
        asked = materialise(asked.withColumnRenamed("id", "qid"), "questions")
        return nearest(asked, self.vectors, k, Sparse(), max_questions=max_questions)


def _gathered(batches: Iterator[pa.RecordBatch], name: str, least: int) -> Iterator[pa.RecordBatch]:
    """``batches`` joined until their lists ``name`` have ``least`` elements, as each lookup has a cost of its own."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column(name).flatten())
        if size >= least:
            yield held[0] if len(held) == 1 else pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield held[0] if len(held) == 1 else pa.concat_batches(held)


def _sum_idf(head: pa.Table, documents: int) -> Callable:
    """Task function: ``id, position, term, total, n`` of sentences given as words.

    One row without a term has the sum and number of the words in the head of
    the vocabulary; each other word has a row of its own.
    """

    def sum_idf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = head.column("term").combine_chunks()
        idf = np.log((documents + 1.0) / (head.column("df").to_numpy() + 1.0))
        names = ["id", "position", "term", "total", "n"]
        for batch in _gathered(batches, "words", WORDS_AT_ONCE):
            found = batch.column("words")
            row = np.repeat(np.arange(len(found)), pc.list_value_length(found).to_numpy(zero_copy_only=False))
            term = found.flatten()
            code = pc.index_in(term, value_set=known)
            met = pc.is_valid(code)
            in_head = met.to_numpy(zero_copy_only=False)
            # Without words numpy would count in integers.
            total = np.bincount(row[in_head], idf[code.drop_null().to_numpy(zero_copy_only=False)], len(found)).astype(np.float64)
            n = np.bincount(row[in_head], minlength=len(found))
            keys = [batch.column("id"), batch.column("position")]
            yield pa.RecordBatch.from_arrays([*keys, pa.nulls(len(found), pa.string()), pa.array(total), pa.array(n)], names)
            at, other = pa.array(row[~in_head]), term.filter(pc.invert(met))
            nothing = [pa.array(np.zeros(len(other))), pa.array(np.zeros(len(other), dtype=np.int64))]
            yield pa.RecordBatch.from_arrays([*(k.take(at) for k in keys), other, *nothing], names)

    return sum_idf


def summarise_long_texts(
    df: DataFrame, id: str, text: str, limit: int = 10_000, keep: int = 3, output: str = "text_short"
) -> DataFrame:
    """Replace texts over ``limit`` characters by their ``keep`` most telling sentences.

    A sentence scores the mean inverse document frequency of its words over
    the whole collection; kept sentences stay in order. Other texts pass
    through unchanged and are not shuffled. Rows are told apart by a key of
    their own, not by ``id``: rows sharing an id, or with a null one, each get
    the summary of their own text.
    """
    # Read four times below, and perhaps costly to make. Each row gets a key of
    # its own, so rows that share an id, or have none, are summarised apart.
    key = "_summarised_row"
    df = materialise(df.withColumn(key, F.monotonically_increasing_id()), "texts")
    # Frequencies need each text's distinct words only, not their counts.
    distinct = F.transform(F.array_distinct(words(F.col(text))), lambda word: F.struct(word.alias("term")))
    vocabulary = Vocabulary.of(df.select(distinct.alias("terms")))
    is_long = F.coalesce(long_texts(F.col(text), limit), F.lit(False))
    long_ones = df.filter(is_long).select(F.col(key).alias("id"), F.col(text).alias("text"))
    chosen = explode_rows(long_ones, sentences(F.col("text")), "position", "sentence")
    head = (vocabulary.frequencies if vocabulary.is_small else vocabulary.head()).select("term", "df").toArrow()
    summed = chosen.select("id", "position", words(F.col("sentence")).alias("words")).mapInArrow(
        _sum_idf(head, vocabulary.documents), "id bigint, position int, term string, total double, n bigint"
    )
    if not vocabulary.is_small:
        # Words outside the head, one row each, are joined; the others came as one row a sentence.
        summed = materialise(summed, "sentence-sums")
        others = summed.where(F.col("term").isNotNull()).select("id", "position", "term")
        found = vocabulary.attach(others, spread_by="id", how="inner").groupBy("id", "position").agg(
            F.sum(vocabulary.idf(F.col("df"))).alias("total"), F.count("*").alias("n")
        )
        summed = summed.where(F.col("term").isNull()).select("id", "position", "total", "n").unionByName(found)
    sums = summed.groupBy("id", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    scores = sums.filter(F.col("n") > 0).select("id", "position", F.round(F.col("total") / F.col("n"), 9).alias("score"))
    order = Window.partitionBy("id").orderBy(F.desc("score"), F.asc("position"))
    best = scores.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)
    kept = best.groupBy("id").agg(F.sort_array(F.collect_list("position")).alias("_kept"))
    kept = materialise(kept.withColumnRenamed("id", key), "kept-sentences")
    # Only positions travel to the long texts, which are not shuffled while the positions are few.
    if kept.count() * keep <= MAX_BROADCAST_POSITIONS:
        kept = F.broadcast(kept)
    met = df.filter(is_long).join(kept, key, "left")
    summary = let(
        sentences(F.col(text)),
        lambda found: F.array_join(F.transform("_kept", lambda position: F.element_at(found, position + 1)), " "),
    )
    short = df.filter(~is_long).withColumn(output, F.col(text))
    # A long text without words has nothing to rank and stays as it is.
    shortened = met.withColumn(output, F.when(F.col("_kept").isNull(), F.col(text)).otherwise(summary))
    return short.unionByName(shortened.drop("_kept")).drop(key)
