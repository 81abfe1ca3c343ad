import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.operators import index as index_ops
from pagequarry.operators import memos
from pagequarry.operators.keys import dense_ids
from pagequarry.operators.models import embed, hashed_words
from pagequarry.plans.memos import memos_to_index
from pagequarry.sources import readers, tables
from pagequarry.streaming.index_sync import IndexSync

EXPORT = """Timestamp,Date of Memo,TO (one per line),FROM (one per line),Memo Subject,FOIP Exception(s) (one per line),Link to Memo (file upload),Memo Text Part 1,Memo Text Part 2,Is this Memo Related to a Meeting?,Meeting Date,Meeting Item Number(s) (one per line),Committee or Council Name(s) (one per line)
"Jan 05, 2022 03:15 PM","Jan 05, 2022","A
B",C,S,,m1,"first ● line
second ""quoted"" line",p2,No,,,
"Feb 7, 2022 11:05 AM","Feb 7, 2022",A,C,S,,m2,"10 K/g",p2,No,,,
"soon","2022-01-01",A,C,S,,m3,text,p2,No,,,
"Dec 31, 2022 12:00 AM","Dec 31, 2022",A,C,S,,m4,,p2,No,,,
"""


@pytest.fixture
def export(tmp_path):
    path = tmp_path / "memos.csv"
    path.write_text(EXPORT)
    return str(path)


def test_memos(spark, export):
    raw = memos.raw_memos(readers.read_memo_export(spark, export))
    assert "Committee_or_Council_Names" in raw.columns and "Timestamp" in raw.columns
    rows = {r.Link_to_Memo: r for r in memos.silver_memos(raw).collect()}
    assert len(rows) == 4
    assert rows["m1"].TO == "A\nB" and rows["m1"].Text == 'first   line\nsecond "quoted" line'
    assert str(rows["m1"].Timestamp) == "2022-01-05 15:15:00" and str(rows["m1"].Date_of_Memo) == "2022-01-05 00:00:00"
    assert str(rows["m2"].Timestamp) == "2022-02-07 11:05:00" and rows["m2"].Text == "10  "
    assert rows["m3"].Timestamp is None and rows["m3"].Date_of_Memo is None
    assert rows["m4"].Text is None and str(rows["m4"].Timestamp) == "2022-12-31 00:00:00"
    joined = memos.silver_memos(raw, join_parts=True)
    assert joined.filter("Link_to_Memo = 'm3'").first().Text == "text p2"
    assert memos.document_records(memos.silver_memos(raw)).count() == 3


def test_memo_export_with_other_column_order(spark, tmp_path):
    path = tmp_path / "few.csv"
    path.write_text("Memo Text Part 1,Timestamp\nhello,soon\n")
    rows = readers.read_memo_export(spark, str(path)).collect()
    assert rows[0]["Memo Text Part 1"] == "hello" and rows[0]["Memo Text Part 2"] is None


def test_memos_to_index(spark, export, tmp_path):
    store = memos_to_index(spark, export, str(tmp_path / "out"), hashed_words(16), "hashed-16")
    assert sorted(r.id for r in store.load("hashed-16").collect()) == ["m1", "m2", "m3"]
    with pytest.raises(ValueError, match="built by hashed-16"):
        store.load("another")


def test_sitemap(spark, tmp_path):
    path = tmp_path / "sitemap.xml"
    path.write_text(
        '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
        "<url><loc> https://b.example/1 </loc><lastmod>x</lastmod></url><url><loc>https://a.example/2</loc></url></urlset>"
    )
    found = readers.read_sitemap(spark, str(path)).orderBy("position")
    assert [r.url for r in found.collect()] == ["https://b.example/1", "https://a.example/2"]
    assert [r.url for r in readers.read_sitemap(spark, str(path), limit=1).collect()] == ["https://b.example/1"]


def test_page_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<article>é</article>")
    (tmp_path / "b.html").write_text("<p>no article</p>")
    pages = readers.read_page_files(spark, str(tmp_path))
    assert [r.text for r in readers.raw_pages(pages).collect()] == ["é"]


def test_versions(spark, tmp_path):
    stored = tables.VersionedTable(spark, str(tmp_path / "t"))
    assert not stored.exists()
    numbers = spark.range(5).toDF("n")
    assert stored.write_if_needed(numbers, min_rows=5)
    assert not stored.write_if_needed(numbers, min_rows=5)
    assert stored.write_if_needed(numbers, min_rows=6)
    assert stored.write_if_needed(numbers, min_rows=5, force=True)
    stored.overwrite(stored.read().withColumn("n", F.when(F.col("n") > 0, F.col("n"))))
    stored.delete(F.col("n") > 3)
    assert sorted(r.n or 0 for r in stored.read().collect()) == [0, 1, 2, 3]
    assert stored.version() == 5 and stored.read(1).count() == 5
    (tmp_path / "t" / "v=9").mkdir()  # a write that never finished
    assert stored.version() == 5 and stored.overwrite(numbers) == 10 and stored.version() == 10


def test_evolving_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.append(spark.createDataFrame([("a", "2024")], "name string, date string"), path)
    tables.append(spark.createDataFrame([("b", "2025", "x")], "name string, date string, run string"), path)
    assert sorted((r.name, r.run) for r in tables.read_evolved(spark, path).collect()) == [("a", None), ("b", "x")]


def test_latest(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")]
    df = spark.createDataFrame(rows, "name string, date int, run string")
    assert tables.latest_for(df, "a").first().run == "y"
    assert sorted(map(tuple, tables.latest_per_name(df, "name", "date").collect())) == [("a", 3, "y"), ("b", 2, "z")]


def test_dense_ids(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    rows = dense_ids(df, "k", partitions=7).collect()
    assert sorted((r.id, r.k) for r in rows) == [(k + 1, k) for k in range(1000)]


def test_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, t string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, None)], "id int, t string")
    changes = {r.id: r.change for r in index_ops.capture_changes(old, new, "id", "t").collect()}
    assert changes == {2: "update", 3: "delete", 4: "insert"}


DIRECT = "id int, text string, text_vector array<float>, bool_val boolean"


def test_upsert(spark):
    index = spark.createDataFrame([(1, "a", [1.0, 0.0], True), (2, "b", [0.0, 1.0], False)], DIRECT)
    rows = spark.createDataFrame([(2, "B", [1.0, 1.0], True), (3, "c", [0.5, 0.5], None)], DIRECT)
    result = {r.id: r for r in index_ops.upsert_vectors(index, rows, "id", "text_vector", 2).collect()}
    assert {i: r.text for i, r in result.items()} == {1: "a", 2: "B", 3: "c"} and result[2].bool_val is True
    with pytest.raises(ValueError, match="duplicate"):
        index_ops.upsert_vectors(index, rows.union(rows), "id", "text_vector", 2)
    with pytest.raises(Exception, match="expected 3 dimensions"):
        index_ops.upsert_vectors(index, rows, "id", "text_vector", 3).collect()
    with pytest.raises(ValueError, match="columns"):
        index_ops.upsert_vectors(index, rows.drop("bool_val"), "id", "text_vector", 2)


def test_index_refuses_duplicate_keys(spark, tmp_path):
    store = index_ops.IndexStore(spark, str(tmp_path / "i"))
    with pytest.raises(ValueError, match="duplicate"):
        store.build(spark.createDataFrame([(1, "a"), (1, "b")], "id int, t string"), "id", "t", hashed_words(4), "m")


# ---- index sync ----

CHANGES = "id bigint, text string, version bigint, deleted boolean"


def state(sync):
    return {r.id: (r.content_hash, [round(x, 5) for x in r.vector], r.version) for r in sync.read().collect()}


def rebuilt(spark, texts):
    df = spark.createDataFrame([(i, t, v) for i, (t, v) in texts.items()], "id bigint, text string, version bigint")
    rows = df.select("id", index_ops.content_hash(F.col("text")).alias("h"), embed(F.col("text"), hashed_words(8)).alias("v"), "version")
    return {r.id: (r.h, [round(x, 5) for x in r.v], r.version) for r in rows.collect()}


@pytest.fixture
def sync(spark, tmp_path):
    made = IndexSync(spark, str(tmp_path / "index"), hashed_words(8), T.LongType(), shards=3)
    made.build(spark.createDataFrame([(i, f"text number {i}") for i in range(10)], "id bigint, t string"), "id", "t")
    return made


def expected_after(batches):
    texts = {i: (f"text number {i}", 0) for i in range(10)}
    newest = {}
    for batch in batches:
        for key, text, version, deleted in batch:
            if version > newest.get(key, (None, -1, None))[1]:
                newest[key] = (text, version, deleted)
    for key, (text, version, deleted) in newest.items():
        texts.pop(key, None)
        if not deleted:
            texts[key] = (text, version)
    return texts


BATCHES = [
    [(1, "one", 2, False), (1, "older", 1, False), (20, "new", 1, False), (3, None, 1, True)],
    [(1, "late", 1, False), (2, "text number 2", 5, False), (3, "again", 2, False), (20, None, 2, True)],
    [(2, "stale", 4, False), (20, "zombie", 1, False), (4, "four", 1, False)],
]


def test_sync_equals_rebuild_and_replays_change_nothing(spark, sync):
    for number, batch in enumerate(BATCHES):
        changes = spark.createDataFrame(batch, CHANGES)
        sync.apply_batch(changes, number)
        after = state(sync)
        assert after == rebuilt(spark, expected_after(BATCHES[: number + 1]))
        sync.apply_batch(changes, number)
        assert state(sync) == after
    before = state(sync)
    assert sync.compact() == 2 and state(sync) == before
    sync.apply_batch(spark.createDataFrame(BATCHES[1], CHANGES), 3)
    assert state(sync) == before


def test_unchanged_text_is_not_embedded_again(spark, tmp_path):
    made = IndexSync(spark, str(tmp_path / "i"), hashed_words(8), T.LongType(), shards=2)
    made.build(spark.createDataFrame([(1, "same"), (2, "same")], "id bigint, t string"), "id", "t")

    def failing():
        raise RuntimeError("model loaded")

    made.embedder = failing
    made.apply_batch(spark.createDataFrame([(1, "same", 3, False), (2, None, 1, True)], CHANGES), 0)
    assert [(r.id, r.version) for r in made.read().collect()] == [(1, 3)]


def test_a_generation_that_broke_off_is_left_aside(spark, sync):
    before = state(sync)
    spark.range(1).write.parquet(f"{sync.folder}/gen=2/snapshot/shard=0")
    assert sync.generation() == 1 and state(sync) == before
    assert sync.compact() == 3 and sync.generation() == 3 and state(sync) == before


def test_equal_versions_have_one_outcome(spark, sync):
    both = [(1, "b", 2, False), (1, "a", 2, False), (2, "x", 2, False), (2, None, 2, True)]
    sync.apply_batch(spark.createDataFrame(both, CHANGES).repartition(4), 0)
    first = state(sync)
    sync.apply_batch(spark.createDataFrame(both[::-1], CHANGES).coalesce(1), 0)
    assert state(sync) == first and sync.read().filter("id = 2").isEmpty()


def test_stream(spark, sync, tmp_path):
    incoming = str(tmp_path / "incoming")
    for batch in BATCHES:
        spark.createDataFrame(batch, CHANGES).coalesce(1).write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(CHANGES).parquet(incoming)
        sync.start(stream, str(tmp_path / "checkpoint")).awaitTermination()
    assert state(sync) == rebuilt(spark, expected_after(BATCHES))


def test_shared_folder_is_the_configured_one(spark):
    from pagequarry.session import new_folder

    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_hashed_words_match_their_definition(spark):
    import hashlib

    df = spark.createDataFrame([("a b a",), ("",), (None,)], "t string")
    found = [r.v for r in df.coalesce(1).select(embed(F.col("t"), hashed_words(8)).alias("v")).collect()]
    expected = [0.0] * 8
    for word, count in (("a", 2), ("b", 1)):
        h = int(hashlib.md5(word.encode()).hexdigest()[:8], 16)
        expected[h % 8] += count * (1 if h // 8 % 2 == 0 else -1)
    norm = sum(x * x for x in expected) ** 0.5
    assert [round(x, 6) for x in found[0]] == [round(x / norm, 6) for x in expected]
    assert found[1] == [0.0] * 8 and found[2] is None


def test_a_micro_batch_reads_state_without_vectors(spark, tmp_path):
    sync = IndexSync(spark, str(tmp_path / "index"), hashed_words(8), T.LongType(), shards=3)
    sync.build(spark.createDataFrame([(k, f"text {k}") for k in range(20)], "id bigint, t string"), "id", "t")
    sync.apply_batch(spark.createDataFrame([(1, "text 1", 2, False), (2, "new", 2, False)], CHANGES), 0)
    plan = sync.current_state([0, 1, 2], 1)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "vector:" not in plan and "vector," not in plan
    # The unchanged text wrote no vector of its own; it is found where it lies.
    log = spark.read.parquet(str(tmp_path / "index" / "gen=1" / "log" / "batch_id=0"))
    assert {(r.id, r.vector is None, r.vector_at) for r in log.collect()} == {(1, True, -1), (2, False, 0)}
    before = {r.id: (r.vector, r.version) for r in sync.read().collect()}
    assert before[1][1] == 2 and before[1][0] is not None and len(before) == 20
    sync.compact()
    assert {r.id: (r.vector, r.version) for r in sync.read().collect()} == before


def test_numbered_appends_go_on_and_reruns_keep_ids(spark, tmp_path):
    from pagequarry.operators.keys import NumberedTable

    table = NumberedTable(spark, str(tmp_path / "numbered"))
    huge = 1 << 50  # page ids far above 2^47
    first = spark.range(70_000).selectExpr(f"{huge} AS page_id", "id AS chunk_no")  # more chunks than one page had room for
    assert table.append(first, "page_id", "chunk_no") == 1 and table.last_id() == 70_000
    second = spark.createDataFrame([(huge + 1, 0), (5, 3)], "page_id bigint, chunk_no bigint")
    assert table.append(second, "page_id", "chunk_no") == 2
    ids = {(r.page_id, r.chunk_no): r.id for r in table.read().collect()}
    assert len(ids) == 70_002 and sorted(ids.values()) == list(range(1, 70_003))
    assert ids[(5, 3)] == 70_001 and ids[(huge + 1, 0)] == 70_002 and ids[(huge, 69_999)] == 70_000
    # An append that broke off before its mark is taken up again with the same ids.
    third = spark.createDataFrame([(7, 0), (7, 1)], "page_id bigint, chunk_no bigint")
    from pagequarry.operators.keys import dense_ids

    dense_ids(third, "page_id", "chunk_no").write.parquet(str(tmp_path / "numbered" / "append=3"))
    assert table.version() == 2 and table.read().count() == 70_002
    assert table.append(third, "page_id", "chunk_no") == 3
    assert sorted(r.id for r in table.read().where("append = 3").collect()) == [70_003, 70_004]
