"""Change feed: monotone versions, null keys left out, a replayed feed changes nothing, files read in bounded batches."""

from pyspark.sql import types as T

from pagequarry.operators.models import hashed_words
from pagequarry.streaming.change_feed import ChangeFeed
from pagequarry.streaming.index_sync import IndexSync

ROWS = "id bigint, t string"


def state(sync):
    return sorted((r.id, r.version, r.content_hash, tuple(r.vector)) for r in sync.read().collect())


def test_feed_brings_the_index_to_the_last_snapshot_and_replays_are_harmless(spark, tmp_path):
    snapshots = [
        [(1, "a"), (2, "b"), (3, "c"), (None, "no key"), (4, None)],
        [(1, "a"), (2, "b changed"), (5, "e"), (None, "other"), (4, None)],
        [(1, "a again"), (5, "e"), (6, "f"), (4, "now text")],
        [(1, "a again"), (5, "e"), (6, "f"), (4, "now text")],  # no change: an empty publication
    ]
    frames = [spark.createDataFrame(rows, ROWS) for rows in snapshots]
    feed = ChangeFeed(spark, str(tmp_path / "feed"))
    versions = [feed.publish(old, new, "id", "t") for old, new in zip(frames, frames[1:])]
    assert versions == [1, 2, 3] and feed.version() == 3
    published = spark.read.schema(feed.schema("bigint")).parquet(str(tmp_path / "feed")).collect()
    assert all(r.id is not None for r in published)
    assert {(r.id, r.version, r.deleted) for r in published} == {(2, 1, False), (3, 1, True), (5, 1, False), (1, 2, False), (2, 2, True), (6, 2, False), (4, 2, False)}

    sync = IndexSync(spark, str(tmp_path / "index"), hashed_words(8), T.LongType(), shards=2)
    sync.build(frames[0].where("id IS NOT NULL"), "id", "t")
    sync.start(feed.stream(max_files=1), str(tmp_path / "stream")).awaitTermination()
    after = state(sync)
    expected = IndexSync(spark, str(tmp_path / "fresh"), hashed_words(8), T.LongType(), shards=2)
    expected.build(frames[-1], "id", "t")
    assert [(i, h, v) for i, _, h, v in after] == [(i, h, v) for i, _, h, v in state(expected)]
    assert {i: version for i, version, _, _ in after} == {1: 2, 4: 2, 5: 1, 6: 2}

    # The whole feed read again from the start, as after a lost checkpoint.
    sync.start(feed.stream(max_files=2), str(tmp_path / "stream-again")).awaitTermination()
    assert state(sync) == after
