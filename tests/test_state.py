"""Versions, merged state, snapshots, streaming state and places: crashes, repeats and order."""

import shutil
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siftwell.operators import ordering, sinks, statelog
from siftwell.operators.versions import ConcurrentChange, Versions
from siftwell.schema import HISTORY
from siftwell.streaming import incremental


def seen(spark, *rows):
    return spark.createDataFrame([(u, date(2024, 1, d)) for u, d in rows], HISTORY)


def dates(frame):
    return {r["url"]: r["first_seen"].day for r in frame.collect()}


def test_versions_are_published_in_turn(spark, tmp_path):
    one, other = (Versions(spark, str(tmp_path)) for _ in range(2))
    assert one.latest() == (0, {})
    one.publish(1, {"a": "ü"})
    assert other.latest() == (1, {"a": "ü"})
    with pytest.raises(ConcurrentChange):
        other.publish(1, {"a": 2})
    other.publish(2, {"a": 2})
    assert one.latest() == (2, {"a": 2}) and one.forget(keep=1) == [{"a": "ü"}]
    assert not [n for n in one.names("_versions") if n.startswith("_draft")]


def test_state_is_the_same_before_and_after_merging(spark, tmp_path):
    log = statelog.history_log(spark, str(tmp_path))
    assert dates(log.read()) == {}
    log.compact()
    log.append(seen(spark, ("a", 5), ("b", 3)))
    log.append(seen(spark, ("a", 2), ("c", 9)))
    assert dates(log.read()) == {"a": 2, "b": 3, "c": 9}
    log.compact()
    assert dates(log.read()) == {"a": 2, "b": 3, "c": 9} and log.deltas() == []
    log.append(seen(spark, ("b", 1), ("c", 20)))
    log.compact()
    log.compact()
    assert dates(log.read()) == {"a": 2, "b": 1, "c": 9}
    assert len(log.versions.names("base")) == 2 and log.versions.names("delta") == []


def test_reading_follows_live_keys_not_writes(spark, tmp_path):
    log = statelog.history_log(spark, str(tmp_path))
    for turn in range(4):
        log.append(seen(spark, *[(f"u{i}", 1 + turn) for i in range(50)] * 20))
        log.compact()
    base = Versions(spark, str(tmp_path)).latest()[1]["base"]
    assert spark.read.parquet(f"{tmp_path}/{base}").count() == 50
    urls = [[r["url"] for r in spark.read.parquet(str(f)).collect()] for f in sorted(Path(tmp_path, base).glob("*.parquet"))]
    assert all(u == sorted(u) for u in urls) and sum(urls, []) == sorted(sum(urls, []))


def test_a_merge_that_dies_leaves_the_old_state(spark, tmp_path, monkeypatch):
    log = statelog.history_log(spark, str(tmp_path))
    log.append(seen(spark, ("a", 1)))
    log.compact()
    log.append(seen(spark, ("b", 2)))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(log.versions, "publish", dies)
        with pytest.raises(OSError):
            log.compact()
    assert dates(log.read()) == {"a": 1, "b": 2}
    with monkeypatch.context() as m:
        m.setattr(log, "_clean", dies)
        with pytest.raises(OSError):
            log.compact()
    # Published, but the merged change is still there: it counts once, and goes next time.
    assert dates(log.read()) == {"a": 1, "b": 2} and log.deltas() == [] and len(log.versions.names("delta")) == 1
    log.append(seen(spark, ("c", 3)))
    log.compact()
    assert dates(log.read()) == {"a": 1, "b": 2, "c": 3} and log.versions.names("delta") == []


def test_two_merges_at_once(spark, tmp_path):
    one, other = (statelog.history_log(spark, str(tmp_path)) for _ in range(2))
    one.append(seen(spark, ("a", 1)))
    publish = one.versions.publish

    def late(number, content):
        other.compact()
        publish(number, content)

    one.versions.publish = late
    with pytest.raises(ConcurrentChange):
        one.compact()
    assert dates(one.read()) == {"a": 1}


def test_an_uncommitted_change_does_not_count_and_a_repeated_one_counts_once(spark, tmp_path):
    log = statelog.history_log(spark, str(tmp_path))
    log.append(seen(spark, ("a", 5)), "batch-1")
    log.append(seen(spark, ("a", 7)), "batch-1")
    Path(tmp_path, "delta", "half").mkdir()
    Path(tmp_path, "delta", "half", "part-0.json").write_text('{"url":"x"}\n')
    assert dates(log.read()) == {"a": 7}


def test_damaged_changes(spark, tmp_path):
    log = statelog.history_log(spark, str(tmp_path))
    log.append(seen(spark, ("a", 1)), "good")
    log.append(seen(spark, ("b", 2)), "bad")
    part = next(Path(tmp_path, "delta", "bad").glob("part-*"))
    part.write_text(part.read_text() + "{oops")
    part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
    assert dates(log.read()) == {"a": 1}
    log.compact()
    assert dates(log.read()) == {"a": 1} and log.versions.names("delta") == ["bad"]
    strict = statelog.StateLog(spark, str(tmp_path), HISTORY, ["url"], log.merge)
    with pytest.raises(sinks.CorruptState):
        strict.read()
    with pytest.raises(ValueError):
        statelog.StateLog(spark, str(tmp_path), HISTORY, ["url"], log.merge, on_corrupt="ignore")


def test_merging_is_due_after_many_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(statelog, "MOST_DELTAS", 2)
    log = statelog.history_log(spark, str(tmp_path))
    for day in range(1, 4):
        log.compact_if_due()
        assert len(log.deltas()) == day - 1
        log.append(seen(spark, ("a", day)))
    log.compact_if_due()
    assert log.deltas() == [] and dates(log.read()) == {"a": 1}
    monkeypatch.setattr(statelog, "LEAST_BYTES", 1)
    log.append(seen(spark, *[(f"u{i}", 1) for i in range(500)]))
    assert log.due()


SCORED = "url string, classification struct<eligible:boolean>"


def test_a_snapshot_that_dies_leaves_the_old_one(spark, tmp_path):
    root = str(tmp_path)
    rows = lambda *urls: spark.createDataFrame([(u, (u != "no",)) for u in urls], SCORED)
    latest = lambda: sorted(r["url"] for r in sinks.read_latest(spark, root, "url string").collect())
    days = lambda: sorted((str(r["run_date"]), r["url"]) for r in sinks.read_days(spark, root, "url string").collect())
    assert latest() == days() == []
    sinks.write_snapshots(rows("a", "no"), root, date(2024, 5, 1))
    assert latest() == ["a", "no"] and days() == [("2024-05-01", "a")]
    broken = rows("b").withColumn("url", F.when(F.col("url") == "b", F.raise_error(F.lit("lost"))).otherwise(F.col("url")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_snapshots(broken, root, date(2024, 5, 2))
    # The second of the two folders fails as well.
    half = rows("c").withColumn("classification", F.when(F.col("url") == "c", F.raise_error(F.lit("lost"))).cast("struct<eligible:boolean>"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_snapshots(half, root, date(2024, 5, 2))
    assert latest() == ["a", "no"] and days() == [("2024-05-01", "a")]
    sinks.write_snapshots(rows("d"), root, date(2024, 5, 2))
    sinks.write_snapshots(rows("e"), root, date(2024, 5, 2))
    sinks.write_snapshots(rows("f"), root, date(2024, 5, 3))
    assert latest() == ["f"] and days() == [("2024-05-01", "a"), ("2024-05-02", "e"), ("2024-05-03", "f")]


def test_opening_a_ledger_leaves_its_schema_alone(spark, tmp_path):
    from siftwell.schema import LEDGER

    names = list(LEDGER.names)
    for _ in range(2):
        log = statelog.ledger_log(spark, str(tmp_path))
    assert [f.name for f in LEDGER.fields] == names and log.schema.names == [*names, "ord"]


def test_snapshots_are_packed(spark, tmp_path):
    """What is written twice, for the latest and for its day, is a small part of the plain text."""
    text = spark.range(2000).selectExpr("concat('https://jobs.example.com/', id) as url", "named_struct('eligible', true) as classification")
    sinks.write_snapshots(text, str(tmp_path), date(2024, 5, 1))
    files = [f for f in tmp_path.rglob("part-*")]
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert sinks.read_latest(spark, str(tmp_path), "url string").distinct().count() == 2000
    assert sinks.read_days(spark, str(tmp_path), "url string").count() == 2000


def land(spark, folder, rows):
    spark.createDataFrame(rows, "url string, ts timestamp").coalesce(1).write.mode("append").json(folder)


def run_stream(spark, landing, target, progress):
    return incremental.stream_first_seen(spark.readStream.schema("url string, ts timestamp").json(landing), target, progress)


def test_a_batch_reads_its_own_urls_only(spark, tmp_path):
    """Known dates come from the state store: the table may be gone."""
    landing, target, progress = (str(tmp_path / n) for n in ("in", "state", "progress"))
    land(spark, landing, [(f"u{i}", datetime(2024, 1, 2)) for i in range(40)])
    run_stream(spark, landing, target, progress)
    shutil.move(target, str(tmp_path / "aside"))
    land(spark, landing, [("u1", datetime(2024, 3, 1)), ("u2", datetime(2024, 1, 1)), ("new", datetime(2024, 3, 2))])
    query = run_stream(spark, landing, target, progress)
    got = {r["url"]: str(r["first_seen"]) for r in incremental.first_seen_table(spark, target).collect()}
    assert got == {"u1": "2024-01-02", "u2": "2024-01-01", "new": "2024-03-02"}
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 41 and sum(p["numInputRows"] for p in query.recentProgress) == 3
    assert "rocksdbBytesCopied" in state["customMetrics"]


def test_state_has_no_more_partitions_than_cores(spark, tmp_path):
    """Each is committed by every batch; the session's own setting stays as it was."""
    key, landing = "spark.sql.shuffle.partitions", str(tmp_path / "in")
    land(spark, landing, [(f"u{i}", datetime(2024, 1, 2)) for i in range(40)])
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    try:
        query = run_stream(spark, landing, str(tmp_path / "state"), str(tmp_path / "progress"))
        assert spark.conf.get(key) == "64"
    finally:
        spark.conf.set(key, before)
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == spark.sparkContext.defaultParallelism
    assert incremental.first_seen_table(spark, str(tmp_path / "state")).count() == 40


def test_streamed_state_is_merged_and_survives_a_new_checkpoint(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(statelog, "MOST_DELTAS", 1)
    landing, target = str(tmp_path / "in"), str(tmp_path / "state")
    for day in (5, 3, 8):
        land(spark, landing, [("a", datetime(2024, 1, day)), (f"b{day}", datetime(2024, 1, day)), (None, datetime(2024, 1, 1))])
        run_stream(spark, landing, target, str(tmp_path / "progress"))
    log = statelog.history_log(spark, target)
    assert len(log.deltas()) <= 1 and log.versions.names("base")
    want = {"a": "2024-01-03", "b5": "2024-01-05", "b3": "2024-01-03", "b8": "2024-01-08"}
    for progress in ("progress", "another"):
        run_stream(spark, landing, target, str(tmp_path / progress))
        assert {r["url"]: str(r["first_seen"]) for r in incremental.first_seen_table(spark, target).collect()} == want


@pytest.mark.parametrize("rows", [[], [(1, None)], [(i, datetime(2024, 1, 1 + i * 7 % 13) if i % 5 else None) for i in range(400)]])
def test_places_of_all_rows(spark, rows):
    posts = spark.createDataFrame(rows, "ord bigint, posted_at timestamp").repartition(7)
    got = {r["ord"]: r["place"] for r in ordering.newest_first_places(posts).collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or datetime(2000, 1, 1)).timestamp(), r[0]))
    assert got == {o: i + 1 for i, (o, _) in enumerate(want)}


def test_places_use_no_window(spark):
    posts = spark.range(100).select(F.col("id").alias("ord"), F.lit(datetime(2024, 1, 1)).alias("posted_at"))
    plan = ordering.newest_first_places(posts)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
