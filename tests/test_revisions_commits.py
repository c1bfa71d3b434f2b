"""Feature revisions under late bars, and versions published by the commit log."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import assert_same, bars, collected, walk
from voltide.operators import etl, features, quality
from voltide.sources import bars as source
from voltide.sources import commits
from voltide.streaming import jobs, revisions


def batch_frame(table):
    newest = table.groupBy("symbol").agg(F.max("datetime").alias("last"))
    return features.feature_frame(table).join(newest, "symbol").where("datetime < last").drop("last")


def feed(spark, tmp_path, parts, **options):
    """One file and one run per part, so that a stream picks up where it stopped."""
    inbox, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for part in parts:
        bars(spark, part.reset_index(drop=True)).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(bars(spark, parts[0]).schema).parquet(inbox)
        jobs.run_batches(stream, revisions.feature_writer(out, **options), "features", f"{tmp_path}/run")
    return out


def test_shuffled_arrivals_equal_the_batch_frame(spark, tmp_path):
    frame = pd.concat([walk(110, 1, "A", gaps=0.1), walk(60, 2, "B")], ignore_index=True)
    order = np.random.default_rng(4).permutation(len(frame))
    out = feed(spark, tmp_path, [frame.iloc[part] for part in np.array_split(order, 10)])
    assert_same(collected(revisions.newest(spark, out)), collected(batch_frame(bars(spark, frame))), 9)
    assert revisions.revisions(spark, out).select("revision").distinct().count() == 10
    assert revisions.rejected_counts(spark, out).count() == 0


def test_only_bars_in_reach_are_emitted_again(spark, tmp_path):
    frame = walk(120)
    late = frame.index == 60
    out = feed(spark, tmp_path, [frame[~late], frame[late]])
    again = revisions.revisions(spark, out).where("revision = 1")
    found = sorted(r.datetime for r in again.select("datetime").collect())
    assert found == [t.to_pydatetime() for t in frame["datetime"][59 : 60 + revisions.REACH + 1]]
    assert_same(collected(revisions.newest(spark, out)), collected(batch_frame(bars(spark, frame))), 9)


def test_bars_behind_the_tail_are_counted_rejects(spark, tmp_path):
    frame = walk(200)
    parts = [frame[100:160], frame[[False] * 20 + [True] + [False] * 179], frame[160:][::-1], frame[152:154]]
    out = feed(spark, tmp_path, parts, lateness=48 * 3600, chunk_seconds=86_400)
    assert [r.rejected_bars for r in revisions.rejected_counts(spark, out).collect()] == [1]
    assert_same(collected(revisions.newest(spark, out)), collected(batch_frame(bars(spark, frame[100:]))), 9)
    assert commits.read(spark, f"{out}/tail").count() <= 49 + 2 * (revisions.REACH + 1)


def test_a_repeated_batch_and_repeated_bars(spark, tmp_path):
    frame = walk(40)
    write = revisions.feature_writer(f"{tmp_path}/out")
    write(bars(spark, frame[:30]), 0)
    for _ in range(2):
        changed = frame[25:].assign(close=frame["close"][25:] + 1)
        write(bars(spark, pd.concat([changed, changed])), 1)
    final = pd.concat([frame[:25], frame[25:].assign(close=frame["close"][25:] + 1)])
    got = revisions.newest(spark, f"{tmp_path}/out")
    assert_same(collected(got), collected(batch_frame(bars(spark, final))), 9)


def test_bars_without_time_are_rejected(spark, tmp_path):
    frame = walk(5)
    frame.loc[2, "datetime"] = pd.NaT
    revisions.feature_writer(f"{tmp_path}/out")(bars(spark, frame), 0)
    assert revisions.newest(spark, f"{tmp_path}/out").count() == 3
    assert revisions.rejected_counts(spark, f"{tmp_path}/out").first().rejected_bars == 1


# ---- commit log ------------------------------------------------------------------------------------


def test_log_answers_without_reading_data(spark, tmp_path):
    path = str(tmp_path / "set")
    for k in (1, 3, 2):
        commits.publish(bars(spark, walk(10 * k)).repartition(3), path, f"processed_data_{k}")
    commits.publish(bars(spark, walk(90)), path, "raw_9")
    rows = {r.version: r for r in commits.manifest(spark, path).collect()}
    assert {v: r.n_rows for v, r in rows.items()} == {
        "processed_data_1": 10, "processed_data_2": 20, "processed_data_3": 30, "raw_9": 90
    }
    direct = source.manifest(bars(spark, walk(20)).withColumn("version", F.lit("x"))).first()
    assert rows["processed_data_2"].content_hash == direct.content_hash
    assert rows["processed_data_2"].n_columns == direct.n_columns == 6
    latest = commits.read_latest(spark, path)
    assert_same(collected(latest), collected(bars(spark, walk(30))))
    assert len({f.rsplit("/", 2)[-2] for f in latest.inputFiles()}) == 1
    files = commits.lines(spark, path).where("version = 'processed_data_3'").first().files
    assert sum(f.n_rows for f in files) == 30 and max(f.max_time for f in files) == rows["processed_data_3"].max_time
    assert commits.read(spark, path, below="processed_data_2").count() == 10
    marks = commits.high_water_marks(spark, path)
    assert [r.datetime for r in marks.collect()] == [walk(90)["datetime"].iloc[-1].to_pydatetime()]


def test_interrupted_and_missing_versions_are_invisible(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "set")
    assert commits.read(spark, path) is None and commits.manifest(spark, path).count() == 0
    with pytest.raises(ValueError, match="no version"):
        commits.read_latest(spark, path)
    commits.publish(bars(spark, walk(10)), path, "processed_data_1")
    with monkeypatch.context() as broken:
        broken.setattr(commits.F, "input_file_name", lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            commits.publish(bars(spark, walk(20)), path, "processed_data_2")
    assert (tmp_path / "set" / "data").exists() and commits.read_latest(spark, path).count() == 10
    assert commits.high_water_marks(spark, path).count() == 1
    commits.publish(bars(spark, walk(30)), path, "processed_data_1")
    assert commits.read_latest(spark, path).count() == 30 and commits.manifest(spark, path).count() == 1
    commits.publish(bars(spark, walk(3)).limit(0), path, "processed_data_3")
    assert commits.read_latest(spark, path).count() == 0


def test_a_failing_gate_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "set")
    frame = walk(60)
    published = etl.run(spark, bars(spark, frame), path, "processed_data_1")
    assert published.count() == commits.manifest(spark, path).first().n_rows > 0
    frame.loc[:30, "close"] = np.nan
    with pytest.raises(quality.DataQualityError):
        etl.run(spark, bars(spark, frame), path, "processed_data_2")
    assert [r.version for r in commits.manifest(spark, path).collect()] == ["processed_data_1"]


def test_increment_follows_the_marks(spark, tmp_path):
    path = str(tmp_path / "set")
    frame = pd.concat([walk(30, 1, "A"), walk(30, 2, "B")], ignore_index=True)
    first = (frame["symbol"] == "A") & (frame["datetime"] < frame["datetime"][20])
    assert etl.run_new(spark, bars(spark, frame[first]), path, "raw_1").count() == 20
    assert etl.run_new(spark, bars(spark, frame), path, "raw_2").count() == 40
    assert etl.run_new(spark, bars(spark, frame), path, "raw_3").count() == 0
