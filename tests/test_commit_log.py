"""Loads of the news table count whole or not at all; compaction; repeated articles."""

import glob
import json
import os
import shutil

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from geonest.plans.news import compact_news, load_news, write_load
from geonest.sinks.commit_log import CommitLog
from geonest.sources.news import load_folder, read_loads, read_news_rejects, read_news_table, read_response_log, rejects_path
from geonest.streaming.news_stream import run_news_stream_once


def _land(spark, path, ids, topic="tech", at="2024-03-04 00:00:00", bad=True):
    body = json.dumps({"status": "ok", "articles": [{"id": i, "text": f"t{i}", "n_chars": 1, "title": "x"} for i in ids]})
    rows = [("NG", topic, 0, at, body)] + ([("NG", topic, 1, at, "{bad")] if bad else [])
    env = spark.createDataFrame(rows, "country string, topic string, page long, requested_at string, body string")
    env.withColumn("requested_at", F.col("requested_at").cast("timestamp")).coalesce(1).write.mode("append").json(path)
    return path


def _ids(spark, table):
    return sorted(r["id"] for r in read_news_table(spark, table).collect())


def _local(path):
    return path.replace("file:", "")


def test_a_load_is_seen_only_when_committed(spark, tmp_dir):
    table, landing = f"{tmp_dir}/t", _land(spark, f"{tmp_dir}/l", [1, 2])
    load_news(spark, landing, table)
    # another load has written its files and not yet its entry
    shutil.copytree(_local(load_folder(table, read_loads(spark, table)[0])), _local(load_folder(table, "batch-open")))
    assert _ids(spark, table) == [1, 2]
    CommitLog(spark, table).commit("batch-open")
    assert _ids(spark, table) == [1, 1, 2, 2]


def test_a_failed_load_is_never_seen(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    good, bad = _land(spark, f"{tmp_dir}/good", [1]), _land(spark, f"{tmp_dir}/bad", [2], topic="")
    with pytest.raises(PySparkException):
        load_news(spark, bad, table)  # an empty partition value stops the write, of the first load too
    assert read_loads(spark, table) == []
    load_news(spark, good, table)
    with pytest.raises(PySparkException):
        load_news(spark, bad, table)
    assert _ids(spark, table) == [1] and len(read_loads(spark, table)) == 1


def test_a_table_without_a_log_is_read_whole_and_taken_over(spark, tmp_dir):
    table, landing = f"{tmp_dir}/t", _land(spark, f"{tmp_dir}/l", [1, 2], bad=False)
    load_news(spark, landing, table)
    shutil.rmtree(_local(f"{table}/_loads"))
    assert _ids(spark, table) == [1, 2]
    load_news(spark, landing, table)
    assert _ids(spark, table) == [1, 1, 2, 2]


def test_articles_and_rejects_count_together_and_once(spark, tmp_dir):
    table, landing, ckpt = f"{tmp_dir}/t", _land(spark, f"{tmp_dir}/l", [1, 2]), f"{tmp_dir}/c"
    run_news_stream_once(spark, landing, table, ckpt)
    assert [r["response_class"] for r in read_news_rejects(spark, table).collect()] == ["malformed"]
    files = sorted(glob.glob(f"{_local(table)}*/load=*/**/*.parquet", recursive=True))
    for f in glob.glob(f"{_local(ckpt)}/commits/*") + glob.glob(f"{_local(ckpt)}/commits/.*.crc"):
        os.remove(f)  # the batch counts, but the stream does not know
    run_news_stream_once(spark, landing, table, ckpt)
    assert files == sorted(glob.glob(f"{_local(table)}*/load=*/**/*.parquet", recursive=True))
    # the batch was written in part only: it is written anew, both outputs
    for f in glob.glob(f"{_local(ckpt)}/commits/*") + glob.glob(f"{_local(ckpt)}/commits/.*.crc"):
        os.remove(f)
    (load,) = read_loads(spark, table)
    os.remove(_local(f"{table}/_loads/{load}.json"))
    assert read_loads(spark, table) == []
    run_news_stream_once(spark, landing, table, ckpt)
    assert _ids(spark, table) == [1, 2] and read_news_rejects(spark, table).count() == 1


def test_the_same_load_twice_is_one(spark, tmp_dir):
    table, responses = f"{tmp_dir}/t", read_response_log(spark, _land(spark, f"{tmp_dir}/l", [1]))
    assert write_load(responses, table, "a") and not write_load(responses, table, "a")
    assert _ids(spark, table) == [1]


def test_compaction_keeps_rows_and_few_files(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    for i in range(4):
        load_news(spark, _land(spark, f"{tmp_dir}/l{i}", [10 * i, 10 * i + 1], topic="01" if i % 2 else "tech"), table)
    before = sorted(map(tuple, read_news_table(spark, table).drop("extra").collect()))
    rejects = read_news_rejects(spark, table).count()
    stale = read_loads(spark, table)
    load = compact_news(spark, table)
    assert read_loads(spark, table) == [load]
    back = read_news_table(spark, table)
    assert sorted(map(tuple, back.drop("extra").collect())) == before
    assert read_news_rejects(spark, table).count() == rejects == 4
    assert len(glob.glob(f"{_local(load_folder(table, load))}/date=*/country=*/topic=*/*.parquet")) == 2
    load_news(spark, _land(spark, f"{tmp_dir}/later", [99]), table)
    assert len(read_loads(spark, table)) == 2
    with pytest.raises(ValueError, match="do not count any more"):
        CommitLog(spark, table).commit("late", replaces=stale)
    assert CommitLog(spark, table).remove_replaced([table, rejects_path(table)]) == stale
    assert len(glob.glob(f"{_local(table)}/load=*")) == 2
    assert read_news_table(spark, table).count() == 9


def test_compaction_cuts_a_large_folder(spark, tmp_dir):
    import random

    table = f"{tmp_dir}/t"
    text = random.Random(1).randbytes(60_000).hex()
    body = json.dumps({"status": "ok", "articles": [{"id": i, "text": text[200 * i:], "n_chars": 1} for i in range(100)]})
    for i in range(3):
        rows = [("NG", "tech", p, "2024-03-04 00:00:00", body) for p in range(3)]
        env = spark.createDataFrame(rows, "country string, topic string, page long, requested_at string, body string")
        env.withColumn("requested_at", F.col("requested_at").cast("timestamp")).repartition(3).write.mode("append").json(f"{tmp_dir}/l{i}")
        load_news(spark, f"{tmp_dir}/l{i}", table)
    load = compact_news(spark, table, target_bytes=1 << 20)
    assert len(glob.glob(f"{_local(load_folder(table, load))}/date=*/country=*/topic=*/*.parquet")) > 1
    assert read_news_table(spark, table).count() == 900


def test_only_new_articles_where_asked_for(spark, tmp_dir):
    table, landing = f"{tmp_dir}/t", _land(spark, f"{tmp_dir}/l", [1, 2, 2])
    load_news(spark, landing, table, new_only=True)
    assert _ids(spark, table) == [1, 2]
    _land(spark, landing, [2, 3], at="2024-03-05 00:00:00")  # the next day's answer repeats one
    _land(spark, landing, [1], topic="food")  # another request's article is another
    load_news(spark, landing, table, new_only=True)
    assert _ids(spark, table) == [1, 1, 2, 3]
    run_news_stream_once(spark, landing, table, f"{tmp_dir}/c", new_only=True)
    assert _ids(spark, table) == [1, 1, 2, 3]
    load_news(spark, landing, table)  # appending stays the default
    assert len(_ids(spark, table)) == 10


def test_a_table_without_loads(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    CommitLog(spark, table).open()
    with pytest.raises(ValueError, match="no committed load"):
        read_news_table(spark, table)
    schema = spark.createDataFrame([], "id long").schema
    assert read_news_table(spark, table, schema).count() == 0
    assert compact_news(spark, table) is None
