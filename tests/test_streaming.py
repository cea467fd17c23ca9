"""Incremental news append (ST1): each landed file is loaded once."""

import json

from pyspark.sql import functions as F

from geonest.streaming.news_stream import run_news_stream_once


def land(spark, path, n_articles, topic):
    body = json.dumps({"status": "ok", "articles": [{"id": i, "text": "x", "n_chars": 1} for i in range(n_articles)]})
    env = spark.createDataFrame(
        [("NG", topic, 0, "2024-03-04 00:00:00", body), ("NG", topic, 1, "2024-03-04 00:00:00", "{bad")],
        "country string, topic string, page long, requested_at string, body string",
    ).withColumn("requested_at", F.col("requested_at").cast("timestamp"))
    env.coalesce(1).write.mode("append").json(path)


def test_stream_loads_each_file_once(spark, tmp_dir):
    landing, table, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    land(spark, landing, 3, "tech")
    run_news_stream_once(spark, landing, table, ckpt)
    assert spark.read.parquet(table).count() == 3
    run_news_stream_once(spark, landing, table, ckpt)
    assert spark.read.parquet(table).count() == 3
    land(spark, landing, 2, "news")
    run_news_stream_once(spark, landing, table, ckpt)
    back = spark.read.parquet(table)
    assert back.count() == 5
    assert {r.topic for r in back.select("topic").distinct().collect()} == {"tech", "news"}


def _land_file(path, country, topic, name, body):
    import os

    d = os.path.join(path.replace("file:", ""), country, topic)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(body)


def test_file_landing_bodies_stay_whole(spark, tmp_dir):
    from geonest.sources.news import read_response_files

    body = json.dumps({"status": "ok", "articles": [{"id": 1, "text": "x", "n_chars": 1}]}, indent=2)
    assert "\n" in body
    _land_file(f"{tmp_dir}/files", "NG", "tech", "r1.json", body)
    rows = read_response_files(spark, f"{tmp_dir}/files").collect()
    assert [(r.country, r.topic, r.body) for r in rows] == [("NG", "tech", body)]


def test_stream_over_file_landing(spark, tmp_dir):
    landing, table, ckpt = f"{tmp_dir}/files", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    ok = lambda n: json.dumps({"status": "ok", "articles": [{"id": i, "text": "x", "n_chars": 1} for i in range(n)]}, indent=1)
    _land_file(landing, "NG", "tech", "a.json", ok(3))
    _land_file(landing, "NG", "news", "b.json", "{bad")
    run_news_stream_once(spark, landing, table, ckpt, landing="files", run_ts="2024-03-04 00:00:00")
    assert spark.read.parquet(table).count() == 3
    run_news_stream_once(spark, landing, table, ckpt, landing="files", run_ts="2024-03-04 00:00:00")
    assert spark.read.parquet(table).count() == 3  # nothing new landed
    _land_file(landing, "US", "news", "c.json", ok(2))
    run_news_stream_once(spark, landing, table, ckpt, landing="files", run_ts="2024-03-05 00:00:00")
    back = spark.read.parquet(table)
    assert back.count() == 5
    assert {(r.country, r.topic) for r in back.select("country", "topic").distinct().collect()} == {("NG", "tech"), ("US", "news")}


def test_backlog_in_several_micro_batches(spark, tmp_dir):
    from geonest.streaming.news_stream import start_news_stream

    landing, table, ckpt = f"{tmp_dir}/files", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    for i in range(5):
        body = json.dumps({"status": "ok", "articles": [{"id": 10 * i + j, "text": "x", "n_chars": 1} for j in range(2)]})
        _land_file(landing, "NG", f"t{i}", "r.json", body)
    q = start_news_stream(spark, landing, table, ckpt, available_now=True, max_files_per_trigger=2,
                          landing="files", run_ts="2024-03-04 00:00:00")
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3  # 2 + 2 + 1 files
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == sorted(10 * i + j for i in range(5) for j in range(2))


def test_a_hot_folder_is_written_by_several_tasks(spark, tmp_dir):
    import glob
    import random

    landing, table = f"{tmp_dir}/files", f"{tmp_dir}/table"
    for i in range(12):  # nearly all articles in one folder, NG/tech
        text = random.Random(i).randbytes(10_000).hex()
        body = json.dumps({"status": "ok", "articles": [{"id": 100 * i + j, "text": text[j * 50:], "n_chars": 1} for j in range(30)]})
        _land_file(landing, "NG", "tech" if i else "news", f"r{i}.json", body)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        run_news_stream_once(spark, landing, table, f"{tmp_dir}/ckpt", landing="files", run_ts="2024-03-04 00:00:00")
    finally:
        spark.conf.set(key, before)
    base = table.replace("file:", "")
    assert len(glob.glob(f"{base}/load=*/date=*/country=NG/topic=tech/*.parquet")) > 1
    assert spark.read.parquet(table).count() == 360


def test_stream_and_batch_share_a_table(spark, tmp_dir):
    from geonest.plans.news import load_news
    from geonest.sources.news import read_news_table

    landing, other, table = f"{tmp_dir}/landing", f"{tmp_dir}/other", f"{tmp_dir}/table"
    land(spark, landing, 3, "tech")
    run_news_stream_once(spark, landing, table, f"{tmp_dir}/ckpt")
    land(spark, other, 2, "news")
    load_news(spark, other, table)
    land(spark, landing, 4, "food")
    run_news_stream_once(spark, landing, table, f"{tmp_dir}/ckpt")
    back = read_news_table(spark, table)
    assert back.count() == 9 and "load" not in back.columns
    # another checkpoint is another stream: nothing of the first is replaced
    run_news_stream_once(spark, landing, table, f"{tmp_dir}/ckpt2")
    assert read_news_table(spark, table).count() == 16


def test_a_repeated_micro_batch_replaces_its_own_rows(spark, tmp_dir):
    import glob
    import os

    landing, table, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    land(spark, landing, 3, "tech")
    run_news_stream_once(spark, landing, table, ckpt)
    for f in glob.glob(f"{ckpt.replace('file:', '')}/commits/*") + glob.glob(f"{ckpt.replace('file:', '')}/commits/.*.crc"):
        os.remove(f)  # as if the batch had been written but not committed
    run_news_stream_once(spark, landing, table, ckpt)
    assert spark.read.parquet(table).count() == 3


def test_a_stream_packs_small_files_and_opens_each_once(spark, tmp_dir):
    import glob

    from geonest.plans.news import packed_files
    from geonest.streaming.news_stream import start_news_stream

    landing = f"{tmp_dir}/files"
    body = json.dumps({"status": "ok", "articles": [{"id": 1, "text": "x", "n_chars": 1}]})
    for i in range(300):  # every other one is rejected
        _land_file(landing, "NG", "tech", f"r{i}.json", body if i % 2 else "{bad")
    run_news_stream_once(spark, landing, f"{tmp_dir}/once", f"{tmp_dir}/once-ckpt", landing="files", run_ts="2024-03-04 00:00:00")
    # one file of rejects for each task that read: some 30 files a task without packing
    assert len(glob.glob(f"{tmp_dir}/once-rejects/load=*/*.parquet".replace("file:", ""))) <= 5
    assert spark.read.parquet(f"{tmp_dir}/once").count() == 150
    with packed_files(spark, "files"):
        q = start_news_stream(spark, landing, f"{tmp_dir}/table", f"{tmp_dir}/ckpt", landing="files", run_ts="2024-03-04 00:00:00")
        q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 300  # articles and rejects come from one reading
    assert spark.read.parquet(f"{tmp_dir}/table").count() == 150
    assert spark.read.parquet(f"{tmp_dir}/table-rejects").count() == 150
    assert not glob.glob(f"{tmp_dir}/*/_staged/*".replace("file:", ""))
