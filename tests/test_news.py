"""News parsing, classification, stamping and request planning."""

import json

from pyspark.sql import functions as F

from geonest import constants as K
from geonest.functions.scalars import date_path, iso_utc, news_storage_path, quoted
from geonest.operators.news import articles_from_responses, classify_responses, parse_responses
from geonest.operators.requests import build_requests, coverage_gaps, request_grid, sample_requests

OK_BODY = json.dumps(
    {"status": "ok", "articles": [{"id": 1, "text": "a", "n_chars": 1}, {"id": 2, "text": "bb", "n_chars": 2}]}
)


def responses(spark):
    rows = [
        ("DE", "news", 0, OK_BODY),
        ("DE", "tech", 0, "{bad"),
        ("FR", "news", 0, json.dumps({"status": K.NEWS_NO_MATCHES_STATUS})),
        ("FR", "tech", 0, ""),
        ("FR", "food", 0, None),
        ("ES", "news", 0, "{}"),
    ]
    df = spark.createDataFrame(rows, "country string, topic string, page long, body string")
    return df.withColumn("requested_at", F.lit("2024-03-04 05:06:07.000001").cast("timestamp"))


def test_response_classes(spark):
    out = classify_responses(parse_responses(responses(spark)))
    got = {(r.country, r.topic): r.response_class for r in out.collect()}
    assert got == {
        ("DE", "news"): "ok",
        ("DE", "tech"): "malformed",
        ("FR", "news"): "no_articles",
        ("FR", "tech"): "empty",
        ("FR", "food"): "empty",
        ("ES", "news"): "no_articles",
    }


def test_articles_are_stamped_and_rejects_kept(spark):
    arts, rejects = articles_from_responses(responses(spark))
    rows = arts.collect()
    assert sorted(r.id for r in rows) == [1, 2]
    assert {r.call_timestamp for r in rows} == {"2024-03-04T05:06:07.000001Z"}
    assert rejects.count() == 5


def test_path_and_iso_functions(spark):
    df = spark.createDataFrame([("2024-03-04 05:06:07",)], "s string").select(F.col("s").cast("timestamp").alias("ts"))
    r = df.select(
        date_path("ts").alias("d"),
        iso_utc("ts").alias("i"),
        news_storage_path("ts", F.lit("NG"), F.lit("tech")).alias("p"),
        quoted(F.lit("Random")).alias("q"),
    ).collect()[0]
    assert r.d == "2024/03/04"
    assert r.i == "2024-03-04T05:06:07.000000Z"
    assert r.p == "newscatcher/2024/03/04/NG/tech/news_data.parquet"
    assert r.q == '"Random"'


def test_grid_gaps_and_urls(spark):
    countries = spark.createDataFrame([("NG",), ("US",), ("NG",)], "country string")
    grid = request_grid(countries, topics=["news", "tech"])
    assert grid.count() == 4
    seen = spark.createDataFrame([("NG", "news"), ("NG", "news")], "country string, topic string")
    gaps = coverage_gaps(grid, seen)
    assert sorted(tuple(r) for r in gaps.collect()) == [("NG", "tech"), ("US", "news"), ("US", "tech")]
    urls = build_requests(gaps, query="hello world").collect()
    u = [r.full_url for r in urls if r.country == "US" and r.topic == "news"][0]
    assert u == "search?q=%22hello+world%22&lang=en&countries=US&topic=news&sort_by=rank&page_size=100&page=1"


def test_sample_does_not_depend_on_partitioning(spark):
    countries = spark.createDataFrame([(f"C{i}",) for i in range(30)] + [(None,)], "country string")
    grid = request_grid(countries)
    picked = {tuple(tuple(r) for r in sample_requests(grid.repartition(n), 5, seed=3).collect()) for n in (1, 3, 16)}
    assert len(picked) == 1 and len(next(iter(picked))) == 5
    assert [tuple(r) for r in sample_requests(grid, 5, seed=4).collect()] not in [list(p) for p in picked]


def test_body_parsed_once(spark):
    from geonest.plans.explain import plan_text

    arts, _ = articles_from_responses(responses(spark))
    assert plan_text(arts, "simple").lower().count("parsejson(") == 1


BODIES = {
    "mistyped": '{"status":"ok","articles":[{"id":"abc","text":"t","n_chars":1},{"id":2,"text":["x"],"n_chars":"3"}]}',
    "unknown": '{"status":"ok","articles":[{"id":1,"title":"T","tags":["a",1],"text":null}],"more":1}',
    "list": '[{"articles":[]}]', "value": "7", "text": '"articles"', "no_list": '{"articles":{"id":1}}', "null": '{"articles":null}',
    "cut": '{"status":"ok","articles":[{"id":1', "spaces": "  ", "none": '{"articles":[]}', "odd": '{"articles":[null,3,{"id":4}]}',
}


def test_a_response_is_in_one_class_and_only_ok_ones_have_articles(spark):
    df = spark.createDataFrame([("C", k, 0, v) for k, v in BODIES.items()], "country string, topic string, page long, body string")
    df = df.withColumn("requested_at", F.lit("2024-01-01").cast("timestamp"))
    classes = {r.topic: r.response_class for r in classify_responses(parse_responses(df)).collect()}
    ok = {"mistyped", "unknown", "none", "odd"}
    assert {k for k, c in classes.items() if c == "ok"} == ok
    assert {k for k, c in classes.items() if c == "malformed"} == {"cut", "spaces"}
    assert {k for k, c in classes.items() if c == "no_articles"} == {"list", "value", "text", "no_list", "null"}
    arts, rejects = articles_from_responses(df)
    assert {r.topic for r in rejects.collect()} == set(BODIES) - ok
    rows = sorted(((r.topic, r.id, r.text, r.n_chars, r.extra) for r in arts.collect()), key=repr)
    assert rows == sorted([
        ("mistyped", None, "t", 1, {"id": '"abc"'}), ("mistyped", 2, '["x"]', 3, {}),
        ("unknown", 1, None, None, {"title": '"T"', "tags": '["a",1]'}),
        ("odd", None, None, None, None), ("odd", None, None, None, None), ("odd", 4, None, None, {}),
    ], key=repr)


def test_callers_article_schema_reaches_the_table(spark, tmp_dir):
    from pyspark.sql import types as T

    from geonest.plans.news import load_news
    from geonest.sources.news import read_news_table

    df = spark.createDataFrame([("DE", "tech", BODIES["unknown"])], "country string, topic string, body string")
    df.selectExpr("country", "topic", "0L as page", "timestamp'2024-05-06 00:00:00' as requested_at", "body").write.json(f"{tmp_dir}/landing")
    load_news(spark, f"{tmp_dir}/landing", f"{tmp_dir}/table", article=T.StructType.fromDDL("id bigint, title string"))
    r = read_news_table(spark, f"{tmp_dir}/table").collect()[0]
    assert (r.id, r.title, r.extra["tags"], "text" in r.extra) == (1, "T", '["a",1]', True)


def test_corrupt_landing_lines_are_rejected_with_their_text(spark, tmp_dir):
    from geonest.plans.news import news_articles
    from geonest.sources.news import read_response_log

    good = json.dumps({"country": "DE", "topic": "tech", "page": 0, "requested_at": "2024-01-01T00:00:00Z", "body": OK_BODY})
    with open(f"{tmp_dir}/l.json".replace("file:", ""), "w") as f:
        f.write(good + "\n" + good[:-5] + "\n")
    arts, rejects = news_articles(read_response_log(spark, tmp_dir))
    assert arts.count() == 2
    assert [(r.response_class, r.corrupt_line) for r in rejects.collect()] == [("corrupt_line", good[:-5])]


def test_folder_values_are_decoded(spark, tmp_dir):
    from geonest.sources.news import read_news_layout, read_response_files

    values = ["real estate", "a:b", "50%", "x+y", "é/".strip("/"), "k=v", None]
    df = spark.createDataFrame([(v, "news", "{}") for v in values], "country string, topic string, body string")
    df.write.partitionBy("country", "topic").text(f"{tmp_dir}/hive")
    assert sorted((r.country for r in read_response_files(spark, f"{tmp_dir}/hive").collect()), key=repr) == sorted(values, key=repr)
    for v in ("real estate", "50%", "x+y"):  # plain folders are not escaped
        spark.range(1).write.parquet(f"{tmp_dir}/plain/api/2024/03/04/{v}/tech")
    got = {r.country for r in read_news_layout(spark, f"{tmp_dir}/plain").collect()}
    assert got == {"real estate", "50%", "x+y"}


def test_utc_functions_under_two_session_zones(spark):
    from geonest.functions.scalars import utc_date

    got = set()
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.range(1).selectExpr(
                "timestamp_micros(1704067200000001) t", "timestamp_ntz'2024-03-10 02:30:00.5' n", "timestamp_micros(-1) old", "cast(null as timestamp) none"
            )
            got.add(tuple(df.select(*(iso_utc(c) for c in df.columns), *(date_path(c) for c in df.columns), utc_date("t")).collect()[0]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {(
        "2024-01-01T00:00:00.000001Z", "2024-03-10T02:30:00.500000Z", "1969-12-31T23:59:59.999999Z", None,
        "2024/01/01", "2024/03/10", "1969/12/31", None, "2024-01-01",
    )}


def test_form_encoding_matches_python_urlencode(spark):
    import urllib.parse

    from geonest.functions.scalars import form_encode

    raw = 'a b*~"+/&=é'
    got = spark.range(1).select(form_encode(F.lit(raw)).alias("e")).collect()[0].e
    assert got == urllib.parse.urlencode({"x": raw})[2:]


def test_file_landing_round_trip_and_rejects(spark, tmp_dir):
    from geonest import fixtures as FX
    from geonest.plans.news import load_news
    from geonest.sources.news import read_news_table, read_response_files

    ok = '{"status":"ok","articles":[{"id":1,"text":"a b","n_chars":3},{"id":2,"text":"c","n_chars":1}]}'
    rows = [("NG", "tech", ok), ("NG", "sport", ""), ("US", "tech", "{bad"), ("US", "news", '{"status":"No matches for your search."}')]
    df = spark.createDataFrame(rows, "country string, topic string, body string")
    landing = FX.land_response_files(df, f"{tmp_dir}/landing")
    got = {(r.country, r.topic) for r in read_response_files(spark, landing).collect()}
    assert got == {(c, t) for c, t, _ in rows}  # keys come from country=/topic= folders
    rejects = load_news(spark, landing, f"{tmp_dir}/table", landing="files", run_ts="2024-05-06 07:08:09")
    classes = {(r.country, r.topic): r.response_class for r in rejects.collect()}
    # the text writer lands the empty body as a newline-only file (a 0-byte
    # file would be invisible to file sources): content that is not JSON
    assert classes == {("NG", "sport"): "malformed", ("US", "tech"): "malformed", ("US", "news"): "no_articles"}
    table = read_news_table(spark, f"{tmp_dir}/table").collect()
    assert sorted(r.id for r in table) == [1, 2]
    assert {r.call_timestamp for r in table} == {"2024-05-06T07:08:09.000000Z"}


def test_whitespace_body_is_malformed_not_empty(spark):
    df = spark.createDataFrame([("ES", "tech", 0, " \n"), ("ES", "news", 0, "")], "country string, topic string, page long, body string")
    got = {r.topic: r.response_class for r in classify_responses(parse_responses(df)).collect()}
    assert got == {"tech": "malformed", "news": "empty"}  # only no content at all is empty


def test_files_are_landed_by_many_tasks_and_read_by_few(spark, tmp_dir):
    from geonest.fixtures import land_response_files
    from geonest.plans.news import FILES_CONF
    from geonest.session import session_conf
    from geonest.sources.news import read_response_files

    body = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(400)), lambda i: F.sha2(F.concat(F.col("id"), i), 256)), "")
    df = spark.range(0, 300, 1, 8).select(F.lit("EN").alias("country"), F.lit("news").alias("topic"), F.col("id"), body.alias("body"))
    with session_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}):
        land_response_files(df.repartition("id"), f"{tmp_dir}/landing")
    landed = read_response_files(spark, f"{tmp_dir}/landing")
    files = spark.read.text(f"{tmp_dir}/landing", wholetext=True, recursiveFileLookup=True).select(F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).alias("t"), "value")
    assert files.count() == 300 and files.select("t").distinct().count() > 2
    assert sorted(r[0].rstrip() for r in landed.select("body").collect()) == sorted(r[0] for r in df.select("body").collect())
    with session_conf(spark, {**FILES_CONF, "spark.sql.files.maxPartitionBytes": "64m"}):
        assert read_response_files(spark, f"{tmp_dir}/landing").rdd.getNumPartitions() < 300 // 16


ODD_KEYS = ["a b", "50%", "x+y", "k=v", "a:b", "é", "q\"'*#", "\x01\x1f\x7f", "{[]^}", "\\?", "<|>", "", None]


def test_landed_files_lie_where_sparks_writer_puts_them(spark, tmp_dir):
    import glob
    import os

    from geonest.fixtures import land_response_files

    rows = [(k, "news", b) for k in ODD_KEYS for b in ("{}", "{}", "", None, "two\nlines é")]
    df = spark.createDataFrame(rows, "country string, topic string, body string")
    (df.write.option("maxRecordsPerFile", 1).partitionBy("country", "topic").text(f"{tmp_dir}/spark"))
    land_response_files(df, f"{tmp_dir}/own")
    land_response_files(df, f"{tmp_dir}/own")  # replaces what lies there

    def landed(at):
        root = f"{tmp_dir}/{at}".replace("file:", "")
        files = [f for f in glob.glob(f"{root}/*/*/*")]
        return sorted((os.path.relpath(os.path.dirname(f), root), open(f, "rb").read()) for f in files)

    assert landed("own") == landed("spark") and len(landed("own")) == len(rows)
    # nothing beside the bodies: no checksum file that the local file system starts a process for
    assert not glob.glob(f"{tmp_dir}/own/*/*/.*".replace("file:", ""))


def test_files_are_landed_in_a_store_that_only_spark_reaches(spark, tmp_dir):
    from geonest.fixtures import land_response_files
    from geonest.sources.news import read_response_files

    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.landing.link./in", f"file://{tmp_dir.replace('file:', '')}")
    df = spark.createDataFrame([("NG", "tech", "{}"), ("NG", "tech", "[]"), (None, "news", "{bad")], "country string, topic string, body string")
    land_response_files(df, "viewfs://landing/in/store")
    got = sorted((r.country or "", r.topic, r.body.rstrip()) for r in read_response_files(spark, "viewfs://landing/in/store").collect())
    assert got == [("", "news", "{bad"), ("NG", "tech", "[]"), ("NG", "tech", "{}")]


def test_a_load_opens_each_file_once(spark, tmp_dir, monkeypatch):
    import glob
    import os

    from geonest.fixtures import land_response_files
    from geonest.plans import news

    ok = '{"status":"ok","articles":[{"id":1,"text":"a","n_chars":1}]}'
    df = spark.createDataFrame([("NG", "tech", ok), ("NG", "news", "{bad")], "country string, topic string, body string")
    land_response_files(df, f"{tmp_dir}/landing")
    parse = news.news_articles

    def late(responses, article):  # what is landed goes before articles and rejects are worked out
        for f in glob.glob(f"{tmp_dir}/landing/*/*/part-*".replace("file:", "")):
            os.remove(f)
        return parse(responses, article)

    monkeypatch.setattr(news, "news_articles", late)
    rejects = news.load_news(spark, f"{tmp_dir}/landing", f"{tmp_dir}/table", landing="files", run_ts="2024-05-06 07:08:09")
    assert [r.response_class for r in rejects.collect()] == ["malformed"]
    assert spark.read.parquet(f"{tmp_dir}/table").count() == 1
    assert not glob.glob(f"{tmp_dir}/table/_staged/*".replace("file:", ""))


def test_a_landing_is_loaded_in_groups_of_folders(spark, tmp_dir, monkeypatch):
    from geonest.fixtures import land_response_files
    from geonest.plans import news
    from geonest.sources import news as source

    rows = [(c, t, f'{{"status":"ok","articles":[{{"id":{10 * i + j},"text":"a","n_chars":1}}]}}') for i, c in enumerate("ABC") for j, t in enumerate(("x", "_y", None))]
    df = spark.createDataFrame(rows + [("A", "x", "{bad")], "country string, topic string, body string")
    landing = land_response_files(df, f"{tmp_dir}/landing")
    spark.range(1).selectExpr("'{bad' as value").write.text(f"{tmp_dir}/landing/_hidden")
    groups = source.landing_groups(spark, landing, 4)
    assert len(groups) == 3 and groups == sorted(groups)  # country folders of 4, 3 and 3 files
    parts = [p.split("landing/")[1] for g in source.landing_groups(spark, landing, 2) for p in g]  # large folders are taken apart
    assert "country=A/topic=_y" in parts and "country=A" not in parts and len(parts) == 9
    assert source.landing_groups(spark, landing) == [[landing]]
    read = []
    monkeypatch.setattr(news, "landing_groups", lambda s, p: source.landing_groups(s, p, 3))
    monkeypatch.setattr(news, "read_response_files", lambda s, p: (read.append(p), source.read_response_files(s, p))[1])
    rejects = news.load_news(spark, landing, f"{tmp_dir}/table", landing="files", run_ts="2024-05-06 07:08:09")
    assert len(read) > 2 and rejects.count() == 1
    got = source.read_news_table(spark, f"{tmp_dir}/table").collect()
    assert sorted(r.id for r in got) == [0, 1, 2, 10, 11, 12, 20, 21, 22]
