"""Nested and response inputs derived by Spark from the driver's flat tables.

Mapping (every document stays bounded in size, and the number of documents
grows with the data, so the fixture scales like real input):

* country document = customer and range of order keys (id c_custkey, iso3 'N' || c_nationkey)
* state            = order and range of line numbers  (id o_orderkey, state_code o_orderstatus)
* city             = lineitem                         (id l_orderkey * 8 + l_linenumber)

Edge cases come from categorical attributes, not from id arithmetic:
customers of segment HOUSEHOLD have an empty ``states`` array, orders
without line items have a null ``cities`` array, and coordinates are
empty, null or ``'n/a'`` text depending on flags. FIXTURES.md has the
full rules and the matching DuckDB expressions.

Population = suppliers per nation; responses = pages of at most 100
documents per (language, source).
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geonest import constants as K
from geonest import schemas as S
from geonest.session import FREE_SHUFFLES, new_scratch_dir, session_conf

FIXED_RUN_TS = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money_text(c: Column) -> Column:
    # Two-decimal text of a money amount, e.g. '1863.84' / '-0.50'.
    return c.cast("decimal(14,2)").cast("string")


# Every parent is nested in parts by ranges of its child key, whatever its
# size, so no collected group grows with a parent. The oracle states the
# same rule.
STATES_PER_PART = 8_192
CITIES_PER_PART = 4


def nest_children(rows: DataFrame, keep: list[str], part: Column, child: Column, name: str) -> DataFrame:
    """``rows`` grouped by ``keep`` and ``part``: the ``child`` structs of each
    group collected into the array ``name``."""
    return rows.groupBy(*keep, part.alias("_part")).agg(F.collect_list(child).alias(name))


def with_children(parents: DataFrame, children: DataFrame, key: str, child_key: str) -> tuple[DataFrame, DataFrame]:
    """Parents joined to their children, and parents that have none. Two
    joins on raw rows, before anything is nested: the inner one may be
    skewed on either side (adaptive execution splits it), the anti one
    reads only the children's distinct keys. Null keys never match."""
    keys = children.select(F.col(child_key).alias("_child_key")).distinct()
    return (
        parents.join(children, parents[key] == children[child_key]),
        parents.join(keys, parents[key] == keys["_child_key"], "left_anti"),
    )


def _city() -> Column:
    latitude = (
        F.when(F.col("l_returnflag") == "R", F.lit(""))
        .when(F.col("l_returnflag") == "A", F.lit(None).cast("string"))
        .when(F.col("l_linestatus") == "O", F.lit("n/a"))
        .otherwise(_money_text(F.col("l_extendedprice")))
    )
    return F.struct(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.concat(F.lit("Port "), F.col("l_returnflag"), F.col("l_linestatus")).alias("name"),
        latitude.alias("latitude"),
        _money_text(-F.col("l_extendedprice")).alias("longitude"),
    )


_ORDER = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]
_LINE = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice"]


def states_frame(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """``o_custkey``, ``o_orderkey`` and the ``state`` struct: one entry per order
    and range of ``CITIES_PER_PART`` line numbers, or one without cities."""
    matched, childless = with_children(orders.select(*_ORDER), lines.select(*_LINE), "o_orderkey", "l_orderkey")
    part = F.expr(f"l_linenumber div {CITIES_PER_PART}")
    nested = nest_children(matched, _ORDER, part, _city(), "cities").drop("_part")
    o = nested.unionByName(childless.withColumn("cities", F.lit(None).cast(nested.schema["cities"].dataType)))
    state = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("state_code"),
        _money_text(F.col("o_totalprice")).alias("latitude"),
        F.when(F.col("o_orderstatus") == "P", F.lit(""))
        .otherwise(_money_text(-F.col("o_totalprice")))
        .alias("longitude"),
        F.col("cities"),
    )
    return o.select("o_custkey", "o_orderkey", state.alias("state"))


def location_docs_of(customers: DataFrame, orders: DataFrame, lines: DataFrame, nations: DataFrame, regions: DataFrame) -> DataFrame:
    """Nested country documents: one per customer and range of
    ``STATES_PER_PART`` order keys, or one without states. HOUSEHOLD
    customers get one document with an empty array; they take no part in
    the joins."""
    dims = nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"], "left").select("n_nationkey", "n_name", "r_name")
    fields = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"]
    cust = customers.select(*fields)
    household = F.col("c_mktsegment") == "HOUSEHOLD"
    parents = cust.where(~household | F.col("c_mktsegment").isNull())
    states = states_frame(orders, lines)
    kind = S.COUNTRY["states"].dataType
    keys = orders.select(F.col("o_custkey").alias("_child_key")).distinct()
    # Customers go to their parts, not the parts to their customers: a part is
    # nested where it is joined, so only raw rows move again. No quotient of a
    # bigint is as small as what stands for that of a null order key.
    part = F.coalesce(F.expr(f"o_orderkey div {STATES_PER_PART}"), F.lit(-(1 << 62)))
    owners = parents.join(orders.select(F.col("o_custkey").alias("_owner"), part.alias("_range")).distinct(), F.col("c_custkey") == F.col("_owner"))
    parts = nest_children(states, ["o_custkey"], part, F.col("state"), "states")
    of_part = (F.col("_owner") == F.col("o_custkey")) & (F.col("_range") == F.col("_part"))
    matched = owners.join(parts, of_part).select(*fields, F.col("states").cast(kind))
    childless = parents.join(keys, parents["c_custkey"] == keys["_child_key"], "left_anti").select(*fields, F.lit(None).cast(kind).alias("states"))
    empty = cust.where(household).select(*fields, F.array().cast(kind).alias("states"))
    c = matched.union(childless).union(empty)
    c = c.join(dims, c["c_nationkey"] == dims["n_nationkey"], "left")
    code = F.concat(F.lit("N"), F.col("c_nationkey"))
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        code.alias("iso3"),
        F.col("c_mktsegment").alias("capital"),
        F.concat(F.lit("CUR"), F.col("c_nationkey")).alias("currency"),
        F.concat(F.col("n_name"), F.lit(" currency")).alias("currency_name"),
        F.lit("$").alias("currency_symbol"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("subregion"),
        (F.col("c_nationkey") + 1).cast("string").alias("phone_code"),
        F.concat(F.lit("flag:"), code).alias("emoji"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("n/a"))
        .otherwise(_money_text(F.col("c_acctbal")))
        .alias("latitude"),
        _money_text(-F.col("c_acctbal")).alias("longitude"),
        F.col("states"),
    )


def location_docs_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents over the driver tables (unmaterialised plan)."""
    return location_docs_of(*(table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem", "nation", "region")))


_materialised: dict[tuple, str] = {}


def location_docs_path(spark: SparkSession, sf_dir: str) -> str:
    """The nested documents, written once per process as Parquet in the
    shared scratch folder (the shape the ELT job reads after JSON
    conversion)."""
    key = ("locations", sf_dir)
    if key not in _materialised:
        path = new_scratch_dir(spark, "fixture-locations")
        with session_conf(spark, FREE_SHUFFLES):
            location_docs_frame(spark, sf_dir).write.mode("overwrite").option("compression", "zstd").parquet(path)
        _materialised[key] = path
    return _materialised[key]


def location_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(S.COUNTRY).parquet(location_docs_path(spark, sf_dir))


def population_frame(spark: SparkSession, sf_dir: str, unique: bool = True) -> DataFrame:
    """Population records keyed by nation code.

    ``unique``: one row per nation with the supplier count;
    otherwise one row per supplier (duplicate ``Alpha_3`` keys).
    """
    sup = table(spark, sf_dir, "supplier")
    if unique:
        return sup.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("Population")).select(
            F.concat(F.lit("A"), F.col("s_nationkey")).alias("Alpha_2"),
            F.concat(F.lit("N"), F.col("s_nationkey")).alias("Alpha_3"),
            F.col("Population").cast("long").alias("Population"),
        )
    return sup.select(
        F.concat(F.lit("A"), F.col("s_nationkey")).alias("Alpha_2"),
        F.concat(F.lit("N"), F.col("s_nationkey")).alias("Alpha_3"),
        F.col("s_suppkey").cast("long").alias("Population"),
    )


def topic_of_source(source: Column) -> Column:
    """Map ``srcN`` onto the fixed topic list (N modulo the list length)."""
    n = F.regexp_extract(source, r"(\d+)$", 1).try_cast("int")
    topics = F.array(*[F.lit(t) for t in K.NEWS_TOPICS])
    return F.element_at(topics, F.pmod(n, F.lit(len(K.NEWS_TOPICS))) + 1)


def response_log_frame(
    spark: SparkSession, sf_dir: str, requested_at: str = FIXED_RUN_TS
) -> DataFrame:
    """One landed response per page of <= 100 documents of a
    (language, source) pair, as the RESPONSE_ENVELOPE schema. Pages are
    requested on three successive days.

    Sources src3, src4, src5, src7 and src8 stand for a malformed body, a "no
    matches" answer, an empty body, a list and a cut body; every other page
    is an ``ok`` response with the documents as articles (whole texts).
    Articles have a ``title`` that no schema declares, and those of src6 an
    id that is no number.
    """
    docs = table(spark, sf_dir, "documents")
    number = F.col("doc_id").cast("string")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    article = F.struct(
        F.parse_json(F.when(F.col("source") == "src6", quoted(F.concat(F.lit("d"), number))).otherwise(number)).alias("id"),
        F.col("text").alias("text"), F.col("n_chars").alias("n_chars"), F.concat(F.lit("T"), number).alias("title"),
    )
    pages = docs.groupBy(
        "lang", "source", F.expr(f"doc_id div {K.NEWS_PAGE_SIZE}").alias("page")
    ).agg(F.collect_list(article).alias("articles"))
    ok_body = F.to_json(F.struct(F.lit("ok").alias("status"), F.col("articles").alias("articles")))
    body = (
        F.when(F.col("source") == "src3", F.lit("{bad"))
        .when(
            F.col("source") == "src4",
            F.to_json(F.struct(F.lit(K.NEWS_NO_MATCHES_STATUS).alias("status"))),
        )
        .when(F.col("source") == "src5", F.lit(""))
        .when(F.col("source") == "src7", F.lit('[{"articles":[]}]'))
        .when(F.col("source") == "src8", F.substring(ok_body, F.lit(1), F.length(ok_body) - 2))
        .otherwise(ok_body)
    )
    return pages.select(
        F.upper("lang").alias("country"),
        topic_of_source(F.col("source")).alias("topic"),
        F.col("page"),
        (F.lit(requested_at).cast("timestamp") + F.make_dt_interval(days=(F.col("page") % 3).cast("int"))).alias("requested_at"),
        body.alias("body"),
        (F.coalesce(F.col("source"), F.lit("")) == "src9").alias("cut_line"),
    )


def land_responses(df: DataFrame, path: str) -> str:
    """Write envelopes as JSON lines (splittable, one response per line); a
    ``cut_line`` loses its end."""
    line = F.to_json(F.struct(*[c for c in df.columns if c != "cut_line"]))
    cut = F.substring(line, F.lit(1), F.length(line) - 1)
    df.select(F.when(F.col("cut_line"), cut).otherwise(line).alias("value")).write.mode("overwrite").text(path)
    return path


def land_plain_layout(articles: DataFrame, path: str) -> str:
    """Articles in the original's plain folders
    ``<api>/<yyyy>/<MM>/<dd>/<country>/<topic>/``: one partitioned write, whose
    ``key=value`` folders then lose their keys (a rename per folder)."""
    spark = articles.sparkSession
    keys = ["_y", "_m", "_d", "_country", "_topic"]
    day = F.split("date", "-")
    placed = articles.select(
        "*", *(day.getItem(i).alias(k) for i, k in enumerate(keys[:3])), F.col("country").alias("_country"), F.col("topic").alias("_topic")
    ).drop("date", "country", "topic")
    root = f"{path}/{K.NEWS_API_NAME}"
    placed.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).parquet(root)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    level = [hadoop(root)]
    for key in keys:
        below = []
        for folder in level:
            for status in fs.listStatus(folder):
                name = status.getPath().getName()
                if name.startswith(f"{key}="):
                    plain = hadoop(folder, name.split("=", 1)[1])
                    fs.rename(status.getPath(), plain)
                    below.append(plain)
        level = below
    return path


#: Shuffled bytes of a task that writes a file per row: a few hundred files.
LANDING_TASK_BYTES = 1 << 20
_LANDING_CONF = {
    **FREE_SHUFFLES,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(LANDING_TASK_BYTES),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def land_response_files(df: DataFrame, path: str) -> str:
    """Write each response body as its own file under
    ``country=<c>/topic=<t>/``, the shape a per-request loader lands. A file
    costs much more than its bytes, so tasks are small
    (``LANDING_TASK_BYTES``), and each moves its own files into place; the
    driver would move all of them one by one.

    Hadoop's local file system starts a process or two for each file that it
    creates (``chmod``, without its native library), which costs many times the
    file; there the tasks write the files themselves, with the bytes and folder
    names of Spark's text writer, and rows stay where they are. That writer
    gets its rows clustered by the folder keys."""
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    with session_conf(spark, _LANDING_CONF):
        rows = df.select("country", "topic", "body")
        if fs.getScheme() == "file":
            fs.delete(target, True)
            fs.mkdirs(target)
            rows.mapInArrow(_land_bodies(target.toUri().getPath()), "n bigint").agg(F.sum("n")).collect()
        else:
            (
                rows.hint("rebalance", "country", "topic")
                .write.mode("overwrite")
                .option("maxRecordsPerFile", 1)
                .option("mapreduce.fileoutputcommitter.algorithm.version", 2)
                .partitionBy("country", "topic")
                .text(path)
            )
    return path


#: What Spark escapes in the name of a partition folder.
_ESCAPED = {c: f"%{c:02X}" for c in (*range(1, 0x20), 0x7F, *map(ord, "\"#%'*/:=?\\{[]^"))}


def _land_bodies(root: str):
    """One file per row below ``root``. A file's name says which task's and what
    it holds, so a task that runs again, in whatever order, writes the same files."""
    escaped = _ESCAPED  # the tasks need nothing of this package

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(key: str, value: str | None) -> str:
            return f"{key}={value.translate(escaped) if value else '__HIVE_DEFAULT_PARTITION__'}"

        task, seen, folders = TaskContext.get().partitionId(), Counter(), set()
        for b in batches:
            for country, topic, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                folder = f"{root}/{part('country', country)}/{part('topic', topic)}"
                if folder not in folders:
                    os.makedirs(folder, exist_ok=True)
                    folders.add(folder)
                data = (body or "").encode() + b"\n"
                name = hashlib.sha256(data).hexdigest()[:32]
                seen[folder, name] += 1
                draft = f"{folder}/.draft-{uuid.uuid4().hex}"
                with open(draft, "wb") as f:
                    f.write(data)
                os.replace(draft, f"{folder}/part-{task:05d}-{name}-{seen[folder, name]}.txt")
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    return run


RAW_FILE_BYTES = 64 * 1024 * 1024


def write_multiline_json(
    df: DataFrame, path: str, n_files: int | None = None, file_bytes: int = RAW_FILE_BYTES, compression: str = "none"
) -> str:
    """Write ``df`` as whole-file JSON arrays (the shape of the original
    raw location files), one array per output file.

    Rows are spread over ``n_files`` files by a hash of their whole JSON
    text, so rows that share an id do not meet in one file (default: one
    file per core, more when needed for about ``file_bytes`` of JSON text
    each), so no file -- and no task -- holds more than its share. Each row
    stays its own line: the first line of a file opens the array and the
    last closes it, both found by one window over the file's rows. Nothing
    is concatenated into one value, so a file may be larger than any row
    can be.

    ``compression``: for readers that take a file whole; a compressed file
    cannot be read by splits.
    """
    rows = df.select(F.to_json(F.struct(*df.columns)).alias("_json"))
    if not n_files:
        # A multi-line file is read by one task: at least one file per core.
        cores = df.sparkSession.sparkContext.defaultParallelism
        size = rows.agg(F.sum(F.octet_length("_json"))).first()[0] or 0
        n_files = max(1, cores, -(-int(size) // file_bytes))
    # Position within the file in (hash, text) order: a retried task numbers
    # its rows exactly as the first attempt did, up to equal rows. The first
    # row opens the array; the row with no successor closes it. Both come
    # from one window pass (no count or join).
    h = F.xxhash64("_json")
    rows = rows.select(F.pmod(h, F.lit(n_files)).alias("_file"), h.alias("_key"), "_json")
    w = Window.partitionBy("_file").orderBy("_key", "_json")
    lines = rows.select(
        "_file",
        F.concat(
            F.when(F.row_number().over(w) == 1, F.lit("[\n")).otherwise(F.lit("")),
            F.col("_json"),
            F.when(F.lead(F.lit(1)).over(w).isNull(), F.lit("\n]")).otherwise(F.lit(",")),
        ).alias("value"),
    )
    # Rows leave the window sorted by (_file, _key, _json), so each file's
    # lines are written in that order.
    with session_conf(df.sparkSession, FREE_SHUFFLES):
        lines.write.mode("overwrite").option("compression", compression).partitionBy("_file").text(path)
    return path


def replicate_docs(docs: DataFrame, factor: int) -> DataFrame:
    """``factor`` copies of every document with distinct ids (id * factor +
    copy), for throughput runs at a multiple of the data. A per-row
    generator: narrow, no join, output grows linearly."""
    if factor <= 1:
        return docs
    cols = [c for c in docs.columns if c != "id"]
    copies = docs.select("*", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("_copy"))
    return copies.select((F.col("id") * factor + F.col("_copy")).alias("id"), *cols)


def land_nation_documents(spark: SparkSession, sf_dir: str, path: str) -> str:
    """One multi-line JSON file per nation that holds a single country document:
    its states are the nation's customers, their cities the customers' orders.
    The text is written line by line in order, so no document is ever a row;
    fields follow the arrays as well as lead them."""
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"), "n_name")

    def opened(fields: Column, array: str) -> Column:
        text = F.to_json(fields)
        return F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(f', "{array}": ['))

    def closed(fields: Column) -> Column:
        return F.concat(F.lit("], "), F.substring(F.to_json(fields), 2, 1 << 30))

    most = F.lit((1 << 63) - 1)
    c = customers.select(F.col("c_nationkey").alias("n"), F.col("c_custkey").alias("c"), "c_name", "c_mktsegment", "c_acctbal").where("n is not null")
    state = F.struct(F.col("c").alias("id"), F.col("c_name").alias("name"))
    place = F.struct(F.col("c_mktsegment").alias("state_code"), _money_text(F.col("c_acctbal")).alias("latitude"))
    city = F.struct(
        F.col("o_orderkey").alias("id"), F.concat(F.col("o_orderstatus"), F.lit(" {}[]\"")).alias("name"), _money_text(F.col("o_totalprice")).alias("latitude")
    )
    lines = [
        nations.select("n", F.lit(-1).cast("bigint").alias("c"), F.lit(-1).cast("bigint").alias("o"), F.lit(0).alias("kind"),
                       F.concat(F.lit("["), opened(F.struct(F.col("n").alias("id"), F.col("n_name").alias("name")), "states")).alias("line")),
        nations.select("n", most, most, F.lit(4), F.concat(closed(F.struct(F.concat(F.lit("N"), F.col("n")).alias("iso3"))), F.lit("]"))),
        c.select("n", "c", F.lit(-1).cast("bigint"), F.lit(1), opened(state, "cities")),
        c.select("n", "c", most, F.lit(3), closed(place)),
        orders.join(c, orders["o_custkey"] == c["c"]).select("n", "c", "o_orderkey", F.lit(2), F.to_json(city)),
    ]
    whole = lines[0]
    for part in lines[1:]:
        whole = whole.union(part)
    known = whole.join(nations.select("n"), "n", "left_semi")
    before = F.lag("kind").over(Window.partitionBy("n").orderBy("c", "o", "kind"))
    comma = F.when(F.col("kind").isin(1, 2) & before.isin(2, 3), F.lit(",")).otherwise(F.lit(""))
    known.select("n", F.concat(comma, "line").alias("value")).write.mode("overwrite").partitionBy("n").text(path)
    return path
