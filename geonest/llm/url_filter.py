"""URL filters (5): a blocked Bloom filter in front of an exact hash join.

The listed (host, path) prefixes are hashed into a blocked Bloom filter: a
key sets one bit in each of the eight 32-bit words of one block. For every
distinct (host, path) of the pages, the prefixes that could be listed are
tested against their block; possible hits go to an exact hash join with the
list, which removes the false positives. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geonest.llm.common import LOWER, UPPER, pick

WORDS = 8
#: Filter bits per listed key: about one false positive in a thousand tests.
BITS_PER_KEY = 16


def url_host(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def _block(host: str, path: str, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(host, path), F.lit(n_blocks)).alias("block")


def _bits(host: str, path: str) -> list[Column]:
    h = F.xxhash64(F.lit(1), host, path)
    return [F.shiftright(h, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(WORDS)]


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def bloom_blocks(keys: DataFrame, n_keys: int) -> tuple[DataFrame, int]:
    """The filter of ``keys`` (``rule_host``, ``rule_path``): one row per used
    block with its words ``w0`` to ``w7``, and the number of blocks."""
    n_blocks = max(1, -(-n_keys * BITS_PER_KEY // (32 * WORDS)))
    words = [F.bit_or(_mask(b)).alias(f"w{i}") for i, b in enumerate(_bits("rule_host", "rule_path"))]
    return keys.groupBy(_block("rule_host", "rule_path", n_blocks)).agg(*words), n_blocks


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` for every row of
    ``pages`` (``page_id``, ``url``).

    ``rules`` lists ``host``, ``path``, ``verdict`` (``allow`` or ``block``). A
    rule fits its host and all subdomains if the url's path starts with the
    rule's. The longest fitting rule decides (ties: the longer host, then
    the smaller text); without one the verdict is ``default`` and ``rule`` is
    null.

    Defined cases: a null url, or one without ``://``, has empty host and
    path and fits no rule; of rules listed twice, block wins; rules without
    a host are ignored, a null path is empty; every row of ``pages`` is
    returned, repeated or without id; other columns are ignored.

    The candidates of a url are the host suffixes and path prefixes that
    have as many labels, or characters, as some rule; both sets of lengths
    are bounded by the longest rule. Pages are judged once per distinct
    (host, path), so a host with a third of all pages is looked up once per
    path; the filter and the list join by hash, and Spark broadcasts either
    only if it is small and else splits skewed keys.
    """
    listed = (
        rules.select(
            F.translate(rules["host"].cast("string"), UPPER, LOWER).alias("rule_host"),
            F.coalesce(rules["path"].cast("string"), F.lit("")).alias("rule_path"),
            rules["verdict"].cast("string").alias("verdict"),
        )
        .where("rule_host is not null and rule_host <> ''")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("verdict"))
    )
    shape = listed.agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_set(F.size(F.split("rule_host", r"\.")))).alias("labels"),
        F.array_sort(F.collect_set(F.length("rule_path"))).alias("lengths"),
    ).first()
    p = pick(pages, page_id="page_id:bigint", url="url:string")
    p = p.select("page_id", F.coalesce(url_host(F.col("url")), F.lit("")).alias("host"), F.coalesce(url_path(F.col("url")), F.lit("")).alias("path"))
    if not shape["n"]:
        return p.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    blocks, n_blocks = bloom_blocks(listed, shape["n"])
    parts = F.split("host", r"\.")
    counts = F.filter(F.lit(shape["labels"]), lambda k: k <= F.size(parts))
    hosts = F.transform(counts, lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."))
    lengths = F.filter(F.lit(shape["lengths"]), lambda k: k <= F.length("path"))
    candidates = (
        p.where("host <> ''")
        .select("host", "path")
        .distinct()
        .select("host", "path", F.explode(hosts).alias("rule_host"))
        .select("*", F.explode(lengths).alias("k"))
        .select("host", "path", "rule_host", F.substring(F.col("path"), F.lit(1), F.col("k")).alias("rule_path"))
        .withColumn("block", _block("rule_host", "rule_path", n_blocks))
    )
    hit = F.lit(True)
    for i, b in enumerate(_bits("rule_host", "rule_path")):
        hit = hit & (F.col(f"w{i}").bitwiseAND(_mask(b)) != 0)
    possible = candidates.join(blocks, "block").where(hit).select("host", "path", "rule_host", "rule_path")
    exact = possible.join(listed, ["rule_host", "rule_path"])
    best = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"),
    )
    decided = (
        exact.withColumn("rule", F.concat("rule_host", "rule_path"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), best).alias("d"))
        .select("host", "path", "d.rule", "d.verdict")
    )
    return p.join(decided, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
