"""News response handling (FI2, FN10-FN12, GE5, TR10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geonest import schemas as S
from geonest.functions.scalars import iso_utc

# Response classes; every response is in exactly one.
CORRUPT_LINE, EMPTY, MALFORMED, NO_ARTICLES, OK = "corrupt_line", "empty", "malformed", "no_articles", "ok"
#: Column that holds a landed line which is not an envelope.
CORRUPT = "corrupt_line"


def parse_responses(df: DataFrame, body: str = "body") -> DataFrame:
    """FN10: parse each response body once into the variant ``payload``, null
    if the body is no JSON. Types are given to fields only afterwards, so a
    field of another type than expected does not make a body invalid."""
    return df.withColumn("payload", F.try_parse_json(F.col(body)))


def response_class(body: Column, payload: Column, corrupt: Column | None = None) -> Column:
    """FI2 + FN12: corrupt_line / empty / malformed / no_articles / ok.

    Empty means no content at all (null or zero length); a body of only
    whitespace is content that does not decode as JSON, so it is
    malformed, as in the original guard. A body that is valid JSON without
    an array ``articles`` (another object, a list, a value) has no
    articles."""
    classes = (
        F.when(body.isNull() | (F.length(body) == 0), F.lit(EMPTY))
        .when(payload.isNull(), F.lit(MALFORMED))
        .when(_articles(payload).isNull(), F.lit(NO_ARTICLES))
        .otherwise(F.lit(OK))
    )
    return classes if corrupt is None else F.when(corrupt.isNotNull(), F.lit(CORRUPT_LINE)).otherwise(classes)


def _articles(payload: Column) -> Column:
    return F.try_variant_get(payload, "$.articles", "array<variant>")


def classify_responses(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``status`` and ``response_class`` to parsed responses."""
    corrupt = F.col(CORRUPT) if CORRUPT in df.columns else None
    return df.withColumn("response_class", response_class(F.col(body), F.col("payload"), corrupt)).withColumn(
        "status", F.try_variant_get(F.col("payload"), "$.status", "string")
    )


def article_fields(article: Column, schema: T.StructType) -> list[Column]:
    """The declared fields of an article (null where its value has another
    type) and ``extra``: the JSON text of every other field, and of declared
    fields that did not fit, by name."""
    typed = {f.name: F.try_variant_get(article, f"$['{f.name}']", f.dataType.simpleString()) for f in schema.fields}
    held = F.try_variant_get(article, "$", "map<string,variant>")

    def left_over(name: Column, value: Column) -> Column:
        lost = F.lit(False)
        for k, c in typed.items():
            lost = lost | ((name == k) & c.isNull() & ~F.is_variant_null(value))
        return ~name.isin(*typed) | lost

    extra = F.transform_values(F.map_filter(held, left_over), lambda _, v: F.to_json(v))
    return [*(c.alias(k) for k, c in typed.items()), extra.alias("extra")]


def explode_articles(df: DataFrame, keep: list[str] = ("country", "topic", "page"), schema: T.StructType = S.ARTICLE) -> DataFrame:
    """GE5: one row per article of ``ok`` responses, article fields as
    top-level columns next to ``keep``.

    Every non-ok response has no array ``articles``, which an inner explode
    drops. ``posexplode_outer`` with a filter on the position is that inner
    explode (null elements of a non-empty array included) without the
    ``size(...) > 0`` filter which the optimizer infers for a plain
    ``explode`` and which would make the parse run twice per body."""
    exploded = df.select(*keep, F.posexplode_outer(_articles(F.col("payload"))).alias("_pos", "_article"))
    return exploded.filter(F.col("_pos").isNotNull()).select(*keep, *article_fields(F.col("_article"), schema))


def articles_from_responses(
    responses: DataFrame, call_ts: Column | None = None, keep=("country", "topic", "page"), article: T.StructType = S.ARTICLE
) -> tuple[DataFrame, DataFrame]:
    """Parse, classify, stamp and explode landed responses.

    Returns ``(articles, rejects)``: articles of ``ok`` responses, each with
    its ``call_timestamp`` (TR10, FN11: ISO-8601 UTC text), and one row per
    non-ok response with its class (nothing is silently dropped).
    """
    call_ts = F.col("requested_at") if call_ts is None else call_ts
    parsed = parse_responses(responses)
    stamped = parsed.withColumn("call_timestamp", iso_utc(call_ts))
    articles = explode_articles(stamped, [*keep, "call_timestamp"], article)
    order = [*keep, *article.names, "extra", "call_timestamp"]
    parsed = classify_responses(parsed)
    line = [F.col(CORRUPT)] if CORRUPT in parsed.columns else []
    rejects = parsed.filter(F.col("response_class") != OK).select(*keep, "status", "response_class", *line)
    return articles.select(*order), rejects
