"""Landed API page payloads as a table: rows, refused pages, completeness.

Input is `(source, page_no, payload)`, one row per page with the payload as text. Three
envelopes occur: `{"response": {"header", "body"}}`, `{"header", "body"}` and a bare body.
`items` of the body is a list of rows or an object that holds the list as `item`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankmill.functions.scalars import parse_json_text
from rankmill.operators.dedup import first_per_key
from rankmill.session import fresh_dir
from rankmill.sources.lake import Lake, write_snapshot_lines

# Result codes that mean success.
OK_CODES = ("00", "0")
UNREADABLE = "unreadable"


class PageError(RuntimeError):
    """The API refused a page, or answered with something that is not JSON."""


def parse_pages(pages: DataFrame) -> DataFrame:
    """`(source, page_no, code, message, total, rows)`, `rows` being an array of row texts."""
    top = F.from_json(
        "payload",
        "response string, header string, body string, items string, totalCount string, bad string",
        {"columnNameOfCorruptRecord": "bad"},
    )
    keys = F.coalesce(F.json_object_keys("payload"), F.array().cast("array<string>"))
    opened = _one_copy(pages).select("source", "page_no", "payload", top.alias("top"), keys.alias("keys"))
    # an envelope is told by its key; one that is there and null holds nothing readable
    legacy = F.array_contains("keys", "response")
    headed = F.array_contains("keys", "header")
    hollow = (legacy & F.col("top.response").isNull()) | (~legacy & headed & F.col("top.header").isNull())
    inner = parse_json_text(F.col("top.response"), ("header", "body"))
    opened = opened.withColumn("inner", inner).select(
        "source",
        "page_no",
        F.when(legacy, F.col("inner.header")).when(headed, F.col("top.header")).alias("header"),
        F.when(legacy, F.col("inner.body")).when(headed, F.col("top.body")).alias("body"),
        (~legacy & ~headed).alias("bare"),
        (F.col("top.bad").isNotNull() | F.col("payload").isNull() | F.col("top").isNull() | hollow).alias("bad"),
        F.col("top.items").alias("bare_items"),
        F.col("top.totalCount").alias("bare_total"),
    )
    parsed = opened.select(
        "source",
        "page_no",
        "bad",
        parse_json_text(F.col("header"), ("resultCode", "resultMsg")).alias("head"),
        parse_json_text(F.col("body"), ("items", "totalCount")).alias("content"),
        "bare",
        "bare_items",
        "bare_total",
    )
    items = F.when(F.col("bare"), F.col("bare_items")).otherwise(F.col("content.items"))
    total = F.when(F.col("bare"), F.col("bare_total")).otherwise(F.col("content.totalCount"))
    code = F.when(F.col("bad"), F.lit(UNREADABLE)).otherwise(
        F.coalesce(F.col("head.resultCode"), F.lit("00"))
    )
    return parsed.select(
        "source",
        "page_no",
        code.alias("code"),
        F.col("head.resultMsg").alias("message"),
        F.coalesce(total.try_cast("bigint"), F.lit(0)).alias("total"),
        _row_texts(items).alias("rows"),
    )


def _one_copy(pages: DataFrame) -> DataFrame:
    """A page that landed more than once counts once: of its payloads the first in text order.

    Pages without a number are told apart by their payload.
    """
    page = F.coalesce(F.col("page_no").cast("string"), F.concat(F.lit("?"), F.col("payload")))
    numbered = pages.select("source", "page_no", "payload", page.alias("page"))
    return first_per_key(numbered, ["source", "page"], [F.col("payload").asc_nulls_last()]).drop("page")


def _row_texts(items: Column) -> Column:
    """Array of row texts: `[..]`, `{"item": [..]}`, `{"item": {..}}`, otherwise empty."""
    def starts(text: Column, mark: str) -> Column:
        return F.substring(F.ltrim(text), 1, 1) == mark

    def as_list(text: Column) -> Column:
        return F.from_json(text, T.ArrayType(T.StringType()))

    wrapped = F.when(starts(items, "{"), parse_json_text(items, ("item",))["item"])
    return F.coalesce(
        F.when(starts(items, "["), as_list(items))
        .when(starts(wrapped, "["), as_list(wrapped))
        .when(starts(wrapped, "{"), F.array(wrapped)),
        F.array().cast("array<string>"),
    )


def unwrap_pages(pages: DataFrame) -> DataFrame:
    """One line per API row: `(source, page_no, row_text)`. Refused pages give no rows."""
    parsed = parse_pages(pages).where(F.col("code").isin(*OK_CODES))
    return parsed.select("source", "page_no", F.explode("rows").alias("row_text"))


def typed_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Row texts as columns of the given schema."""
    return rows.select(F.from_json("row_text", schema).alias("r")).select("r.*")


def page_errors(pages: DataFrame) -> DataFrame:
    """Pages whose result code is not a success. A missing code counts as success."""
    return (
        parse_pages(pages)
        .where(~F.col("code").isin(*OK_CODES))
        .select("source", "page_no", "code", "message")
    )


def page_completeness(pages: DataFrame) -> DataFrame:
    """Per source: rows collected against the announced total; a refused page is a missing one."""
    good = F.col("code").isin(*OK_CODES)
    return (
        parse_pages(pages)
        .groupBy("source")
        .agg(
            F.count_if(good).alias("pages"),
            F.coalesce(F.sum(F.when(good, F.size("rows"))), F.lit(0)).cast("bigint").alias("collected"),
            F.coalesce(F.max(F.when(good, F.col("total"))), F.lit(0)).alias("announced"),
            F.bool_and(good).alias("readable"),
        )
        .withColumn("complete", F.col("readable") & (F.col("collected") >= F.col("announced")))
        .drop("readable")
    )


def missing_pages(pages: DataFrame, first_page: int | None = None) -> DataFrame:
    """One row per run of missing pages: `(source, kind, first_page, last_page, pages)`.

    `refused` pages came with an error code; `absent` ones did not come at all, between the pages that did
    or after them, as far as the announced total asks for pages of the largest size seen. Numbering starts
    at `first_page`, by default at the smallest number of the source. Pages without a number are left
    out. The page numbers of a source, not its payloads, are sorted together.
    """
    good = F.col("code").isin(*OK_CODES)
    seen = parse_pages(pages.where("page_no is not null")).select(
        "source", F.col("page_no").cast("bigint").alias("page"), good.alias("good"), "total", F.size("rows").alias("size")
    )
    starts = F.min("page") if first_page is None else F.lit(first_page).cast("bigint")
    feeds = seen.groupBy("source").agg(
        starts.alias("start"), F.max("page").alias("end"), F.max(F.when(F.col("good"), F.col("total"))).alias("total"), F.max("size").alias("size")
    )
    due = F.when(F.col("size") > 0, F.col("start") + F.ceil(F.col("total") / F.col("size")) - 1)
    feeds = feeds.select("source", "start", "end", F.greatest("end", F.coalesce(due, "end")).alias("due"))

    by_page = Window.partitionBy("source").orderBy("page")
    numbered = seen.select("source", "page", "good", F.lag("page").over(by_page).alias("before"))
    inner = numbered.join(feeds, "source").select(
        "source", (F.coalesce("before", F.col("start") - 1) + 1).alias("first_page"), (F.col("page") - 1).alias("last_page")
    )
    after = feeds.select("source", (F.col("end") + 1).alias("first_page"), F.col("due").alias("last_page"))
    absent = inner.unionByName(after).where("first_page <= last_page").select("source", F.lit("absent").alias("kind"), "first_page", "last_page")

    # neighbours keep their distance to their place in the order
    refused = seen.where("not good").withColumn("island", F.col("page") - F.row_number().over(by_page))
    refused = refused.groupBy("source", "island").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"))
    refused = refused.select("source", F.lit("refused").alias("kind"), "first_page", "last_page")
    return absent.unionByName(refused).withColumn("pages", F.col("last_page") - F.col("first_page") + 1)


def land_pages(lake: Lake, pages: DataFrame, source: str, day: dt.date | str, partial: bool = False) -> int:
    """Turn the pages of one source into its dated snapshot: every row as it is, with all its fields.

    Refused pages stop it, and so do fewer rows than announced unless `partial` allows them.
    The pages are parsed once, into the shared folder.
    """
    spark = pages.sparkSession
    path = fresh_dir(spark, "parsed-pages")
    parsed = parse_pages(pages.where(F.col("source") == source))
    parsed.write.parquet(path)
    parsed = spark.read.schema(parsed.schema).parquet(path)
    refused = parsed.where(~F.col("code").isin(*OK_CODES)).orderBy("page_no").head(1)
    if refused:
        page = refused[0]
        raise PageError(f"[{source}] page {page.page_no}: code {page.code} {page.message or ''}".strip())
    got = parsed.agg(F.coalesce(F.sum(F.size("rows")), F.lit(0)).alias("rows"), F.max("total").alias("total")).head()
    if got["rows"] < (got["total"] or 0) and not partial:
        raise PageError(f"[{source}] {got['rows']} of {got['total']} announced rows")
    return write_snapshot_lines(lake, parsed.select(F.explode("rows").alias("value")), source, day)
