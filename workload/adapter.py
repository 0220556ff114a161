"""Raw-layer tables derived from the driver's star-schema tables, whole table by whole table.

The attribute choices below (which row gets which category, copy, defect) only shape the
data; every input row contributes. `oracles.py` states the same choices in plain SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankmill.operators.snapshot import latest_snapshot
from rankmill.session import use_utc
from rankmill.sources.schemas import SOURCES

# The two snapshot dates of the derived tables.
OLD_DAY, NEW_DAY = "2026-07-06", "2026-07-07"

PAGE_ROWS = 10


_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """The derived raw tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = use_utc(spark)
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        """A driver table. Its schema is taken from the file footers once per path."""
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # -- snapshots: an older partial one and a newer full one

    def ingredient(self) -> DataFrame:
        """Two ingredient rows per part, one per word of its name; names repeat within a lot."""
        return self.read("part").selectExpr(
            "explode(split(p_name, ' ')) as word",
            "*",
        ).selectExpr(
            "concat(word, '_', cast(p_partkey div 20 as string)) as INGR_KOR_NAME",
            "case when p_size % 5 > 0 then concat(word, ' ', cast(p_size as string)) end as INGR_ENG_NAME",
            "p_brand as INGR_SYNONYM",
            "lpad(cast(p_partkey as string), 8, '0') as CAS_NO",
            "p_type as ORIGIN_MAJOR_KOR_NAME",
            _DAYS.format("p_size <= 25"),
        )

    def regulation(self) -> DataFrame:
        """One rule per part, on the second word of its name."""
        return self.read("part").selectExpr(
            "concat(split(p_name, ' ')[1], '_', cast(p_partkey div 20 as string)) as INGR_STD_NAME",
            "upper(split(p_name, ' ')[1]) as INGR_ENG_NAME",
            "case p_size when 13 then 'EU' when 14 then '' end as PROH_NATIONAL",
            "case when p_size in (7, 21, 35) then 'KR' when p_size = 13 then 'JP' end as LIMIT_NATIONAL",
            _DAYS.format("p_size <= 25"),
        )

    def manufacturer(self) -> DataFrame:
        """One company per supplier; those with a low balance appear twice."""
        return (
            self.read("supplier")
            .selectExpr("explode(sequence(1, case when s_acctbal < 500 then 2 else 1 end)) as copy", "*")
            .selectExpr(
                "cast(s_suppkey as string) as ENTP_SEQ",
                "s_name as ENTP_NAME",
                "concat('owner ', cast(s_nationkey as string)) as BOSS_NAME",
                "'manufacturing' as INDUTY",
                "concat('nation ', cast(s_nationkey as string)) as FACTORY_ADDR",
                "cast(s_suppkey * 1000003 as string) as BIZRNO",
                "case s_nationkey when 3 then '20260230' when 4 then null else "
                "concat('2020', lpad(cast(1 + s_nationkey % 12 as string), 2, '0'), "
                "lpad(cast(1 + s_suppkey % 28 as string), 2, '0')) end as ENTP_PERMIT_DATE",
                _DAYS.format("s_acctbal < 5000"),
            )
        )

    def products(self) -> DataFrame:
        """One product per part, with general and lot-specific ingredients."""
        return self.read("part").selectExpr(
            "concat('p_', lpad(cast(p_partkey as string), 7, '0')) as product_id",
            "p_name as product_name",
            "p_type as category",
            "case p_size % 6 when 0 then 'dry' when 1 then 'oily' when 2 then 'combination' "
            "when 3 then 'sensitive' when 4 then 'normal' else 'all' end as target_skin_type",
            "cast(round(p_retailprice * 10) as bigint) as price_krw",
            "case p_size when 49 then array() when 50 then null else concat(split(p_name, ' '), "
            "transform(split(p_name, ' '), w -> concat(w, '_', cast(p_partkey div 20 as string)))) "
            "end as key_ingredients",
            _DAYS.format("p_size <= 25"),
        )

    # -- events

    def sent_events(self, dirty: bool = True) -> DataFrame:
        """Published events in payload form, one row per event that carries an id."""
        return self._events(dirty).where("event_type is not null").select("event_id", "event_ts")

    def raw_events(self, dirty: bool = True, lossy: bool = False) -> DataFrame:
        """Messages as they land: JSON text, unreadable payloads, repeated deliveries.

        `dirty` adds unknown types, segments and time stamps; `lossy` loses the messages
        of one product key.
        """
        events = self._events(dirty)
        if lossy:
            events = events.where("k <> 17")
        return events.selectExpr(
            "explode(sequence(0, case when event_no % 10 = 0 then 2 else 0 end)) as copy", "*"
        ).selectExpr(
            "'events-sub' as subscription_name",
            "concat(event_id, '-', cast(copy as string)) as message_id",
            "event_ts + make_dt_interval(0, 0, 0, 2 + event_no % 7 + 60 * ((copy + event_no) % 3)) "
            "as publish_time",
            "data",
            "'{}' as attributes",
        )

    def _events(self, dirty: bool) -> DataFrame:
        segments = self.read("customer").selectExpr(
            "c_custkey",
            "case c_mktsegment when 'HOUSEHOLD' then 'dry' when 'MACHINERY' then 'oily' "
            "when 'FURNITURE' then 'combination' when 'BUILDING' then 'sensitive' "
            "when 'AUTOMOBILE' then 'normal' end as segment",
        )
        keyed = (
            _spread(self.read("events"))
            .selectExpr(
                "event_id as event_no",
                "cast(ts as timestamp) as event_ts",
                "user_id",
                "event_type as kind",
                "cast(get_json_object(props, '$.k') as int) as k",
            )
            .join(segments, F.col("user_id") == F.col("c_custkey"), "left")
        )
        segment = "case k when 91 then null when 92 then 'robot' else segment end" if dirty else "segment"
        odd_type = "when k = 93 then 'share'" if dirty else ""
        event_ts = "concat(replace(cast(event_ts as string), ' ', 'T'), '+00:00')"
        if dirty:
            event_ts = f"case when k = 94 then 'yesterday' else {event_ts} end"
        typed = keyed.selectExpr(
            "event_no",
            "concat('e_', lpad(cast(event_no as string), 9, '0')) as event_id",
            "event_ts",
            "k",
            f"case when kind = 'signup' then null {odd_type} when kind = 'click' then 'like' "
            "when kind = 'error' then 'rating' else kind end as event_type",
            f"{event_ts} as ts_text",
            "concat('u_', lpad(cast(user_id as string), 5, '0')) as user",
            f"{segment} as segment",
            "concat('p_', lpad(cast(case when k < 30 then k when k < 95 then user_id * 13 + k % 40 "
            "else 9000000 + k end as string), 7, '0')) as product_id",
            "concat('s_', cast(user_id as string), '_', cast(event_no % 4 as string)) as session",
            "case when kind <> 'error' then 'null' when k % 6 = 5 then '\"x\"' "
            "else cast(1 + event_no % 5 as string) end as rating",
        )
        # none of the values needs JSON escapes
        payload = """
            case when event_type is null and k % 2 = 0 then concat('{"user_id":"', user, '"}')
              when event_type is null then concat('signup ', user)
              else concat('{"event_id":"', event_id, '","event_type":"', event_type,
                '","event_ts":"', ts_text, '","user_id":"', user,
                '","skin_type":', coalesce(concat('"', segment, '"'), 'null'),
                ',"product_id":"', product_id, '","session_id":"', session,
                '","rating":', rating, '}') end as data"""
        return typed.selectExpr("event_no", "event_id", "event_ts", "event_type", "k", payload)

    # -- API pages

    def company_pages(self) -> DataFrame:
        """Suppliers as pages of five of one complete feed, each row with a field no table knows."""
        rows = self.read("supplier").selectExpr(
            "cast(s_suppkey div 5 as int) as page_no",
            "to_json(struct(cast(s_suppkey as string) as ENTP_SEQ, s_name as ENTP_NAME, "
            "cast(s_nationkey as string) as HOME)) as row_text",
        )
        total = rows.agg(F.count(F.lit(1)).alias("total"))
        # a page holds five rows at most
        pages = rows.groupBy("page_no").agg(F.array_join(F.collect_list("row_text"), ",").alias("items"))
        head = '{"response":{"header":{"resultCode":"00"},"body":{"totalCount":%d,"items":[%s]}}}'
        return pages.join(F.broadcast(total)).select(
            F.lit("manufacturer").alias("source"), "page_no", F.format_string(head, "total", "items").alias("payload")
        )

    def snapshot_pages(self, page_rows: int = 100) -> DataFrame:
        """The newer snapshot of each master list as the pages of one feed, about `page_rows` rows each."""
        parts = []
        for source in SOURCES:
            rows = latest_snapshot(getattr(self, source)(), NEW_DAY).drop("dt")
            text = rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row_text"))
            total = text.agg(F.count(F.lit(1)).alias("total"))
            # repeated rows share a page, as they share their text
            paged = text.join(F.broadcast(total)).withColumn(
                "page_no", F.expr(f"cast(crc32(row_text) % (1 + total div {page_rows}) as int)")
            )
            one = paged.groupBy("page_no", "total").agg(F.array_join(F.collect_list("row_text"), ",").alias("items"))
            head = '{"header":{"resultCode":"00"},"body":{"totalCount":%d,"items":[%s]}}'
            parts.append(one.select(F.lit(source).alias("source"), "page_no", F.format_string(head, "total", "items").alias("payload")))
        return reduce(DataFrame.unionAll, parts)

    def api_pages(self) -> DataFrame:
        """Customers as pages of ten in four feeds: three envelopes, refusals, a short feed."""
        rows = self.read("customer").selectExpr(
            "c_custkey div 10 as page_no",
            "concat('feed_', cast(c_custkey div 10 % 4 as string)) as source",
            "c_custkey",
            "to_json(struct(c_custkey, c_name)) as row_text",
        )
        totals = rows.groupBy("source").agg(F.count(F.lit(1)).alias("total"))
        pages = (
            rows.groupBy("source", "page_no")
            # a page holds ten rows at most
            .agg(F.array_join(F.array_sort(F.collect_list("row_text")), ",").alias("items"))
            .join(totals, "source")
        )
        ok = '{"resultCode":"00","resultMsg":"ok"}'
        payload = F.when(
            F.col("page_no") % 8 == 7,
            F.lit('{"header":{"resultCode":"30","resultMsg":"key not registered"}}'),
        )
        templates = {
            "feed_0": f'{{"header":{ok},"body":{{"totalCount":%d,"items":[%s]}}}}',
            "feed_1": f'{{"response":{{"header":{ok},"body":{{"totalCount":%d,"items":{{"item":[%s]}}}}}}}}',
            "feed_2": '{"totalCount":%d,"items":[%s]}',
            "feed_3": f'{{"response":{{"header":{ok},"body":{{"totalCount":%d,"items":[%s]}}}}}}',
        }
        for feed, template in templates.items():
            total = F.col("total") + (7 if feed == "feed_2" else 0)
            payload = payload.when(F.col("source") == feed, F.format_string(template, total, F.col("items")))
        return pages.select("source", F.col("page_no").cast("int").alias("page_no"), payload.alias("payload"))


def _spread(df: DataFrame) -> DataFrame:
    """Give every core a share of the input, however it lies.

    A row group is read by one task, and splits count bytes: a file of one row group has many
    splits, of which all but one are empty.
    """
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, 64)
    return df.repartition(max(wanted, df.rdd.getNumPartitions()))


# Every row is in the newer snapshot; rows that meet the condition also in the older one.
_DAYS = (
    "explode(case when {} then array(date'" + OLD_DAY + "', date'" + NEW_DAY + "') "
    "else array(date'" + NEW_DAY + "') end) as dt"
)
