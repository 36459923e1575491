"""The star schema as views over the driver's tables; ``CTES`` are the same views in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START = "2024-01-01 00:00:00"


def author_id(source: Column) -> Column:
    """The number in a source's name; null if there is none."""
    return F.regexp_extract(source, r"([0-9]+)", 1).try_cast("long")


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def content(self) -> DataFrame:
        d = self.table("documents")
        collected = F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("doc_id"))
        return d.select(
            F.col("doc_id").alias("content_id"), F.element_at(F.array(*map(F.lit, ("answer", "article", "thought", "comment"))), (F.col("doc_id") % 4 + 1).cast("int")).alias("content_type"),
            F.col("doc_id").cast("string").alias("platform_id"), F.concat(F.lit("https://example.org/c/"), F.col("doc_id")).alias("url"), author_id(F.col("source")).alias("author_id"), F.when((F.col("doc_id") % 4).isin(0, 3), F.col("doc_id") % 50).alias("question_id"), F.when(F.col("doc_id") % 4 == 1, F.substring("text", 1, 40)).alias("title"),
            F.when(F.length("text") <= 500, F.col("text")).alias("content_text"), (F.col("n_chars") % 1000).alias("voteup_count"), (F.col("doc_id") % 97).alias("comment_count"), collected.alias("collected_at"),
            F.when(F.col("doc_id") % 10 != 0, collected - F.make_dt_interval(hours=F.col("doc_id") % 500)).alias("published_at"),
        )

    @property
    def analysis(self) -> DataFrame:
        risk = F.when(F.col("toxic") == 1, "高风险").when(F.col("quality") == 0, "中风险").otherwise("低风险")
        stance = F.when(F.col("toxic") == 1, "抹黑").when(F.col("quality") == 1, "有利").otherwise("中立")
        i = F.col("doc_id")
        return self.table("labels").select(
            i.alias("content_id"), risk.alias("risk_level"), stance.alias("platform_stance"), F.when(i % 3 != 0, F.concat(F.lit("summary of "), i)).alias("ai_summary"), (i % 100 / F.lit(100.0)).alias("stance_confidence"),
            F.when(F.col("toxic") == 1, "abuse").alias("risk_reasoning"), F.when(i % 9 == 0, "human").otherwise("ai").alias("analyzed_by"),
        )

    @property
    def authors(self) -> DataFrame:
        """An author for each source but every seventh."""
        own = self.table("documents").where("source is not null").select("source").distinct().withColumn("author_id", author_id(F.col("source")))
        known = own.groupBy("author_id").agg(F.min("source").alias("nickname")).where("author_id % 7 <> 6")
        return known.select("author_id", F.concat(F.lit("u"), F.col("author_id")).alias("platform_user_id"), "nickname", (F.col("author_id") % 5 == 0).alias("is_watched"))

    @property
    def events(self) -> DataFrame:
        return self.table("benchmark").select(F.col("item_id").alias("event_id"), F.concat(F.lit("event-"), F.col("item_id")).alias("name"), (1 + F.col("item_id") % 3).alias("version"))

    @property
    def bridge(self) -> DataFrame:
        """A document is on the event of its own number and on the fifth after it, both counted around all events."""
        n = self.events.agg(F.count("*").alias("n"))  # one row
        d = self.table("documents").crossJoin(F.broadcast(n)).where("n > 0").select("doc_id", F.explode(F.array(F.col("doc_id") % F.col("n"), (F.col("doc_id") + 5) % F.col("n"))).alias("event_id"))
        which = F.element_at(F.array(*map(F.lit, ("正向", "反向", "中立"))), ((F.col("doc_id") + F.col("event_id")) % 3 + 1).cast("int"))
        return d.select(F.col("doc_id").alias("content_id"), "event_id", F.when(F.col("doc_id") % 11 != 0, which).alias("stance"), (1 + F.col("doc_id") % 3).alias("event_version"))

    @property
    def questions(self) -> DataFrame:
        """The questions of the contents."""
        k = F.col("question_id")
        first = F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(hours=k)
        return self.content.where(k.isNotNull()).select(k).distinct().select(k, F.when(k % 7 != 0, k % 3 != 0).alias("is_relevant"), (k % 2 == 0).alias("follow_up_done"), first.alias("first_seen_at"))

    @property
    def evidence(self) -> DataFrame:
        return self.table("labels").where("toxic = 1").select(F.col("doc_id").alias("evidence_id"), (F.col("doc_id") % 5).alias("content_id"), (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("doc_id") % 60)).alias("filed_at"))

    @property
    def log(self) -> DataFrame:
        return self.table("events")


CTES = """with recursive v_content as (
  select doc_id as content_id, case doc_id % 4 when 0 then 'answer' when 1 then 'article' when 2 then 'thought' else 'comment' end as content_type, cast(doc_id as varchar) as platform_id, 'https://example.org/c/' || doc_id as url,
    try_cast(regexp_extract(source, '([0-9]+)', 1) as bigint) as author_id,
    case when doc_id % 4 in (0, 3) then doc_id % 50 end as question_id, case when doc_id % 4 = 1 then substr(text, 1, 40) end as title,
    case when length(text) <= 500 then text end as content_text, n_chars % 1000 as voteup_count, doc_id % 97 as comment_count,
    timestamp '2024-01-01' + interval 1 minute * doc_id as collected_at,
    case when doc_id % 10 <> 0 then timestamp '2024-01-01' + interval 1 minute * doc_id - interval 1 hour * (doc_id % 500) end as published_at
  from documents),
v_analysis as (
  select doc_id as content_id, case when toxic = 1 then '高风险' when quality = 0 then '中风险' else '低风险' end as risk_level,
    case when toxic = 1 then '抹黑' when quality = 1 then '有利' else '中立' end as platform_stance,
    case when doc_id % 3 <> 0 then 'summary of ' || doc_id end as ai_summary, (doc_id % 100) / 100.0::double as stance_confidence, case when toxic = 1 then 'abuse' end as risk_reasoning,
    case when doc_id % 9 = 0 then 'human' else 'ai' end as analyzed_by from labels),
v_author as (
  select author_id, 'u' || author_id as platform_user_id, min(source) as nickname, author_id % 5 = 0 as is_watched
  from (select distinct source, try_cast(regexp_extract(source, '([0-9]+)', 1) as bigint) as author_id from documents where source is not null) where author_id % 7 <> 6 group by author_id),
v_event as (select item_id as event_id, 'event-' || cast(item_id as varchar) as name, 1 + item_id % 3 as version from benchmark),
v_bridge as (
  select doc_id as content_id, event_id, case when doc_id % 11 <> 0 then case (doc_id + event_id) % 3 when 0 then '正向' when 1 then '反向' else '中立' end end as stance, 1 + doc_id % 3 as event_version
  from (select doc_id, unnest([doc_id % n, (doc_id + 5) % n]) as event_id from documents, (select count(*) as n from benchmark))),
v_question as (
  select i as question_id, case when i % 7 <> 0 then i % 3 <> 0 end as is_relevant, i % 2 = 0 as follow_up_done, timestamp '2024-01-01' + interval 1 hour * i as first_seen_at from (select distinct question_id as i from v_content where question_id is not null)),
v_evidence as (select doc_id as evidence_id, doc_id % 5 as content_id, timestamp '2024-01-01' + interval 1 minute * (doc_id % 60) as filed_at from labels where toxic = 1)
"""
