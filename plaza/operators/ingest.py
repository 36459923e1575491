"""The ingest of a batch of records: authors, questions, parents, contents and their analysis, and what happened."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import has_body
from ..shared import written
from . import gate, store

#: What is counted of a batch: which rows each counter has.
COUNTERS = ("inserted", "duplicates", "dangling_parents", "no_snapshot", "unresolved_authors", "unresolved_questions")
JUDGED = ("kept_by_parent", "dropped_irrelevant", "dropped_unknown_parent", "unjudged", "rejected_question", "stance_conflict")


def _counts() -> dict[str, Column]:
    tried = F.col("inserted").isNotNull()
    return {
        "inserted": F.count_if("inserted"), "duplicates": F.count_if(tried & ~F.col("inserted")), "dangling_parents": F.count_if(tried & F.col("parent_platform_id").isNotNull() & F.col("parent_content_id").isNull()),
        "no_snapshot": F.count_if(tried & F.col("snapshot_path").isNull()), "unresolved_authors": F.count_if(tried & F.col("author_id").isNull()), "unresolved_questions": F.count_if(tried & F.col("question_id").isNull()),
    }


def _judged_counts() -> dict[str, Column]:
    return {d: F.count_if(F.col("disposition") == d) for d in JUDGED[:-1]} | {"stance_conflict": F.count_if("stance_conflict")}


def upsert_authors(authors: DataFrame, batch: DataFrame, order: str = "ord") -> DataFrame:
    """authors after those of batch(ord, author_platform_id, author_name, author_url): names and addresses as last given, nulls too; new authors get ids in the order in which they come."""
    last = batch.where("author_platform_id is not null").groupBy(F.col("author_platform_id").alias("platform_user_id")).agg(F.max_by(F.struct("author_name", "author_url"), order).alias("__new"), F.min(order).alias("__ord"))
    both = authors.withColumn("__old", F.lit(True)).join(last, "platform_user_id", "full")
    new = {"nickname": "author_name", "profile_url": "author_url"}
    named = both.select(*(F.when(F.col("__new").isNotNull(), F.col(f"__new.{new[c]}")).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in authors.columns), "__old", "__ord")
    fresh = store.with_ids(named.where("__old is null").drop("author_id"), authors, "author_id", "__ord")
    return named.where("__old").select(authors.columns).unionByName(fresh.select(authors.columns))


@dataclass
class Ingested:
    """The next versions of the tables, the batch with what became of each row, and the counters, known once a table has been written or read."""

    authors: DataFrame
    contents: DataFrame
    batch: DataFrame
    analysis: DataFrame | None = None
    counted: Observation = field(default_factory=Observation)

    def report(self) -> dict[str, int]:
        """The counters, of the pass that made the batch; there is no second one."""
        return dict(self.counted.get)

    def content_ids(self) -> DataFrame:
        """(url, content_id) of what was really inserted."""
        return self.batch.where("inserted").select("url", "content_id")


def ingest_contents(batch: DataFrame, contents: DataFrame, authors: DataFrame, questions: DataFrame, judgments: DataFrame | None = None, relevant: DataFrame | None = None, analysis: DataFrame | None = None) -> Ingested:
    """batch(ord, url, content_type, platform_id, parent_platform_id, author_platform_id, author_name, author_url, question_platform_id, snapshot_path, and columns of contents) into the tables.

    Authors are made or renamed, those of rows that come to nothing too; a question is looked up
    and null if it isn't known; the first row of a url that isn't there is inserted, with an id
    made of its url and its parent among the rows inserted before it. With judgments(url,
    is_relevant, columns of analysis, and ord where a url has several) rows pass the gate first, by the questions of
    relevant(question_id), and each content that is inserted gets exactly one analysis.

    The resolved batch is written once, and counted by an observation in that pass; all three
    tables are read from it, so they agree whatever is lost and computed again. Commit them
    together, the contents last: a run that dies before has inserted nothing.
    """
    names = upsert_authors(authors, batch)
    who = names.select(F.col("platform_user_id").alias("author_platform_id"), "author_id")
    which = questions.select(F.col("platform_qid").alias("question_platform_id"), "question_id")
    known = batch.drop("author_id", "question_id").join(who, "author_platform_id", "left").join(which, "question_platform_id", "left")
    rows = known.withColumn("content_id", store.content_id(F.col("url")))
    counts = _counts()
    if judgments is None:
        resolved = gate.resolve_parents(gate.new_rows(rows, contents, "url", "ord"))
    else:
        at = "ord" if "ord" in judgments.columns else None  # of several judgments of a url the last counts
        gated = gate.content_disposition(rows, judgments, relevant, questions, at)
        kept = F.col("disposition").isin("kept", "kept_by_parent")
        tried = gate.resolve_parents(gate.new_rows(gated.where(kept), contents, "url", "ord"))
        resolved = tried.unionByName(gated.where(~kept), allowMissingColumns=True)
        counts |= _judged_counts()
    counted = Observation()
    done = written(resolved.observe(counted, *(c.cast("long").alias(n) for n, c in counts.items())), "ingest")
    new = done.where("inserted").withColumn("parent_id", F.col("parent_content_id"))
    columns = [F.col(c) if c in new.columns else F.lit(None).cast(contents.schema[c].dataType).alias(c) for c in contents.columns]
    out = Ingested(names, contents.unionByName(new.select(columns)), done, None, counted)
    if judgments is not None and analysis is not None:
        of = judgments.groupBy("url").agg(F.max_by(F.struct(*(c for c in judgments.columns if c not in ("url", "ord"))), F.col("ord") if "ord" in judgments.columns else F.lit(0)).alias("__j"))
        rows = new.select("url", "content_id").join(of, "url").select("content_id", "__j.*")
        out.analysis = analysis.unionByName(rows.select(*((F.col(c) if c in rows.columns else F.lit(None)).cast(analysis.schema[c].dataType).alias(c) for c in analysis.columns)))
    return out


def question_message(title: Column, description: Column, captions: tuple[str, str], nothing: str) -> Column:
    """A question's message: its title, and its description or that it has none; null without a title, as there is nothing to ask about."""
    told = F.when(has_body(description), F.trim(description)).otherwise(F.lit(nothing))
    return F.when(has_body(title), F.concat(F.lit(captions[0]), F.trim(title), F.lit("\n"), F.lit(captions[1]), told))
