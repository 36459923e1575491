"""Cards of raw pages as a table: a row a card, with what became of it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..ddl import columns
from . import page
from .css import group
from .text import count_in_text, parse_count
from .urls import QA_SITE, Site, normalize_url, profile_user_id


@dataclass(frozen=True)
class Cards:
    """Where a kind of card is, and its parts in it; groups of CSS candidates. ``roots``: cards inside another one don't count. An empty ``card`` is the whole page."""

    card: str
    link: str = ""
    title: str = ""
    body: str = ""
    author: str = ""
    author_link: str = ""
    votes: str = ""
    vote_meta: str = ""
    comments: str = ""
    comment_meta: str = ""
    published: str = ""
    published_meta: str = ""
    id_attribute: str = ""
    roots: bool = False


# The cards of the collected site.
_TITLE, _BODY = "[itemprop='headline'], .Post-Title, .QuestionHeader-title", "[itemprop='text'], .Post-RichText, .RichText"
_COMMON = {
    "title": _TITLE, "body": _BODY, "author": ".AuthorInfo-name", "author_link": "[itemprop='author'] .UserLink-link", "votes": "button[aria-label*='赞同']", "vote_meta": "meta[itemprop='upvoteCount']",
    "comments": ".BottomActions-CommentBtn, .ContentItem-action", "comment_meta": "meta[itemprop='commentCount']", "published": ".ContentItem-time", "published_meta": "meta[itemprop='datePublished'], meta[itemprop='dateCreated']",
}
KINDS = {
    "search": Cards(card=".SearchResult-Card .ContentItem, .ContentItem", link=".ContentItem-title a[href]", **_COMMON | {"body": ".RichText"}),
    "answer": Cards(card=".AnswerItem", link="a[href*='/answer/']", id_attribute="name", **_COMMON),
    "content": Cards(card="", **_COMMON),
    "comment": Cards(card="[data-id]", body=".CommentContent", author="a[href*='/people/'], a[href*='/org/']", author_link="a[href*='/people/'], a[href*='/org/']", votes="button[aria-label*='赞同']", published=".ContentItem-time", id_attribute="data-id", roots=True),
}

ROW = "ord int, native_id string, hrefs array<string>, metas array<string>, title string, link_text string, body string, author_name string, author_url string, vote_meta string, vote_text string, vote_label string, comment_meta string, comment_texts array<string>, published_meta string, published_text string"


def read_cards(html: str | None, where: Cards) -> Iterator[tuple]:
    """The cards of a page in its order, in the columns of ROW."""
    root = page.tree(html)
    nodes = group(where.card).all(root) if where.card else [root]
    mine = set(map(id, nodes))
    if where.roots:
        nodes = [n for n in nodes if not n.inside(lambda up: id(up) in mine)]
    text = lambda n: n.text() or (n.attrs.get("content") or "").strip() or None if n else None
    for ord_, node in enumerate(nodes):
        scope = node if node is root else page.holder(node)
        pick = lambda g: group(g).first(scope) if g else None  # noqa: B023, E731
        every = lambda g: group(g).all(scope) if g else []  # noqa: B023, E731
        attr = lambda n, name: n.attrs.get(name) if n else None
        own = next((n.attrs[where.id_attribute].strip() for n in scope.walk() if where.id_attribute in n.attrs and n.tag not in ("meta", "input", "a")), None) if where.id_attribute else None
        links, votes = every(where.link), pick(where.votes)
        named = next((n for n in every(where.author) if n.text("")), None)
        yield (
            ord_, own or None, [n.attrs.get("href", "").strip() for n in links], [n.attrs.get("content", "") for n in scope.walk() if n.tag == "meta" and n.attrs.get("itemprop") == "url"],
            text(pick(where.title)), links[0].text(" ") if links else None, text(pick(where.body)), named.text("") if named else None, attr(pick(where.author_link), "href"),
            attr(pick(where.vote_meta), "content"), votes.text(" ") if votes else None, attr(votes, "aria-label"), attr(pick(where.comment_meta), "content"), [t for n in every(where.comments) if (t := n.text(" "))],
            attr(pick(where.published_meta), "content"), text(pick(where.published)),
        )


@udtf(returnType=ROW, useArrow=True)
class CardRows:
    """Table function (html, the fields of a Cards as a map) -> ROW."""

    def eval(self, html: str, where: dict) -> Iterator[tuple]:
        known = {k: v == "true" if k == "roots" else v for k, v in where.items()}
        yield from read_cards(html, Cards(**known))


def _where(where: Cards) -> Column:
    return F.create_map(*(F.lit(x) for k, v in asdict(where).items() for x in (k, str(v).lower() if k == "roots" else v)))


def cards(pages: DataFrame, kind: str | Cards, html: str = "html", site: Site = QA_SITE, url: str | None = None, question_id: Column | None = None) -> DataFrame:
    """pages joined laterally with their cards, a row each: ord, fate and the record.

    fate, by kind: kept; ``no_link`` (a search card without a link) and ``not_content`` (its link, or
    the address ``url`` of a content page, is none of the site's contents); ``no_address`` (an answer
    that neither a meta element, a link that ends with its id, nor its question and id give one);
    ``no_author`` and ``empty`` (a comment without its author's link; with neither id nor text). A
    dropped card has nulls in url, content_type and platform_id. Cards of one page add up over the
    fates; a page without cards has no row.
    """
    where = KINDS[kind] if isinstance(kind, str) else kind
    name = kind if isinstance(kind, str) else "search"
    found = pages.lateralJoin(CardRows(F.col(html).outer(), _where(where)))
    complete = lambda href: F.when(href.startswith("/") & ~href.startswith("//"), F.concat(F.lit(f"https://{site.home}"), href)).otherwise(href)
    first = F.nullif(F.get("hrefs", F.lit(0)), F.lit(""))
    qid = question_id if question_id is not None else F.lit(None).cast("string")
    if name == "answer":
        meta = F.get(F.filter("metas", lambda m: F.contains(m, F.lit(page.ANSWER))), 0)
        own = F.get(F.filter("hrefs", lambda h: F.col("native_id").isNull() | F.endswith(F.rtrim(h, F.lit("/")), F.concat(F.lit(page.ANSWER), "native_id"))), 0)
        made = F.when(F.col("native_id").isNotNull() & qid.isNotNull(), F.concat(F.lit(f"https://{site.home}/question/"), qid, F.lit(page.ANSWER), "native_id"))
        address = F.coalesce(normalize_url(meta, site), normalize_url(complete(own), site), normalize_url(made, site))
        fate = F.when(F.col("__address").isNull(), "no_address").otherwise("kept")
    elif name == "comment":
        address = F.lit(None).cast(found.select(normalize_url(F.lit(""), site)).schema[0].dataType)
        fate = F.when(F.col("author_url").isNull(), "no_author").when(F.col("native_id").isNull() & F.col("body").isNull(), "empty").otherwise("kept")
    elif name == "content":
        address = normalize_url(F.col(url), site)
        fate = F.when(F.col("__address").isNull(), "not_content").otherwise("kept")
    else:
        address = normalize_url(complete(first), site)
        fate = F.when(first.isNull(), "no_link").when(F.col("__address").isNull(), "not_content").otherwise("kept")
    rows = found.withColumn("__address", address).withColumn("fate", fate)
    said = F.get(F.filter("comment_texts", lambda t: F.contains(t, F.lit(page.COMMENT_WORD))), 0)
    comments = F.when(F.col("comment_meta").isNotNull(), parse_count(F.col("comment_meta"))).otherwise(F.greatest(count_in_text(said), F.lit(0)))
    return rows.select(
        *(c for c in pages.columns if c != html), "ord", "fate", F.col("__address.url").alias("card_url"), F.col("__address.content_type").alias("content_type"), F.coalesce("__address.id", F.when(F.col("fate") == "kept", F.col("native_id"))).alias("platform_id"),
        F.coalesce("title", "link_text").alias("title"), F.col("body").alias("text"), "author_name", complete(F.col("author_url")).alias("author_url"), profile_user_id(F.col("author_url")).alias("author_platform_id"),
        page.vote_count(F.col("vote_meta"), F.col("vote_text"), F.col("vote_label")).alias("voteup_count"), comments.alias("comment_count"), "published_text", page.published_at(F.col("published_meta"), F.col("published_text")).alias("published_at"), first.alias("href"),
    )


def fates(rows: DataFrame) -> DataFrame:
    """(fate, n) of the rows of ``cards``."""
    return rows.groupBy("fate").agg(F.count("*").alias("n"))
