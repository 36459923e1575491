"""Records from pages of the collected site: embedded data as column functions, cards and comments by one Arrow function each."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..ddl import columns
from .cards import VOID
from .css import group
from .html import html_to_text
from .text import parse_count, parse_datetime
from .urls import QA_SITE, Site, normalize_url, once

# Where the site's pages have what.
STATE_ID = "js-initialData"
ENTITIES = {"question": "questions", "answer": "answers", "article": "articles", "thought": "pins", "comment": "comments"}
TITLE, BODY = group("[itemprop='headline'], .Post-Title, .QuestionHeader-title, h1"), group("[itemprop='text'], .Post-RichText, .RichText")
AUTHOR_NAME, AUTHOR_LINK, PUBLISHED, ACTION = "AuthorInfo-name", "UserLink-link", "ContentItem-time", "ContentItem-action"
COMMENT_BODY, COMMENT_ID, ANSWER_ID = "CommentContent", "data-id", "name"
VOTE_WORD, COMMENT_WORD, PEOPLE, ANSWER = "赞同", "评论", "/people/", "/answer/"


# --- embedded data ---


def initial_state(html: Column) -> Column:
    """The page's embedded state, a variant object; null if there is none or it can't be read."""
    found = F.nullif(F.regexp_extract(html, rf"(?s)<script[^>]*\bid=[\"']{STATE_ID}[\"'][^>]*>(.*?)</script>", 1), F.lit(""))
    state = F.try_variant_get(F.try_parse_json(found), "$.initialState", "variant")
    return F.when(F.schema_of_variant(state).startswith("OBJECT"), state)


def entity(state: Column, content_type: Column, platform_id: Column) -> Column:
    """The entity of this type and id in a state, a variant object; null if there is none."""
    found = F.lit(None).cast("variant")
    for kind, group in ENTITIES.items():
        found = F.when(content_type == kind, F.try_element_at(F.try_variant_get(state, f"$.entities.{group}", "map<string,variant>"), platform_id)).otherwise(found)
    return F.when(F.schema_of_variant(found).startswith("OBJECT"), found)


def _string(v: Column, key: str) -> Column:
    own = F.try_variant_get(v, f"$.{key}", "variant")
    return F.when(F.schema_of_variant(own) == "STRING", F.try_variant_get(own, "$", "string"))


def _whole(v: Column, key: str) -> Column:
    own = F.try_variant_get(v, f"$.{key}", "variant")
    n = F.try_variant_get(own, "$", "long")
    return F.when((F.schema_of_variant(own) == "BIGINT") & (n >= 0), n)


def question_detail(url: Column, html: Column, site: Site = QA_SITE) -> Column:
    """struct<detail, reason>: a question's page, if its address is a question's and its data has that question.

    reason: not_a_question, no_data, not_in_data or no_title; null if there is a detail. A blank
    description is one.
    """

    def judged(x: Column) -> Column:
        address, state, own = x["address"], x["state"], x["own"]
        reason = F.when(~F.coalesce(address["content_type"] == "question", F.lit(False)), "not_a_question").when(state.isNull(), "no_data").when(own.isNull(), "not_in_data").when(x["title"] == "", "no_title")
        detail = F.struct(
            address["id"].alias("platform_qid"), address["url"].alias("url"), x["title"].alias("title"), x["description"].alias("description"), _whole(own, "followerCount").alias("follower_count"),
            _whole(own, "visitCount").alias("view_count"), _whole(own, "answerCount").alias("answer_count"), F.timestamp_seconds(_whole(own, "created")).alias("asked_at"),
        )
        return once(reason, lambda why: F.struct(F.when(why.isNull(), detail).alias("detail"), why.alias("reason")))

    found = once(F.struct(normalize_url(url, site).alias("address"), initial_state(html).alias("state")), lambda x: F.struct(x["address"].alias("address"), x["state"].alias("state"), entity(x["state"], F.lit("question"), x["address"]["id"]).alias("own")))
    title = F.trim(F.coalesce(_string(found["own"], "title"), F.lit("")))
    description = html_to_text(F.coalesce(_string(found["own"], "detail"), F.lit("")))  # Python: not inside a lambda
    return once(F.struct(found["address"].alias("address"), found["state"].alias("state"), found["own"].alias("own"), title.alias("title"), description.alias("description")), judged)


def parse_iso(text: Column) -> Column:
    """An ISO-8601 time, taken as UTC if it names no zone; null if it is none."""
    return F.try_to_timestamp(F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?$"), text))


def published_at(meta: Column, visible: Column) -> Column:
    """The machine-readable time, else the visible one."""
    return F.coalesce(parse_iso(meta), parse_datetime(visible))


def vote_count(meta: Column, button: Column, label: Column) -> Column:
    """From a meta element's content, else a button's text, else its label; 0 if none says it."""
    by_text = parse_count(button)
    return F.when(meta.isNotNull(), parse_count(meta)).when(by_text > 0, by_text).otherwise(parse_count(label))


# --- elements ---


class Node:
    """An element with its attributes, parent, and children: elements and pieces of text."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """All elements inside, in the order of the page."""
        waiting = [c for c in reversed(self.children) if isinstance(c, Node)]
        while waiting:
            node = waiting.pop()
            yield node
            waiting += [c for c in reversed(node.children) if isinstance(c, Node)]

    def first(self, *tests: Callable[[Node], bool]) -> Node | None:
        """The first element that passes the first test that any passes."""
        return next((n for t in tests for n in self.walk() if t(n)), None)

    def text(self, between: str = "\n") -> str | None:
        """Stripped pieces of text inside; null if there are none."""
        pieces, waiting = [], list(reversed(self.children))
        while waiting:
            c = waiting.pop()
            if isinstance(c, str):
                pieces.append(c.strip())
            elif c.tag not in ("script", "style"):
                waiting += reversed(c.children)
        return between.join(filter(None, pieces)) or None

    def has(self, css_class: str) -> bool:
        return css_class in self.attrs.get("class", "").split()

    def inside(self, test: Callable[[Node], bool]) -> bool:
        up = self.parent
        while up and not test(up):
            up = up.parent
        return up is not None


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs}, self.now)
        self.now.children.append(node)
        if tag not in VOID:
            self.now = node

    def handle_endtag(self, tag: str) -> None:
        up = self.now
        while up.parent and up.tag != tag:
            up = up.parent
        if up.parent:
            self.now = up.parent

    def handle_data(self, data: str) -> None:
        self.now.children.append(data)


def tree(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def _attr(name: str, value: str | None = None) -> Callable[[Node], bool]:
    return lambda n: name in n.attrs if value is None else n.attrs.get(name) == value


def _of_class(*names: str) -> Callable[[Node], bool]:
    return lambda n: any(n.has(c) for c in names)


def _href(node: Node | None, base: str) -> str | None:
    href = (node.attrs.get("href") or "").strip() if node else ""
    return urljoin(base, href) if href else None


def _meta(scope: Node, *names: str) -> str | None:
    found = scope.first(*(lambda n, p=p: n.tag == "meta" and n.attrs.get("itemprop") == p for p in names))
    return found.attrs.get("content") if found else None


ITEM = columns(
    "own_id string, meta_url string, link_url string, title string, body string, author_name string, author_url string, vote_meta string, vote_text string, vote_label string, comment_meta string, comment_text string, published_meta string, published_text string"
)


def read_item(scope: Node, base: str) -> tuple:
    """What one card or page has, in the columns of ITEM."""
    own = scope.first(lambda n: ANSWER_ID in n.attrs and n.tag not in ("meta", "input", "a"))
    own_id = own.attrs[ANSWER_ID] if own else None
    metas = [n.attrs.get("content", "") for n in scope.walk() if n.tag == "meta" and n.attrs.get("itemprop") == "url"]
    links = [n.attrs["href"] for n in scope.walk() if n.tag == "a" and ANSWER in n.attrs.get("href", "")]
    mine = [x for x in links if not own_id or x.rstrip("/").endswith(f"{ANSWER}{own_id}")]
    button = scope.first(lambda n: n.tag == "button" and VOTE_WORD in n.attrs.get("aria-label", ""))
    told = next((t for n in scope.walk() if n.has(ACTION) and COMMENT_WORD in (t := n.text(" ") or "")), None)
    text = lambda n: n.text() if n else None
    told_text = lambda n: n.text() or (n.attrs.get("content") or "").strip() or None if n else None
    return (
        own_id, next((m for m in metas if ANSWER in m), None), urljoin(base, mine[0]) if mine else None, told_text(TITLE.first(scope)),
        text(BODY.first(scope)), text(scope.first(_of_class(AUTHOR_NAME))),
        _href(scope.first(lambda n: n.has(AUTHOR_LINK) and n.inside(_attr("itemprop", "author"))), base),
        _meta(scope, "upvoteCount"), button.text(" ") if button else None, button.attrs.get("aria-label") if button else None, _meta(scope, "commentCount"), told, _meta(scope, "datePublished", "dateCreated"), text(scope.first(_of_class(PUBLISHED))),
    )


_REFERENCE = re.compile("&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")


def closed_references(page: str) -> str:
    """A page of whose character references only those that end with a semicolon are left; the ampersands of others stand for themselves."""
    return _REFERENCE.sub(lambda m: m[0] if m[1] and (m[1][0] == "#" or m[1] in html5) else f"&amp;{m[1] or ''}", page)


def item(html: Column, platform_id: Column | None = None, site: Site = QA_SITE, unclosed: bool = True) -> Column:
    """ITEM of a page or card. With an id: of the card of that id, where the page has cards; null if none of them is it (another card never stands in).

    A character reference without its semicolon is read as browsers do, or left as it is (not unclosed).
    """
    base = f"https://{site.home}"

    def read(page: str | None, wanted: str | None) -> tuple:
        scope = tree(page if unclosed or not page else closed_references(page))
        cards = [n for n in scope.walk() if ANSWER_ID in n.attrs and n.has("AnswerItem")]
        if wanted and cards:
            scope = next((holder(n) for n in cards if n.attrs[ANSWER_ID] == wanted), None)
        return read_item(scope, base) if scope else (None,) * len(ITEM)

    @F.pandas_udf(ITEM)
    def run(pages: pd.Series, ids: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read(p, i) for p, i in zip(pages, ids)], columns=ITEM.names)

    return run(html, platform_id if platform_id is not None else F.lit(None).cast("string"))


def holder(node: Node) -> Node:
    """A node as the only child of a root, so that it is found itself."""
    root = Node("", {}, None)
    root.children.append(node)
    return root


def answer_url(found: Column, question_id: Column, site: Site = QA_SITE) -> Column:
    """The normalised address of a card: its own meta address, else the link that ends with its id, else made of the question's id and its own; null if none is one."""
    made = F.when(found["own_id"].isNotNull() & question_id.isNotNull(), F.concat(F.lit(f"https://{site.home}/question/"), question_id, F.lit(ANSWER), found["own_id"]))
    return F.coalesce(normalize_url(found["meta_url"], site), normalize_url(found["link_url"], site), normalize_url(made, site))


def answer_record(html: Column, question_id: Column, site: Site = QA_SITE) -> Column:
    """struct of an answer card's record; null without an address."""

    def record(f: Column) -> Column:
        found = f["item"]
        comments_ = F.when(found["comment_meta"].isNotNull(), parse_count(found["comment_meta"])).otherwise(parse_count(found["comment_text"]))
        made = lambda url: F.struct(
            url["url"].alias("url"), url["content_type"].alias("content_type"), url["id"].alias("platform_id"), f["question_id"].alias("question_id"), found["title"].alias("title"), found["body"].alias("text"), found["author_name"].alias("author_name"),
            found["author_url"].alias("author_url"), vote_count(found["vote_meta"], found["vote_text"], found["vote_label"]).alias("voteup_count"), comments_.alias("comment_count"), found["published_text"].alias("published_text"),
            published_at(found["published_meta"], found["published_text"]).alias("published_at"),
        )
        return once(answer_url(found, f["question_id"], site), lambda url: F.when(url.isNotNull(), made(url)))

    return once(F.struct(item(html, None, site).alias("item"), question_id.alias("question_id")), record)


COMMENT = columns("native_id string, text string, author_name string, author_url string, vote_text string, vote_label string, published_text string")


def read_comments(page: str | None, base: str) -> list[tuple]:
    """First-level comments: those inside no other. Without an author's link they are dropped, and without both id and text; a picture alone stays, with null text."""
    out = []
    for node in tree(page).walk():
        if COMMENT_ID not in node.attrs or node.inside(_attr(COMMENT_ID)):
            continue
        links = [n for n in node.walk() if n.tag == "a" and PEOPLE in n.attrs.get("href", "")]
        body = node.first(_of_class(COMMENT_BODY))
        text = body.text() if body else None
        native = node.attrs[COMMENT_ID].strip() or None
        if links and (native or text):
            button = node.first(lambda n: n.tag == "button" and VOTE_WORD in n.attrs.get("aria-label", ""))
            told = node.first(_of_class(PUBLISHED))
            out.append((native, text, next((t for n in links if (t := n.text(""))), None), _href(links[0], base), button.text(" ") if button else None, button.attrs.get("aria-label") if button else None, told.text() if told else None))
    return out


def comments(html: Column, site: Site = QA_SITE) -> Column:
    """array of a page's first-level comments."""
    base = f"https://{site.home}"

    @F.pandas_udf(T.ArrayType(COMMENT))
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: [dict(zip(COMMENT.names, c)) for c in read_comments(p, base)])

    return run(html)
