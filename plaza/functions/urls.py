"""URL functions on columns. Anchored patterns, since URL parsers refuse what pages hold."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Site:
    """Which hosts hold content, and the hosts and paths of its canonical addresses."""

    hosts: tuple[str, ...]
    home: str
    article_host: str
    #: content type -> pattern of its path; the first group is the id, or the second if there is a question before it
    paths: tuple[tuple[str, str], ...]
    profile: str


# Hosts and paths of the collected site.
QA_SITE = Site(
    hosts=("zhihu.com", "www.zhihu.com", "m.zhihu.com", "zhuanlan.zhihu.com"),
    home="www.zhihu.com",
    article_host="zhuanlan.zhihu.com",
    paths=(("answer", r"^/question/(\d+)/answer/(\d+)$"), ("question", r"^/question/(\d+)$"), ("article", r"^/p/(\d+)$"), ("thought", r"^/pin/(\d+)$")),
    profile=r"^/(?:people|org)/([^/]+)$",
)

_BLANK = r"[\s\x1c-\x1f\x85\xa0  -     　]+"


def stripped(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(F.regexp_replace(text, f"^{_BLANK}", ""), f"{_BLANK}$", "")


def once(value: Column, make: Callable[[Column], Column]) -> Column:
    """make of a value that is computed once, however often make names it."""
    return F.transform(F.array(value), make)[0]


def absolute_url(raw: Column, site: Site = QA_SITE) -> Column:
    """A full address: scheme-relative, path-only and scheme-less ones are completed; blank is null."""
    return once(
        stripped(raw),
        lambda url: F.when(url == "", F.lit(None).cast("string")).when(url.startswith("//"), F.concat(F.lit("https:"), url)).when(url.startswith("/"), F.concat(F.lit(f"https://{site.home}"), url))
        .when(url.startswith("http://") | url.startswith("https://"), url).otherwise(F.concat(F.lit("https://"), url)),
    )


def _host_and_path(url: Column) -> tuple[Column, Column]:
    host = F.lower(F.regexp_extract(url, r"^https?://(?:[^/?#]*@)?([^/?#:]*)", 1))
    return host, F.regexp_replace(F.regexp_extract(url, r"^https?://[^/?#]*([^?#]*)", 1), "/+$", "")


def _placed(raw: Column, site: Site, make: Callable[[Column, Column], Column]) -> Column:
    """make of the host and path of an address, each computed once."""
    parts = lambda url: F.struct(*(c.alias(n) for c, n in zip(_host_and_path(url), ("host", "path"))))
    return once(once(absolute_url(raw, site), parts), lambda p: make(p["host"], p["path"]))


def normalize_url(raw: Column, site: Site = QA_SITE) -> Column:
    """struct<url, content_type, id, question_id> of a content address in its one canonical form; null for anything else."""

    def classified(host: Column, path: Column) -> Column:
        found = F.lit(None).cast("struct<url: string, content_type: string, id: string, question_id: string>")
        for kind, pattern in reversed(site.paths):
            on = site.article_host if kind == "article" else site.home
            first = F.regexp_extract(path, pattern, 1)
            own = F.regexp_extract(path, pattern, 2) if kind == "answer" else first
            question = first if kind in ("answer", "question") else F.lit(None).cast("string")
            found = F.when(path.rlike(pattern), F.struct(F.concat(F.lit(f"https://{on}"), path).alias("url"), F.lit(kind).alias("content_type"), own.alias("id"), question.alias("question_id"))).otherwise(found)
        return F.when(host.isin(*site.hosts), found)

    return _placed(raw, site, classified)


def profile_user_id(raw: Column, site: Site = QA_SITE) -> Column:
    """The user of a profile address of exactly two path segments, else null."""
    return _placed(raw, site, lambda host, path: F.when(host.isin(*site.hosts) & path.rlike(site.profile), F.regexp_extract(path, site.profile, 1)))


def storage_key(content_type: Column, content_id: Column, file: str) -> Column:
    return F.concat_ws("/", F.lit("content"), F.coalesce(F.nullif(content_type, F.lit("")), F.lit("unknown")), content_id, F.lit(file))


def search_url(base: str, keyword: Column) -> Column:
    """base with the keyword percent-encoded: space as %20, slash kept."""
    encoded = F.url_encode(keyword)
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(a), F.lit(b))
    return F.concat(F.lit(base), encoded)
