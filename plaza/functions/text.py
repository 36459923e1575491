"""Counts, dates, hashes and messages from page text, as column functions.

A text is taken apart into runs of digits and what stands between them; numbers and dates are
read from neighbouring runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .urls import once, stripped

# Units of counts, words of the collected pages, and what stands between the parts of a date.
UNITS = {"万": 10_000, "千": 1_000, "k": 1_000, "K": 1_000}
ANSWERS_SAID, FOLDED_SAID, COMMENTS_SAID = "个回答", "个回答被折叠", "条评论"
AFTER_YEAR, AFTER_MONTH, AFTER_DAY = ["-", "/", "年"], ["-", "/", "月"], "日"
INVISIBLE = "\u200b\u200c\u200d\ufeff"

DIGITS = "0123456789"


def _runs(text: Column) -> Column:
    """Runs of digits and of other characters, in turn."""
    return F.split(text, "(?<=[0-9])(?=[^0-9])|(?<=[^0-9])(?=[0-9])")


def _at(runs: Column, i: Column | int) -> Column:
    """The i-th run from 0, empty beyond the last."""
    return F.coalesce(F.get(runs, i if isinstance(i, Column) else F.lit(i)), F.lit(""))


def _is_number(run: Column) -> Column:
    return (run != "") & (F.translate(run, DIGITS, "") == "")


def _first_number(runs: Column) -> Column:
    """The place of the first run of digits, 0 or 1."""
    return F.when(_is_number(_at(runs, 0)), 0).otherwise(1)


def _times(unit: Column) -> Column:
    return reduce(lambda out, u: F.when(unit == u, float(UNITS[u])).otherwise(out), UNITS, F.lit(1.0))


def parse_count(text: Column) -> Column:
    """The first number with its unit, cut to a whole; 0 if there is none. Commas and blanks inside don't count."""

    def read(runs: Column) -> Column:
        i = _first_number(runs)
        decimal = (_at(runs, i + 1) == ".") & _is_number(_at(runs, i + 2))
        number = F.when(decimal, F.concat(_at(runs, i), F.lit("."), _at(runs, i + 2))).otherwise(_at(runs, i))
        behind = stripped(F.when(decimal, _at(runs, i + 3)).otherwise(_at(runs, i + 1)))
        return F.floor(number.try_cast("double") * _times(F.left(behind, F.lit(1))))

    return F.coalesce(once(_runs(F.translate(text, ", ", "")), read), F.lit(0)).cast("long")


def _numbers_before(text: Column, said: str) -> Column:
    """For each place of a phrase the digits and commas right before it, blanks between allowed; null where there are none."""
    before = F.split(text, said)
    tail = lambda piece: F.element_at(F.split(stripped(piece), f"[^{DIGITS},]"), -1)
    return F.transform(F.slice(before, F.lit(1), F.size(before) - 1), lambda p: F.translate(tail(p), ",", "").try_cast("long"))


def _first_said(text: Column, said: str) -> Column:
    return F.get(F.filter(_numbers_before(text, said), lambda n: n.isNotNull()), 0)


def count_in_text(text: Column) -> Column:
    """The number, perhaps with a unit, that stands with the word for comments; 0 if there is none."""

    def tail(piece: Column) -> Column:
        flat = stripped(piece)
        unit = F.right(flat, F.lit(1))
        number = stripped(F.when(unit.isin(*UNITS), F.left(flat, F.length(flat) - 1)).otherwise(flat))
        return F.when(F.right(number, F.lit(1)).isin(*DIGITS), F.concat(F.element_at(F.split(number, f"[^{DIGITS},.]"), -1), F.when(unit.isin(*UNITS), unit).otherwise("")))

    before = F.split(text, COMMENTS_SAID)
    said = F.transform(F.slice(before, F.lit(1), F.size(before) - 1), tail)
    return parse_count(F.get(F.filter(said, lambda x: x.isNotNull()), 0))


def comment_total(text: Column) -> Column:
    """The declared number of comments, if that is all the text says; else null."""
    clean = stripped(F.translate(text, INVISIBLE, ""))
    number = F.when(F.endswith(clean, F.lit(COMMENTS_SAID)), stripped(F.left(clean, F.length(clean) - len(COMMENTS_SAID))))
    return F.when(F.translate(number, DIGITS + ",", "") == "", F.translate(number, ",", "").try_cast("long"))


def question_total(text: Column) -> Column:
    """The number of answers that a page declares; null if it says none."""
    return _first_said(text, ANSWERS_SAID)


def collapsed_count(text: Column) -> Column:
    """A lower bound: 0 if nothing is said."""
    return F.coalesce(_first_said(text, FOLDED_SAID), F.lit(0))


def parse_datetime(text: Column) -> Column:
    """An absolute date, with a time if there is one, taken as UTC; null for relative, yearless or impossible dates.

    The first place counts where a run of digits that ends a year, a month and a day follow each
    other with a separator between.
    """

    def read(runs: Column) -> Column:
        short = lambda run: _is_number(run) & (F.length(run) <= 2)
        begins = lambda i: (
            _is_number(_at(runs, i)) & (F.length(_at(runs, i)) >= 4) & _at(runs, i + 1).isin(AFTER_YEAR) & short(_at(runs, i + 2)) & _at(runs, i + 3).isin(AFTER_MONTH) & _is_number(_at(runs, i + 4))
        )
        return once(F.get(F.filter(F.sequence(F.lit(0), F.size(runs)), begins), 0), lambda i: F.when(i.isNotNull(), moment(runs, i)))

    def moment(runs: Column, i: Column) -> Column:
        day, between = _at(runs, i + 4), _at(runs, i + 5)
        gap = F.when(F.startswith(between, F.lit(AFTER_DAY)), F.substring(between, 2, 1_000)).otherwise(between)
        timed = (F.length(day) <= 2) & (gap != "") & (stripped(gap) == "") & _is_number(_at(runs, i + 6)) & (F.length(_at(runs, i + 6)) <= 2) & (_at(runs, i + 7) == ":") & (F.length(_at(runs, i + 8)) >= 2)
        number = lambda x: x.try_cast("int")
        time = lambda x: F.when(timed, number(x)).otherwise(0)
        return F.try_make_timestamp(number(F.right(_at(runs, i), F.lit(4))), number(_at(runs, i + 2)), number(F.left(day, F.lit(2))), time(_at(runs, i + 6)), time(F.left(_at(runs, i + 8), F.lit(2))), F.lit(0))

    return once(_runs(text), read)


def asked_at(seconds: Column) -> Column:
    """Unix seconds as a timestamp; null if negative."""
    return F.when(seconds.between(0, 253_402_300_799), F.timestamp_seconds(seconds))


def date_window(start: Column, end: Column) -> Column:
    a, b = F.date_format(start, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd")
    return F.when(start.isNotNull() & end.isNotNull(), F.concat(a, F.lit(" ~ "), b)).when(start.isNotNull(), F.concat(a, F.lit(" 起"))).when(end.isNotNull(), F.concat(F.lit("截至 "), b))


def has_body(text: Column) -> Column:
    return F.coalesce(stripped(text) != "", F.lit(False))


def content_hash(text: Column, html: Column) -> Column:
    """sha256 of the text, or of the page where the text is blank."""
    return F.sha2(F.when(has_body(text), text).otherwise(F.coalesce(html, F.lit(""))), 256)


def comment_identity(native: Column, text: Column) -> Column:
    """The platform's id, or one made of the text."""
    return F.coalesce(F.nullif(native, F.lit("")), F.concat(F.lit("c-"), F.left(F.sha2(text, 256), F.lit(16))))


def file_checksum(text: Column) -> Column:
    """sha256 that doesn't depend on line ends."""
    return F.sha2(F.replace(text, F.lit("\r\n"), F.lit("\n")), 256)


def excerpt_flat(text: Column, size: int) -> Column:
    """White space collapsed, cut at ``size`` with an ellipsis."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(flat) > size, F.concat(F.left(flat, F.lit(size)), F.lit("…"))).otherwise(flat)


def message(*pieces: Column) -> Column:
    """Pieces on lines of their own; blank ones are left out."""
    return F.concat_ws("\n", *(F.when(has_body(p), stripped(p)) for p in pieces))
