"""Prompt modules as rows: each version's hash, the text of a task, what is missing, and an event's background block."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import date_window, has_body
from .urls import stripped

# Each module in the order of the hash, its tasks, and its place in their text.
MODULES = (
    ("a_role", "content question event", 1),
    ("b_subject", "content question event", 2),
    ("c_tasks", "content", 3),
    ("d_rubric", "content", 4),
    ("e_schema", "content", 5),
    ("f_examples", "content", 6),
    ("g_guardrails", "content question event", 7),
    ("question_tasks", "question", 3),
    ("question_rubric", "question", 4),
    ("question_schema", "question", 5),
    ("question_examples", "question", 6),
    ("event_tasks", "event", 3),
    ("event_rubric", "event", 4),
    ("event_schema", "event", 5),
    ("event_examples", "event", 6),
)
HASH_SIZE = 16
# How JSON writes characters that it can't have in a string; others below a blank by their number.
ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def json_string(text: Column) -> Column:
    """A JSON string; characters beyond ASCII stay as they are."""
    written = ESCAPES | {chr(i): f"\\u{i:04x}" for i in range(32) if chr(i) not in ESCAPES}
    return F.concat(F.lit('"'), reduce(lambda x, c: F.replace(x, F.lit(c), F.lit(written[c])), written, text), F.lit('"'))


def bundles(rows: DataFrame, key: str, order: str) -> DataFrame:
    """(key, bodies): for each prompt version of rows(key, module, body, order) the bodies by module, the last of each."""
    last = rows.groupBy(key, "module").agg(F.max_by(F.coalesce("body", F.lit("")), order).alias("body"))
    return last.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("module", "body"))).alias("bodies"))


def _body(bodies: Column, module: str) -> Column:
    return F.coalesce(F.try_element_at(bodies, F.lit(module)), F.lit(""))


def prompt_hash(bodies: Column) -> Column:
    """The version's name: of all modules in their order, missing ones empty, whatever the order of the rows was."""
    parts = [F.concat(F.lit(f'"{m}": '), json_string(_body(bodies, m))) for m, *_ in MODULES]
    return F.left(F.sha2(F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")), 256), F.lit(HASH_SIZE))


def modules_of(task: str | None = None) -> list[str]:
    """The modules of a task in the order of its text, or all; an unknown task is an error."""
    known = {t for _, tasks, _ in MODULES for t in tasks.split()}
    if task is not None and task not in known:
        raise ValueError(f"no task {task!r}; one of {sorted(known)}")
    return [m for m, *_ in MODULES] if task is None else [m for m, tasks, _ in sorted(MODULES, key=lambda x: x[2]) if task in tasks.split()]


def assemble(bodies: Column, task: str) -> Column:
    """One task's modules, trimmed, blank ones left out, with a blank line between."""
    return F.concat_ws("\n\n", *(F.when(has_body(_body(bodies, m)), stripped(_body(bodies, m))) for m in modules_of(task)))


def missing_modules(bodies: Column, task: str | None = None) -> Column:
    """Blank modules of a task, or of all, in order."""
    return F.filter(F.array(*(F.when(~has_body(_body(bodies, m)), F.lit(m)) for m in modules_of(task))), lambda m: m.isNotNull())


def event_background(name: Column, summary: Column, start: Column, end: Column, keywords: Column, captions: tuple[str, str, str], cautions: tuple[str, str]) -> Column:
    """An event's block of a prompt: caption, name, summary, the time with its caution, the keywords with theirs; parts that are absent are left out."""
    window = date_window(start, end)
    words = F.size(F.coalesce(keywords, F.array().cast("array<string>"))) > 0
    parts = [F.lit(captions[0]), F.when(has_body(name), stripped(name)), stripped(summary), F.when(window.isNotNull(), F.concat_ws("\n", F.lit(captions[1]), window, F.lit(cautions[0]))), F.when(words, F.concat_ws("\n", F.lit(captions[2]), F.array_join(keywords, "、"), F.lit(cautions[1])))]
    return F.concat_ws("\n", *parts)
