"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a predicate over measures of the text.  Its cost and the share of
documents that it rejects are estimated on a sample, and rules then run in the
order of rejections per second.  A document that one rule rejects is not looked
at by the later ones, and a measure is only taken when a rule needs it.  The
order decides the work and the reported first reason, never the verdict.

Defined results: a null or empty text has no words and fails ``few_words``;
null ids and repeated rows are judged row by row; an empty table gives an empty
table; columns of the input are carried along, and a column of the input with
the name of a result is replaced by the result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from vigilpay.llm.common import SPACE, pass_through, words

#: Symbols counted by ``n_symbols``.
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def _window_hashes() -> Column:
    nexts = lambda i: [F.get("__words", i + k) for k in range(1, WINDOW)]
    every = F.transform("__words", lambda w, i: F.xxhash64(w, *nexts(i)))
    return F.slice(every, F.lit(1), F.greatest(F.size("__words") - (WINDOW - 1), F.lit(0)))


def _sorted_repeats() -> Column:
    """Window hashes with their places in the order of the hash; null if no window occurs twice."""
    some = F.size(F.array_distinct("__windows")) < F.size("__windows")
    return F.when(some, F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))


def _repeat_starts() -> Column:
    twin = lambda s, j: (
        (F.get("__sorted", j - 1)["h"] == s["h"]) | (F.get("__sorted", j + 1)["h"] == s["h"])
    )
    return F.array_sort(F.array_compact(F.transform("__sorted", lambda s, j: F.when(twin(s, j), s["i"]))))


def _covered() -> Column:
    """Words covered by windows that start at ``__starts``."""
    steps = F.transform(
        "__starts", lambda p, j: F.least(F.coalesce(F.get("__starts", j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
    )
    return F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))


def _lines() -> Column:
    return F.filter(F.split("__text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))


#: Measures in the order in which they may be taken: name, its column, the measures it is made of.
MEASURES: dict[str, tuple[Callable[[], Column], tuple[str, ...]]] = {
    "words": (lambda: words("__text"), ()),
    "n_words": (lambda: F.size("__words").cast("long"), ("words",)),
    "word_chars": (lambda: F.length(F.regexp_replace("__text", f"{SPACE}+", "")).cast("long"), ()),
    "n_symbols": (lambda: F.length(F.regexp_replace("__text", f"[^{SYMBOLS}]+", "")).cast("long"), ()),
    "lines": (_lines, ()),
    "n_lines": (lambda: F.size("__lines").cast("long"), ("lines",)),
    "n_dup_lines": (lambda: (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"), ("lines",)),
    "windows": (_window_hashes, ("words",)),
    "sorted": (_sorted_repeats, ("windows",)),
    "starts": (_repeat_starts, ("sorted",)),
    "n_repeat_words": (_covered, ("starts",)),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """``failed`` is true for documents to reject; ``needs`` names the measures it reads as ``__name``."""

    name: str
    needs: tuple[str, ...]
    failed: Callable[[], Column]


BASE_RULES = (
    Rule("few_words", ("n_words",), lambda: F.col("__n_words") < 10),
    Rule(
        "repeated_windows", ("n_words", "n_repeat_words"),
        lambda: 100 * F.col("__n_repeat_words") > 20 * F.col("__n_words"),
    ),
)
RULES = BASE_RULES + (
    Rule("symbols", ("n_words", "n_symbols"), lambda: 100 * F.col("__n_symbols") > 20 * F.col("__n_words")),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda: 100 * F.col("__n_dup_lines") > 30 * F.col("__n_lines")),
    Rule("short_words", ("n_words", "word_chars"), lambda: F.col("__word_chars") < 2 * F.col("__n_words")),
    Rule("long_words", ("n_words", "word_chars"), lambda: F.col("__word_chars") > 15 * F.col("__n_words")),
)


def _closure(needs: tuple[str, ...]) -> list[str]:
    wanted: set[str] = set()

    def add(name: str) -> None:
        wanted.add(name)
        for part in MEASURES[name][1]:
            add(part)

    for name in needs:
        add(name)
    return [name for name in MEASURES if name in wanted]


def _measure(df: DataFrame, names: list[str], guard: Column | None = None) -> DataFrame:
    for name in names:
        column = MEASURES[name][0]()
        df = df.withColumn(f"__{name}", column if guard is None else F.when(guard, column))
    return df


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))


def order_rules(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", fraction: float = 0.01, rows: int = 1000
) -> list[Rule]:
    """Rules by rejections per second, measured on a sample of at most ``rows`` documents.

    The sample only decides the order of evaluation.
    """
    # the sample is kept in memory of the executors while it is measured; a lost block is read again
    sample = _with_text(docs.select(text), text).sample(fraction, seed=5).limit(rows).select("__text").persist()
    try:
        kept = sample.count()
        if kept == 0:
            return list(rules)
        rates = {}
        for rule in rules:
            failed = _measure(sample, _closure(rule.needs)).select(
                F.sum(F.when(rule.failed(), 1).otherwise(0)).alias("n")
            )
            failed.first()  # pays for planning and compilation
            begin = time.perf_counter()
            rejected = failed.first()["n"] or 0
            rates[rule.name] = (rejected + 0.5) / (time.perf_counter() - begin)
    finally:
        sample.unpersist()
    return sorted(rules, key=lambda rule: -rates[rule.name])


def _settled(name: str) -> Column:
    """The column as it is, in a form that no filter on it moves below the measures.

    The condition never fails, but it is not deterministic.  A filter pushed
    down would take each measure anew wherever the verdict uses it.
    """
    return F.when(F.monotonically_increasing_id() >= 0, F.col(name))


def cascade(docs: DataFrame, ordered: list[Rule], text: str = "text") -> DataFrame:
    """``docs`` with ``rejected_by``: the first rule in the order given that rejects, or null."""
    keep = pass_through(docs, ["rejected_by"])
    df = _with_text(docs, text).withColumn("__rejected", F.lit(None).cast("string"))
    taken: set[str] = set()
    for rule in ordered:
        missing = [m for m in _closure(rule.needs) if m not in taken]
        df = _measure(df, missing, F.col("__rejected").isNull())
        taken.update(missing)
        df = df.withColumn("__rejected", F.coalesce("__rejected", F.when(rule.failed(), F.lit(rule.name))))
    return df.select(*keep, _settled("__rejected").alias("rejected_by"))


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with the columns of the input."""
    judged = cascade(docs, order_rules(docs, rules, text), text)
    return judged.filter(F.col("rejected_by").isNull()).select(*docs.columns)


def quality_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with all counts, ``base_failed``, ``rejected_by`` and ``kept``.

    Every count is taken for every document, so only the predicates are
    short-circuited here.
    """
    own = [*COUNTS, "base_failed", "rejected_by", "kept"]
    df = _measure(_with_text(docs, text), _closure(tuple(COUNTS) + ("n_lines",)))
    verdict = F.lit(None).cast("string")
    for rule in reversed(order_rules(docs, rules, text)):
        verdict = F.when(rule.failed(), F.lit(rule.name)).otherwise(verdict)
    base = F.lit(False)
    for rule in BASE_RULES:
        base = base | rule.failed()
    df = df.withColumn("__rejected", verdict).withColumn("__rejected", _settled("__rejected"))
    return df.select(
        *pass_through(docs, own), *[F.col(f"__{c}").alias(c) for c in COUNTS], base.alias("base_failed"),
        F.col("__rejected").alias("rejected_by"), (~base & F.col("__rejected").isNull()).alias("kept"),
    )
