"""Quality rules: a table of thresholds compiled into one projection.

Every rule bounds a ratio of a document from below or above: length, symbols, stop words, lines.
The table is data (``RULES`` by default) and becomes one boolean expression over measured columns,
all of it built-in functions; the projection also tells which rules a document breaks.

Words are runs of characters other than the six ASCII white space characters.  Repeated passages are
windows of eight words found twice or more in a document; windows are compared by 64-bit hashes, so
that two different windows of one document agree by chance once in about 10**11 documents of 20,000
words.  All measures cover whole texts.

Defined results: a null or empty text has zero for every count and fails the base rules; null keys
stay null; repeated rows are judged one by one; an empty table gives an empty table; other columns
are ignored by ``quality_rules`` and kept by ``passing``.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """A document passes if ``low <= measure <= high``; None is no bound."""

    name: str
    measure: str
    low: float | None
    high: float | None


#: Frequent words of four languages.
STOP_WORDS = (
    "a an and are as at be but by for from have in is it not of on or that the this to was were what which with you "
    "au aux avec ce dans de des du elle en est et il la le les ne nous ou par pas pour que qui se sur un une vous "
    "als am an auch auf aus bei das dem den der des die durch ein eine einer er es für im in ist mit nicht sich sie sind "
    "um und von war wie zu zum zur "
    "al como con de del el ella en es esta la las lo los más no o para pero por que se sin son su un una y"
).split()

#: The rules of production.  Ratios are per word, per letter or per line, as their names say.
RULES = (
    Rule("too_short", "n_words", 20, None),
    Rule("repeated", "repeat_share", None, 0.3),
    Rule("long_words", "word_length", 1.5, 25),
    Rule("symbols", "symbols_per_word", None, 0.25),
    Rule("shouting", "upper_share", None, 0.6),
    Rule("no_stop_words", "stop_share", 0.02, None),
    Rule("line_copies", "dup_line_share", None, 0.5),
)

#: The base rules, which alone make ``base_failed``.
BASE = ("too_short", "repeated")

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "repeat_share", "word_length", "symbols_per_word", "upper_share", "stop_share", "dup_line_share",
)

_WINDOW = 8


def compiled(rules: tuple[Rule, ...], measure: dict[str, Column]) -> list[Column]:
    """One expression per rule: true where the document breaks it."""
    out = []
    for rule in rules:
        value, broken = measure[rule.measure], F.lit(False)
        if rule.low is not None:
            broken = broken | (value < rule.low)
        if rule.high is not None:
            broken = broken | (value > rule.high)
        out.append(broken)
    return out


def _measured(df: DataFrame, text: Column, tag: str) -> tuple[DataFrame, dict[str, Column]]:
    """The table with helper columns under names that begin with ``tag``, and the measures over them."""
    name = lambda x: f"{tag}{x}"
    col = lambda x: F.col(name(x))
    body = F.coalesce(text.cast("string"), F.lit(""))
    df = df.withColumn(name("words"), F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    df = df.withColumn(name("lines"), F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    words = col("words")
    windows = F.when(
        F.size(words) >= _WINDOW,
        F.transform(F.sequence(F.lit(1), F.size(words) - (_WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, _WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(name("windows"), windows)
    # Few documents repeat a window; only those sort theirs.
    pairs = F.when(
        F.size(F.array_distinct(name("windows"))) < F.size(name("windows")),
        F.sort_array(F.transform(name("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    df = df.withColumn(name("pairs"), pairs)
    pairs = col("pairs")
    twice = F.filter(
        pairs,
        lambda x, k: ((k > 0) & (F.get(pairs, k - 1)["h"] == x["h"])) | F.coalesce(F.get(pairs, k + 1)["h"] == x["h"], F.lit(False)),
    )
    df = df.withColumn(name("begins"), F.sort_array(F.transform(twice, lambda x: x["i"])))
    begins = col("begins")
    covered = F.aggregate(
        F.transform(begins, lambda b, k: F.when(k == 0, _WINDOW).otherwise(F.least(F.lit(_WINDOW), b - F.get(begins, k - 1)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    joined = F.array_join(words, "")
    letters = F.regexp_replace(joined, r"\P{L}+", "")
    stops = F.size(F.filter(words, lambda w: F.lower(F.regexp_replace(w, r"[.,;:!?]+$", "")).isin(STOP_WORDS)))
    df = df.select(
        "*",
        F.size(words).cast("long").alias(name("n_words")),
        F.length(joined).cast("long").alias(name("word_chars")),
        (F.length(body) - F.length(F.regexp_replace(body, r"[#*$%&|<>]", ""))).cast("long").alias(name("n_symbols")),
        (F.size(name("lines")) - F.size(F.array_distinct(name("lines")))).cast("long").alias(name("n_dup_lines")),
        covered.cast("long").alias(name("n_repeat_words")),
        F.size(name("lines")).alias(name("n_lines")),
        F.length(letters).alias(name("n_letters")),
        F.length(F.regexp_replace(letters, r"\P{Lu}+", "")).alias(name("n_upper")),
        stops.alias(name("n_stops")),
    ).drop(*map(name, ("words", "lines", "windows", "pairs", "begins")))
    per = lambda a, b: F.coalesce(F.try_divide(col(a).cast("double"), col(b)), F.lit(0.0))
    measure = {x: col(x) for x in MEASURES[:5]} | {
        "repeat_share": per("n_repeat_words", "n_words"),
        "word_length": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "upper_share": per("n_upper", "n_letters"),
        "stop_share": per("n_stops", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
    }
    return df, measure


def _verdict(measure: dict[str, Column], rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    base = (measure["n_words"] < 20) | (100 * measure["n_repeat_words"] > 30 * measure["n_words"])
    broken = base
    for condition in compiled(tuple(r for r in rules if r.name not in BASE), measure):
        broken = broken | condition
    return base, ~broken


def quality_rules(df: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, all measures, ``base_failed``, ``kept`` and ``broken`` (names of the rules) of every row."""
    df = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    df, measure = _measured(df, F.col("text"), "_")
    base, kept = _verdict(measure, rules)
    names = [F.when(broken, F.lit(rule.name)) for rule, broken in zip(rules, compiled(rules, measure))]
    return df.select(
        "doc_id", *(measure[x].alias(x) for x in MEASURES), base.alias("base_failed"), kept.alias("kept"),
        F.filter(F.array(*names), lambda x: x.isNotNull()).alias("broken"),
    )


def passing(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that the rules keep, with all their columns."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    tag = f"_{uuid.uuid4().hex[:8]}_"
    marked, measure = _measured(df, F.col(f"`{text}`"), tag)
    # A condition is not pushed below a column that is not deterministic.  Pushed down, it would hold
    # the measures' definitions put into one another and work them out for every element.
    marked = marked.withColumn(f"{tag}row", F.monotonically_increasing_id())
    return marked.where(_verdict(measure, rules)[1] & (F.col(f"{tag}row") >= 0)).select(*columns)
