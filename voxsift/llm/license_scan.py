"""Licence scan: ordered signature rules behind a keyword prefilter, with containment suppression.

A text is brought to lower-case words once. Each keyword is looked for once, and
the rules that share it are tried only where it occurs; a match is an interval of words. A match is suppressed if one of
the same or a better rank contains its interval (equal intervals and ranks: the
earlier rule stays). Sorted by start, that needs no more than the furthest end
of each rank so far, so a text with many matches costs one sort.

All of it is DataFrame expressions on one row: no join, no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .license_rules import BASE, Rule, rules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SCORES = {1: 1.0, 2: 0.8, 3: 0.5}
_NONE = -1


def _let(value: Column, body) -> Column:
    """Bind a value so that the body may use it often and it is computed once."""
    return F.transform(F.array(value), body)[0]


def _intervals(padded: Column, pattern: Column) -> Column:
    """Word intervals [from, upto) of all matches, from marks set around them."""
    marked = F.split(F.regexp_replace(padded, F.concat(F.lit(" ("), pattern, F.lit(")(?= )")), F.lit(" \x01$1\x02")), " ")

    def ends(words: Column) -> Column:
        placed = lambda mark, test: F.filter(
            F.transform(words, lambda word, i: F.when(test(word, F.lit(mark)), i)), lambda i: i.isNotNull()
        )
        return F.arrays_zip(
            placed("\x01", F.startswith).alias("first"), placed("\x02", F.endswith).alias("last")
        )

    # the blank in front makes the first piece empty: word numbers are one less
    return F.transform(_let(marked, ends), lambda x: F.struct((x["first"] - 1).alias("from"), x["last"].alias("upto")))


def _places(padded: Column, phrase: str, label: str) -> Column:
    return F.transform(
        _intervals(padded, F.lit(phrase)), lambda x: F.struct(F.lit(label).alias("label"), x["from"].alias("from"))
    )


def with_matches(docs: DataFrame, text_col: str = "text", table: list[Rule] | None = None) -> DataFrame:
    """Add ``l_words`` (number of words), ``l_base`` and ``l_found``.

    ``l_base`` are the places of the base phrases: (label, from). ``l_found`` are
    all matches before suppression, sorted: (from, upto, rank, rule, label). A null
    text has no words.
    """
    table = rules() if table is None else table
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # lower() folds more letters than A-Z, but no other one to an ASCII letter than these two
    odd = F.contains(text, F.lit("\u212a")) | F.contains(text, F.lit("\u0130"))
    lower = F.when(odd, F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))
    df = docs.withColumn("l_text", F.concat(
        F.lit(" "), F.btrim(F.regexp_replace(lower, _BETWEEN, " "), F.lit(" ")), F.lit(" ")
    ))
    blank = F.col("l_text") == "  "
    n_words = F.length("l_text") - F.length(F.replace("l_text", F.lit(" "), F.lit(""))) - 1
    df = df.withColumn("l_words", F.when(blank, 0).otherwise(n_words).cast("long"))
    phrases = reduce(Column.__or__, (F.contains("l_text", F.lit(f" {phrase} ")) for phrase in BASE))
    places = [_places(F.col("l_text"), phrase, label) for phrase, label in BASE.items()]
    df = df.withColumn("l_base", F.when(phrases, F.concat(*places)))
    groups: dict[str, list[Column]] = {}
    for n, r in enumerate(table):
        groups.setdefault(r.keyword, []).append(F.struct(
            F.lit(n).alias("rule"), F.lit(r.rank).alias("rank"), F.lit(r.label).alias("label"), F.lit(r.pattern).alias("pattern")
        ))
    listed = F.array(*(F.struct(F.lit(keyword).alias("keyword"), F.array(*group).alias("rules")) for keyword, group in groups.items()))
    passed = F.flatten(F.transform(F.filter(listed, lambda g: F.contains("l_text", g["keyword"])), lambda g: g["rules"]))
    found = F.flatten(F.transform(passed, lambda r: F.transform(
        _intervals(F.col("l_text"), r["pattern"]),
        lambda x: F.struct(x["from"].alias("from"), (-x["upto"]).alias("minus_upto"), r["rank"].alias("rank"), r["rule"].alias("rule"), r["label"].alias("label")),
    )))
    df = df.withColumn("l_found", F.array_sort(found) if table else F.lit(None))
    return df.drop("l_text")


def _covered(ends: list[Column], match: Column) -> Column:
    """Whether a match so far, of the same rank or a better one, reaches to this one's end."""
    upto, hidden = -match["minus_upto"], F.lit(False)
    for rank, end in enumerate(ends, 1):
        hidden = hidden | ((match["rank"] >= rank) & (end >= upto))
    return hidden


def _survivors(found: Column) -> Column:
    """(labels of the matches that are not suppressed, their best rank)."""
    start = F.struct(
        *(F.lit(_NONE).alias(f"end{rank}") for rank in (1, 2, 3)),
        F.array().cast("array<string>").alias("labels"), F.lit(9).alias("best"),
    )

    def step(state: Column, match: Column) -> Column:
        hidden = _covered([state[f"end{rank}"] for rank in (1, 2, 3)], match)
        return F.struct(
            *(
                F.when(match["rank"] == rank, F.greatest(state[f"end{rank}"], -match["minus_upto"])).otherwise(state[f"end{rank}"]).alias(f"end{rank}")
                for rank in (1, 2, 3)
            ),
            F.when(hidden, state["labels"]).otherwise(F.array_union(state["labels"], F.array(match["label"]))).alias("labels"),
            F.when(hidden, state["best"]).otherwise(F.least(state["best"], match["rank"])).alias("best"),
        )

    return F.aggregate(found, start, step, lambda state: F.struct(state["labels"].alias("labels"), state["best"].alias("best")))


def scan(docs: DataFrame, table: list[Rule] | None = None) -> DataFrame:
    """Per document: words, base places, labels and a score (that of the best rank left; base places alone count as rank 3).

    Null and empty texts have no words and no labels. Repeated rows stay.
    Columns other than ``doc_id`` and ``text`` are not read.
    """
    df = with_matches(docs.select("doc_id", "text"), "text", table).drop("text")
    df = df.withColumn("l_left", F.when(F.size("l_found") > 0, _survivors(F.col("l_found"))))
    base = F.coalesce(F.array_sort(F.array_distinct(F.transform("l_base", lambda x: x["label"]))), F.array().cast("array<string>"))
    left = F.coalesce(F.col("l_left.labels"), F.array().cast("array<string>"))
    score = F.coalesce(
        *(F.when(F.col("l_left.best") == rank, F.lit(value)) for rank, value in _SCORES.items()),
        F.when(F.size("l_base") > 0, F.lit(_SCORES[3])), F.lit(0.0),
    )
    starts = F.transform("l_base", lambda x: x["from"])
    return df.select(
        "doc_id", F.col("l_words").alias("n_words"), F.coalesce(F.size("l_base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.concat_ws(",", base).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(base, left))).alias("labels"), score.alias("score"),
    )


def spans(docs: DataFrame, table: list[Rule] | None = None) -> DataFrame:
    """The matches that are not suppressed, one row each: doc_id, label, rank, rule, first_word, n_words."""
    df = with_matches(docs.select("doc_id", "text"), "text", table).drop("text")
    row = df.where(F.size("l_found") > 0).withColumn("l_row", F.monotonically_increasing_id())
    each = row.select("doc_id", "l_row", F.posexplode("l_found").alias("l_at", "m"))
    before = Window.partitionBy("l_row").orderBy("l_at").rowsBetween(Window.unboundedPreceding, -1)
    ends = [
        F.coalesce(F.max(F.when(F.col("m.rank") == rank, -F.col("m.minus_upto"))).over(before), F.lit(_NONE)) for rank in (1, 2, 3)
    ]
    return each.withColumn("hidden", _covered(ends, F.col("m"))).where("NOT hidden").select(
        "doc_id", "m.label", "m.rank", "m.rule", F.col("m.from").cast("long").alias("first_word"),
        (-F.col("m.minus_upto") - F.col("m.from")).cast("long").alias("n_words"),
    )
