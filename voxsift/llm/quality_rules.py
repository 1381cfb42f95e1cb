"""Quality rules whose thresholds are drawn from quantile sketches per language and source.

One pass takes the measures of every whole text and stores them. Mergeable
(KLL) sketches of each measure are built per language and source, and merged
again into one per language and one for all: a group with few documents falls
back to those. A document is rejected if a measure lies above the fence

    q75 + max(margin, SPREAD * (q75 - q25))

of its group, so the cutoffs move with what is usual there, while the margin
keeps groups without any spread from rejecting ordinary documents. The small
table of fences is stored as well, since sketches of large groups are drawn at
random, and joined to the measures.

Everything is DataFrame expressions. Sketches are combined before the shuffle,
so a hot source costs one sketch a task; the join is salted, so a hot source is
spread when the fences are too many to be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.staging import stage

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
SKETCH_K = 4096
RANK_ERROR = 0.002  # of a quantile's rank, by a sketch that holds fewer values than it has seen; smaller groups are exact
LEAST_ROWS = 30  # documents a group needs for fences of its own
SPREAD = 3.0
SALTS = 32

#: Measure: the least distance of its fence from q75.
MARGINS = {
    "symbol_share": 0.10,
    "dup_line_share": 0.40,
    "repeat_share": 0.15,
    "capital_share": 0.20,
}


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``q`` to each row: a struct of the counts and shares of its whole text; a null text has no words.

    n_repeat_words counts the words in windows of five words that occur twice
    or more. Hashes tell first whether any window can occur twice; only then
    the windows themselves are sorted and compared.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    space = f"[{SPACE}]+"
    trimmed = F.btrim(text, F.lit(SPACE))
    df = docs.withColumn("q_words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, space)))
    df = df.withColumn("q_hashes", F.transform("q_words", lambda word: F.xxhash64(word)))
    df = df.withColumn("q_n", F.size("q_words"))
    at = lambda name, i: F.get(F.col(name), i)
    df = df.withColumn("q_windows", F.slice(
        F.transform("q_hashes", lambda h, i: F.xxhash64(h, *(at("q_hashes", i + k) for k in range(1, WINDOW)))),
        F.lit(1), F.greatest(F.lit(0), F.col("q_n") - (WINDOW - 1)),
    ))
    df = df.withColumn("q_sorted", F.when(
        F.size(F.array_distinct("q_windows")) < F.size("q_windows"),
        F.array_sort(F.transform(
            F.sequence(F.lit(1), F.col("q_n") - (WINDOW - 1)),
            lambda i: F.struct(F.concat_ws(" ", F.slice("q_words", i, WINDOW)).alias("window"), i.alias("i")),
        )),
    ))
    same = lambda x, i: F.coalesce(x["window"] == F.get(F.col("q_sorted"), i)["window"], F.lit(False))
    df = df.withColumn("q_starts", F.array_sort(F.transform(
        F.filter("q_sorted", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]
    )))
    covered = F.aggregate(
        "q_starts", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    df = df.withColumn("q_lines", lines)
    n_words, word_chars = F.col("q_n").cast("long"), F.length(F.regexp_replace(text, space, "")).cast("long")
    n_symbols = (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")
    n_dup_lines = (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long")
    n_repeat = F.coalesce(covered, F.lit(0)).cast("long")
    df = df.withColumn("q", F.struct(
        n_words.alias("n_words"), word_chars.alias("word_chars"), n_symbols.alias("n_symbols"),
        n_dup_lines.alias("n_dup_lines"), n_repeat.alias("n_repeat_words"),
        F.size("q_lines").cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
    ))
    df = df.withColumn("q", F.struct(
        "q.*",
        ((F.col("q.n_words") < 10) | (100 * F.col("q.n_repeat_words") > 20 * F.col("q.n_words"))).alias("base_failed"),
        F.struct(
            _share(F.col("q.n_symbols"), F.col("q.n_words")).alias("symbol_share"),
            _share(F.col("q.n_dup_lines"), F.col("q.n_lines")).alias("dup_line_share"),
            _share(F.col("q.n_repeat_words"), F.col("q.n_words")).alias("repeat_share"),
            _share(F.col("q.n_capitals"), F.col("q.word_chars")).alias("capital_share"),
        ).alias("shares"),
    ))
    return df.drop("q_words", "q_hashes", "q_n", "q_windows", "q_sorted", "q_starts", "q_lines")


def fences(measured: DataFrame) -> DataFrame:
    """Per language and source (columns ``q_lang``, ``q_source``): the fence of each measure.

    Only documents that pass the base rules are sketched. A null language or
    source is a group like any other.
    """
    names = list(MARGINS)
    sketched = measured.where(~F.col("q.base_failed")).groupBy("q_lang", "q_source").agg(
        *(F.kll_sketch_agg_double(F.col("q.shares")[n], F.lit(SKETCH_K)).alias(n) for n in names)
    )
    merged = lambda df: [F.kll_merge_agg_double(n).alias(n) for n in names]

    def rows(n_rows: Column, sketches: str) -> Column:
        return F.when(n_rows >= LEAST_ROWS, F.col(sketches))

    sketched = stage(sketched, "sketches")
    groups = measured.select("q_lang", "q_source").distinct()
    own = sketched.select("q_lang", "q_source", F.struct(*names).alias("own"))
    of_lang = sketched.groupBy("q_lang").agg(*merged(sketched)).select("q_lang", F.struct(*names).alias("of_lang"))
    # one row; without a passing document nothing is merged, and only the base rules decide
    of_all = sketched.agg(F.count("*").alias("groups"), *merged(sketched)).select(F.when(F.col("groups") > 0, F.struct(*names)).alias("of_all"))
    joined = (
        groups.alias("g")
        .join(own.alias("o"), F.col("g.q_lang").eqNullSafe(F.col("o.q_lang")) & F.col("g.q_source").eqNullSafe(F.col("o.q_source")), "left")
        .join(of_lang.alias("l"), F.col("g.q_lang").eqNullSafe(F.col("l.q_lang")), "left")
        .crossJoin(F.broadcast(of_all))  # a single row
        .select("g.q_lang", "g.q_source", "own", "of_lang", "of_all")
    )
    size = lambda name: F.coalesce(F.kll_sketch_get_n_double(F.col(name)[names[0]]), F.lit(0))
    chosen = F.when(size("own") >= LEAST_ROWS, F.col("own")).when(size("of_lang") >= LEAST_ROWS, F.col("of_lang")).otherwise(F.col("of_all"))
    joined = joined.withColumn("chosen", chosen)
    quantile = lambda n, q: F.kll_sketch_get_quantile_double(F.col("chosen")[n], F.lit(q))
    fence = lambda n: quantile(n, 0.75) + F.greatest(F.lit(MARGINS[n]), F.lit(SPREAD) * (quantile(n, 0.75) - quantile(n, 0.25)))
    return joined.select("q_lang", "q_source", F.struct(*(fence(n).alias(n) for n in names)).alias("q_fence"))


def judge(measured: DataFrame) -> DataFrame:
    """Add ``kept``: false for what the base rules or the fences reject. Rows and columns stay otherwise.

    ``measured`` is a stored table with ``q``, ``q_lang`` and ``q_source``.
    """
    limits = stage(fences(measured), "fences").withColumn("q_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = measured.withColumn("q_salt", F.pmod(F.xxhash64("q"), F.lit(SALTS)).cast("int")).alias("d")
    joined = salted.join(
        limits.alias("f"),
        F.col("d.q_lang").eqNullSafe(F.col("f.q_lang")) & F.col("d.q_source").eqNullSafe(F.col("f.q_source"))
        & (F.col("d.q_salt") == F.col("f.q_salt")),
        "left",
    )
    above = F.lit(False)
    for name in MARGINS:
        above = above | F.coalesce(F.col("d.q.shares")[name] > F.col("f.q_fence")[name], F.lit(False))
    return joined.select("d.*", (~F.col("d.q.base_failed") & ~above).alias("q_kept")).drop("q_salt", "q_lang", "q_source")


def quality(docs: DataFrame) -> DataFrame:
    """Per document its counts and the verdict ``kept``. Repeated rows stay; an empty table gives an empty one."""
    narrow = docs.select("doc_id", "text", F.col("lang").alias("q_lang"), F.col("source").alias("q_source"))
    measured = stage(with_measures(narrow).drop("text"), "measures")
    return judge(measured).select(
        "doc_id", *(f"q.{n}" for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")),
        F.col("q_kept").alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that pass, with all their columns."""
    names = docs.columns
    held = docs.select(
        F.struct(*names).alias("q_row"), F.col("text"), F.col("lang").alias("q_lang"), F.col("source").alias("q_source")
    )
    measured = stage(with_measures(held).drop("text"), "measures")
    return judge(measured).where("q_kept").select("q_row.*")


def _fence_sql() -> str:
    """Fences as long as no sketch has more than SKETCH_K values, so that it is exact."""
    quantiles = ", ".join(
        f"quantile_disc({name}, 0.25) FILTER (NOT base_failed) AS {name}_25, quantile_disc({name}, 0.75) FILTER (NOT base_failed) AS {name}_75"
        for name in MARGINS
    )
    tables = [("own", "lang, source"), ("of_lang", "lang"), ("of_all", "")]
    parts = ", ".join(
        f"{name} AS (SELECT {keys + ',' if keys else ''} count(*) FILTER (NOT base_failed) AS n, {quantiles} FROM m {'GROUP BY ' + keys if keys else ''})"
        for name, keys in tables
    )

    def value(name: str) -> str:
        return f"CASE WHEN own.n >= {LEAST_ROWS} THEN own.{name} WHEN of_lang.n >= {LEAST_ROWS} THEN of_lang.{name} ELSE of_all.{name} END"

    tests = " OR ".join(
        f"coalesce({name} > {value(name + '_75')} + greatest({margin}::DOUBLE, {SPREAD}::DOUBLE * ({value(name + '_75')} - {value(name + '_25')})), false)"
        for name, margin in MARGINS.items()
    )
    return f"""{parts}
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({tests}) AS kept
FROM m JOIN own ON m.lang IS NOT DISTINCT FROM own.lang AND m.source IS NOT DISTINCT FROM own.source
JOIN of_lang ON m.lang IS NOT DISTINCT FROM of_lang.lang CROSS JOIN of_all
"""


STATEMENT = r"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (
  SELECT *, list_transform(range(greatest(0, len(words) - 4)), lambda i: array_to_string(words[i + 1:i + 5], ' ')) AS windows FROM d),
o AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n
  FROM (SELECT doc_id, unnest(windows) AS win, unnest(range(len(windows))) AS i FROM w)),
r AS (
  SELECT doc_id, sum(least(5, coalesce(i - before, 5)))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM o WHERE n > 1) GROUP BY doc_id),
c AS (
  SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words, len(lines)::BIGINT AS n_lines,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(regexp_extract_all(text, '\p{Lu}'))::BIGINT AS n_capitals
  FROM w LEFT JOIN r USING (doc_id)),
m AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0::DOUBLE END AS symbol_share,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0::DOUBLE END AS dup_line_share,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0::DOUBLE END AS repeat_share,
    CASE WHEN word_chars > 0 THEN n_capitals / word_chars ELSE 0.0::DOUBLE END AS capital_share
  FROM c),
""" + _fence_sql()
