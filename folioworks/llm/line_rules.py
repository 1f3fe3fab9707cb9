"""Cross-document line frequency, with DataFrame functions only.

Normalised lines are hashed and counted per host over distinct texts, so that copies of one document do not make its
lines look like boilerplate. Lines in more texts of a host than the limit go, and a document that loses most of
its words with them is rejected. Rules on the text itself (word count, repeated word windows) come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.llm.common import words_of
from folioworks.session import materialise

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
WINDOW = 5
# A line is boilerplate in a host if it stands in more than this share of its texts, and in more than so many.
LINE_SHARE = 0.05
LINE_LEAST = 20
# A document must keep this share of its words.
KEPT_SHARE = 0.3


def normalised(line: Column) -> Column:
    """Lower case, digits alike, spaces squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), r"[\x20\x09-\x0D]+", " "))


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)


def text_rules(documents: DataFrame, text: str) -> DataFrame:
    """``documents`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and ``base_failed``.

    Repeated windows of five words: window hashes are sorted with their places, equal neighbours mark places, and the
    union of the marked windows is added up in order of place, so the work stays near linear in the text.
    """
    bare = F.coalesce(F.col(text), F.lit(""))
    lines = _lines(F.col(text))
    first = documents.withColumns({
        "_hashes": F.transform(words_of(text), lambda w: F.xxhash64(w)),
        "word_chars": F.length(F.translate(bare, SPACES, "")).cast("bigint"),
        "n_symbols": (F.length(bare) - F.length(F.translate(bare, SYMBOLS, ""))).cast("bigint"),
        "_lines": lines,
    })
    first = first.withColumns({
        "n_words": F.size("_hashes").cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        # Window hash and place, sorted: equal windows stand side by side.
        "_sorted": F.when(F.size("_hashes") >= WINDOW, F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
            lambda i: F.struct(F.xxhash64(*(F.get("_hashes", i + j) for j in range(WINDOW))).alias("h"), i.alias("i")),
        ))),
    })
    twice = F.filter(
        F.col("_sorted"),
        lambda x, j: (F.get("_sorted", j + 1)["h"] == x["h"]) | ((j > 0) & (F.get("_sorted", j - 1)["h"] == x["h"])),
    )
    second = first.withColumn("_places", F.sort_array(F.transform(twice, lambda x: x["i"])))
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
    union = F.aggregate(
        F.coalesce("_places", F.array().cast("array<int>")), begin,
        lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n")),
    )
    third = second.withColumn("n_repeat_words", union["n"])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return third.withColumn("base_failed", failed).drop("_hashes", "_lines", "_sorted", "_places")


def frequent_lines(documents: DataFrame, key: str, host: str, text: str, share: float, least: int) -> tuple[DataFrame, DataFrame]:
    """(``unit, line, n_words`` of every line of every text per host, ``line`` hashes above the limit).

    ``unit`` is a hash of host and text, ``line`` of host and normalised line. Documents of one host with equal texts have the same
    lines, so a task combines them to one unit before the exchange, and a line counts the documents of its units. Units are
    written with their numbers of documents, so that Spark can split one that very many lines belong to; a host
    with a third of all rows is spread by line.
    """
    unit = F.xxhash64(F.lit("unit"), documents[host], documents[text])
    exploded = documents.select(
        documents[host].alias("_host"), unit.alias("unit"), F.posexplode(_lines(documents[text])).alias("place", "_line")
    )
    rows = exploded.select(
        "unit", F.xxhash64(F.lit("line"), "_host", normalised(F.col("_line"))).alias("line"), "place",
        F.size(words_of("_line")).cast("int").alias("n_words"), F.xxhash64("_host").alias("host"),
    )
    # One row per line and unit: copies of a unit have the same line at the same place.
    placed = rows.groupBy("unit", "line", "host", "place").agg(F.max("n_words").alias("n_words"))
    lines = materialise(placed.groupBy("unit", "line", "host").agg(F.sum("n_words").alias("n_words")), "lines")
    texts = documents.select(F.xxhash64(documents[host]).alias("host"), unit.alias("unit"), documents[key].alias("_key")).distinct()
    units = materialise(texts.groupBy("host", "unit").agg(F.count(F.lit(1)).alias("docs")), "units")
    limits = units.groupBy("host").agg(F.greatest(F.lit(least), F.floor(F.sum("docs") * share)).alias("limit"))
    limits = materialise(limits, "line-limits")
    counts = lines.join(units.select("unit", "docs"), "unit").groupBy("line", "host").agg(F.sum("docs").alias("docs"))
    counts = materialise(counts.where(F.col("docs") > least), "line-counts")
    return lines, materialise(counts.join(limits, "host").where("docs > limit").select("line"), "frequent-lines")


def line_verdicts(
    documents: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text",
    share: float = LINE_SHARE, least: int = LINE_LEAST, kept_share: float = KEPT_SHARE,
) -> DataFrame:
    """One row per input row: ``key``, the text rules, ``n_line_words`` (words in lines above the limit) and ``kept``.

    A line's documents are the distinct keys of its host; rows that repeat key and text are one, and all rows without a key that share
    a text are. A null text has no words and fails the text rules, as does an empty one. A null host is a host. Rows that
    repeat host and text get the same verdict. A line that a text repeats counts once for the text; its words count each
    time they are removed. An empty table gives no rows.
    """
    source = documents.select(documents[key].alias(key), documents[host].alias("_host"), documents[text].alias("_text"))
    lines, frequent = frequent_lines(source, key, "_host", "_text", share, least)
    gone = lines.join(frequent, "line", "left_semi")
    return _judged(source, gone, key, kept_share)


def _judged(source: DataFrame, gone: DataFrame, key: str, kept_share: float) -> DataFrame:
    removed = materialise(gone.groupBy("unit").agg(F.sum("n_words").alias("_gone")), "removed-words")
    rated = text_rules(source, "_text").withColumn("unit", F.xxhash64(F.lit("unit"), "_host", "_text")).drop("_text", "_host")
    joined = rated.join(removed, "unit", "left").withColumn("n_line_words", F.coalesce("_gone", F.lit(0)))
    enough = F.col("n_words") - F.col("n_line_words") >= kept_share * F.col("n_words")
    return joined.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & enough).alias("kept"), "n_line_words",
    )


def without_frequent_lines(
    documents: DataFrame, host: str = "source", text: str = "text", share: float = LINE_SHARE, least: int = LINE_LEAST,
    key: str = "doc_id",
) -> DataFrame:
    """``documents``, all rows and columns, the text without its lines above the limit. Nulls and repeats: as in
    :func:`line_verdicts`; a null text stays null."""
    names = documents.columns
    inner = documents.select(*(documents[c].alias(f"c{i}") for i, c in enumerate(names)))
    h, t, k = (f"c{names.index(c)}" for c in (host, text, key))
    lines, frequent = frequent_lines(inner, k, h, t, share, least)
    gone = lines.join(frequent, "line", "left_semi").groupBy("unit").agg(F.collect_list("line").alias("_gone"))
    marked = inner.withColumn("unit", F.xxhash64(F.lit("unit"), h, t)).join(gone, "unit", "left")
    kept = F.filter(F.split(t, "\n"), lambda line: ~F.array_contains("_gone", F.xxhash64(F.lit("line"), F.col(h), normalised(line))))
    shorter = F.when(F.col("_gone").isNull(), F.col(t)).otherwise(F.concat_ws("\n", kept))
    return marked.withColumn(t, shorter).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
