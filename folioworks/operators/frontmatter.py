"""Read front matter back into columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.functions.text import parse_list_literal, strip_ws, unescape_quotes
from folioworks.operators.filters import has_front_matter

# A double-quoted value with escapes, and the block between the rules.
QUOTED = r'"([^"\\]*(?:\\.[^"\\]*)*)"'
BLOCK = r"(?s)^---\n(.*?)\n---"


def _value(block: Column, key: str) -> Column:
    """A quoted value without its escapes, else the bare rest of the line; null when the key is absent."""
    quoted, bare = rf"(?m)^{key}:[ \t]*{QUOTED}", rf"(?m)^{key}:[ \t]*([^\n]+)"
    return (
        F.when(block.rlike(quoted), unescape_quotes(F.regexp_extract(block, quoted, 1)))
        .when(block.rlike(bare), strip_ws(F.regexp_extract(block, bare, 1)))
    )


def parse_front_matter(
    files: DataFrame, default_author: str, text: str = "text", path: str = "file_path"
) -> DataFrame:
    """``(title, date, author, categories, original_url, file_path)``; files without front matter are dropped."""
    block = F.col("_fm")
    body = F.regexp_extract(block, r"(?m)^categories:\s*\[(.*)\]\s*$", 1)
    return (
        has_front_matter(files, text)
        .withColumn("_fm", F.regexp_extract(text, BLOCK, 1))
        .select(
            F.coalesce(_value(block, "title"), F.lit("Untitled")).alias("title"),
            F.regexp_extract(block, r'(?m)^date:\s*"?(\d{4}-\d{2}-\d{2})', 1).alias("date"),
            F.coalesce(_value(block, "author"), F.lit(default_author)).alias("author"),
            parse_list_literal(body).alias("categories"),
            F.coalesce(_value(block, "original_url"), F.lit("")).alias("original_url"),
            F.col(path).alias("file_path"),
        )
    )
