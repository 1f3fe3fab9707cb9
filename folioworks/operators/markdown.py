"""HTML to Markdown: the conversion runs in Arrow batches, the spacing rules on the JVM."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.functions.text import col_, strip_ws
from folioworks.operators.htmltree import parse, to_markdown


# The spacing rules of the contract.
def space_text(c: Column | str) -> Column:
    """Blank line before numbered and bulleted items and around a lone ``OR``; never two blank lines."""
    out = col_(c)
    for pattern, into in (
        (r"\n{3,}", "\n\n"),
        (r"(\n)(\d+\.\s)", "$1\n$2"),
        (r"(\n)(-\s)", "$1\n$2"),
        (r"(\n)(OR)(\n)", "$1\n$2\n$3"),
        (r"\n{3,}", "\n\n"),
    ):
        out = F.regexp_replace(out, pattern, into)
    return strip_ws(out)


def space_blocks(c: Column | str) -> Column:
    """Apply the spacing rules to a ``struct<text, spaced>``; missing content becomes ``""``."""
    md = col_(c)
    return F.coalesce(F.when(md["spaced"], space_text(md["text"])).otherwise(md["text"]), F.lit(""))


def markdown_of(html: Column | str, mode: str = "paragraphs_first") -> Column:
    """``paragraphs_first``: paragraph texts, then the rest converted; ``document_order``: all in place. A page
    that cannot be converted gives null."""
    if mode not in ("paragraphs_first", "document_order"):
        raise ValueError(f"unknown mode {mode!r}")
    first = mode == "paragraphs_first"
    kind = pa.struct([("text", pa.string()), ("spaced", pa.bool_())])

    @F.arrow_udf("text string, spaced boolean")
    def run(sources: pa.Array) -> pa.Array:
        sys.setrecursionlimit(50_000)
        rows = []
        for source in sources:
            try:
                rows.append(dict(zip(("text", "spaced"), to_markdown(parse(source.as_py() or ""), first))))
            except Exception:  # one bad page must not fail the batch; RecursionError is the likely one
                rows.append(None)
        return pa.array(rows, type=kind)

    return run.asNondeterministic()(col_(html))


def html_to_markdown(df: DataFrame, col: str, out: str = "markdown", mode: str = "paragraphs_first") -> DataFrame:
    """Add ``out`` with the Markdown of the HTML in ``col``: ``""`` for a missing source, null for one that cannot be converted."""
    staged = df.withColumn(out, markdown_of(col, mode))
    return staged.withColumn(out, F.when(F.col(out).isNotNull(), space_blocks(out)))
