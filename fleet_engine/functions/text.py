"""Text as columns: tokens, sentences, blocks, mark-up. All run inside the JVM, on whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: str | Column) -> Column:
    """Lower-case words and numbers of any script, in order."""
    return F.array_remove(F.split(F.lower(_col(text)), "[^\\p{L}\\p{N}]+"), "")


def _pieces(text: Column, pattern: str) -> Column:
    return F.array_remove(F.transform(F.split(text, pattern), lambda s: F.trim(s)), "")


def explode_each(df: DataFrame, keep: list[str], array: Column, value: str, index: str | None = None) -> DataFrame:
    """One row per array element with its position from 0; empty and NULL arrays give none.

    The outer form with a filter behind it matters: for the inner form Spark adds a filter on the size of the array below
    the explode, which computes the whole array a second time.
    """
    if index is None:
        return df.select(*keep, F.explode_outer(array).alias(value)).filter(F.col(value).isNotNull())
    rows = df.select(*keep, F.posexplode_outer(array).alias(index, value))
    return rows.filter(F.col(index).isNotNull())


def sentences(text: str | Column) -> Column:
    """Trimmed sentences, split at full stops and line ends."""
    return _pieces(_col(text), "[.\\n]+")


def text_blocks(text: str | Column) -> Column:
    """Layout blocks of plain text: its non-empty lines."""
    return _pieces(F.regexp_replace(_col(text), "\\r", "\n"), "\\n+")


# Elements whose content is not text, elements that end a block, named entities.
HIDDEN_ELEMENTS = ["script", "style", "noscript", "template"]
BLOCK_ELEMENTS = ["address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "figure",
                  "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main",
                  "nav", "ol", "p", "pre", "section", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr",
                  "ul"]
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&amp;", "&")]


def html_blocks(html: str | Column) -> Column:
    """Layout blocks of a page: hidden elements and comments dropped, block tags split, other tags removed."""
    text = F.regexp_replace(_col(html), "(?s)<!--.*?-->", " ")
    for name in HIDDEN_ELEMENTS:
        text = F.regexp_replace(text, f"(?is)<{name}\\b.*?</{name}\\s*>", " ")
    text = F.regexp_replace(text, "[\\r\\n]+", " ")
    text = F.regexp_replace(text, f"(?i)</?(?:{'|'.join(BLOCK_ELEMENTS)})\\b[^>]*>", "\n")
    text = F.regexp_replace(text, "<[^>]*>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return _pieces(text, "\\n+")


def token_estimate(text: str | Column) -> Column:
    """Cost estimate: one token per four characters, rounded down."""
    return F.floor(F.length(_col(text)) / 4).cast("long")


def like_escape(text: str | Column) -> Column:
    """Escape user text for a LIKE pattern with backslash as the escape character."""
    out = F.replace(_col(text), F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("%"), F.lit("\\%"))
    return F.replace(out, F.lit("_"), F.lit("\\_"))


def vin_from_filename(path: str | Column, default: str | None = None) -> Column:
    """The part of the file name before its first underscore; ``default`` replaces names without one."""
    name = F.element_at(F.split(_col(path), "/"), -1)
    head = F.split_part(name, F.lit("_"), F.lit(1))
    return head if default is None else F.when(F.contains(name, F.lit("_")), head).otherwise(F.lit(default))


def mask_tail(col: str | Column, n: int = 4, prefix: str = "***-***-") -> Column:
    """Keep the last ``n`` characters behind a constant prefix."""
    return F.concat(F.lit(prefix), F.right(_col(col), F.lit(n)))
