"""From scanned files to documents: one extractor per file type.

An extractor is a function from the ``path`` and ``text`` columns to the
``title`` and ``content`` columns.  The longest matching suffix wins; files
without one take the fallback.  Extractors for foreign formats may return a
``pandas_udf`` column; the built-in ones are plain expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.html import html_body_text, html_title
from wordloom.sources.files import file_name

Extractor = Callable[[Column, Column], tuple[Column, Column]]


def plain_text(path: Column, text: Column) -> tuple[Column, Column]:
    return file_name(path), text


def html_page(path: Column, text: Column) -> tuple[Column, Column]:
    return html_title(text), html_body_text(text)


DEFAULT_EXTRACTORS: dict[str, Extractor] = {".htm": html_page, ".html": html_page}


def route(path: Column, suffixes, fallback: str = "") -> Column:
    """The suffix whose extractor takes the file, or the fallback's name."""
    name = F.lower(file_name(path))
    chosen = F.lit(fallback)
    for suffix in sorted(suffixes, key=lambda s: (len(s), s)):
        chosen = F.when(F.endswith(name, F.lit(suffix.lower())), F.lit(suffix)).otherwise(chosen)
    return chosen


def extract(
    scan: DataFrame,
    extractors: Mapping[str, Extractor] = DEFAULT_EXTRACTORS,
    fallback: Extractor = plain_text,
) -> DataFrame:
    """Add ``title`` and ``content`` and drop the raw ``text``.

    All routes are one projection, so no file type costs a pass of its own.
    """
    path, text = F.col("path"), F.col("text")
    chosen = route(path, extractors)
    title, content = fallback(path, text)
    by_extractor: dict[Extractor, list[str]] = {}
    for suffix, extractor in extractors.items():
        by_extractor.setdefault(extractor, []).append(suffix)
    for extractor, suffixes in by_extractor.items():
        its_title, its_content = extractor(path, text)
        taken = chosen.isin(*suffixes)
        title = F.when(taken, its_title).otherwise(title)
        content = F.when(taken, its_content).otherwise(content)
    return scan.withColumns({"title": title, "content": content}).drop("text")
