"""Text expressions over titles and HTML bodies.

Null in, null out. Counts are in characters, markup included.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and markers that define the features.
CODE_OPEN = "<code"
CODE_CLOSE = "</code>"
IMAGE_OPEN = "<img"
QUESTION_MARK = "?"
QUESTION_PREFIX = "wh"
HTML_TAG = "<[^>]*>"
CODE_BLOCK = "(?s)<code.*?</code>"
NEW_LINE = "\n"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def count_marker(text, marker: str) -> Column:
    """How often ``marker`` occurs, without overlaps."""
    body = _col(text)
    removed = F.length(body) - F.length(F.replace(body, F.lit(marker), F.lit("")))
    return (removed / F.lit(len(marker))).cast("int")


def span_length(text, opening: str = CODE_OPEN, closing: str = CODE_CLOSE) -> Column:
    """Characters from each ``opening`` up to its ``closing``, summed.

    The rest of the opening tag counts, so ``<code>abc</code>`` gives 4. A span
    without a ``closing`` runs to the next ``opening`` or the end.
    """
    parts = F.split(_col(text), rf"\Q{opening}\E", -1)
    spans = F.transform(
        F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))),
        lambda part: F.substring_index(part, closing, 1),
    )
    return F.length(F.array_join(spans, ""))


def ends_with(text, mark: str = QUESTION_MARK) -> Column:
    return F.endswith(_col(text), F.lit(mark))


def begins_with(text, prefix: str = QUESTION_PREFIX) -> Column:
    return F.lower(F.substring(_col(text), 1, len(prefix))) == prefix


def strip_html(text) -> Column:
    return F.regexp_replace(_col(text), HTML_TAG, "")


def strip_code(text) -> Column:
    """Remove code blocks one by one; text between two blocks stays."""
    return F.regexp_replace(_col(text), CODE_BLOCK, "")


def strip_newlines(text) -> Column:
    return F.replace(_col(text), F.lit(NEW_LINE), F.lit(""))
