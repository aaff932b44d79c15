"""Stripping, joining, templates and clean-up of model text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def strip_left(text: Column) -> Column:
    return F.ltrim(text, F.lit(WHITESPACE))


def strip_right(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITESPACE))


def contains_ci(text: Column, word: str) -> Column:
    return F.coalesce(F.lower(text).contains(word), F.lit(False))


def key_path(*parts: Column) -> Column:
    return F.concat_ws("_", *parts)


def fill_template(template: str, slots: dict[str, Column]) -> Column:
    """Fill ``{{name}}`` slots of a fixed template.

    The template is split once, so a value that itself holds ``{{...}}`` stays as it is. A name
    without a slot value stays in the text.
    """
    pieces: list[Column] = []
    for index, piece in enumerate(re.split(r"\{\{(\w+)\}\}", template)):
        if index % 2 == 0:
            if piece:
                pieces.append(F.lit(piece))
        elif piece in slots:
            pieces.append(F.coalesce(slots[piece].cast("string"), F.lit("")))
        else:
            pieces.append(F.lit("{{" + piece + "}}"))
    return F.concat(*pieces)


def fill_template_column(template: Column, slots: dict[str, Column]) -> Column:
    """The same for a template held in a column: every slot is replaced in the order given."""
    for name, value in slots.items():
        template = F.replace(template, F.lit("{{" + name + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return template


def strip_code_fences(text: Column) -> Column:
    """Model text without a leading ``json`` on any line, line-end blanks and code fences."""
    lines = F.regexp_replace(strip(text), r"(?m)^json\s*|\s*$", "")
    return strip(F.replace(F.replace(lines, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))
