"""Text expressions. HTML unescaping is the only one that needs Python."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: code points that count as white space at a text end.
WHITESPACE = "".join(
    map(
        chr,
        [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760]
        + [*range(8192, 8203), 8232, 8233, 8239, 8287, 12288],
    )
)


def strip_text(text: Column) -> Column:
    """Drop white space of any kind at both ends (``trim`` drops spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def left_strip_chars(text: Column, n: int) -> Column:
    """Drop the first ``n`` characters."""
    return F.substr(text, F.lit(n + 1))


def right_strip_chars(text: Column, n: int) -> Column:
    """Drop the last ``n`` characters."""
    return F.left(text, F.greatest(F.length(text) - n, F.lit(0)))


def split_item(text: Column, sep: str, index: int) -> Column:
    """The ``index``-th part (0-based) of a text split on a literal separator."""
    if index == 0:
        return F.substring_index(text, sep, 1)
    return F.get(F.split(text, _literal(sep)), F.lit(index))


def last_item(text: Column, sep: str) -> Column:
    return F.substring_index(text, sep, -1)


def join_middle(text: Column, sep: str) -> Column:
    """All parts but the first and last, with the separators between them.

    The middle is cut out by position: nothing is split and joined again.
    ``text`` occurs several times here, so pass a column of the frame.
    """
    first = F.length(F.substring_index(text, sep, 1))
    last = F.length(F.substring_index(text, sep, -1))
    size = F.length(text) - first - last - 2 * len(sep)
    return F.substr(text, first + 1 + len(sep), F.greatest(size, F.lit(0)))


def _literal(sep: str) -> str:
    """A separator as a regular expression, in the form Java splits on fastest."""
    return "".join("\\" + c if c in r".$|()[{^?*+\\" else c for c in sep)


def drop_inline_tag(text: Column, pattern: str) -> Column:
    """Replace each match of ``pattern`` with its first capture group."""
    return F.regexp_replace(text, pattern, "$1")


def tagged(text: Column, pattern: str, group: int) -> Column:
    return strip_text(F.regexp_extract(text, pattern, group))


def collapse_punctuation(text: Column) -> Column:
    """Normalise spacing as detokenised prose has it.

    Runs of spaces become one; no space before closing punctuation, after an
    opening bracket, or inside a contraction.
    """
    text = F.regexp_replace(text, " {2,}", " ")
    text = F.regexp_replace(text, r" ([.,!?;:%)\]}])", "$1")
    text = F.regexp_replace(text, r"([(\[{]) ", "$1")
    text = F.regexp_replace(text, r" ('(s|m|d|re|ve|ll)\b)", "$1")
    return F.trim(text)


# How tokens stand together in prose: (what is matched, what it becomes). Quotes are paired
# from the left; a pair that shares its space with the next needs the second round.
_QUOTED = ((r'(^| )" ([^"]*) "( |$)', '$1"$2"$3'), (r"(^| )' ([^']*) '( |$)", "$1'$2'$3"))
DETOKENIZING = (
    (r"[ \t]+", " "),
    (r"(^| )(?:``|&quot;) ", '$1" '),
    (r" ''( |$)", ' "$1'),
    *_QUOTED,
    *_QUOTED,
    (r" ([.,!?;:%)\]}\x{2026}\x{201D}])", "$1"),
    (r"([(\[{$\x{A3}\x{20AC}\x{201C}]) ", "$1"),
    (r" ('(?:[sSmMdD]|re|RE|ve|VE|ll|LL)|n't|N'T)\b", "$1"),
    (r"\b([cC]an|[gG]on|[gG]ot|[wW]an) (not|na|ta)\b", "$1$2"),
    (r"(\w) / (\w)", "$1/$2"),
    (r"^ | $", ""),
)


def detokenize(text: Column) -> Column:
    """Prose from tokens that stand apart: paired quotes close on what they hold,
    punctuation, ellipses and contractions join what is before them, brackets and
    currency signs what follows, slashes both sides.

    Quotes that have no partner are left as they stand. Every rule runs once over the
    text, in the JVM; whole texts of any length take time in proportion.
    """
    for pattern, replacement in DETOKENIZING:
        text = F.regexp_replace(text, pattern, replacement)
    return text


# The entities resolved without Python; the ampersand comes last,
# so that what it uncovers is not resolved again.
COMMON_ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
)
# Anything else that could be an entity, with or without its semicolon.
_RARE_ENTITY = "&(?!(?:lt|gt|quot|#39|amp);)[#A-Za-z]"


def _unescaper():
    # Made inside a function, so that it is sent to the workers by value and they
    # need no copy of this package.
    @F.pandas_udf(T.StringType())
    def unescape(values: pd.Series) -> pd.Series:
        return values.map(html.unescape, na_action="ignore")

    return unescape


def html_unescape(text: Column) -> Column:
    """Resolve HTML entities.

    Texts with none but the common entities stay in the JVM; the others travel
    to Python, which knows all of them. ``text`` occurs several times in the
    expression: pass a column of the frame, not a long computation.
    """
    common = text
    for entity, character in COMMON_ENTITIES:
        common = F.replace(common, F.lit(entity), F.lit(character))
    rare = F.contains(text, F.lit("&")) & text.rlike(_RARE_ENTITY)
    return F.when(rare, _unescaper()(F.when(rare, text))).otherwise(common)
