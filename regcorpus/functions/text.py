"""Text clean-up expressions.

Java regex differs from Python ``re`` in two ways that matter here: ``\\s``/``\\w``
are ASCII unless ``(?U)`` is given, and multiline ``^``/``$`` treat ``\\r`` and
U+2028 as line ends unless ``(?d)`` (UNIX_LINES) is given.  Every pattern below
carries the flags that make it behave like the Python original.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's Unicode ``\w`` is "alphanumeric or underscore"; spelled as explicit
# classes so the same pattern means the same thing in Java and in RE2.
WORD_CLASS = r"\p{L}\p{N}_"


def ustrip(c: Column) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze_ws(c: Column) -> Column:
    """``re.sub(r"\\s+", " ", t).strip()`` with Unicode whitespace."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"^ +| +$", "")


def safe_name(c: Column, width: int = 50) -> Column:
    """Every char outside word/``-`` becomes ``_``; first ``width`` chars."""
    return F.substring(F.regexp_replace(c, rf"[^{WORD_CLASS}\-]", "_"), 1, width)


def truncate(c: Column, n: int) -> Column:
    """First ``n`` characters (code points)."""
    return F.substring(c, 1, n)


def headings_eu(md: Column) -> Column:
    """Line-start article/chapter/title markers of EU acts become headings."""
    md = F.regexp_replace(md, r"(?dmU)^(Artyku[lł]\s+\d+[a-z]?)", "\n#### $1")
    md = F.regexp_replace(md, r"(?dmU)^(ROZDZIA[LŁ]\s+[IVX\d]+)", "\n## $1")
    return F.regexp_replace(md, r"(?dmU)^(TYTU[LŁ]\s+[IVX\d]+)", "\n# $1")


def headings_national(md: Column) -> Column:
    """article/chapter/part markers of national acts become headings."""
    md = F.regexp_replace(md, r"(?dmU)^(Art\.\s+\d+[a-z]?\.)", "\n### $1")
    md = F.regexp_replace(md, r"(?dmU)^(Rozdzia[lł]\s+\d+[a-z]?)", "\n## $1")
    return F.regexp_replace(md, r"(?dmU)^(DZIA[LŁ]\s+[IVX\d]+)", "\n# $1")


def clean_markdown(md: Column) -> Column:
    """X18, in the reference order: cap blank runs, strip trailing spaces,
    drop empty headings, at most one blank line after a heading, strip and
    end with one newline."""
    md = F.regexp_replace(md, r"\n{4,}", "\n\n\n")
    md = F.regexp_replace(md, r"(?dm) +$", "")
    md = F.regexp_replace(md, r"(?dmU)^#{1,6}\s*$", "")
    md = F.regexp_replace(md, r"(?dm)(^#{1,6} .+)\n{3,}", "$1\n\n")
    return F.concat(ustrip(md), F.lit("\n"))


# X11: the stripped core of every line in one regex pass.  Possessive leading
# runs strip *all* leading whitespace, then all '#', then all whitespace; the
# lazy core followed by whitespace/'#'/whitespace to the end of the line is
# the core ``str.strip().strip("#").strip()`` leaves.
_HWS = r"[\s&&[^\n]]"
_LINE_CORE = rf"(?dmU)^{_HWS}*+#*+{_HWS}*+(.*?){_HWS}*#*{_HWS}*$"


def first_title_line(md: Column, min_len: int = 5, width: int = 200) -> Column:
    """X11: first line that, stripped of whitespace, then ``#``, then
    whitespace, is longer than ``min_len``; cut to ``width``.  NULL when there
    is none.  One regex pass yields every line's core (no split into lines)."""
    cores = F.regexp_extract_all(md, F.lit(_LINE_CORE), 1)
    return F.substring(F.get(F.filter(cores, lambda x: F.length(x) > min_len), 0), 1, width)
