"""Text functions on columns: markup cleaning, answers, choices, years.

All are built-in expressions, so they stay in the JVM. Two points hold throughout: white space is
the set of ``SPACE`` (Java's own ``\\s`` knows ASCII only), and ``\\z`` stands for the end of the
text (Java's ``$`` also matches before a final line feed).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\t\n\x0B\f\r\p{Z}\uFEFF]"
LINE = r"[^\n\r\u2028\u2029]"

# Markup replacements, applied from top to bottom.
ENTITIES = (("&#160;", " "), ("&#39;", "'"), ("&amp;", "&"), ("&quot;", '"'))
COMMANDS = (
    ("&lt;", "\\lt "),
    ("&gt;", "\\gt "),
    ("$", "\\$"),
    ("align*", "aligned"),
    ("eqnarray*", "aligned"),
)
RENAMED = (
    ("\\bold{", "\\mathbf{"),
    ("\\congruent", "\\cong"),
    ("\\overarc", "\\overgroup"),
    ("\\overparen", "\\overgroup"),
    ("\\underarc", "\\undergroup"),
    ("\\underparen", "\\undergroup"),
    ("\\mathdollar", "\\$"),
    ("\\textdollar", "\\$"),
)
ESCAPES = (("\\n", "\n"), ("\\t", "\t"), ('\\"', '"'), ("\\'", "'"), ("\\\\", "\\"))
HTML = (("&", "&amp;"), ('"', "&quot;"), ("<", "&lt;"), (">", "&gt;"))


def replace_all(c: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    """Literal replacements, one after the other."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def strip_space(c: Column) -> Column:
    """Without white space (Unicode) at both ends."""
    return F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")


def format_latex(c: Column) -> Column:
    """Entities and math delimiters to plain LaTeX. One leading and one trailing ``$`` go, the
    others are escaped; ``&amp;lt;`` becomes ``\\lt``, as entities are read first."""
    c = F.regexp_replace(replace_all(c, ENTITIES), r"\A\$|\$\z|\\\[|\\\]", "")
    c = F.regexp_replace(replace_all(c, COMMANDS), r"\{tabular\}(?:\[\w\])*", "{array}")
    return replace_all(c, RENAMED)


def escape_html(c: Column) -> Column:
    return replace_all(c, HTML)


def unescape(c: Column) -> Column:
    """Backslash escapes, line feeds first and backslashes last."""
    return replace_all(c, ESCAPES)


def boxed_pattern(depth: int = 3) -> str:
    """A pattern of ``\\boxed{...}`` with up to ``depth`` levels of braces inside. Possessive
    quantifiers keep it linear; nothing is lost, as text and braces exclude each other."""
    inner = r"[^{}]*+"
    for _ in range(depth):
        inner = rf"[^{{}}]*+(?:\{{{inner}\}}[^{{}}]*+)*+"
    return rf"\\boxed\{{({inner})\}}"


def first_boxed(c: Column, depth: int = 3) -> Column:
    """Content of the first box, empty for an empty one, null without any."""
    return F.get(F.regexp_extract_all(c, F.lit(boxed_pattern(depth)), F.lit(1)), F.lit(0))


def clean_problem(c: Column) -> Column:
    """Without a heading ``[b]Problem #n:[/b]`` and without ``[i]... proposed by ...[/i]``."""
    # fixed values: the input's own marks
    c = F.regexp_replace(c, rf"(?i)\A\[b\]problem #\d+:\[/b\]{SPACE}*", "")
    return strip_space(F.regexp_replace(c, r"(?i)\[i\][^\[]*?proposed by [^\[]*?\[/i\]", ""))


def extract_choices(c: Column) -> Column:
    """Texts after each ``\\textbf{(A)}`` to ``(E)`` in their order: without a final ``\\qquad``,
    one leading backslash, all from a line feed on, and one or two final ``$``."""

    def tidy(x: Column) -> Column:
        for pattern in (rf"\\qquad{SPACE}*\z", r"\A\\", r"(?s)\n.*\z", r"\${1,2}\z"):
            x = F.regexp_replace(x, pattern, "")
        return strip_space(x)

    parts = F.split(c, r"\\textbf\{\([A-E]\)" + SPACE + r"*\}", -1)
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), tidy)


def clean_choices(c: Column) -> Column:
    """The statement before the first choice, without one or two ``$`` at its end. The label has
    no inner space here, other than in ``extract_choices``."""
    c = F.regexp_replace(c, r"(?s)\\textbf\{\([A-E]\)\}.*", "")
    return strip_space(F.regexp_replace(c, rf"\${{1,2}}{SPACE}*\z", ""))


def parse_answer(c: Column) -> Column:
    """struct(type, value): a letter A to E that stands alone, or the text; null for null or
    empty. Look-arounds stand for word bounds of ASCII letters, digits and underscore."""
    text = strip_space(F.regexp_replace(c, r"\\textbf\{([^}]+)\}", "$1"))
    letter = F.upper(F.regexp_extract(text, r"(?<!\w)([A-Ea-e])(?!\w)", 1))
    found = F.when(letter != "", F.struct(F.lit("letter").alias("type"), letter.alias("value"))).otherwise(F.struct(F.lit("text").alias("type"), text.alias("value")))
    return F.when(c.isNotNull() & (c != ""), found)


def extract_year(c: Column) -> Column:
    """The first year 1900 to 2099 that stands alone, as text, or null."""
    return F.nullif(F.regexp_extract(c, r"(?<!\w)(?:19|20)\d{2}(?!\w)", 0), F.lit(""))


def csv_cell(c: Column) -> Column:
    """A CSV cell of a text: CRLF is LF; quoted where it holds a quote, comma or line break."""
    c = F.replace(c, F.lit("\r\n"), F.lit("\n"))
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(c.rlike('[",\n\r]'), quoted).otherwise(F.coalesce(c, F.lit("")))


def csv_array(c: Column) -> Column:
    """A CSV cell of an array, always quoted; nulls are empty slots, quotes are doubled."""
    joined = F.array_join(c, ",", "")
    return F.when(c.isNotNull(), F.concat(F.lit('"'), F.replace(joined, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.lit(""))


def progress_bar(done: Column, total: Column, width: int = 20) -> Column:
    """A bar of ``width`` marks; ``done`` is held within 0 and ``total``."""
    held = F.greatest(F.lit(0), F.least(total, done))
    full = F.when(total > 0, F.floor(width * held / total + 0.5)).otherwise(0).cast("int")
    return F.concat(F.repeat(F.lit("\u2588"), full), F.repeat(F.lit("\u2591"), F.lit(width) - full))


def literal_pattern(text: str) -> str:
    """``text`` as a pattern that matches just it."""
    return re.escape(text)
