"""Numbered lists within one text, and images of drawing blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import LINE, SPACE, literal_pattern, strip_space


@dataclass(frozen=True)
class ListStyle:
    """``opener`` matches a number with its mark; ``line`` a whole line: number, text."""

    opener: str
    line: str

    @property
    def whole(self) -> str:
        """Two items at least: one at the start of the text, another one at the start of a line."""
        return rf"(?s)\A{SPACE}*{self.opener}{SPACE}+.+\n{self.opener}{SPACE}+."


PLAIN = ListStyle(r"\d+\.", rf"\Ap?(\d+)\.{SPACE}*({LINE}+)\z")


def tagged(tag: str) -> ListStyle:
    """Numbers in a BBCode tag: ``[b]p1.[/b] text``; p and dot may be missing."""
    t = literal_pattern(tag)
    return ListStyle(rf"\[{t}\]p?\d+\.?\[/{t}\]", rf"\A\[{t}\]p?(\d+)\.?\[/{t}\]{SPACE}*({LINE}+)\z")


STYLES = (PLAIN, tagged("b"))


def split_list(c: Column, start: Column | int = 1, styles: tuple[ListStyle, ...] = STYLES, loose: bool = False) -> Column:
    """The items of a numbered list, [] where the text is none.

    The first style that fits decides. An item starts at a line with the next number, counted from
    ``start``; other lines belong to the item before, joined by line feeds; blank lines and lines
    before the first item are dropped. ``loose`` drops a leading ``[i]...[/i]`` first.
    """
    if loose:
        c = F.regexp_replace(c, rf"(?i)\A\[i\]{LINE}*?\[/i\]", "")
    start = F.lit(start) if isinstance(start, int) else start
    lines = F.filter(F.transform(F.split(c, "\n", -1), strip_space), lambda x: x != "")
    empty = F.struct(F.array().cast("array<string>").alias("items"), F.lit(None).cast("string").alias("last"))

    def fold(style: ListStyle) -> Column:
        def step(acc: Column, line: Column) -> Column:
            seen = F.size(acc["items"]) + F.when(acc["last"].isNull(), 0).otherwise(1)
            hit = F.regexp_extract(line, style.line, 1) == (start + seen).cast("string")
            closed = F.when(acc["last"].isNull(), acc["items"]).otherwise(F.array_append(acc["items"], acc["last"]))
            return F.struct(
                F.when(hit, closed).otherwise(acc["items"]).alias("items"),
                F.when(hit, F.regexp_extract(line, style.line, 2)).otherwise(F.concat(acc["last"], F.lit("\n"), line)).alias("last"),
            )

        close = lambda acc: F.when(acc["last"].isNull(), acc["items"]).otherwise(F.array_append(acc["items"], acc["last"]))
        return F.aggregate(lines, empty, step, close)

    chosen = F.when(c.rlike(styles[0].whole), fold(styles[0]))
    for style in styles[1:]:
        chosen = chosen.when(c.rlike(style.whole), fold(style))
    return chosen.otherwise(F.array().cast("array<string>"))


def drop_postscript(items: Column) -> Column:
    """Without ``P.S. ... hide for answers ...`` at the end of the last item."""
    last = F.element_at(items, -1)
    tidy = strip_space(F.regexp_replace(last, rf"(?i)P\.?S\.?{LINE}*hide for answers{LINE}*\z", ""))
    return F.when(F.size(items) > 0, F.concat(F.slice(items, F.lit(1), F.size(items) - 1), F.array(tidy))).otherwise(items)


def link_drawings(text: Column, html: Column) -> Column:
    """``[asy]...[/asy]`` number k as ``[asy=url]...[/asy]`` with the address of drawing k of the
    page; blocks without one stay as they are."""
    block = F.lit(r"(?is)\[asy\](.*?)\[/asy\]")
    images = F.regexp_extract_all(html, F.lit(r"""(?i)<img\b[^>]*\bclass\s*=\s*["']asy-image["'][^>]*>"""), F.lit(0))
    urls = F.transform(images, lambda tag: F.nullif(F.regexp_extract(tag, r"""(?i)src=["']([^"']*)["']""", 1), F.lit("")))
    whole, inner = F.regexp_extract_all(text, block, F.lit(0)), F.regexp_extract_all(text, block, F.lit(1))
    linked = F.transform(whole, lambda w, k: F.coalesce(F.concat(F.lit("[asy=https:"), F.get(urls, k), F.lit("]"), F.get(inner, k), F.lit("[/asy]")), w))
    between = F.split(text, r"(?is)\[asy\].*?\[/asy\]", -1)
    joined = F.array_join(F.transform(between, lambda b, k: F.concat(b, F.coalesce(F.get(linked, k), F.lit("")))), "")
    return F.when(html.isNull(), text).otherwise(joined)
