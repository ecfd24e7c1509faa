"""Builders of DuckDB SQL for the checks of the registered queries."""

from __future__ import annotations

from ..functions import text
from ..sources import registry


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def literal(value: str) -> str:
    """A literal in which control characters are written by their code."""
    parts = []
    for c in value:
        if ord(c) < 32:
            parts.append(f"chr({ord(c)})")
        elif parts and parts[-1].startswith("'"):
            parts[-1] += c
        else:
            parts.append("'" + c)
    return " || ".join(p if p.startswith("chr") else quote(p[1:]) for p in parts) or "''"


def replaced(expr: str, pairs: tuple[tuple[str, str], ...]) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, {literal(old)}, {literal(new)})"
    return expr


def latex(expr: str) -> str:
    expr = rf"regexp_replace({replaced(expr, text.ENTITIES)}, '^\$|\$$|\\\[|\\\]', '', 'g')"
    expr = rf"regexp_replace({replaced(expr, text.COMMANDS)}, '\{{tabular\}}(\[\w\])*', '{{array}}', 'g')"
    return replaced(expr, text.RENAMED)


def stripped(expr: str) -> str:
    return rf"regexp_replace({expr}, '^\s+|\s+$', '', 'g')"


def infer(name: str) -> str:
    has = lambda x: f"contains({name}, '{x}')"
    return rf"""CASE WHEN {has('OMMC')} THEN CASE WHEN {has('final')} THEN 'AMO' ELSE 'OMMC' END
      WHEN {has('RML')} THEN 'ARML' WHEN regexp_matches({name}, '[A-Z]MC') THEN 'AMC'
      WHEN regexp_matches({name}, '\bHMMT\b') THEN 'HMMT'
      WHEN {has('IME')} AND NOT {has('(AIME level)')} THEN 'AIME' WHEN {has('MO')} THEN 'AMO'
      WHEN contains(lower({name}), 'pumac') THEN 'COMPUTE' END"""


def level(name: str) -> str:
    word = lambda x: rf"regexp_matches({name}, '\b{x}\b')"
    return f"CASE WHEN {word(8)} THEN 'AMC 8' WHEN {word(10)} OR {word(11)} THEN 'AMC 10' WHEN {word(12)} THEN 'AMC 12' ELSE 'AMC' END"


def registry_rows() -> str:
    """The registry as a table (grp, name, id, kind)."""
    rows = ", ".join(f"({quote(g)}, {quote(n)}, {'NULL' if i is None else i}::BIGINT, {quote(more['kind']) if 'kind' in more else 'NULL'})" for g, n, i, more in registry.CONTESTS)
    return f"(VALUES {rows}) AS r(grp, name, id, kind)"
