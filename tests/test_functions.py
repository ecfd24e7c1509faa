"""Vectors of the text functions."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marginalia.functions import classify, lists, text
from marginalia.operators.answers import KEY_ENTRY


def one(spark, make, *values):
    row = spark.createDataFrame([(i, *values) for i in (1,)], ", ".join(["i int", *[f"v{k} string" for k in range(len(values))]]))
    return row.select(make(*[F.col(f"v{k}") for k in range(len(values))]).alias("x")).first().x


DEMO = "\n\n\n".join(f"[b]p{k}.[/b] statement ${k}$" for k in range(1, 10)) + "\n\n\n[b]p10.[/b] Set $a_0$.\nFor all\n$$x$$\nLet k.\nFind.\n\n\nPS. You should use hide for answers.  Collected here."

CASES = [
    (text.format_latex, "$x&lt;y$", "x\\lt y"),
    (text.format_latex, "$$x$$", "\\$x\\$"),
    (text.format_latex, "\\[\\begin{align*}a&amp;b\\end{align*}\\]", "\\begin{aligned}a&b\\end{aligned}"),
    (text.format_latex, "\\begin{tabular}[c]", "\\begin{array}"),
    (text.format_latex, "\\bold{v}", "\\mathbf{v}"),
    (text.format_latex, "\\overarc{AB}", "\\overgroup{AB}"),
    (text.format_latex, "a&amp;lt;b", "a\\lt b"),
    (text.format_latex, "5$\n", "5\\$\n"),
    (text.escape_html, 'a<b & "c"', "a&lt;b &amp; &quot;c&quot;"),
    (text.escape_html, "&lt;", "&amp;lt;"),
    (text.first_boxed, "\\boxed{\\frac{1}{\\sqrt{2}}}", "\\frac{1}{\\sqrt{2}}"),
    (text.first_boxed, "\\boxed{}", ""),
    (text.first_boxed, "none", None),
    (text.first_boxed, "\\boxed {5}", None),
    (text.first_boxed, "\\boxed{x", None),
    (text.first_boxed, "\\boxed{a{b{c{d{e}}}}} \\boxed{42}", "42"),
    (text.clean_problem, "[b]Problem #3:[/b] Find x. [i]Proposed by A. B[/i] ", "Find x."),
    (text.extract_choices, "Q? $\\textbf{(A)}\\ 5\\qquad\\textbf{(B)}\\ 7\\qquad\\textbf{(C) }\\ 9$", ["5", "7", "9"]),
    (text.extract_choices, "\\textbf{(A)}\\frac12", ["frac12"]),
    (text.extract_choices, "\\textbf{(A)} \\frac12", ["\\frac12"]),
    (text.extract_choices, "\\textbf{(A)} x\ny", ["x"]),
    (text.extract_choices, "\\textbf{(A)} 5$ ", ["5$"]),
    (text.extract_choices, "none", []),
    (text.clean_choices, "Find x. $\\textbf{(A)}\\ 5$", "Find x."),
    (text.clean_choices, "Find $x$", "Find $x"),
    (text.parse_answer, "\\textbf{(C)}", ("letter", "C")),
    (text.parse_answer, "(d)", ("letter", "D")),
    (text.parse_answer, "B.", ("letter", "B")),
    (text.parse_answer, "\\frac{a}{b}", ("letter", "A")),
    (text.parse_answer, "42", ("text", "42")),
    (text.parse_answer, "ABC", ("text", "ABC")),
    (text.parse_answer, "3e", ("text", "3e")),
    (text.parse_answer, "", None),
    (text.unescape, "a\\nb", "a\nb"),
    (text.unescape, "\\\\n", "\\\n"),
    (text.extract_year, "2019 AMC 10A", "2019"),
    (text.extract_year, "2013-14 X", "2013"),
    (text.extract_year, "AMC 2020B", None),
    (text.extract_year, "1899", None),
    (text.csv_cell, "a,b", '"a,b"'),
    (text.csv_cell, 'q"z', '"q""z"'),
    (text.csv_cell, "l1\nl2", '"l1\nl2"'),
    (text.csv_cell, "x", "x"),
    (text.strip_space, " ﻿ a  \n", "a"),
    (lists.split_list, "1. one\ncont\n\n3. x\n2. two\n  tail", ["one\ncont\n3. x", "two\ntail"]),
    (lists.split_list, "intro\n1. a\n2. b", []),
    (lists.split_list, "5. x\n1. a\n2. b", ["a", "b"]),
    (lists.split_list, "1. a\n7. b", ["a\n7. b"]),
    (lists.split_list, "1. a\n2.5 b\n2. c", ["a", "5 b\n2. c"]),
    (lists.split_list, "[b]p1.[/b] a\n[b]2[/b] b", ["a", "b"]),
    (lambda c: lists.split_list(c, 3), "3. a\n4. b", ["a", "b"]),
    (lambda c: lists.split_list(c, loose=True), "[I]by x[/I]1. a\n2. b", ["a", "b"]),
    (classify.infer_type, "USAJMO", "AMO"),
    (classify.infer_type, "AIME (AIME level)", None),
    (classify.infer_type, "OMMC final", "AMO"),
    (classify.infer_type, "PUMaC", "COMPUTE"),
    (classify.level_label, "AMC 11", "AMC 10"),
]


@pytest.mark.parametrize("n", range(len(CASES)))
def test_vector(spark, n):
    make, value, want = CASES[n]
    got = one(spark, make, value)
    assert (tuple(got) if hasattr(got, "asDict") else got) == want


def test_demo_post(spark):
    items = one(spark, lists.split_list, DEMO)
    assert len(items) == 10 and len(items[9].split("\n")) == 6 and items[9].split("\n")[-1].startswith("PS. You should use hide")
    assert "PS" not in one(spark, lambda c: lists.drop_postscript(lists.split_list(c)), DEMO)[9]


def test_drawings(spark):
    html = '<p><img class="asy-image" src="//h/1.png"></p>'
    assert one(spark, lists.link_drawings, "[ASY]draw(a);[/ASY] t", html) == "[asy=https://h/1.png]draw(a);[/asy] t"
    assert one(spark, lists.link_drawings, "[asy]a[/asy][asy]b[/asy]", html) == "[asy=https://h/1.png]a[/asy][asy]b[/asy]"
    assert one(spark, lists.link_drawings, "[asy]a[/asy]", "none") == "[asy]a[/asy]"


def test_answer_index(spark):
    rows = spark.createDataFrame([("C", 2), ("7", 1), ("zz", -1), (None, -1)], "a string, want int")
    got = rows.select("want", classify.answer_index(text.parse_answer(F.col("a")), F.array(F.lit("5"), F.lit("7"))).alias("got")).collect()
    assert all(r.got == r.want for r in got)


def test_csv_array_and_key(spark):
    assert spark.range(1).select(text.csv_array(F.array(F.lit("a"), F.lit(None), F.lit("b"))).alias("x")).first().x == '"a,,b"'
    assert spark.range(1).select(text.csv_array(F.array().cast("array<string>")).alias("x")).first().x == '""'
    assert one(spark, lambda c: F.regexp_extract_all(c, F.lit(KEY_ENTRY), F.lit(2)), "1. 025\n2. 110\n10. 999") == ["025", "110", "999"]


def test_long_text_is_linear(spark):
    assert one(spark, text.first_boxed, "\\boxed{" + "x{y}" * 50_000) is None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("abc xyz", min_size=1).filter(lambda s: s.strip()), min_size=2, max_size=8))
def test_round_trip(spark, items):
    post = "\n\n".join(f"{i}. {t}" for i, t in enumerate(items, 1))
    assert one(spark, lists.split_list, post) == [t.strip() for t in items]
