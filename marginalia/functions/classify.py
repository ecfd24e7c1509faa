"""Contest types from names, and answer indexes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _word(c: Column, word: str) -> Column:
    return c.rlike(rf"(?<!\w){word}(?!\w)")


def infer_type(name: Column) -> Column:
    """The key of a contest's type, or null. Case counts, but for the last rule."""
    return (
        F.when(name.contains("OMMC"), F.when(name.contains("final"), "AMO").otherwise("OMMC"))
        .when(name.contains("RML"), "ARML")
        .when(name.rlike("[A-Z]MC"), "AMC")
        .when(_word(name, "HMMT"), "HMMT")
        .when(name.contains("IME") & ~name.contains("(AIME level)"), "AIME")
        .when(name.contains("MO"), "AMO")
        .when(F.lower(name).contains("pumac"), "COMPUTE")
    )


def level_label(name: Column) -> Column:
    """AMC 8, AMC 10 (also for 11), AMC 12 or AMC: by whole numbers of the name itself."""
    return F.when(_word(name, "8"), "AMC 8").when(_word(name, "10") | _word(name, "11"), "AMC 10").when(_word(name, "12"), "AMC 12").otherwise("AMC")


def answer_index(answer: Column, choices: Column) -> Column:
    """Place of a parsed answer (struct of type and value): of its letter in A to J, of its text
    in ``choices``, or -1."""
    place = F.coalesce(F.array_position(choices, answer["value"]).cast("int"), F.lit(0)) - 1
    return F.when(answer.isNull(), -1).when(answer["type"] == "letter", F.ascii(answer["value"]) - 65).otherwise(place)
