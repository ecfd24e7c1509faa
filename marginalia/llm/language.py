"""Language ID with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram's vector is the product of its letters'
vectors, each rotated by its place; a text's vector is the sum over its n-grams (white space and
other non-letters count as one blank); a language's prototype is the sum over normalised vectors of
labelled texts. A text gets the language whose prototype has the largest cosine with it.

All sums are of integers, so results do not depend on how rows are dealt to tasks.

Defined cases: a null text or one without a letter is ``und`` with score 0; ties go to the first
language in sorted order; without labelled rows all is ``und``; a null id counts as the text
``null`` when the held-out rows are chosen; equal texts get equal results; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import in_arrow, table
from .tokens import is_letter_table

DIMENSIONS = 1024
ORDER = 3
SAMPLE = 20_000  # labelled rows that the prototypes are learned from, about
CHUNK = 500_000  # characters handled at once
_TABLES: dict[str, np.ndarray] = {}


def letter_vector(code: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The random vector of a letter; 0 is the blank."""
    return np.random.Generator(np.random.Philox(key=[20_011, code])).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of letters in lower case with single blanks between words, and each one's text."""
    if not _TABLES:
        _TABLES["letter"] = is_letter_table()
    flat = [x.lower() for x in texts]
    codes = np.frombuffer("".join(f" {x} " for x in flat).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(flat)), [len(x) + 2 for x in flat])
    codes = np.where(_TABLES["letter"][codes], codes, 0)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0) | (owner[1:] != owner[:-1])
    return codes[keep], owner[keep]


def vectors(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """A row of integers (as doubles) for each text; all zero where it has no letter."""
    codes, owner = _letters(texts)
    alphabet, code = np.unique(codes, return_inverse=True)
    if len(codes) < ORDER:
        return np.zeros((len(texts), dimensions))
    base = np.stack([letter_vector(int(c), dimensions) for c in alphabet])
    n, k = len(codes) - ORDER + 1, len(alphabet)
    key = np.zeros(n, np.int64)
    for i in range(ORDER):
        key = key * k + code[i : i + n]
    inside = owner[:n] == owner[ORDER - 1 :]
    key, own = key[inside], owner[:n][inside]
    if k**ORDER <= 4_000_000:
        grams = np.flatnonzero(np.bincount(key, minlength=1))
        rank = np.zeros(k**ORDER, np.int32)
        rank[grams] = np.arange(len(grams))
        gram = rank[key]
    else:
        grams, gram = np.unique(key, return_inverse=True)
    bound = np.ones((len(grams), dimensions), np.int8)
    left = grams
    for i in range(ORDER):
        bound *= np.roll(base, i, axis=1)[left % k]
        left = left // k
    out = np.zeros((len(texts), dimensions))
    step = max(1, 2_000_000 // max(1, len(grams)))
    bound = bound.astype(np.float32)
    for a in range(0, len(texts), step):
        lo, hi = np.searchsorted(own, [a, a + step])
        rows = min(step, len(texts) - a)
        counts = np.bincount((own[lo:hi] - a) * len(grams) + gram[lo:hi], minlength=rows * len(grams)).reshape(rows, -1)
        kind = np.float32 if counts.sum(axis=1).max(initial=0) < 1 << 24 else np.float64
        out[a : a + rows] = counts.astype(kind) @ bound
    return out


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        texts = [x or "" for x in batch.column(column).to_pylist()]
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= CHUNK):
                size += len(texts[end])
                end += 1
            yield batch.slice(at, end - at), texts[at:end]
            at = end


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", sample: int = SAMPLE, id_col: str = "doc_id") -> tuple[list[str], np.ndarray]:
    """Languages in sorted order and their integer prototypes.

    Rows are chosen by a hash of id and text so that about ``sample`` take part (rows that repeat
    share a draw); that bound holds for the classifier only, and only sums leave a task.
    """
    labelled = labelled.where(F.col(label_col).isNotNull())
    n = labelled.count()
    share = 1 << 30 if n <= sample else (sample << 30) // n
    some = labelled.where(F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 30)) < share).select(F.col(label_col).cast("string"), F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part, texts in _chunks(batches, 1):
            v = vectors(texts)
            size = np.sqrt((v * v).sum(axis=1))
            v = np.rint(10_000 * v / np.maximum(size, 1)[:, None]).astype(np.int64)
            for label, row in zip(part.column(0).to_pylist(), v):
                sums[label] = sums.get(label, 0) + row
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.string()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["label", "total"])

    rows = some.repartition(8).transform(in_arrow, run, "label string, total binary").collect()
    sums: dict[str, np.ndarray] = {}
    for r in rows:
        sums[r.label] = sums.get(r.label, 0) + np.frombuffer(r.total, np.int64)
    labels = sorted(sums)
    if not labels:
        return [], np.zeros((0, DIMENSIONS))
    protos = np.stack([sums[x] for x in labels]).astype(np.float64)
    protos = np.rint(protos * (32_767 / np.maximum(1, np.abs(protos).max(axis=1)))[:, None])
    return labels, protos


def identify(docs: DataFrame, labels: list[str], protos: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; the other columns pass through, ones of
    these names are replaced. Map-only."""
    norms = np.sqrt((protos * protos).sum(axis=1))
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    at = names.index(text_col)
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _chunks(batches, at):
            v = vectors(texts)
            size = np.sqrt((v * v).sum(axis=1))
            if labels:
                cos = v @ protos.T / np.maximum(size, 1)[:, None] / np.maximum(norms, 1)
                best = cos.argmax(axis=1)
                score = np.clip(np.round(cos.max(axis=1), 9), 0.0, 1.0)
                pred = [labels[b] if s else "und" for b, s in zip(best, size)]
                score = np.where(size > 0, score, 0.0)
            else:
                pred, score = ["und"] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())], [*names, "lang_pred", "score"])

    return docs.transform(in_arrow, run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """True for the quarter of rows from which nothing is learned."""
    return F.coalesce(F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))), F.lit(4)) == 2, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    labels, protos = fit(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text", held_out().alias("held_out")), labels, protos).select("doc_id", "held_out", "lang_pred", "score")
