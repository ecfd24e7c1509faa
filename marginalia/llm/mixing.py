"""Mixing to target weights with soft membership.

A softmax classifier, learned from the labels table and calibrated on labelled documents that it was
not fitted on, gives each document a posterior over domains. A document's tokens count for the
domains in these shares. With t tokens, posterior p and M tokens in all, the rates r >= 0 minimise

    |sum(r t p) - target|**2 / (2 M**2)  +  RIDGE * sum(t (r - 1)**2) / (2 M)

a least-squares fit of the domain totals that stays near one copy of everything where the targets
leave a choice, or where they are out of reach (no document is emptied for a gain that it cannot
bring). It is found by lazily projected gradient steps: steps on p add up to one vector ``pull``, and
rates are the projection of 1 - p . pull onto what is allowed. A step needs sums over all documents
only (totals, the Gram matrix that scales it, and the objective, on which a step that does not help
is halved); nothing is kept for each document but tokens and posterior. Steps go on until they are
under TOLERANCE; ``Fit`` tells what was reached and whether each target is met.

Domains: ``toxic`` (toxic = 1), ``low`` (quality = 0) and ``clean`` (the rest). Text of the CAPPED
domains is never multiplied: their targets are at most what they hold, and documents whose likeliest
domain is one of them have rates of 1 at most. Tokens are words.

Defined cases: a null or empty text has no tokens and the prior's posterior; labels that disagree
for a document count as toxic, then low; null labels count as clean; without labels all is one
domain at rate 1; rows that repeat are documents of their own, and share a draw when rates are made
whole numbers; null ids are kept and draw by their text; an empty table gives no rows; further
columns pass through, those named like results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import cut, drop, in_arrow, table
from .words import LOWER, SPACE, Chunk, chunks, word_bounds, word_hashes

DOMAINS = ("clean", "low", "toxic")
WEIGHTS = {"clean": 0.905, "low": 0.085, "toxic": 0.01}
CAPPED = ("low", "toxic")
SAMPLE = 20_000  # labelled documents that the classifier is fitted on, about
FEATURES = 1 << 20
TELLING = 4096  # features that the classifier weighs, at most
ROUNDS = 12
RIDGE, TOLERANCE = 2e-3, 1e-7
MET = 0.01  # a target counts as met if it is missed by no more than this share of all tokens
ALNUM = np.array([c > 127 or chr(c).isalnum() for c in range(256)])
CORE = np.where(ALNUM, LOWER, np.uint64(0))
KIND = np.array([97 if c > 127 or chr(c).islower() else 65 if chr(c).isupper() else 48 if chr(c).isdigit() else 32 if SPACE[c] else c for c in range(256)], np.uint8)


def feature_pairs(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Two features of each word: its letters and digits in lower case, and its shape, in which
    runs of characters of one kind are one."""
    kinds = KIND[np.frombuffer(chunk.data, np.uint8)]
    shapes = kinds[np.concatenate([[True], kinds[1:] != kinds[:-1]])].tobytes() if len(kinds) else b""
    half = np.uint64(FEATURES // 2)
    return (chunk.hashes % half).astype(np.int64), (word_hashes(shapes, *word_bounds(shapes)) % half + half).astype(np.int64)


def feature_sets(chunk: Chunk) -> Iterator[np.ndarray]:
    """Sorted distinct features of each text."""
    core, shape = feature_pairs(chunk)
    for a, b in zip(chunk.first[:-1].tolist(), chunk.first[1:].tolist()):
        yield np.unique(np.concatenate([core[a:b], shape[a:b]])).astype(np.int32)


def fit_classifier(rows: np.ndarray, labels: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of softmax regression by adaptive gradient steps, the bias last; ``rows`` are packed
    bits, one for each feature. Every fifth row is left out of the fit and calibrates it."""
    hold = np.arange(len(rows)) % 5 == 4
    bits = lambda some: np.unpackbits(rows[some], axis=1).astype(np.float64)
    fit = np.flatnonzero(~hold)
    width = 8 * rows.shape[1]
    weights = np.zeros((width + 1, classes))
    weights[-1] = np.log((np.bincount(labels[fit], minlength=classes) + 1) / (len(fit) + classes))
    scale = np.full((width + 1, classes), 1e-3)
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        order = rng.permutation(fit)
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            x = bits(some)
            p = _softmax(x @ weights[:-1] + weights[-1])
            p[np.arange(len(some)), labels[some]] -= 1
            grad = np.concatenate([x.T @ p, p.sum(axis=0, keepdims=True)]) / 64
            scale += grad * grad
            weights -= 0.1 * grad / np.sqrt(scale)
    held = np.flatnonzero(hold)
    logits = [bits(held[at : at + 1024]) @ weights[:-1] + weights[-1] for at in range(0, len(held), 1024)]
    factor, shift = calibrate(np.concatenate(logits) if logits else np.zeros((0, classes)), labels[held])
    weights *= factor
    weights[-1] += shift
    return weights


def calibrate(logits: np.ndarray, labels: np.ndarray, steps: int = 400) -> tuple[float, np.ndarray]:
    """Factor and shift of logits under which the labels are likeliest; a prior holds them near 1
    and 0 where there are few."""
    classes = logits.shape[1]
    log_factor, shift = 0.0, np.zeros(classes)
    hit = np.eye(classes)[labels] if len(labels) else np.zeros((0, classes))
    rate = 1.0 / (len(labels) + 5.0)
    size = rate * 2 / (1 + np.abs(logits).max(initial=1.0))
    for _ in range(steps):
        gap = _softmax(np.exp(log_factor) * logits + shift) - hit
        log_factor -= size * float((gap * logits).sum() * np.exp(log_factor) + 5 * log_factor)
        shift -= rate * (gap.sum(axis=0) + shift)
    return float(np.exp(log_factor)), shift


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def telling(found: DataFrame, sizes: np.ndarray, most: int = TELLING, least: float = 4.0) -> np.ndarray:
    """Of (domain, features) the features whose count in some class is over ``least`` deviations
    from their overall share, sorted; the ``most`` that differ most where there are more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(DOMAINS), FEATURES), np.int32)
        for batch in batches:
            for domain, features in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts[domain, np.frombuffer(features.as_buffer(), np.int32)] += 1
        some = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *[pa.array(c[some].astype(np.int64)) for c in counts]], ["feature", *[f"n{i}" for i in range(len(DOMAINS))]])

    names = [f"n{i}" for i in range(len(DOMAINS))]
    counted = found.transform(in_arrow, run, "feature int, " + ", ".join(f"{n} long" for n in names)).groupBy("feature").agg(*[F.sum(n).alias(n) for n in names])
    base = sum((F.col(n) for n in names), F.lit(0)) / F.lit(float(sizes.sum()))
    z = [F.abs((F.col(n) - k * base) / F.sqrt(k * base * (1 - F.least(base, F.lit(0.999))) + 0.5)) for n, k in zip(names, map(float, sizes))]
    top = counted.select("feature", F.round(F.greatest(*z), 6).alias("z")).where(F.col("z") > least).orderBy(F.desc("z"), "feature").limit(most)
    return np.sort(np.array([r.feature for r in top.collect()], np.int64))


def learn_domains(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray] | None:
    """The classifier (features, weights with the bias last), None without labelled documents.

    About ``sample`` labelled ids are chosen by hash, which bounds what is broadcast; where ids
    repeat, rows are thinned by hash to about twice that. Documents with equal features count
    once. The driver gets TELLING bits for each document.
    """
    domain = F.when(F.max("toxic") == 1, 2).when(F.min("quality") == 0, 1).otherwise(0)
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(domain.alias("domain"))
    share = lambda n, most: 1 << 30 if n <= most else (most << 30) // n
    draw = lambda *c: F.pmod(F.xxhash64(*c), F.lit(1 << 30))
    known = known.where(draw("doc_id") < share(known.count(), sample)).select(F.col("doc_id").alias(id_col), "domain")
    picked = docs.select(id_col, F.col(text_col).cast("string").cast("binary").alias("text")).join(F.broadcast(known), id_col)
    picked = picked.where(draw(F.lit(3), id_col, "text") < share(picked.count(), 2 * sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [f.tobytes() for chunk in chunks(iter([batch]), CORE) for f in feature_sets(chunk)]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(found, pa.binary())], ["domain", "features"])

    found = picked.transform(in_arrow, run, "domain int, features binary").withColumn("key", F.sha2("features", 256))
    found = cut(found.dropDuplicates(["domain", "key"]), "features")
    sizes = np.zeros(len(DOMAINS))
    for r in found.groupBy("domain").count().collect():
        sizes[r.domain] = r["count"]
    if not sizes.sum():
        drop(found)
        return None
    used = telling(found.select("domain", "features"), sizes)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(np.isin(used, np.frombuffer(f.as_buffer(), np.int32))).tobytes() for f in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary()), batch.column(2)], ["domain", "bits", "key"])

    got = found.select("domain", "features", "key").transform(in_arrow, pack, "domain int, bits binary, key string").toArrow().sort_by([("key", "ascending"), ("domain", "ascending")])
    drop(found)
    rows = np.frombuffer(b"".join(got["bits"].to_pylist()), np.uint8).reshape(got.num_rows, -1)
    weights = fit_classifier(rows, got["domain"].to_numpy().astype(np.int64), len(DOMAINS))
    return used, np.concatenate([weights[: len(used)], weights[-1:]])


def posteriors(docs: DataFrame, model: tuple[np.ndarray, np.ndarray] | None, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens and p, the posterior over DOMAINS; columns of these names are
    replaced. Map-only."""
    docs = docs.drop("n_tokens", "p")
    names = docs.columns
    at = names.index(text_col)
    schema = StructType([*docs.schema.fields, *StructType.fromDDL("n_tokens long, p array<double>").fields])
    used, weights = model or (np.zeros(0, np.int64), np.array([[50.0, 0.0, 0.0]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(FEATURES, -1, np.int32)
        slot[used] = np.arange(len(used))
        for batch in batches:
            counts, rows = [], []
            texts = batch.column(at).cast(pa.binary())
            for chunk in chunks(iter([pa.RecordBatch.from_arrays([texts, texts], ["id", "text"])]), CORE, id_at=None):
                owner, found = np.repeat(np.arange(len(chunk.texts)), np.diff(chunk.first)), []
                for f in feature_pairs(chunk):
                    hit = np.flatnonzero(slot[f] >= 0)
                    found.append(owner[hit] * len(weights) + slot[f[hit]])
                pair = np.unique(np.concatenate(found))
                z = np.tile(weights[-1], (len(chunk.texts), 1))
                np.add.at(z, pair // len(weights), weights[pair % len(weights)])
                rows += np.round(_softmax(z), 6).tolist()
                counts += np.diff(chunk.first).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64()), pa.array(rows, pa.list_(pa.float64()))], [*names, "n_tokens", "p"])

    return docs.transform(in_arrow, run, schema)


def _room(capped: tuple[str, ...]) -> Column:
    """The highest rate that a document may have."""
    hot = F.lit(False)
    for d in capped:
        hot = hot | (F.col("p")[DOMAINS.index(d)] >= F.array_max("p"))
    return F.when(hot, F.lit(1.0)).otherwise(F.lit(float("inf")))


def _along(pull: np.ndarray) -> Column:
    return sum((F.col("p")[k] * F.lit(float(x)) for k, x in enumerate(pull)), F.lit(0.0))


def rate(pull: np.ndarray, capped: tuple[str, ...] = CAPPED) -> Column:
    """1 - p . pull, projected onto what is allowed."""
    return F.round(F.least(_room(capped), F.greatest(F.lit(0.0), 1 - _along(pull))), 6)


@dataclass(frozen=True)
class Fit:
    """What ``solve`` found; vectors are by DOMAINS, in tokens."""

    pull: np.ndarray
    target: np.ndarray
    reached: np.ndarray
    total: float

    @property
    def gap(self) -> np.ndarray:
        """By how much of all tokens each target is missed."""
        return (self.reached - self.target) / max(self.total, 1.0)

    @property
    def met(self) -> np.ndarray:
        """False where a target is out of reach."""
        return np.abs(self.gap) <= MET


def solve(scored: DataFrame, weights: dict[str, float], capped: tuple[str, ...] = CAPPED, ridge: float = RIDGE) -> Fit:
    """The rates of a table with n_tokens and p, as a Fit.

    Targets are in proportion to the weights; the domain of the largest weight keeps what it holds,
    and targets of capped domains are at most what those hold.
    """
    k = len(DOMAINS)
    want = np.array([weights.get(d, 0.0) for d in DOMAINS])
    p = [F.col("p")[i] for i in range(k)]
    light = scored.select(F.col("n_tokens").cast("double").alias("t"), "p", _room(capped).alias("room"))

    def sums(pull: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Domain totals, the Gram matrix of documents whose rates may move, and the sum of the
        integrals of rates over p . pull."""
        at = light.withColumn("s", _along(pull)).withColumn("free", 1 - F.col("s"))
        moves = (F.col("free") > 0) & (F.col("free") < F.col("room"))
        r = F.least("room", F.greatest(F.lit(0.0), F.col("free")))
        low = F.col("s") - F.col("s") * F.col("s") / 2
        edge = 1 - F.col("room")
        area = F.when(F.col("free") <= 0, F.lit(0.5)).when(moves, low).otherwise(F.col("room") * F.col("s") + edge * edge / 2)
        parts = [F.sum(F.col("t") * r * x) for x in p]
        parts += [F.sum(F.when(moves, F.col("t") * p[i] * p[j]).otherwise(0.0)) for i in range(k) for j in range(i, k)]
        row = [x or 0.0 for x in at.agg(*[c.alias(f"c{i}") for i, c in enumerate([*parts, F.sum(F.col("t") * area)])]).first()]
        gram = np.zeros((k, k))
        gram[np.triu_indices(k)] = row[k:-1]
        return np.array(row[:k]), gram + gram.T - np.diag(np.diag(gram)), row[-1]

    pull = np.zeros(k)
    reached, gram, area = sums(pull)
    total = float(reached.sum())
    target = want * (reached[want.argmax()] / want.max() if want.max() > 0 else 0.0)
    for d in capped:
        target[DOMAINS.index(d)] = min(target[DOMAINS.index(d)], reached[DOMAINS.index(d)])
    if not total:
        return Fit(pull, target, reached, total)
    unit = 1 / (ridge * total)
    value = lambda pull, area: pull @ pull / 2 + unit * (target @ pull - area)
    while True:
        slope = pull - unit * (reached - target)
        step = -np.linalg.solve(np.eye(k) + unit * gram, slope)
        if np.abs(step).max() <= TOLERANCE * (1 + np.abs(pull).max()):
            return Fit(pull, target, reached, total)
        size, now = 1.0, value(pull, area)
        while True:
            after = np.round(pull + size * step, 12)
            found = sums(after)
            if value(after, found[2]) <= now + 1e-4 * size * (slope @ step) + 1e-12 * abs(now):
                break
            size /= 2
            if size < 1e-12:
                raise ArithmeticError("the sums over documents are not finite")
        pull, (reached, gram, area) = after, found


def fit_mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, text_col: str = "text", capped: tuple[str, ...] = CAPPED) -> tuple[DataFrame, Fit]:
    """``docs`` with n_tokens, p and rate, and how the targets were met. Texts are scored once for
    the sums, of which only tokens and posteriors are stored, and once more for the result."""
    model = learn_domains(docs, labels, text_col=text_col)
    light = cut(posteriors(docs.select(text_col), model, text_col).select("n_tokens", "p"), "posteriors")
    fit = solve(light, weights or WEIGHTS, capped)
    drop(light)
    return posteriors(docs, model, text_col).withColumn("rate", rate(fit.pull, capped)), fit


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, text_col: str = "text", capped: tuple[str, ...] = CAPPED) -> DataFrame:
    return fit_mix(docs, labels, weights, text_col, capped)[0]


def copies(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """How often a document is taken: floor(rate + u), u a hash of id and text in [0, 1); on average
    that is the rate."""
    u = F.pmod(F.xxhash64(F.lit(41), F.col(id_col), F.col(text_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(F.col("rate") + u).cast("int")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, domain posterior and rate of every document; of its likeliest domain also by how
    much of all tokens the target is missed, and whether it is met."""
    mixed, fit = fit_mix(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    domain = F.array_position("p", F.array_max("p")).cast("int")
    of = lambda values, cast: F.element_at(F.array(*[F.lit(cast(x)) for x in values]), domain)
    return mixed.select(
        "doc_id", "n_tokens", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate",
        of(DOMAINS, str).alias("domain"), of(np.round(fit.gap, 6), float).alias("domain_gap"), of(fit.met, bool).alias("domain_met"),
    )
