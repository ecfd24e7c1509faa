"""Secret scans with inferred grammars.

Three fixed patterns give the base spans (of an assignment, the span of its value, or with ``whole``
that of its match). Labelled
credentials are their distinct matches in all documents and examples of published token formats.
For each kind a prefix tree of a bounded sample of them is folded into a probabilistic automaton:
a state is merged with the one that explains it best where that is likelier than a state of its own.
Compared are the next characters and the lengths of what is still to come (Bayes factors of
Dirichlet-multinomial counts, which hold for few observations, too), so states of a format of fixed
length follow one another and those of a free length become loops. What base spans and the labels
of assignments leave of every run of 8 or more credential characters is then scored by its
likelihood under the automata against that of ordinary text, a chain of letter pairs counted in all
documents (but not in long mixtures of letters and digits); parts over the threshold are added as kind ``format``. Base spans always stay.

Defined cases: a null text is empty; offsets are code points, end exclusive; parts of
under 8 characters add nothing; credentials of over ``LONGEST`` characters teach nothing, but are
spans like others; rows that repeat give repeated rows; null ids are kept; an empty table gives no
rows. Only the text is read, further columns pass through.
"""

from __future__ import annotations

import math
import random
import re
import string
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from xxhash import xxh64_intdigest

from .common import cut, drop, in_arrow, table

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ASSIGN_KEYS = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{8,}+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
LONG_PIECE = re.compile(r"[A-Za-z0-9]{8,}")
WORDY = re.compile(r"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]{2,})+")  # words, capitals, numbers, and several in a row
PER_KIND, LONGEST = 300, 256  # credentials of a kind that an automaton is fitted on, and their length at most
SEEN_WORDS = 1 << 16  # words whose verdict a task remembers
STATE_COST = 3.0  # in nats: a merge that either count speaks against by more gives a state of its own
ODDS = 12.0  # in nats: how much likelier a credential must be than ordinary text
LETTERS = 95  # printable characters and the end
SEPARATORS = "=/."

_ALNUM = string.ascii_letters + string.digits
_URL = _ALNUM + "-_"
# Published token formats, as literal text and (alphabet, length).
FORMATS = {
    "github": ("ghp_", (_ALNUM, 36)),
    "gitlab": ("glpat-", (_URL, 20)),
    "slack": ("xoxb-", (string.digits, 12), "-", (string.digits, 12), "-", (_ALNUM, 24)),
    "google": ("AIza", (_URL, 35)),
    "stripe": ("sk_live_", (_ALNUM, 24)),
    "npm": ("npm_", (_ALNUM, 36)),
    "sendgrid": ("SG.", (_URL, 22), ".", (_URL, 43)),
}


def examples(formats: dict[str, tuple] = FORMATS, n: int = 100, seed: int = 1) -> dict[str, list[str]]:
    """Labelled credentials of published formats, the same in every run."""
    rng = random.Random(seed)
    draw = lambda part: part if isinstance(part, str) else "".join(rng.choices(part[0], k=part[1]))
    return {kind: ["".join(map(draw, parts)) for _ in range(n)] for kind, parts in formats.items()}


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """Base spans by start and kind, and what they and their labels leave of all runs of 8 or more
    credential characters."""
    spans, used = [], []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(k in low for k in ASSIGN_KEYS):
        named = [m for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
        spans += [("assign", *m.span(2)) for m in named]
        used += [m.span() for m in named]
    runs = [m.span() for m in RUN.finditer(text)]
    for a, b in runs:  # the other two kinds lie within such runs
        if b - a >= LEAST["access"]:
            for kind, pattern in (("access", ACCESS), ("hex", HEX)):
                found = [m.span() for m in pattern.finditer(text, a, b) if m.end() - m.start() >= LEAST[kind]]
                spans += [(kind, *f) for f in found]
                used += found
    spans = in_order(spans)
    return spans, outside(runs, sorted(used)) if used else runs


def whole_matches(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The base spans with each assignment from its name on, as the pattern matches it."""
    if not any(s[0] == "assign" for s in spans):
        return spans
    named = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    return in_order(named + [s for s in spans if s[0] != "assign"])


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def outside(runs: list[tuple[int, int]], used: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of the runs that are in none of the used spans; both are sorted."""
    parts, k = [], 0
    for a, b in runs:
        while k < len(used) and used[k][1] <= a:
            k += 1
        at = k
        while at < len(used) and used[at][0] < b:
            if used[at][0] > a:
                parts.append((a, used[at][0]))
            a = max(a, used[at][1])
            at += 1
        if a < b:
            parts.append((a, b))
    return parts


def ordinary(text: str, spans: list[tuple[str, int, int]], parts: list[tuple[int, int]]) -> str:
    """The text without its base spans and without runs that hold a long piece in which letters and
    digits, or small and capital letters, are mixed: so no credential counts as ordinary text."""
    gone = [(a, b) for _, a, b in spans] + [(a, b) for a, b in parts if not all(WORDY.fullmatch(x) for x in LONG_PIECE.findall(text, a, b))]
    if not gone:
        return text
    kept, at = [], 0
    for a, b in sorted(gone):
        kept.append(text[at : max(a, at)])
        at = max(at, b)
    return "\n".join([*kept, text[at:]])


def infer(words: list[str]) -> list[dict]:
    """A probabilistic automaton: for each state the log-probability of ending (key ""), for
    each character the next state and its log-probability, and for all others (key None)."""
    kids: list[dict[str, int]] = [{}]
    took, left = [Counter()], [Counter()]  # of each state: next characters, lengths to come
    for word in words:
        at = 0
        left[0][len(word)] += 1
        for i, c in enumerate(word, 1):
            took[at][c] += 1
            if c not in kids[at]:
                kids[at][c] = len(kids)
                kids.append({})
                took.append(Counter())
                left.append(Counter())
            at = kids[at][c]
            left[at][len(word) - i] += 1
        took[at][""] += 1

    def gain(a: Counter, b: Counter, kinds: int, prior: float) -> float:
        """Log Bayes factor of one source for both counts against a source for each; before any
        observation each of ``kinds`` counts ``prior / kinds``."""
        n, m, p = a.total(), b.total(), prior / kinds
        out = math.lgamma(n + prior) + math.lgamma(m + prior) - math.lgamma(n + m + prior) - math.lgamma(prior)
        for x, k in b.items():
            out += math.lgamma(a[x] + k + p) - math.lgamma(a[x] + p) - math.lgamma(k + p) + math.lgamma(p)
        return out

    def fold(a: int, b: int) -> None:
        """Adds the tree under b to a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            took[a].update(took[b])
            left[a].update(left[b])
            for c, t in kids[b].items():
                if c in kids[a]:
                    todo.append((kids[a][c], t))
                else:
                    kids[a][c] = t

    red, known = [0], {0}
    while blue := [(-left[kids[r][c]].total(), k, c) for k, r in enumerate(red) for c in kids[r] if kids[r][c] not in known]:
        _, k, c = min(blue)
        state = kids[red[k]][c]
        pairs = [(gain(took[r], took[state], LETTERS, LETTERS), gain(left[r], left[state], len(left[r].keys() | left[state].keys()), 1.0)) for r in red]
        best = max(range(len(red)), key=lambda i: (min(pairs[i]) > -STATE_COST, sum(pairs[i]), -i))
        if min(pairs[best]) > -STATE_COST:
            kids[red[k]][c] = red[best]
            fold(red[best], state)
        else:
            red.append(state)
            known.add(state)

    number = {s: i for i, s in enumerate(red)}
    letters = sum((Counter({c: n for c, n in took[s].items() if c}) for s in red), Counter())
    rare = math.log(1 / (letters.total() + LETTERS))
    machine = []
    for s in red:
        n, t = took[s].total(), len(took[s])
        other = math.log(t / (n + t)) if n else 0.0  # what a character costs that was not seen here
        usual = max(kids[s], key=lambda c: (took[s][c], c), default=None)
        end = math.log(took[s][""] / (n + t)) if took[s][""] else other + rare
        row = {c: (number[kids[s][c]], math.log(took[s][c] / (n + t))) for c in kids[s]}
        machine.append({"": (number[s], end), None: (number[s] if usual is None else row[usual][0], other + rare)} | row)
    return machine


def likelihood(machine: list[dict], word: str, least: float = -math.inf) -> float:
    """Log-likelihood of a word; minus infinity as soon as it is under ``least``."""
    at, total = 0, 0.0
    for c in word:
        row = machine[at]
        at, p = row.get(c) or row[None]
        total += p
        if total < least:
            return -math.inf
    return total + machine[at][""][1]


BORDER = 0
_CANDIDATE = np.array([c < 128 and (chr(c).isalnum() or chr(c) in "+/_.=-") for c in range(256)])
_SYMBOL = np.where(_CANDIDATE, np.arange(256), BORDER)


def pair_counts(data: bytes) -> np.ndarray:
    """How often each character follows each other one; all that is no credential character is
    the border, and texts begin and end with one."""
    x = _SYMBOL[np.frombuffer(b" " + data + b" ", np.uint8)]
    return np.bincount(x[:-1] * 128 + x[1:], minlength=128 * 128)


def pair_logs(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities of the next character, backed off to the share of the character."""
    counts = counts.reshape(128, 128).astype(np.float64)
    counts[BORDER, BORDER] = 0
    share = (counts.sum(axis=0) + 1) / (counts.sum() + 128)
    kinds = np.maximum((counts > 0).sum(axis=1), 1)[:, None]
    return np.log((counts + kinds * share) / (counts.sum(axis=1, keepdims=True) + kinds))


def learn(docs: DataFrame, text_col: str = "text", known: dict[str, list[str]] | None = None) -> dict:
    """{"machines": kind to automaton, "plain": log-probabilities of pairs in ordinary text}.

    ``known``: labelled credentials beside those of the documents (default: ``examples()``).
    Base spans and letter pairs are of all documents. An automaton is fitted on the PER_KIND
    distinct credentials of its kind that come first by hash; each task sends on no more than
    these, so no kind is missed, and what the driver gets is bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, dict[str, int]] = {kind: {} for kind in LEAST}
        counts = np.zeros(128 * 128, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                spans, parts = base_spans(text)
                for kind, a, b in spans:
                    if b - a <= LONGEST:
                        value = text[a:b]
                        found[kind][value] = xxh64_intdigest(value) >> 1
                counts += pair_counts(ordinary(text, spans, parts).encode("utf-8", "surrogatepass"))
            for kind, values in found.items():
                if len(values) > PER_KIND:
                    found[kind] = dict(sorted(values.items(), key=lambda v: (v[1], v[0]))[:PER_KIND])
        rows = [(kind, v, h) for kind, values in found.items() for v, h in values.items()]
        rows += [("", str(c), int(counts[c])) for c in np.flatnonzero(counts)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["kind", "value", "n"])

    some = cut(docs.select(F.col(text_col).cast("string")).transform(in_arrow, run, "kind string, value string, n long"), "credentials")
    counts = np.zeros(128 * 128, np.int64)
    for r in some.where("kind = ''").groupBy("value").agg(F.sum("n").alias("n")).collect():
        counts[int(r.value)] = r.n
    first = lambda kind: some.where(F.col("kind") == kind).select("n", "value").distinct().orderBy("n", "value").limit(PER_KIND)
    words = {kind: [r.value for r in first(kind).collect()] for kind in LEAST}
    drop(some)
    machines = {kind: infer(w) for kind, w in words.items() if w}
    machines |= _known_machines() if known is None else {kind: infer(w) for kind, w in known.items()}
    return {"machines": machines, "plain": pair_logs(counts)}


@lru_cache(1)
def _known_machines() -> dict[str, list[dict]]:
    return {kind: infer(words) for kind, words in examples().items()}


def plain_likelihood(plain: np.ndarray, word: str) -> float:
    """Log-likelihood of a word as ordinary text; words in capitals and numbers, also dates and
    the like, are ordinary text too."""
    forms = {word, word.lower()} if word.isupper() else {word}
    best = -math.inf
    for form in forms:
        x = np.frombuffer(f" {form} ".encode(), np.uint8)
        x = _SYMBOL[x]
        best = max(best, float(plain[x[:-1], x[1:]].sum()))
    if not any(c.isalpha() for c in word):
        best = max(best, -len(word) * math.log(10))
    return best


def is_format(word: str, model: dict) -> bool:
    """Whether the logarithm of the likelihood ratio is over ODDS."""
    least = plain_likelihood(model["plain"], word) + ODDS
    return any(likelihood(m, word, least) > least for m in model["machines"].values())


def added_spans(text: str, parts: list[tuple[int, int]], judge: Callable[[str], bool]) -> list[tuple[str, int, int]]:
    """The parts that ``judge`` takes for credentials, without punctuation at their ends; of a part
    that it does not, the pieces between separators are judged."""
    out, todo = [], [(a, b, 0) for a, b in reversed(parts)]
    while todo:
        a, b, level = todo.pop()
        word = text[a:b].strip(".=-")
        if len(word) < LEAST["assign"]:
            continue
        start = text.index(word, a)
        if judge(word):
            out.append(("format", start, start + len(word)))
            continue
        for k in range(level, len(SEPARATORS)):
            if SEPARATORS[k] in word:
                edges, at = [], start
                for piece in word.split(SEPARATORS[k]):
                    edges.append((at, at + len(piece), k + 1))
                    at += len(piece) + 1
                todo += reversed(edges)
                break
    return out


SPANS = "array<struct<kind:string,start:long,end:long>>"


def find_secrets(docs: DataFrame, model: dict, text_col: str = "text", redact: bool = False, whole: bool = False) -> DataFrame:
    """``docs`` with base_spans and all_spans; with ``redact`` each span of the text reads [secret]
    instead, with ``whole`` the span of an assignment is that of its match. The other columns pass through, ones of these names are replaced. Map-only."""
    docs = docs.drop("base_spans", "all_spans")
    names = docs.columns
    at = names.index(text_col)
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(f"base_spans {SPANS}, all_spans {SPANS}").fields])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    rows = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = lru_cache(SEEN_WORDS)(lambda word: is_format(word, model))
        for batch in batches:
            base, every, texts = [], [], []
            for text in batch.column(at).to_pylist():
                spans, parts = base_spans(text or "")
                if whole:
                    spans = whole_matches(text or "", spans)
                more = in_order(spans + added_spans(text or "", parts, judge))
                base.append(rows(spans))
                every.append(rows(more))
                if redact and more:
                    pieces, end = [], 0
                    for _, a, b in more:
                        if a >= end:
                            pieces += [text[end:a], "[secret]"]
                        end = max(end, b)
                    text = "".join(pieces) + text[end:]
                texts.append(text)
            columns = list(batch.columns)
            if redact:
                columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(base, kind), pa.array(every, kind)], [*names, "base_spans", "all_spans"])

    return docs.transform(in_arrow, run, schema)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document, as the patterns match them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, learn(docs), whole=True)
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(span_text(F.col("base_spans")), 256).alias("base_sha256"),
        span_text(F.col("all_spans")).alias("spans"),
    )
