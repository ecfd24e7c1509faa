"""The registered queries, digests included, against versions worked out row by row."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from test_llm import ROWS, base, brute_repeats, prose

from marginalia.llm import counts, language, media, mixing, queries, secrets

WHITE = b" \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with odd and repeated rows, their labels, as a folder of tables."""
    folder = tmp_path_factory.mktemp("tables")
    rng = random.Random(41)
    rows = [r for r in ROWS if r[0] is not None and r[0] != 406] + [(600, "password=abcdef0123456789 and " + "0af1" * 10), (601, "x" * 5000), (602, prose(rng, 6000))]
    rows = list({i: (i, t) for i, t in rows}.values()) + [(None, "key AKIA" + "Q7" * 8)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, p string, score string"
    spark.createDataFrame([(i, t, "en" if k % 3 else "fr", "s", len(t or ""), "x", "x") for k, (i, t) in enumerate(rows)], schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(k % 4 > 0), int(k % 5 == 0)) for k, (i, _) in enumerate(rows)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows, str(folder)


@pytest.fixture(scope="module")
def vocabulary():
    from public_tokenizers import path
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path("word_bpe_49k.json"))
    made.encode_special_tokens = True
    return made


def run(spark, tables, name):
    return queries.QUERIES[name](spark, tables[1]).collect()


def test_packing(spark, tables, vocabulary):
    ids = {i: np.array([*vocabulary.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in tables[0]}
    got = run(spark, tables, "op1_packing")
    for r in got:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length and r.ids_crc32 == zlib.crc32(piece.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert Counter({i: sum(r.length for r in got if r.doc_id == i) for i in ids}) == Counter({i: len(x) for i, x in ids.items()})
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert all(n & (n - 1) == 0 and n <= 4096 for n in ends.values())


def test_token_counts(spark, tables, vocabulary):
    want = {i: len(vocabulary.encode(t or "", add_special_tokens=False).ids) for i, t in tables[0]}
    assert {r.doc_id: r.n_tokens for r in run(spark, tables, "op6_token_counts")} == want


def test_repeats(spark, tables):
    want = Counter((i, n, k, hashlib.sha256(x.encode()).hexdigest()) for (i, n, k, x), m in brute_repeats(tables[0]).items() for _ in range(m))
    assert Counter(tuple(r) for r in run(spark, tables, "op5_repeats")) == want


def test_secrets(spark, tables):
    texts = {i: t or "" for i, t in tables[0]}
    got = run(spark, tables, "op9_secrets")
    assert len(got) == len(texts)
    for r in got:
        spans = base(texts[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in spans) for k in secrets.KINDS[:3])
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        every = [tuple(x.split(":")) for x in r.spans.split(",") if x]
        assert [x for x in every if x[0] != "format"] == [tuple(x.split(":")) for x in line.split(",") if x]
        for _, a, b in (x for x in every if x[0] == "format"):
            assert re.fullmatch(r"[A-Za-z0-9+/_.=-]{8,}", texts[r.doc_id][int(a) : int(b)])
    by = {r.doc_id: r for r in got}
    assert by[600].n_assign == 1 and by[600].n_hex == 1 and by[None].n_access == 1


def test_base_spans_are_those_of_matches(spark, tmp_path):
    """The contract names matches and their start and end: an assignment's begins with its name."""
    texts = ["my password = 'abcdefgh' and token:AKIAQQQQQQQQQQQQQQ.", 'é API_KEY":"' + "0af1" * 8, "secret=short passwd=" + "9" * 8, "none"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = ["assign:3:23,assign:29:54,access:35:53", "assign:2:44,hex:12:44", "assign:13:28", ""]
    got = {r.doc_id: r for r in queries.QUERIES["op9_secrets"](spark, str(tmp_path)).collect()}
    assert [got[i].base_sha256 for i in range(4)] == [hashlib.sha256(w.encode()).hexdigest() for w in want]
    assert [",".join(s for s in got[i].spans.split(",") if not s.startswith("format")) for i in range(4)] == want
    assert [(got[i].n_assign, got[i].n_access, got[i].n_hex) for i in range(4)] == [(2, 1, 0), (1, 0, 1), (1, 0, 0), (0, 0, 0)]


def test_media(spark, tables):
    texts = {i: (t or "").encode() for i, t in tables[0]}
    for r in run(spark, tables, "op10_media"):
        payload = texts[r.doc_id] + b" " * (-len(texts[r.doc_id]) % 192 or (0 if texts[r.doc_id] else 192))
        stored = media.encode([payload])[0]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(texts[r.doc_id]), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-16:]) and (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert r.feature.startswith("frames=")


def test_mixing(spark, tables):
    got = run(spark, tables, "op7_mixing")
    want = {i: len((t or "").encode().split()) for i, t in tables[0]}
    assert {r.doc_id: r.n_tokens for r in got} == want and all(r.rate >= 0 and abs(r.p_clean + r.p_low + r.p_toxic - 1) < 1e-5 for r in got)
    for r in got:
        p = (r.p_clean, r.p_low, r.p_toxic)
        assert p[mixing.DOMAINS.index(r.domain)] == max(p) and r.domain_met == (abs(r.domain_gap) <= mixing.MET)
    assert {r.rate <= 1 for r in got if r.domain in mixing.CAPPED} <= {True}


def profile(text):
    """The profile of a text, gram by gram: product of rotated letter vectors, summed."""
    out = np.zeros(language.DIMENSIONS)
    line = [0]
    for c in f" {text.lower()} ":
        code = ord(c) if c.isalpha() else 0
        if code or line[-1]:
            line.append(code)
    if line[-1]:
        line.append(0)
    for k in range(len(line) - 2):
        out += np.prod([np.roll(language.letter_vector(line[k + j]), 2 - j) for j in range(3)], axis=0)
    return out


def test_language(spark, tables):
    sums, seen = {}, 0
    docs = [(i, t, "en" if k % 3 else "fr") for k, (i, t) in enumerate(tables[0])]
    held = lambda i: zlib.crc32(("null" if i is None else str(i)).encode()) % 4 == 2
    profiles = {i: profile(t or "") for i, t, _ in docs}
    for i, _, lang in docs:
        if not held(i) and np.abs(profiles[i]).any():
            sums[lang] = sums.get(lang, 0) + np.rint(10_000 * profiles[i] / np.sqrt((profiles[i] ** 2).sum()))
    for r in run(spark, tables, "op4_language_id"):
        v = profiles[r.doc_id]
        assert r.held_out == held(r.doc_id)
        if not any(c.isalpha() for c in dict(tables[0])[r.doc_id] or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        cos = {x: v @ s / np.sqrt((v @ v) * (s @ s)) for x, s in sums.items()}
        assert r.score == pytest.approx(max(0.0, max(cos.values())), abs=1e-3)
        if abs(cos["en"] - cos["fr"]) > 1e-3:
            seen += 1
            assert r.lang_pred == max(cos, key=cos.get)
    assert seen > 20 and counts.SEPARATOR == 49407
