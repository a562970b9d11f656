"""Fill-in-middle, vector codes and byte-level BPE against plain Python, on the given tables and on rows that are odd."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm import byte_bpe, columns, fill_middle, queries, vector_codes
from tests.llm.test_operators import ODD, SMALL, VECTORS, odd, texts  # noqa: F401

BPE = queries.tokenizer_path(queries.BYTE_PIECES)
ROUGH = [
    "", "<", "<P", "<P><S><M>", "a<S>b\nc", "\n", "\n\n\n", "a\n", "no end", "<\n<\n<P\n>\nS>\n<M", "é\nü\n漢字\n\U0001f600\n", "P>\nS>\nM>\n", "x\r\ny\r\n", "\x00\x01\n\x7f", "line\n" * 5000, "one very long line " * 9000,
    "don't 'tis '' !!'t ''re we'll x'd 'lq 'rx 9's", "  two  spaces \n\n next\t\ttab \x0b\x0c \x1c\x1f.", "a  b  c　 d\u0085 e᠎ f​ g﻿ h", "été, naïve; “quotes” — dash… 漢字、かな", "<|endoftext|>", "a <|endoftext|>b<|endoftext|><|endoftext|> <|endoftext", "qjxzvkq zxqj 0x1F3a 12345678901234567890", "{}[]()%^&*~`'\"'\\//--==++" * 50,
    "\U0001f468‍\U0001f469‍\U0001f467 ̀́é ١٢²½", "Привет, мир! Как дела?  Γειά σου", "=" * 5000 + " " * 5000 + "x", "AbCdEf" * 3000,
]


def rough_texts():
    """Texts that mix the pieces at random, so that all kinds of neighbours meet."""
    rng = np.random.default_rng(8)
    parts = ["'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", " ", " ", "é", "漢", "7", "42", "!", "?!", "the", " of", "Q", "zj", "<|endoftext|>", "<|", "|>", "\U0001f600", "́", "\x1c", "-", '"']
    return ROUGH + ["".join(rng.choice(parts, rng.integers(1, 60))) for _ in range(1500)]


def plain_cut(doc, text, seed=7, rate=100, spm=50):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    hexes = hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()
    h = [int(hexes[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted(x % (len(lines) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(x) for x in (lines[:low], lines[low:high], lines[high:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text or ""
    if h[3] % 100 < spm:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_fill_middle_of_documents(spark, texts):  # noqa: F811
    got = {r.doc_id: r for r in queries.QUERIES["op11_fill_middle"](spark, SMALL).collect()}
    for doc, text in texts.items():
        *facts, output = plain_cut(doc, text)
        assert [got[doc].n, got[doc].form, got[doc].prefix_chars, got[doc].middle_chars] == facts
        assert (got[doc].output_sha256, got[doc].restored_sha256) == (sha(output), sha(text))
    assert len(got) == len(texts) and {r.form for r in got.values()} >= {"psm", "spm"}


@pytest.mark.parametrize(("piece", "step", "rate"), [(4 << 20, 1 << 20, 100), (64, 7, 60)])
def test_fill_middle_of_rough_texts(spark, monkeypatch, piece, step, rate):
    # the functions themselves, for small pieces reach only this process
    monkeypatch.setattr(fill_middle, "STEP", step)
    import pyarrow as pa

    rows = [(i, t) for i, t in enumerate([*rough_texts(), None])]
    column = pa.array([t for _, t in rows], pa.string())
    want = [plain_cut(i, t, 3, rate, 40) for i, t in rows]
    hexes = [hashlib.sha256(f"3:{i}".encode()).hexdigest() for i, _ in rows]
    h = np.array([[int(x[8 * k : 8 * k + 8], 16) for k in range(4)] for x in hexes])
    for first, end, data, offsets in columns.pieces(column.slice(3), piece):
        at = slice(3 + first, 3 + end)
        out, ends, form, lines, prefix, middle = fill_middle.scattered(data, offsets, h[at, :2], h[at, 2] % 100 < rate, h[at, 3] % 100 < 40)
        got = columns.strings(out, ends).to_pylist()
        assert [(int(n), fill_middle.FORMS[f], *((int(p), int(m)) if f else (None, None)), o) for n, f, p, m, o in zip(lines, form, prefix, middle, got, strict=True)] == want[at]
        back, ends = fill_middle.gathered(out, ends, form)
        assert columns.strings(back, ends).to_pylist() == [t or "" for _, t in rows[at]]


def test_fill_middle_keeps_rows_and_columns(spark, odd):  # noqa: F811
    clash = odd.withColumns({"output": F.lit("o"), "form": F.lit("f"), "made_0": F.lit(1), "kept_0": F.lit(2), "dotted.name": F.lit(3)})
    cut = fill_middle.transformed(clash)
    assert set(cut.columns) == set(clash.columns) | {"prefix_chars", "middle_chars"}
    rows = fill_middle.restored(cut).collect()
    assert len(rows) == sum(i is not None for i, _, _ in ODD) and all(r.restored == (r.text or "") and r["dotted.name"] == 3 and r.made_0 == 1 for r in rows)
    assert {(r.doc_id, r.output) for r in rows} == {(i, plain_cut(i, t)[-1]) for i, t, _ in ODD if i}
    assert fill_middle.restored(fill_middle.transformed(odd.where("false"))).count() == 0


def test_byte_bpe_of_documents(spark, texts):  # noqa: F811
    tokenizer = Tokenizer.from_file(BPE)
    got = {r.doc_id: r for r in queries.QUERIES["op13_byte_bpe"](spark, SMALL).collect()}
    assert len(got) == len(texts)
    for doc, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert (got[doc].n_tokens, got[doc].ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert got[doc].decoded_sha256 == sha(tokenizer.decode(ids, skip_special_tokens=False))


def test_byte_bpe_of_rough_texts(spark, monkeypatch):
    tokenizer = Tokenizer.from_file(BPE)
    rows = list(enumerate([*rough_texts(), None]))
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"made_0": F.lit(1), "decoded": F.lit("d")})
    got = byte_bpe.decoded(byte_bpe.encoded(frame, BPE), BPE).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids, r.text[:200]
        assert r.decoded == tokenizer.decode(ids, skip_special_tokens=False) == (r.text or "")
    monkeypatch.setattr(byte_bpe, "FRAGMENTS", 5)  # many runs of fragments, a small memory
    monkeypatch.setattr(byte_bpe, "KEPT", 40)
    coder = byte_bpe.Coder(BPE)
    import pyarrow as pa

    for first, end, data, offsets in columns.pieces(pa.array([t for _, t in rows], pa.string()), 1000):
        ids, ends = coder.encode(data, offsets)
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [tokenizer.encode(t or "", add_special_tokens=False).ids for _, t in rows[first:end]]
        assert len(coder.met) <= 40
    assert byte_bpe.decoded(byte_bpe.encoded(frame.where("false"), BPE), BPE).count() == 0


def test_cuts_stand_in_no_token():
    coder = byte_bpe.Coder.of(BPE)
    assert not any(coder.cuts[a, b] for t in coder.bytes_of for a, b in zip(t, t[1:], strict=False))
    text = np.frombuffer(b"The end, of 12 days.", np.uint8)
    assert np.insert(text, coder.places(text), ord("|")).tobytes() == b"The| end|,| of| 12| days|."


def test_decoding_of_any_ids(spark):
    tokenizer = Tokenizer.from_file(BPE)
    rng = np.random.default_rng(2)
    lists = [rng.integers(0, 50257, 30).tolist() for _ in range(200)] + [[], None, [50256, 50256], [99999, 5, -1]]
    rows = byte_bpe.decoded(spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, ids array<int>"), BPE).collect()
    for r in rows:
        assert r.decoded == tokenizer.decode([x for x in r.ids or [] if 0 <= x < 50257], skip_special_tokens=False)


def plain_codes(vectors, parts=8, entries=16, rounds=6, scale=4096):
    """(code, error) of each vector in order and the final codebooks; vectors: (id, list) of one length that divides."""
    whole = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in vectors]
    width = len(whole[0][1]) // parts
    cuts = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in whole]
    first = {}
    for i, v in sorted(whole):
        first.setdefault(i, v)
    seeds = [first[i] for i in sorted(first)[:entries]]
    books = [[v[p * width : (p + 1) * width] for v in seeds] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for c in cuts:
                held[nearest(p, c[p])[1]].append(c[p])
            books[p] = [[sum(x) // len(h) for x in zip(*h, strict=True)] if h else e for h, e in zip(held, books[p], strict=True)]
    best = [[nearest(p, c[p]) for p in range(parts)] for c in cuts]
    text = ",".join(str(x) for b in books for e in b for x in e)
    return [("".join(f"{k:02x}" for _, k in b), sum(d for d, _ in b)) for b in best], hashlib.sha256(text.encode()).hexdigest()


def test_vector_codes_of_embeddings(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    codes, digest = plain_codes([(r.vec_id, r.embedding) for r in rows])
    sums = {}
    for r, (_, error) in zip(rows, codes, strict=True):
        sums[r.label] = sums.get(r.label, 0) + error
    want = {r.vec_id: (code, error, sums[r.label], digest) for r, (code, error) in zip(rows, codes, strict=True)}
    got = queries.QUERIES["op12_vector_codes"](spark, SMALL).collect()
    assert {r.vec_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_equal_average_search_is_exact():
    rng = np.random.default_rng(3)
    for kinds, width in ((2, 4), (5, 3), (40, 8), (3, 1)):  # few values give many ties
        book, rows = rng.integers(-kinds, kinds, (16, width)), rng.integers(-kinds, kinds, (500, width))
        want = ((rows[:, None] - book[None]) ** 2).sum(axis=2)
        for kind in (np.int64, object):
            near, best, compared = vector_codes.Entries(book.astype(kind)).nearest(rows.astype(kind))
            assert near.tolist() == want.argmin(axis=1).tolist() and best.tolist() == want.min(axis=1).tolist()
        assert compared < want.size
    far = np.arange(16)[:, None] * 1000 + np.zeros((1, 4), np.int64)
    assert vector_codes.Entries(far).nearest(far + 3)[2] <= 2 * 16  # the sums leave one entry or two


def test_vector_codes_of_odd_rows(spark):
    frame = spark.createDataFrame([*VECTORS, (None, [1.0, 1.0], 1), (200, [], 1), (3, [0.9, 0.1], 1), (3, [0.1, 0.1], 4), (201, [float("-inf"), 0.0], 1)], "vec_id long, embedding array<double>, label int").withColumns({"v": F.lit(1), "code": F.lit(2)})
    rows = vector_codes.coded(frame).collect()
    good = [(i, v, k) for i, v, k in [*VECTORS, (3, [0.9, 0.1], 1), (3, [0.1, 0.1], 4)] if v is not None and len(v) == 2 and None not in v and not np.isnan(v).any()]
    codes, digest = plain_codes([(i, [*v, *[0.0] * 6]) for i, v, _ in good])  # parts of one component
    two = [r for r in rows if r.vec_id not in (10, 200)]
    assert sorted((r.vec_id, r.code, r.error) for r in two) == sorted((i, *c) for (i, _, _), c in zip(good, codes, strict=True))
    assert {r.codebooks_sha256 for r in two} == {digest} and len(rows) == len(good) + 2
    assert [(r.code, r.error) for r in rows if r.vec_id in (10, 200)] == [("00" * 8, 0)] * 2
    for label in {r.label for r in rows}:
        assert {r.label_error for r in rows if r.label == label} == {sum(r.error for r in rows if r.label == label)}
    assert vector_codes.coded(frame.where("false")).count() == 0 and vector_codes.coded(frame.where("embedding is null")).count() == 0


def test_vector_codes_stay_exact_for_large_components(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, (rng.normal(size=8) * 10.0 ** rng.integers(0, 5)).tolist()) for i in range(60)]
    rows = vector_codes.coded(spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<double>, label int")).collect()
    codes, digest = plain_codes(vectors)
    assert {r.vec_id: (r.code, r.error, r.codebooks_sha256) for r in rows} == {i: (*c, digest) for (i, _), c in zip(vectors, codes, strict=True)}
    mixed = [[0.25, 3e9], [-7.5, -2e18], [1e300, 0.0]]
    assert vector_codes.whole(np.array(mixed)).tolist() == [[int(np.floor(4096 * x)) if x < 1e290 else int(x) * 4096 for x in v] for v in mixed]


def test_settings_stay(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    for name in ("op11_fill_middle", "op12_vector_codes", "op13_byte_bpe"):
        queries.QUERIES[name](spark, SMALL).count()
    assert spark.conf.get(key) == before
