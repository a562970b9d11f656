"""Several texts, or a null and a text, under one id; the search's tasks and settings."""

import hashlib
import random

import numpy as np

from ledgerlake.llm import bitsliced_topk, bwt_repeats, random_secrets


def plain_removed(texts: list[bytes], length: int) -> list[list[bool]]:
    """Marks of the bytes that repeated strings of ``length`` bytes cover."""
    times: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            times[t[i : i + length]] = times.get(t[i : i + length], 0) + 1
    marks = [[False] * len(t) for t in texts]
    for t, mark in zip(texts, marks, strict=True):
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                mark[i : i + length] = [True] * length
    return marks


def test_repeats_of_texts_under_one_id(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = word(420)
    texts = [word(300) + passage + word(615), word(131), passage, None, "", passage[:250] + word(90), word(800)]
    ids = [1, 1, 1, 1, 1, 2, 2]
    rows = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(3)
    plain = [(t or "").encode() for t in texts]
    want = []
    for doc, t, mark in zip(ids, plain, plain_removed(plain, 200), strict=True):
        kept = bytes(b for b, gone in zip(t, mark, strict=True) if not gone)
        spans = sum(gone and not before for gone, before in zip(mark, [False, *mark], strict=False))
        want.append((doc, len(t), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in bwt_repeats.without_repeats(rows, 200).collect()]
    assert sorted(got) == sorted(want) and sum(r[2] for r in want) > 900


def test_spans_of_texts_under_one_id(spark):
    rng = random.Random(5)
    key = lambda: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    texts = [f"see {key()} here", "nothing", None, f"a longer beginning, then {key()}", f"{key()} {key()}", "password = abcdef123"]
    shared, own = (spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string") for ids in ([7] * 6, range(6)))
    got, want = ([tuple(r)[1:] for r in random_secrets.secrets(rows).collect()] for rows in (shared, own))
    assert sorted(got) == sorted(want) and sum("random" in r[-1] for r in want) >= 2


def test_search_over_several_blocks_keeps_settings(spark, monkeypatch):
    monkeypatch.setattr(bitsliced_topk, "BLOCK", 64)
    monkeypatch.setattr(bitsliced_topk, "QUERIES", 2)
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(size=5 if i % 50 else 3).tolist()) for i in range(900)]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    bitsliced_topk.ready(spark, 2000)
    seen = []
    settle = bitsliced_topk.settle
    monkeypatch.setattr(bitsliced_topk, "settle", lambda df, label: (seen.append((label, df.rdd.getNumPartitions())) if label == "search-hits" else None, settle(df, label))[1])
    got = bitsliced_topk.top_scores(rows, k=10, every=25).collect()
    assert spark.conf.get(bitsliced_topk.ROWS_AT_ONCE) == "2000" and dict(seen)["search-hits"] >= 15
    whole = {i: np.floor(1024 * np.array(v)).astype(np.int64) for i, v in vectors}
    want = []
    for q in range(0, 900, 25):
        hits = sorted((-int(v @ whole[q]), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        want += [(q, n, i, -score) for n, (score, i) in enumerate(hits[:10], 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)
