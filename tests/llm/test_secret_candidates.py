"""Keys after NAME= and keys of letters alone reach the randomness tests."""

import string

import numpy as np

from ledgerlake.llm import random_secrets


def test_every_random_key_is_tested(spark):
    rng = np.random.default_rng(11)
    draw = lambda letters, n: "".join(rng.choice(list(letters), n))
    keys = [
        ("DB_KEY=", draw(string.ascii_letters + string.digits, 28)), ("AWS_SECRET_ACCESS_KEY=", draw(string.ascii_letters + string.digits, 40)), ("", draw(string.ascii_letters, 24)),
        ("", draw(string.ascii_lowercase, 24)), ("x ", draw(string.ascii_letters + string.digits, 26) + "=="),
    ]
    rest = [(100, "=" * 60), (101, "-" * 60), (102, "12345678901234567890"), (103, "zyq" * 10), (104, "K=" + "xy1" * 20)]
    rows = spark.createDataFrame([(i, a + b) for i, (a, b) in enumerate(keys)] + rest, "doc_id long, text string")
    got = {r.doc_id: r.spans.split(",") for r in random_secrets.secrets(rows).collect()}
    for i, (a, b) in enumerate(keys):
        assert f"random:{len(a)}:{len(a) + len(b)}" in got[i], (i, a, b, got[i])
    assert all(got[i] == [""] for i, _ in rest), got
