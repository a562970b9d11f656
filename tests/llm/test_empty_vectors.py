"""Vectors without components score 0 against each other and leave the others' results as they are."""

import pytest

from ledgerlake.llm import bitsliced_topk


@pytest.mark.parametrize("empty", [2, 70])
def test_topk_with_empty_vectors(spark, empty):
    full = [(1, [1.0, 0.0]), (100, [0.5, 0.5]), (3, [2.0, 0.0])]
    none = [(200 + i, []) for i in range(empty)]
    got = sorted(tuple(r) for r in bitsliced_topk.top_scores(spark.createDataFrame(full + none, "vec_id long, embedding array<double>")).collect())
    want = [(100, 1, 3, 1024 * 2 * 512), (100, 2, 1, 1024 * 512)] + [(200, i, 200 + i, 0) for i in range(1, min(empty, 11))]
    assert got == sorted(want)
