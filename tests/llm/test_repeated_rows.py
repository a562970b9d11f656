"""Rows that are given twice keep one copy of their text."""

from ledgerlake.llm import line_runs, trie_join
from tests.llm.test_operators import plain_lines

BODY = "\n".join(f"line {i}" for i in range(5))


def test_line_runs_keep_a_repeated_row(spark, monkeypatch):
    alone, copy, inner = (1, BODY), (2, BODY + "\nend"), (3, "p\nq\nr\ns\np\nq\nr")
    want = plain_lines([alone, copy, inner])
    for parts in (1, 7):  # repeated rows in one task, and in several
        rows = spark.createDataFrame([alone, copy, inner, inner, copy, alone, alone], "doc_id long, text string").repartition(parts)
        got = line_runs.without_repeated_lines(rows).collect()
        assert len(got) == 7 and all((r.n_lines, r.n_removed) == want[r.doc_id] for r in got)
        assert {(r.doc_id, r.kept_text) for r in got} == {alone, (2, "end"), (3, "p\nq\nr\ns")}


def test_texts_of_one_id_are_marked_apart(spark):
    texts = ["a\nb\nc", "x\na\nb\nc", "a\nb\nc\nd\ne\nf\ng"]
    rows = spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string")
    got = [(r.text, r.kept_text) for r in line_runs.without_repeated_lines(rows).collect()]
    # a, b, c stand in all three; one of them keeps the run
    assert sorted(t for t, _ in got) == sorted(texts) and sum("a\nb\nc" in kept for _, kept in got) == 1
    assert all(kept.replace("a\nb\nc", "").strip("\n") == t.replace("a\nb\nc", "").strip("\n") for t, kept in got)


def test_jaccard_components_of_repeated_rows(spark):
    words = [f"w{i}" for i in range(120)]
    apart = [(1, " ".join(words)), (2, " ".join(words[:90] + [f"x{i}" for i in range(30)]))]  # Jaccard 0.57, twice that if counted twice
    rows = spark.createDataFrame(apart + apart, "doc_id long, text string").repartition(3)
    assert {(r.doc_id, r.component_id) for r in trie_join.jaccard_components(rows, 4, 85).collect()} == {(1, 1), (2, 2)}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    once, twice = ({(r.doc_id, r.n_shingles, r.component_id) for r in trie_join.jaccard_components(d, 4, 85).collect()} for d in (docs, docs.union(docs)))
    assert once == twice
