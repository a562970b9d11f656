"""A corpus pipeline: toxic documents go, repeated lines go, one document of each near-duplicate group stays, sources are
mixed to target weights, and what is left is packed into sequences.

Every stage takes (spark, docs, sf_dir) and is written as Parquet before the next one reads it. All but the last return
the columns of documents. Rows without a doc_id cannot be told apart later, so the first stage leaves them out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import budget_mixing, gga_packing, line_runs, toxicity, trie_join
from ledgerlake.llm.queries import tokenizer_path
from ledgerlake.llm.shared import read_table, settle

SHARE = 0.9  # part of the tokens that the mixture may take


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of op6 scores below 0.5; it learns from the labelled rows that are not held out."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.scored(docs.where("doc_id is not null"), model).where("predicted = 0").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of repeated runs of lines; documents of which nothing but white space is left go."""
    done = line_runs.without_repeated_lines(docs).where(r"n_removed = 0 or n_removed < n_lines")
    kept = [F.col("kept_text").alias("text") if c == "text" else F.length("kept_text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return done.select(kept)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that links of five-word shingles (Jaccard 0.8) connect."""
    found = trie_join.jaccard_components(docs, words=5, percent=80)
    return docs.join(found.where("doc_id = component_id").select("doc_id"), "doc_id", "left_semi").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mixture takes in its first epoch, which is its only one here: each at most once."""
    taken = budget_mixing.mixture(docs, budget_mixing.standard_levels(), share=SHARE, epochs=1, seed=17)
    return docs.join(taken.select("doc_id"), "doc_id", "left_semi").select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return gga_packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# the classifier and the packing have no SQL form; tests/llm compares the stages with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next one reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
