"""The registered queries of this folder, each over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bitsliced_topk, budget_mixing, bwt_repeats, byte_bpe, cell_dedup, chat_pairs, fill_middle, gga_packing, line_runs, random_secrets, toxicity, trie_join, vector_codes
from ledgerlake.llm.shared import read_table

WORD_PIECES = "word_bpe_49k.json"
BYTE_PIECES = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str = WORD_PIECES) -> str:
    """Where the public tokenizer files lie, the same place on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_trie_join(spark: SparkSession, sf: str) -> DataFrame:
    """Four words, 0.85: components of documents by shingle sets."""
    return trie_join.jaccard_components(read_table(spark, sf, "documents"), words=4, percent=85).select("doc_id", "n_shingles", "component_id")


@query
def op7_bwt_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes under 200-byte strings that start more than once in all documents."""
    return bwt_repeats.without_repeats(read_table(spark, sf, "documents"), 200)


@query
def op4_gga_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return gga_packing.pack(read_table(spark, sf, "documents"), tokenizer_path())


@query
def op10_line_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without the later occurrences of repeated runs of lines."""
    done = line_runs.without_repeated_lines(read_table(spark, sf, "documents").select("doc_id", "text").where("doc_id is not null"))
    return done.select("doc_id", "n_lines", "n_removed", line_runs.digest(done.kept_text).alias("kept_sha256"))


ORACLES["op10_line_runs"] = line_runs.SQL


@query
def op1_chat_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation's last answer against its successor's."""
    return chat_pairs.formatted(chat_pairs.next_answers(read_table(spark, sf, "conversations")))


ORACLES["op1_chat_pairs"] = chat_pairs.SQL


@query
def op5_budget_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """As many tokens as there are, by weight, with at most three epochs of a source."""
    return budget_mixing.mixture(read_table(spark, sf, "documents"), budget_mixing.standard_levels(), share=1.0, epochs=3, seed=17)


ORACLES["op5_budget_mixing"] = budget_mixing.sql(1.0, 3, 17)


@query
def op9_random_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets in all documents."""
    return random_secrets.secrets(read_table(spark, sf, "documents"))


@query
def op2_cell_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine 0.93 or more among vectors of one label."""
    return cell_dedup.near_duplicates(read_table(spark, sf, "embeddings"), 0.93)


@query
def op8_bitsliced_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The ten best rows for every hundredth vector."""
    return bitsliced_topk.top_scores(read_table(spark, sf, "embeddings"), k=10, every=100)


@query
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all documents by a model of the labels that are not held out."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf, "labels"))
    return toxicity.scored(docs, model).select("doc_id", (~toxicity.in_training()).alias("held_out"), "score", "predicted")


@query
def op11_fill_middle(spark: SparkSession, sf: str) -> DataFrame:
    """All documents cut into prefix, middle and suffix at line ends, and rebuilt from the outputs."""
    cut = fill_middle.transformed(read_table(spark, sf, "documents").select("doc_id", "text"), seed=7, rate=100, spm_rate=50)
    facts = cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", line_runs.digest(cut.output).alias("output_sha256"), "output")
    back = fill_middle.restored(facts)
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", line_runs.digest(back.restored).alias("restored_sha256"))


ORACLES["op11_fill_middle"] = fill_middle.SQL


@query
def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of all vectors: eight parts, sixteen entries each, six rounds."""
    return vector_codes.coded(read_table(spark, sf, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


ORACLES["op12_vector_codes"] = vector_codes.sql()


@query
def op13_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """All documents encoded, and decoded again."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text").where("doc_id is not null")
    codes = byte_bpe.encoded(docs, tokenizer_path(BYTE_PIECES)).select("doc_id", "ids")
    back = byte_bpe.decoded(codes.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), byte_bpe.ids_digest(codes.ids).alias("ids_sha256"), "ids"), tokenizer_path(BYTE_PIECES))
    return back.select("doc_id", "n_tokens", "ids_sha256", line_runs.digest(back.decoded).alias("decoded_sha256"))
