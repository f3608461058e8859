"""The registered queries of the operators: thin wraps that apply each to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.bpe import round_trip
from ledgerline.llm.fuzzy_lines import without_repeats
from ledgerline.llm.grades import fit, graded, rated
from ledgerline.llm.graph_ann import nearest
from ledgerline.llm.main_text import main_texts
from ledgerline.llm.mixing import mixed
from ledgerline.llm.oracle import oracle_sql  # noqa: F401
from ledgerline.llm.prefix_join import similar_documents
from ledgerline.llm.prefix_tree import CLOSE, END, OPEN, digests
from ledgerline.llm.spellings import variants, vocabulary
from ledgerline.llm.syncmers import edited_pairs, likeness
from ledgerline.llm.token_files import through_files
from ledgerline.llm.vector_codes import coded
from ledgerline.llm.warc import archived
from ledgerline.sources.landing import land


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: The public byte-level vocabulary of the contract.
VOCABULARY = "byte_bpe_50k.json"
#: The public vocabulary with word ends.
WORD_VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations, and one that is full of control strings, formatted in prefix trees and read back."""
    given = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    trap = f"{END}{OPEN} ok {CLOSE}"
    added = spark.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], "conv_id long, turn long, role string, text string")
    return digests(given.unionByName(added))


def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with their main text."""
    found = main_texts(_table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Documents encoded and decoded: counts and digests of ids and text."""
    both = round_trip(_table(spark, folder, "documents"), vocabulary_path())
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the words that a mix of 150 % takes of each; sources weigh 5, 2, 1 in turn."""
    return mixed(_table(spark, folder, "documents"), (5, 2, 1), 1.5, 2.0)


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages through archives: payload size and digest (of the payload read back; a revisit's from its headers), type, response."""
    found = archived(_table(spark, folder, "pages"))
    whole = F.col("record_type") == "response"
    return found.select(
        "page_id", F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha1(F.col("payload").cast("binary"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", F.col("refers_to_page").alias("refers_to"),
    )


def op6_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and their edited texts: fingerprints, and how alike they, and the next document's, are."""
    found = edited_pairs(_table(spark, folder, "documents"))
    listed = lambda c: F.array_join(F.col(c).cast("array<string>"), " ")
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), listed("fp").alias("fingerprint"), listed("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with one line left of each group of fuzzy copies."""
    kept = without_repeats(_table(spark, folder, "documents").select("doc_id", "text", "n_chars"))
    return kept.select("doc_id", "text", F.size(F.split("text", "\n")).cast("long").alias("n_lines"), F.char_length("text").cast("long").alias("n_chars"))


def op8_ann(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of each vector whose vec_id is divisible by 20."""
    return nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that the classifier keeps, with expected grade and tail probabilities."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, rated(_table(spark, folder, "labels")))
    found = graded(docs, model).where(F.element_at("tail", 2) >= 0.5)
    return found.select("doc_id", "expected_grade", F.element_at("tail", 1).alias("p_poor_or_better"), F.element_at("tail", 2).alias("p_good"))


def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their component under 4-word shingles and a similarity of 0.85."""
    return similar_documents(_table(spark, folder, "documents").select("doc_id", "text"), 4, 85)


def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents from token files: their place, count and checksum of ids, an end id included."""
    return through_files(_table(spark, folder, "documents"), vocabulary_path(WORD_VOCABULARY))


def op12_spellings(spark: SparkSession, folder: str) -> DataFrame:
    """Words of at least 7 letters with the form they are a spelling of, and where forms lead to."""
    return variants(land(vocabulary(_table(spark, folder, "documents")), "vocabulary"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors as 16 entry numbers, with what they miss and the digest of the codebooks."""
    return coded(_table(spark, folder, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
