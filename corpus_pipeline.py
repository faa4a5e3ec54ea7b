"""Corpus pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Stages: language ID (documents that it rejects go), n-gram Jaccard join (the smallest doc_id of each
group of similar documents stays), secret scans (live-looking secrets are replaced, every document
stays), mixing sources to target weights (documents are repeated or left out by the mix), SentencePiece
encoding and decoding (its rows are the result). All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm.common import shared_path, ship, word_count
from martforge.llm.language_id import fit, held_out, identify
from martforge.llm.ngram_join import ngram_components
from martforge.llm.piece_encode import encode_decode
from martforge.llm.secret_scan import redact, scan_secrets
from martforge.llm.source_mix import emit, mix_sources


def _packed(docs: DataFrame) -> Column:
    """The whole row in one column, so that no column of the operators can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("kept_row").getField(c).alias(c) for c in docs.columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is accepted: not null, with letters, within the calibrated bounds.

    If nothing can be learned (no labelled rows), nothing can be rejected by score, and all documents
    with a text stay.
    """
    ship(spark)
    doc_id, text = F.col("doc_id"), F.col("text")
    models = fit(docs, doc_id, text, F.col("lang"), ~held_out(doc_id))
    if not models.langs:
        return docs.where("text is not null")
    return _unpacked(identify(docs, models, doc_id, text, _packed(docs)).where("accepted"), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest doc_id.

    Copies share 80 % of their distinct five-word shingles; the thin query's three words and 0.9 bind only
    that query. Documents with fewer than five words are one shingle, so only equal ones are copies. Rows
    that repeat a kept doc_id stay; a null doc_id is never a copy.
    """
    ship(spark)
    found = ngram_components(docs, width=5, percent=80).where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces live-looking secrets in the texts and brings n_chars up to date; keeps every document.

    A secret is live however many documents of a source hold it, and copies of one text are one holder.
    Null and empty texts hold none and stay as they are; a null source is a source of its own; rows that
    repeat a doc_id and its text are redacted alike; spans that overlap are replaced as one; an empty
    table stays empty.
    """
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    found = scan_secrets(docs, F.col("doc_id"), F.col("text"), digest, F.col("source"), max_repositories=None)
    out = redact(docs, "doc_id", "text", found)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that each source's words come near its target.

    A null text has no words, a null source is a source of its own, the last one; ties of size are ordered by
    digest and id, and rows that repeat a doc_id are documents of their own; an empty table stays empty.
    """
    mix = mix_sources(docs, word_count(F.col("text")), F.col("source"), F.col("doc_id"), _packed(docs))
    return emit(docs, mix)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A null text is empty: only the end id. Rows that the mix repeats give equal rows; an empty table gives none.
    """
    import public_tokenizers

    ship(spark)
    return encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("secret scans", secret_stage),
    ("mixing sources", mix_stage),
    ("SentencePiece encoding", encode_stage),
]

#: Language models and the piece encoder are no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the result is read from what the last one wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = shared_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
