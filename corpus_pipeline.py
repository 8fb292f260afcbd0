"""A corpus pipeline of five stages; each is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that lose too much go whole."""
    from headway.llm.quality import cleaned

    return cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, a similarity of 0.8 or more."""
    from headway.llm.neardup import deduplicated

    return deduplicated(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    from headway.llm.decontaminate import clean

    return clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    from headway.llm.secret_scan import redacted

    return redacted(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, their number and the digests of ids and decoded bytes."""
    import public_tokenizers

    from headway.llm.bpe import byte_bpe

    return byte_bpe(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=True)


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secret_scan", secrets), ("byte_bpe", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
