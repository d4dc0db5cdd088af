"""From documents to token shards: quality, near duplicates, benchmark leaks, source mix, token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return rows of documents with the
columns that came in. `run` writes each stage and reads it back, so a stage may scan its input as often as it likes.
"""
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fareforge.llm import decontaminate, jaccard, mixing, quality, token_store
from fareforge.llm.common import materialize, ready, table

TOKENIZER = "word_bpe_49k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ready(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    ready(spark)
    return jaccard.deduplicated(docs)


def leaks_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that quote a benchmark item go."""
    ready(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix of sources takes them: some not at all, some up to three times."""
    ready(spark)
    return mixing.mixed_rows(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining row as token ids in binary shards, read back by key."""
    ready(spark)
    return token_store.round_trip(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality classifier", quality_stage), ("n-gram Jaccard join", duplicates_stage),
          ("benchmark decontamination", leaks_stage), ("source mix", mix_stage), ("token ids", tokens_stage)]
#: Model scores, shingle hashes and token ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
