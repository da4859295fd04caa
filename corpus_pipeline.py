"""The training-text pipeline: from raw documents to token ids.

``STAGES`` are applied in order, each to all rows that the one before kept;
between stages the rows are written as Parquet and read again. All stages
but the last return the columns of ``documents``.
"""

import public_tokenizers
from pyspark.sql import functions as F

from quarry.llm.bpe_codec import encode_documents
from quarry.llm.common import stored, table
from quarry.llm.decontaminate import remove_leaks
from quarry.llm.jaccard_join import without_copies
from quarry.llm.quality_rules import judge
from quarry.llm.substring import remove_repeats


def quality(spark, docs, sf_dir):
    """Documents that meet every quality rule (operator 5)."""
    judged = judge(docs, verdict="__kept")
    return judged.filter("__kept").select(*docs.columns)


def near_copies(spark, docs, sf_dir):
    """One document of each group of near copies, the one with the smallest
    id (operator 2): five-word shingles, similarity 0.8 or more. Documents
    without words are no copies of each other. Rows are judged one by one,
    so rows that repeat an id, or have none, count like any other."""
    return without_copies(docs, width=5, percent=80)


def repeated_passages(spark, docs, sf_dir):
    """Passages that an earlier document holds are cut out (operator 3);
    ``n_chars`` follows, and documents of which nothing is left go."""
    cut = remove_repeats(docs)
    changed = F.size("removed") > 0
    return (cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
            .filter(~changed | (F.trim("text") != "")).select(*docs.columns))


def benchmark_leaks(spark, docs, sf_dir):
    """Documents that hold a benchmark item go (operator 8)."""
    return remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark, docs, sf_dir):
    """(doc_id, n_tokens, ids) by byte-level BPE (operator 9)."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                            decoded=False)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_copies),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_leaks),
    ("byte_level_bpe", token_ids),
]

#: SQL cannot express the stages after the first.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
