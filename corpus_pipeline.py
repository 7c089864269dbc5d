"""The corpus pipeline: language ID, near duplicates, secrets, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs; all but the last return the columns of ``documents``. The last gives
one row per document copy with its token count and digests.
"""

from __future__ import annotations

from dfinsight.llm import blob_ledger, bpe, lang_id, ngram_join, source_mix
from dfinsight.llm.base import stored

STAGES = [
    ("language_id", lang_id.stage_lang_id),
    ("near_duplicates", ngram_join.stage_ngram_join),
    ("secrets", blob_ledger.stage_blob_ledger),
    ("mix", source_mix.stage_source_mix),
    ("tokens", bpe.stage_bpe),
]

#: The near-duplicate, secret-scan and BPE stages have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; every stage's result is stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
