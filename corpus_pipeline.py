"""A corpus from raw documents: toxicity, exact and near copies, benchmark leaks, packing.

Every stage takes the documents its predecessor kept, written as Parquet and read again.
The first four return documents with unchanged columns; packing adds the columns of the batch.
"""

from tillroll.llm.block_naming import distinct_documents
from tillroll.llm.common import importable, saved
from tillroll.llm.decontamination import without_contaminated
from tillroll.llm.jaccard_join import one_of_each
from tillroll.llm.packing import pack_documents
from tillroll.llm.toxicity import without_toxic

TOKENIZER = "word_bpe_49k.json"


def toxicity_stage(spark, docs, sf_dir):
    importable(spark)
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark, docs, sf_dir):
    importable(spark)
    return distinct_documents(docs)


def jaccard_stage(spark, docs, sf_dir):
    importable(spark)
    return one_of_each(docs)


def decontamination_stage(spark, docs, sf_dir):
    importable(spark)
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark, docs, sf_dir):
    import public_tokenizers  # only this stage needs the vocabulary files

    importable(spark)
    return pack_documents(docs, public_tokenizers.path(TOKENIZER), whole_rows=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]
#: Scores of the learned classifier and near copies over word shingles are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
