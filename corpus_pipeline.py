"""The corpus pipeline: documents in, the cleaned and mixed corpus out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept.
``run`` writes every stage's rows as Parquet to the shared folder and rereads them.

Rows without a ``doc_id`` pass every stage but cannot be named by one: none drops them for
being a copy or for holding benchmark text. Rows that share a ``doc_id`` count as one document,
but only those of its texts that are copies are dropped as such.
"""

from pyspark.sql import functions as F

from candlemill.llm.common import staged, table
from candlemill.llm.decontaminate import contaminated
from candlemill.llm.jaccard_join import near_texts
from candlemill.llm.mixing import mixture
from candlemill.llm.quality import THRESHOLD, scored, train
from candlemill.llm.suffix_dedup import without_repeats


def good_documents(spark, docs, sf_dir):
    """Documents the quality classifier accepts."""
    machine = train(docs, table(spark, sf_dir, "labels"))
    return scored(docs, machine).filter(F.col("score") >= THRESHOLD).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """Of every class of documents linked by 5-word shingles at 0.8, the least id stays."""
    copies = near_texts(docs, n=5, percent=80).filter("doc_id != component_id")
    copies = copies.select(F.col("doc_id").alias("copy_id"), F.col("text_id").alias("copy_text")).distinct()
    same = (F.col("doc_id") == F.col("copy_id")) & (F.xxhash64("text") == F.col("copy_text"))
    return docs.join(copies, same, "left_anti").select(*docs.columns)


def repeated_passages(spark, docs, sf_dir):
    """Passages of 50 words or more stay in the first document that has them."""
    return without_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontaminated(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    leaks = contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


def mixed(spark, docs, sf_dir):
    """How many words of each document the mix takes."""
    return mixture(docs)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]

#: Stages train models, join sets and compare suffixes, which SQL can't express.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
