"""The registered corpus queries: each applies one operator to its whole table."""

from pyspark.sql import functions as F

from candlemill.llm.common import table
from candlemill.llm.decontaminate import contaminated
from candlemill.llm.fingerprint import fingerprints
from candlemill.llm.hard_negatives import hard_negatives
from candlemill.llm.hnsw import nearest_vectors
from candlemill.llm.html_text import extracted
from candlemill.llm.jaccard_join import near_sets
from candlemill.llm.mixing import mixture
from candlemill.llm.quality import quality_scores
from candlemill.llm.suffix_dedup import repeated_spans
from candlemill.llm.toxicity import toxicity_scores
from candlemill.llm.url_filter import filter_urls
from candlemill.llm.warc import archived
from candlemill.llm.whitening import whitened


def op1_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op2_jaccard_join(spark, sf_dir):
    return near_sets(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc(spark, sf_dir):
    return archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_suffix_dedup(spark, sf_dir):
    return repeated_spans(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_html_text(spark, sf_dir):
    return extracted(table(spark, sf_dir, "pages"))


def op9_mixing(spark, sf_dir):
    return mixture(table(spark, sf_dir, "documents"))


def op10_fingerprint(spark, sf_dir):
    return fingerprints(table(spark, sf_dir, "documents"))


def op11_whitening(spark, sf_dir):
    return whitened(table(spark, sf_dir, "embeddings"))


def op12_hnsw(spark, sf_dir):
    return nearest_vectors(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


QUERIES = {
    f.__name__: f
    for f in [
        op1_url_filter,
        op2_jaccard_join,
        op3_decontaminate,
        op4_quality,
        op5_warc,
        op6_suffix_dedup,
        op7_toxicity,
        op8_html_text,
        op9_mixing,
        op10_fingerprint,
        op11_whitening,
        op12_hnsw,
        op13_hard_negatives,
    ]
}
