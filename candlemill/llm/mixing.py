"""Mixing sources to target weights.

Every document gets a random key from a hash of its id; within a source the documents are
ordered by it. The key's first digits cut a source into equal ranges, whose token counts are
summed and turned into running sums; inside a range the documents' own running sum follows.
So a document's place in its source is known without ordering a whole source in one task,
and the source is cut at its budget exactly: whole passes first, then the documents from the
beginning of the order up to the budget, the last one in part.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlemill.llm.common import staged

#: Hexadecimal digits of the key that name a range: 4096 ranges a source.
RANGE_DIGITS = 3
#: The most often a source may be repeated.
MOST_EPOCHS = 3
#: Weights by the source's place in order, repeating.
WEIGHTS = (1, 2, 3)

BLANKS = r"[^\x20\x09-\x0D]+"


def word_count(column):
    return F.coalesce(F.regexp_count(column, F.lit(BLANKS)), F.lit(0)).cast("long")


def shares(sources, weights=WEIGHTS, most=MOST_EPOCHS):
    """Targets of sources ``(source, source_size)`` that share the sum of all sizes by weight.

    A target stops at ``most`` times its source's size; what is over goes to the others by
    weight. Sources reach that limit in the order of size over weight, so the limit binds for
    a beginning of that order: the first source whose share of what the ones before it left
    is no more than its limit, and all after it, get their share. There is a row for each
    source here, however many documents there are.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (number % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight.cast("long"))
    limit = F.col("source_size") * most
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = (
        rows.withColumn("limit", limit)
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(onward))
        .withColumn("free", F.col("weight") * F.col("level") <= F.col("limit"))
        .withColumn("final", F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    target = F.when(F.col("final").isNull(), F.col("limit").cast("double")).otherwise(F.col("weight") * F.col("final"))
    return rows.select("source", "source_size", target.alias("target"))


def mixture(documents, weights=WEIGHTS, most=MOST_EPOCHS):
    """How many words the mix takes of each document.

    Takes ``doc_id``, ``source`` and ``text``. Returns ``(doc_id, size, source_size, target,
    taken)``, a row per input row. ``size`` is the number of words, ``taken`` the words taken,
    repeats counted; a source's taken words sum to its target, rounded down. The order of a
    source is by the MD5 of ``doc_id``, then ``doc_id``, size and text, so reruns agree.

    * NULL and empty texts have size 0 and are taken 0 times.
    * NULL sources form one source, last in order. A source without words has target 0.
    * NULL ``doc_id`` is ordered by an empty key. Equal rows share the words between them.
    * An empty table gives an empty result; other columns are ignored.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = staged(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
            key.alias("key"),
            F.xxhash64("text").alias("tie"),
        ).withColumn("range", F.conv(F.substring("key", 1, RANGE_DIGITS), 16, 10).cast("int")),
        "sizes",
    )
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    target = shares(sources, weights, most)
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    running = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("start", F.coalesce(F.sum("range_size").over(running), F.lit(0)))
    # One row for each source and range tells where the range begins and what the source may take.
    plan = starts.join(target, same(starts, target)).select(
        starts["source"].alias("source"), "range", "start", "source_size", "target"
    )
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size", "tie")
    placed = rows.withColumn(
        "inside", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    both = placed.join(plan, same(placed, plan) & (placed["range"] == plan["range"])).select(
        placed["doc_id"], placed["size"], "source_size", "target", (F.col("start") + F.col("inside")).alias("at")
    )
    # A source without words has no budget; the branch also keeps from dividing by zero.
    passes = F.expr("CASE WHEN source_size > 0 THEN budget DIV source_size ELSE 0 END")
    rest = F.col("budget") - F.col("passes") * F.col("source_size") - F.col("at")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest))
    return (
        both.withColumn("budget", F.floor("target"))
        .withColumn("passes", passes)
        .select("doc_id", "size", "source_size", "target", (F.col("passes") * F.col("size") + part).cast("long").alias("taken"))
    )
