"""Document fingerprints: bottom-k sketches of 5-word shingle hashes.

A sketch is the ``k`` least distinct 64-bit hashes of a text's shingles, in order. Sketches
of parts merge into the sketch of the whole, and two sketches tell resemblance, containment
and the number of distinct shingles. Only DataFrame functions are used.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlemill.llm.common import staged

SHINGLE = 5
K = 128
#: Documents are ordered by id within ranges; about this many ids go to a range, and no more
#: than MOST_RANGES ranges are made (their bounds come to the driver).
RANGE_ROWS = 1000
MOST_RANGES = 128 * 128
#: Sub-groups by which sketches of one key are merged.
MERGE_PARTS = 64

_LEAST = -(2.0**63)
_ALL = 2.0**64


def sketch(text, n=SHINGLE, k=K):
    """The sketch of a text as ``array<long>``: words are runs other than ASCII white space.

    A text of one to ``n - 1`` words has the one shingle of all its words; NULL and empty
    texts have an empty sketch.
    """
    # Only a text's beginning and end can give an empty piece.
    pieces = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    words = F.transform(pieces, lambda w: F.xxhash64(w))

    def shingles(w):
        many = F.transform(
            F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(n)])
        )
        none = F.array().cast("array<bigint>")
        return F.when(F.size(w) >= n, many).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(none)

    # A one-element transform names the words, so that they are made once.
    found = F.get(F.transform(F.array(words), shingles), 0)
    return F.slice(F.array_sort(F.array_distinct(found)), 1, k)


def merge(a, b, k=K):
    """Sketch of two texts' shingles together."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merged(sketches, keys, k=K):
    """Merges the column ``sketch`` of all rows with equal ``keys``.

    A group's hashes are made distinct before and after the shuffle and cut to ``k`` in
    sub-groups first, so no group has to fit one task.
    """
    keys = list(keys)
    hashes = sketches.select(*keys, F.explode_outer("sketch").alias("hash")).distinct()
    salted = hashes.withColumn("part", F.pmod("hash", F.lit(MERGE_PARTS)))
    cut = lambda rows, by: rows.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("hash").asc_nulls_last()))
    ).filter(F.col("rank") <= k).drop("rank")
    few = cut(cut(salted, [*keys, "part"]).drop("part"), keys)
    return few.groupBy(*keys).agg(F.sort_array(F.collect_list("hash")).alias("sketch"))


def distinct_shingles(s, k=K):
    """Estimated number of distinct shingles; exact below ``k``."""
    kth = (F.element_at(s, k).cast("double") - F.lit(_LEAST)) / F.lit(_ALL)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(F.lit(k - 1.0) / kth)


def resemblance(a, b, k=K):
    """Estimated Jaccard index: the share of the union's sketch that lies in both.

    1 for two empty sketches, 0 for an empty and a full one. Exact while the union has no
    more than ``k`` shingles.
    """
    union = merge(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def containment(a, b, k=K):
    """Estimated share of a's shingles that b has too; 1 for an empty sketch a."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j / (1 + j) * (na + nb) / na))


def as_text(s):
    """A sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(s, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def _ranged(docs):
    """Adds ``range``: ids in descending order lie in ranges 0, 1, … of about equal size."""
    n = docs.agg(F.count("doc_id")).first()[0]
    ranges = max(1, min(MOST_RANGES, -(-n // RANGE_ROWS)))
    if ranges == 1:
        return docs.withColumn("range", F.lit(0))
    probs = [i / ranges for i in range(1, ranges)]
    bounds = docs.agg(F.percentile_approx("doc_id", probs, 10 * ranges)).first()[0]
    bounds = sorted(set(bounds), reverse=True)
    # Two steps of at most 128 comparisons find the range of an id.
    step = 128
    coarse = [bounds[i] for i in range(0, len(bounds), step)]
    fine = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    longs = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    above = lambda xs: F.size(F.filter(xs, lambda b: b >= F.col("doc_id")))
    block = F.greatest(above(longs(coarse)) - 1, F.lit(0))
    table = F.array(*[longs(xs) for xs in fine])
    place = block * step + above(F.get(table, block))
    # Rows without an id come last in order.
    return docs.withColumn("range", F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(place))


def with_next(documents):
    """Each document with the text of the next one, in descending order of ``doc_id``.

    NULL texts count as empty. The document after the last is the first. Within a range of ids the next row follows in
    order; the first document of the range below is added to each range as its last row.
    Repeated ids are ordered by text; rows without an id come last.
    """
    docs = _ranged(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
    )
    # The heads: of each range the row that comes first. One row a range, so these are few.
    ids = staged(docs.groupBy("range").agg(F.max("doc_id").alias("head_id")), "range-heads")
    order = Window.orderBy("range")
    before = F.coalesce(F.lag("range").over(order), F.max("range").over(Window.partitionBy()))
    goes_to = ids.withColumn("to", before)
    heads = (
        docs.join(F.broadcast(goes_to), "range")
        .filter(F.col("doc_id").eqNullSafe(F.col("head_id")))
        .groupBy("to", "doc_id")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", F.col("to").alias("range"), F.lit(True).alias("ghost"))
    )
    rows = docs.select("doc_id", "text", "range", F.lit(False).alias("ghost"))
    return rows.unionByName(heads)


def fingerprints(documents, n=SHINGLE, k=K):
    """Fingerprints of every text and of an edited copy of it, and how alike they are.

    Takes ``doc_id`` and ``text``; other columns are ignored. The edited text is the text with
    its last third (rounded down, in code points) replaced by the first as many code points,
    or all, of the next document in descending order of ``doc_id``; the first document follows
    the last. Returns ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)``, a row per input row.

    * NULL texts count as empty. An empty text has an empty fingerprint.
    * Repeated ids follow each other in the order of their texts; rows without an id come last.
    * A single document is its own next one. An empty table gives an empty result.
    """
    placed = with_next(documents).repartition("range").withColumn("sketch", sketch(F.col("text"), n, k))
    order = Window.partitionBy("range").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "text")
    follow = placed.withColumn("next_text", F.lead("text").over(order)).withColumn(
        "next_sketch", F.lead("sketch").over(order)
    )
    length = F.length("text")
    third = F.floor(length / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), length - third), F.substring(F.col("next_text"), F.lit(1), third))
    rows = (
        follow.filter("NOT ghost")
        .select("doc_id", length.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
        .withColumn("edited_sketch", sketch(F.col("edited"), n, k))
    )
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )
