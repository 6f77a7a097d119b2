"""Hard negatives: per anchor its nearest positives, and per positive the nearest other rows below it.

Vector components become whole numbers, ``floor(scale * c)``; a row's score for an anchor is
their inner product, and higher scores come first, ties by smaller id. A positive's negatives
are the first rows of another label whose score lies between ``low`` and ``high`` percent of
the positive's. The windows of an anchor overlap, but their upper limits split the scores into
disjoint slots: every task keeps the top rows of each slot, the tops of all tasks are merged
once, and a window's rows are the first of the slots from its own downwards, cut at its lower
limit. So a row is compared with an anchor once, however many windows hold it.

Anchors are a stated set. They meet all rows in blocks: a task has one block of anchors and one
of ``TILES`` parts of the rows, which it reads block by block. No group is made by label.

Edge cases: rows whose label or vector is NULL, whose vector is empty or holds a NULL or
non-finite component take no part, nor do rows without ``vec_id``, which nothing could name,
nor rows with ``|floor(scale * c)|`` beyond 2^23 (products stay exact). Equal rows count once;
of rows that share an id each distinct one counts, and an anchor never meets rows of its own
id. Rows with vectors of another length are no candidates. A positive with a negative score has
an empty window. Empty tables and anchors without positives give no rows. Other columns are
ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlemill.llm.common import staged
from candlemill.llm.vectors import floored, matrices, packed, pieces, unpacked

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
SCALE = 256
LIMIT = 1 << 23
ANCHOR_EVERY = 100
#: Anchors and rows of one block, parts the rows are dealt to.
BLOCK = 1024
TILES = 32

ROW = "vec_id long, label long, anchor boolean, dims int, width int, x binary"
BLOCKS = "made long, part int, dims int, width int, ids binary, labels binary, x binary"
FOUND = "anchor_key long, anchor_id long, slot int, vec_id long, score long"


def _rows(scale):
    def run(batches):
        for piece in pieces(batches, "embedding"):
            for at, matrix in matrices(piece.column("embedding")):
                x, fits = floored(matrix, scale, LIMIT)
                for rows, width, values in packed(x):
                    own = piece.select(["vec_id", "label", "anchor"]).take(pa.array(at[fits][rows]))
                    sizes = [pa.array(np.full(len(rows), v, np.int32)) for v in (x.shape[1], width)]
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns, *sizes, values], ["vec_id", "label", "anchor", "dims", "width", "x"]
                    )

    return run


def _blocks(batches):
    """Rows joined into blocks of one vector length and width, dealt over the tiles in turn."""
    task = TaskContext.get().partitionId()
    held, part, made = {}, task * 7, task << 32

    def block(key):
        ids, labels, x = zip(*held.pop(key))
        bins = [np.array(v, np.int64).tobytes() for v in (ids, labels)]
        arrays = [pa.array([made], pa.int64()), *[pa.array([v], pa.int32()) for v in (part % TILES, *key)]]
        arrays += [pa.array([v], pa.binary()) for v in (*bins, b"".join(x))]
        return pa.RecordBatch.from_arrays(arrays, ["made", "part", "dims", "width", "ids", "labels", "x"])

    names = ("dims", "width", "vec_id", "label", "x")
    for batch in batches:
        for dims, width, *row in zip(*(batch.column(c).to_pylist() for c in names)):
            rows = held.setdefault((dims, width), [])
            rows.append(row)
            if len(rows) == BLOCK:
                yield block((dims, width))
                part, made = part + 1, made + 1
    for key in list(held):
        yield block(key)
        part, made = part + 1, made + 1


def _scores(a, b):
    """Exact inner products of two integer matrices."""
    reach = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if reach < 1 << 53:  # then doubles are exact in any order of addition
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


_NONE = np.iinfo(np.int64).min


class _Tops:
    """The first ``count`` rows per (anchor, slot), by score and id, out of the blocks added."""

    def __init__(self, count):
        self.count = count
        self.key = self.score = self.id = np.zeros(0, np.int64)

    def add(self, key, score, ids):
        key, score, ids = (np.concatenate(x) for x in ((self.key, key), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        kept = np.arange(len(key)) - np.searchsorted(key, key) < self.count
        self.key, self.score, self.id = key[kept], score[kept], ids[kept]

    def add_block(self, base, scores, allowed, slot_of, ids):
        """The allowed ones of a block's scores that can be among the first of their slot."""
        masked = np.where(allowed, scores, _NONE)
        if masked.shape[1] > self.count:
            least = np.partition(masked, -self.count, axis=1)[:, -self.count]
            allowed = allowed & (masked >= least[:, None])
        row, col = np.nonzero(allowed)
        self.add(base[row] + slot_of, scores[row, col], ids[col])


def _compare(count, slots):
    """Task: a block of anchors first, then row blocks; yields the tops of each (anchor, slot)."""

    def run(batches):
        anchors, tops = None, None

        def found():
            place, slot = np.divmod(tops.key, slots)
            arrays = [anchors["first"] + place, anchors["ids"][place], slot.astype(np.int32), tops.id, tops.score]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], [c.split()[0] for c in FOUND.split(", ")])

        for batch in batches:
            for row in range(len(batch)):
                get = lambda name: batch.column(name)[row]
                dims = get("dims").as_py()
                ids, labels = (np.frombuffer(get(c).as_buffer(), np.int64) for c in ("ids", "labels"))
                x = unpacked(get("x").as_buffer(), get("width").as_py(), dims)
                if not get("is_row").as_py():
                    if anchors is not None:
                        yield found()
                    tops = _Tops(count)
                    anchors = {"ids": ids.copy(), "labels": labels.copy(), "x": x, "dims": dims}
                    anchors["first"] = get("block").as_py() * BLOCK
                    anchors["limits"] = _limits(get("limits").as_py(), len(ids), slots)
                    continue
                if dims != anchors["dims"]:
                    continue
                scores = _scores(anchors["x"], x)
                same = anchors["labels"][:, None] == labels
                base = np.arange(len(anchors["ids"])) * slots
                if anchors["limits"] is None:  # positives
                    tops.add_block(base, scores, same & (anchors["ids"][:, None] != ids), 0, ids)
                    continue
                upper, floor = anchors["limits"]
                other = ~same & (anchors["ids"][:, None] != ids) & (scores >= floor[:, None])
                for slot in range(slots):
                    below = upper[:, slot + 1] if slot + 1 < slots else np.full(len(base), _NONE)
                    within = other & (scores <= upper[:, slot][:, None]) & (scores > below[:, None])
                    if within.any():
                        tops.add_block(base, scores, within, slot, ids)
        if anchors is not None:
            yield found()

    return run


def _limits(limits, size, slots):
    """Upper limits per anchor and slot, falling, and the least lower limit per anchor."""
    if limits is None:
        return None
    upper = np.full((size, slots), _NONE, np.int64)
    floor = np.full(size, np.iinfo(np.int64).max, np.int64)
    for limit in limits:
        upper[limit["place"], limit["slot"]] = limit["upper"]
        floor[limit["place"]] = min(floor[limit["place"]], limit["lower"])
    return upper, floor


def _met(anchors, blocks, count, slots):
    """Tops of every (anchor, slot) in each part of the rows."""
    many = anchors.agg(F.coalesce(F.max("block") + 1, F.lit(0))).first()[0]
    if many == 0:
        return anchors.sparkSession.createDataFrame([], FOUND)
    units = TILES * many
    unit = (F.col("part") * F.lit(many) + F.col("block")).alias("unit")
    part = F.explode(F.sequence(F.lit(0), F.lit(TILES - 1))).alias("part")
    block = F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("block")
    body = ["block", "dims", "width", "ids", "labels", "x"]
    limits = "array<struct<place:int,slot:int,upper:long,lower:long>>"
    asked = anchors.select("*", part).select(unit, F.lit(False).alias("is_row"), *body, "limits")
    rows = blocks.select("*", block).select(unit, F.lit(True).alias("is_row"), *body, F.lit(None).cast(limits).alias("limits"))
    both = asked.unionByName(rows).repartitionById(units, "unit").sortWithinPartitions("unit", "is_row")
    return both.mapInArrow(_compare(count, slots), FOUND)


def _first(rows, keys, count):
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= count)


def _share(score, percent, up):
    """``score * percent / 100`` rounded down or up, for scores of 0 and more."""
    rest = (score % 100) * F.lit(percent) + F.lit(99 if up else 0)
    return (F.expr("score div 100") * F.lit(percent) + F.floor(rest / 100)).cast("long")


def hard_negatives(
    rows, is_anchor=None, positives=POSITIVES, negatives=NEGATIVES, low=LOW, high=HIGH, scale=SCALE
):
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` is a condition on them.
    """
    if is_anchor is None:
        is_anchor = F.col("vec_id") % ANCHOR_EVERY == 0
    taken = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        "embedding",
    )
    # Equal rows go in each task before the shuffle.
    whole = staged(taken.mapInArrow(_rows(scale), ROW).distinct(), "negatives-rows")
    blocks = staged(whole.mapInArrow(_blocks, BLOCKS), "negatives-blocks")
    chosen = whole.filter("anchor")
    few = max(1, -(-chosen.count() // BLOCK))
    asked = staged(chosen.repartition(few).mapInArrow(_blocks, BLOCKS).drop("part"), "negatives-anchors")
    # One short row per block of anchors is numbered, not the blocks themselves.
    numbers = asked.select("made", (F.row_number().over(W.orderBy("made")) - 1).alias("block"))
    asked = asked.join(numbers, "made")

    none = F.lit(None).cast("array<struct<place:int,slot:int,upper:long,lower:long>>")
    near = _met(asked.withColumn("limits", none), blocks, positives, 1)
    near = _first(near, ["anchor_key"], positives).filter("score >= 0")
    slot = F.dense_rank().over(W.partitionBy("anchor_key").orderBy(F.desc("upper"))) - 1
    windows = near.select(
        "anchor_key",
        "anchor_id",
        F.col("vec_id").alias("positive_id"),
        F.col("rank").alias("nth"),
        F.col("score").alias("positive_score"),
        _share(F.col("score"), high, False).alias("upper"),
        _share(F.col("score"), low, True).alias("lower"),
    ).withColumn("slot", slot)
    windows = staged(windows, "negatives-windows")

    place = (F.col("anchor_key") % BLOCK).cast("int").alias("place")
    limits = windows.groupBy(F.expr("cast(anchor_key div %d as int)" % BLOCK).alias("block")).agg(
        F.collect_list(F.struct(place, "slot", "upper", "lower")).alias("limits")  # a block's own
    )
    slots = _met(asked.join(limits, "block"), blocks, negatives, positives)
    tops = _first(slots, ["anchor_key", "slot"], negatives).drop("rank", "anchor_id").withColumnRenamed("slot", "at")
    # The suffix of slots from a window's own downwards, cut at its lower limit.
    held = windows.join(tops, "anchor_key").filter((F.col("at") >= F.col("slot")) & (F.col("score") >= F.col("lower")))
    result = _first(held, ["anchor_key", "nth"], negatives)
    return result.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
