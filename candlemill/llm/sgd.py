"""What the trained classifiers share: labelled samples, sparse rows, AdaGrad."""

import numpy as np
from pyspark.sql import functions as F

#: Documents whose label may be learned from have another remainder than this.
FOLDS, HELD_OUT = 5, 0


def fold(doc_id):
    return F.crc32(doc_id.cast("string")) % FOLDS


def held_out(doc_id):
    """Whether a document's label is kept for testing; rows without an id are."""
    return F.coalesce(fold(doc_id) == HELD_OUT, F.lit(True))


def sample(documents, labels, target, most, balanced=False):
    """At most ``most`` labelled rows ``(text, target)`` outside the held-out fold.

    Rows are taken in the order of a hash of ``doc_id``, so the sample is random, the same in
    each run, and bounded: its ids and labels are broadcast to the scan of the texts, which is
    not shuffled. With ``balanced``, at most half of it are of one label. NULL labels and ids
    are left out; of contradicting labels of one id the larger counts, and of its texts one.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("target"))
    known = known.dropna().filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("target").alias("target"))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    if balanced:
        parts = [known.filter(F.col("target") == t).orderBy(*order).limit(most // 2) for t in (0, 1)]
        chosen = parts[0].unionByName(parts[1])
    else:
        chosen = known.orderBy(*order).limit(most)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(F.broadcast(chosen), "doc_id")
    # However many rows share an id, one of them is learned from.
    one = F.min_by(F.struct("text", "target"), F.struct(F.xxhash64("text"), "text")).alias("row")
    return found.groupBy("doc_id").agg(one).select("doc_id", "row.text", "row.target")


class Rows:
    """Sparse rows: ``first[i]:first[i + 1]`` are the entries of row i."""

    def __init__(self, first, index, value):
        self.first, self.index, self.value = first, index, value

    def __len__(self):
        return len(self.first) - 1

    def take(self, chosen):
        sizes = np.diff(self.first)[chosen]
        first = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.first[chosen] - first[:-1], sizes) + np.arange(first[-1])
        return Rows(first, self.index[at], self.value[at])

    def owner(self):
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def sums(self, entries):
        """Sum of each row's entries (a value or a vector each)."""
        out = np.zeros((len(self), *entries.shape[1:]), np.result_type(entries.dtype, np.float32))
        full = np.flatnonzero(np.diff(self.first))
        if len(full):
            out[full] = np.add.reduceat(entries, self.first[full], axis=0)
        return out

    @staticmethod
    def joined(parts):
        first = [np.zeros(1, np.int64)]
        for p in parts:
            first.append(p.first[1:] + first[-1][-1])
        return Rows(
            np.concatenate(first),
            np.concatenate([p.index for p in parts]),
            np.concatenate([p.value for p in parts]),
        )

    @staticmethod
    def counted(owner, index, n, buckets):
        """Rows of how often each index occurs for each owner."""
        key, times = np.unique(owner.astype(np.int64) * buckets + index, return_counts=True)
        row = key // buckets
        first = np.searchsorted(row, np.arange(n + 1))
        return Rows(first, (key % buckets).astype(np.int32), times.astype(np.float32))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AdaGrad:
    def __init__(self, rate):
        self.rate, self.seen = rate, {}

    def step(self, name, weights, rows, gradient):
        """Moves the given rows of ``weights`` (all distinct) against the gradient."""
        seen = self.seen.setdefault(name, np.full(weights.shape, 1e-8, np.float32))
        seen[rows] += gradient**2
        weights[rows] -= self.rate * gradient / np.sqrt(seen[rows])
