"""Quality classifier: a factorisation machine over hashed words and text statistics.

The score is ``sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)``. The pairwise part is
computed in linear time as half of ``sum_f (sum_i v_if x_i)^2 - sum_i (v_if x_i)^2``. Features
are a text's words, hashed, and statistics of its structure and length.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from candlemill.llm.common import text_slices
from candlemill.llm.sgd import AdaGrad, Rows, held_out, sample, sigmoid
from candlemill.llm.wordhash import batch_words

WORDS = 1 << 14
RANK = 8
#: Most labelled documents the model is fitted on.
SAMPLE = 12_000
EPOCHS = 8
BATCH = 128
THRESHOLD = 0.3
SEED = 7

_STATS = [
    "upper", "digits", "marks", "symbols", "pipes", "blanks", "line_ends", "beyond_ascii",
    "word_bytes", "long_words", "distinct_words", "same_as_before", "top_word", "log_words", "log_bytes",
    "marked_words", "empty",
]
_KINDS = np.zeros((256, 8), np.float32)
for _kind, _bytes in enumerate(
    [
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b".,;:!?'\"()-",
        b"#$%&*+/<=>@[\\]^_`{}~",
        b"|",
        b" \t",
        b"\r\n",
        bytes(range(128, 256)),
    ]
):
    _KINDS[list(_bytes), _kind] = 1


def features(texts):
    """``(Rows of hashed words, matrix of statistics)`` of an array of binary texts.

    A text's word values are square roots of shares, so their squares sum to 1.
    """
    n = len(texts)
    hashes, first, starts, ends, base = batch_words(texts)
    counts = np.diff(first)
    owner = np.repeat(np.arange(n), counts)
    rows = Rows.counted(owner, (hashes >> np.uint64(40)).astype(np.int64) % WORDS, n, WORDS)
    most = np.zeros(n, np.float32)
    full = np.flatnonzero(np.diff(rows.first))
    if len(full):
        most[full] = np.maximum.reduceat(rows.value, rows.first[full])
    rows.value = np.sqrt(rows.value / np.maximum(counts, 1)[rows.owner()]).astype(np.float32)

    sizes = np.array([len(t) for t in texts.to_pylist()]) if n else np.zeros(0, int)
    stats = np.zeros((n, len(_STATS)), np.float32)
    put = lambda name, value: stats.__setitem__((slice(None), _STATS.index(name)), value)
    for i in range(n):
        if sizes[i]:
            data = np.frombuffer(texts[i].as_buffer(), np.uint8)
            stats[i, :8] = np.bincount(data, minlength=256).astype(np.float32) @ _KINDS / sizes[i]
    lengths = (ends - starts).astype(np.float32)
    per = np.maximum(counts, 1)
    total = lambda values: np.bincount(owner, values, n) / per
    put("word_bytes", np.log1p(total(lengths)))
    put("long_words", total(lengths > 12))
    put("distinct_words", np.diff(rows.first) / per)
    same = np.concatenate(([False], hashes[1:] == hashes[:-1])) if len(hashes) else np.zeros(0, bool)
    same[first[:-1][counts > 0]] = False
    put("same_as_before", total(same))
    put("top_word", most / per)
    put("log_words", np.log1p(counts) / 10)
    put("log_bytes", np.log1p(sizes) / 10)
    put("marked_words", total(_ends_marked(texts, starts, ends, base)))
    put("empty", counts == 0)
    return rows, stats


def _ends_marked(texts, starts, ends, base):
    """Whether a word ends in a symbol or a run of marks."""
    odd = np.zeros(256, bool)
    odd[list(b"#$%&*!|@^~=+<>")] = True
    out = np.zeros(len(starts), bool)
    first = np.searchsorted(starts, base)
    first = np.concatenate((first, [len(starts)]))
    for i in range(len(texts)):
        lo, hi = first[i], first[i + 1]
        if hi > lo:
            data = np.frombuffer(texts[i].as_buffer(), np.uint8)
            out[lo:hi] = odd[data[ends[lo:hi] - 1 - base[i]]]
    return out


class Machine:
    """Weights of the factorisation machine; statistics follow the words in one index range."""

    def __init__(self, bias, linear, factors, mean, scale):
        self.bias, self.linear, self.factors = bias, linear, factors
        self.mean, self.scale = mean, scale

    def to_bytes(self):
        parts = [np.float32([self.bias]), self.linear, self.factors.ravel(), self.mean, self.scale]
        return np.concatenate(parts).astype(np.float32).tobytes()

    def dense(self, stats):
        return np.clip((stats - self.mean) / self.scale, -4, 4).astype(np.float32)

    def parts(self, rows, stats):
        """Logits and the sums of factors, which the gradient needs too."""
        word, stat = self.factors[:WORDS], self.factors[WORDS:]
        entry = word[rows.index] * rows.value[:, None]
        sums = rows.sums(entry) + stats @ stat
        squares = rows.sums((entry**2).sum(1)) + (stats**2) @ (stat**2).sum(1)
        linear = rows.sums(self.linear[rows.index] * rows.value) + stats @ self.linear[WORDS:]
        return self.bias + linear + ((sums**2).sum(1) - squares) / 2, sums

    def score(self, rows, stats):
        """As ``parts``, in doubles and added up in one order per row, whatever rows are beside
        it: equal texts score alike."""
        wide = [x.astype(np.float64) for x in (self.linear, self.factors, self.dense(stats), rows.value)]
        linear, factors, x, value = wide
        entry = factors[rows.index] * value[:, None]
        sums, squares, logit = rows.sums(entry), rows.sums(entry**2), rows.sums(linear[rows.index] * value)
        for j in range(x.shape[1]):
            part = x[:, j : j + 1] * factors[WORDS + j]
            sums, squares, logit = sums + part, squares + part**2, logit + x[:, j] * linear[WORDS + j]
        pairs = np.zeros(len(rows))
        for k in range(sums.shape[1]):
            pairs += sums[:, k] ** 2 - squares[:, k]
        return sigmoid(float(self.bias) + logit + pairs / 2)


def fit(rows, stats, target, epochs=EPOCHS, rate=0.05, decay=1e-4):
    """Fits a machine by AdaGrad on log loss; one label alone gives a constant score."""
    rng = np.random.default_rng(SEED)
    size = WORDS + stats.shape[1]
    share = (target.sum() + 1) / (len(target) + 2)
    mean = stats.mean(0) if len(stats) else np.zeros(stats.shape[1], np.float32)
    scale = stats.std(0) + 1e-3 if len(stats) else np.ones(stats.shape[1], np.float32)
    machine = Machine(
        np.float32(np.log(share / (1 - share))),
        np.zeros(size, np.float32),
        rng.normal(0, 0.02, (size, RANK)).astype(np.float32),
        mean,
        scale,
    )
    if len(target) == 0 or target.min() == target.max():
        machine.factors[:] = 0
        return machine
    dense, ada = machine.dense(stats), AdaGrad(rate)
    bias = np.array([machine.bias], np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(target))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            part, x = rows.take(chosen), dense[chosen]
            logit, sums = machine.parts(part, x)
            error = ((sigmoid(logit) - target[chosen]) / len(chosen)).astype(np.float32)
            owner = part.owner()
            weight = error[owner] * part.value
            pull = weight[:, None] * (sums[owner] - machine.factors[part.index] * part.value[:, None])
            used, place = np.unique(part.index, return_inverse=True)
            order_of = np.argsort(place, kind="stable")
            cut = np.searchsorted(place[order_of], np.arange(len(used)))
            fold = lambda v: np.add.reduceat(v[order_of], cut, axis=0) if len(used) else v[:0]
            stat_pull = x.T @ (error[:, None] * sums) - (x**2 * error[:, None]).sum(0)[:, None] * machine.factors[WORDS:]
            ids = np.concatenate((used, np.arange(WORDS, size)))
            linear = np.concatenate((fold(weight), x.T @ error)) + decay * machine.linear[ids]
            factors = np.concatenate((fold(pull), stat_pull)) + decay * machine.factors[ids]
            ada.step("linear", machine.linear, ids, linear)
            ada.step("factors", machine.factors, ids, factors)
            ada.step("bias", bias, np.arange(1), error.sum(keepdims=True))
            machine.bias = bias[0]
    return machine


_FEATURES = "doc_id long, target int, first binary, index binary, value binary, stats binary"


def _featured(batches):
    """Features of sampled rows, a row for each run of texts."""
    for batch, texts in text_slices(batches, "text"):
        rows, stats = features(texts)
        column = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
        for i in range(len(texts)):
            lo, hi = rows.first[i], rows.first[i + 1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column("doc_id")[i : i + 1], pa.int64()),
                    pa.array(column("target")[i : i + 1], pa.int32()),
                    pa.array([np.array([hi - lo]).tobytes()], pa.binary()),
                    pa.array([rows.index[lo:hi].astype(np.int32).tobytes()], pa.binary()),
                    pa.array([rows.value[lo:hi].tobytes()], pa.binary()),
                    pa.array([stats[i].tobytes()], pa.binary()),
                ],
                names=["doc_id", "target", "first", "index", "value", "stats"],
            )


def _fitted(frame):
    """Fits on the bounded sample and returns the model as one row of bytes."""
    frame = frame.sort_values("doc_id", kind="stable")
    sizes = np.array([np.frombuffer(x, np.int64)[0] for x in frame["first"]], np.int64)
    bytes_of = lambda name, kind: np.frombuffer(b"".join(frame[name]), kind)
    rows = Rows(np.concatenate(([0], np.cumsum(sizes))), bytes_of("index", np.int32), bytes_of("value", np.float32))
    stats = bytes_of("stats", np.float32).reshape(len(frame), len(_STATS))
    m = fit(rows, stats, frame["target"].to_numpy(np.float32))
    return pd.DataFrame({"model": [m.to_bytes()]})


def _machine(raw):
    """The model from its bytes."""
    size = WORDS + len(_STATS)
    cuts = np.cumsum([1, size, size * RANK, len(_STATS)])
    bias, linear, factors, mean, scale = np.split(np.frombuffer(raw, np.float32), cuts)
    return Machine(bias[0], linear.copy(), factors.reshape(size, RANK).copy(), mean, scale)


def train(documents, labels, most=SAMPLE):
    """A machine fitted on at most ``most`` labelled documents outside the held-out fold.

    The sample is bounded by the parameter, so it is fitted in one task; only the weights come
    to the driver. Without labels the score is 0.5 for every text.
    """
    chosen = sample(documents, labels, "quality", most)
    model = chosen.mapInArrow(_featured, _FEATURES).withColumn("all", F.lit(True)).groupBy("all").applyInPandas(_fitted, "model binary").first()
    if model is None:
        none = np.zeros(0, np.float32)
        return fit(Rows(np.zeros(1, np.int64), none.astype(np.int32), none), np.zeros((0, len(_STATS)), np.float32), none)
    return _machine(bytes(model["model"]))


def scored(documents, machine):
    """All columns of ``documents`` and ``score``, the probability of label 1."""
    model = documents.sparkSession.sparkContext.broadcast(machine.to_bytes())
    schema = documents.drop("score").schema.add("score", "double")

    def run(batches):
        fitted = _machine(model.value)
        for batch, texts in text_slices(batches, "text"):
            score = fitted.score(*features(texts))
            columns = [c for c, n in zip(batch.columns, batch.schema.names) if n != "score"]
            names = [n for n in batch.schema.names if n != "score"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score, pa.float64())], names=[*names, "score"])

    return documents.mapInArrow(run, schema)


def quality_scores(documents, labels, most=SAMPLE, threshold=THRESHOLD):
    """Quality of every text: ``(doc_id, held_out, score, predicted)``, a row per input row.

    Learns from ``labels`` ``(doc_id, quality)``, without the rows whose
    ``crc32(doc_id) mod 5`` is 0. Only the text enters the score.

    * NULL and empty texts are scored as texts without words; equal texts score alike.
    * NULL ``doc_id``: scored, counted as held out. Repeated rows give repeated results.
    * No labels: 0.5 for all. An empty table gives an empty result.
    """
    machine = train(documents, labels, most)
    rows = scored(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), machine)
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
