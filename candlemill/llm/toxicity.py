"""Toxicity: averaged subword embeddings and a linear softmax, trained together in numpy.

A word is the bag of its character n-grams (3 to 5, with its ends marked), a text the average
of its words. Misspelt and inflected words share n-grams with the ones seen in training. As
the softmax is linear, a trained model comes down to one number per n-gram, which is what a
text is scored with.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from candlemill.llm.common import text_slices
from candlemill.llm.sgd import AdaGrad, Rows, held_out, sample, sigmoid
from candlemill.llm.wordhash import mix

BUCKETS = 1 << 17
DIMENSION = 8
GRAMS = (3, 4, 5)
#: Most labelled documents the model is fitted on, at most half of them of one label.
SAMPLE = 6_000
EPOCHS = 5
BATCH = 64
THRESHOLD = 0.5
#: Any passage of a text that isn't toxic is not toxic either: each such text of the sample
#: also gives this many short passages, so that short texts are learned too.
PASSAGES = 3
PASSAGE_WORDS = 40
#: The average is multiplied by this, as a few words in hundreds have to turn it.
SHARPNESS = 200.0
SEED = 11
#: Characters scored at once.
PIECE = 1 << 19

_U = np.uint64
_STEP = _U(0xD6E8FEB86659FD93)
_EDGE = {ord(c) for c in ".,;:!?\"'()[]{}<>«»„“”‘’…-–—"}
_BLANK = {0x20, *range(0x09, 0x0E), 0xA0}


def _kind(codes):
    """0 for letters and the like, 1 for blanks, 2 for marks that may end a word."""
    table = np.zeros(0x2100, np.uint8)
    table[list(_BLANK)] = 1
    table[list(_EDGE)] = 2
    return table[np.minimum(codes, 0x20FF)]


def _words(codes):
    """Starts and ends of words: runs between blanks, without the marks at their ends."""
    kind = _kind(codes)
    solid = kind != 1
    edge = np.diff(np.concatenate(([False], solid, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    letters = np.concatenate(([0], np.cumsum(kind == 0)))
    at = np.flatnonzero(kind == 0)
    has = letters[ends] > letters[starts]
    starts, ends = starts[has], ends[has]
    return at[letters[starts]], at[letters[ends] - 1] + 1


def subwords(codes):
    """N-grams of the words of a text's code points: ``(bucket, weight)``.

    Weights of one word's n-grams sum to 1.
    """
    starts, ends = _words(codes)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(0, np.float32), 0
    # Each word in a frame of two marks: <word>.
    sizes = ends - starts + 2
    first = np.concatenate(([0], np.cumsum(sizes)))
    framed = np.zeros(first[-1], _U)
    row = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(first[-1]) - first[row]
    inner = (place > 0) & (place < sizes[row] - 1)
    framed[inner] = codes[(starts[row] + place - 1)[inner]]
    framed[place == 0] = 2
    framed[place == sizes[row] - 1] = 3
    count = len(framed)
    letters = np.concatenate((mix(framed + _U(1)), np.zeros(max(GRAMS), _U)))
    found, of_word = [], []
    rest = sizes[row] - place
    total = np.zeros(count, _U)
    for n in range(1, max(GRAMS) + 1):
        total = total * _STEP + letters[n - 1 : n - 1 + count]
        if n in GRAMS:
            fits = np.flatnonzero(rest >= n)
            found.append((mix(total[fits] + _U(n)) >> _U(40)).astype(np.int64) % BUCKETS)
            of_word.append(row[fits])
    bucket, word = np.concatenate(found), np.concatenate(of_word)
    number = np.bincount(word, minlength=len(starts))
    return bucket.astype(np.int32), (1 / number[word]).astype(np.float32), len(starts)


def _pieces(text):
    """Code points of a lower-cased text, cut at blanks into pieces of bounded length."""
    at = 0
    while at < len(text):
        stop = min(len(text), at + PIECE)
        while stop < len(text) and not text[stop].isspace():
            stop += 1
        yield np.frombuffer(text[at:stop].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        at = stop


def bag(text):
    """A text's n-grams and their shares in the average; a text without words has none."""
    buckets, weights, words = [], [], 0
    for codes in _pieces(text):
        b, w, n = subwords(codes)
        buckets.append(b)
        weights.append(w)
        words += n
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    bucket, weight = np.concatenate(buckets), np.concatenate(weights)
    used, place = np.unique(bucket, return_inverse=True)
    return used.astype(np.int32), (np.bincount(place, weight) / words).astype(np.float32)


def fit(rows, target, prior, epochs=EPOCHS, rate=0.1):
    """Trains embeddings and softmax together; returns a weight per n-gram and a bias.

    ``prior`` is the share of label 1 among all labelled rows, by which the bias of a sample
    with other shares is corrected.
    """
    rng = np.random.default_rng(SEED)
    share = (target.sum() + 1) / (len(target) + 2)
    shift = np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    if len(target) == 0 or target.min() == target.max():
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    # Embeddings begin near zero, so that n-grams never seen in training say nothing.
    table = rng.normal(0, 1e-4, (BUCKETS, DIMENSION)).astype(np.float32)
    softmax = rng.normal(0, 0.3, (DIMENSION, 2)).astype(np.float32)
    offset = np.zeros(2, np.float32)
    ada = AdaGrad(rate)
    for _ in range(epochs):
        order = rng.permutation(len(target))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            part = rows.take(chosen)
            value = part.value * SHARPNESS
            hidden = part.sums(table[part.index] * value[:, None])
            logits = hidden @ softmax + offset
            odds = np.exp(logits - logits.max(1, keepdims=True))
            odds /= odds.sum(1, keepdims=True)
            odds[np.arange(len(chosen)), target[chosen].astype(int)] -= 1
            error = odds / len(chosen)
            back = error @ softmax.T
            pull = back[part.owner()] * value[:, None]
            gradient = np.empty((BUCKETS, DIMENSION), np.float32)
            for k in range(DIMENSION):
                gradient[:, k] = np.bincount(part.index, pull[:, k], BUCKETS)
            ada.step("softmax", softmax, slice(None), hidden.T @ error)
            ada.step("offset", offset, slice(None), error.sum(0))
            ada.step("table", table, slice(None), gradient)
    weight = table @ (softmax[:, 1] - softmax[:, 0]) * SHARPNESS
    return weight.astype(np.float32), float(offset[1] - offset[0] + shift)


def _passages(text, seed):
    """Short runs of words of a text, chosen by its id."""
    words, rng = text.split(), np.random.default_rng(abs(seed))
    for _ in range(PASSAGES if words else 0):
        size = int(rng.integers(1, PASSAGE_WORDS + 1))
        at = int(rng.integers(0, max(1, len(words) - size + 1)))
        yield " ".join(words[at : at + size])


def _bags(batches):
    for batch in batches:
        for row in batch.select(["doc_id", "text", "target"]).to_pylist():
            text = row["text"] or ""
            texts = [text, *(_passages(text, row["doc_id"]) if row["target"] == 0 else [])]
            bags = [bag(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["doc_id"]] * len(bags), pa.int64()),
                    pa.array(range(len(bags)), pa.int32()),
                    pa.array([row["target"]] * len(bags), pa.int32()),
                    pa.array([b.tobytes() for b, _ in bags], pa.binary()),
                    pa.array([w.tobytes() for _, w in bags], pa.binary()),
                ],
                names=["doc_id", "part", "target", "bucket", "weight"],
            )


def _fitter(prior):
    def run(frame):
        frame = frame.sort_values(["doc_id", "part"], kind="stable")
        sizes = np.array([len(x) // 4 for x in frame["bucket"]], np.int64)
        rows = Rows(
            np.concatenate(([0], np.cumsum(sizes))),
            np.frombuffer(b"".join(frame["bucket"]), np.int32),
            np.frombuffer(b"".join(frame["weight"]), np.float32),
        )
        weight, bias = fit(rows, frame["target"].to_numpy(np.float32), prior)
        return pd.DataFrame({"weight": [weight.tobytes()], "bias": [bias]})

    return run


def train(documents, labels, most=SAMPLE):
    """``(weights, bias)`` learned from at most ``most`` labelled documents.

    The sample is bounded by the parameter and fitted in one task. Without labels every text
    scores 0.5.
    """
    known = labels.filter(~held_out(F.col("doc_id"))).agg(F.avg(F.col("toxic").cast("int")).alias("p")).first()["p"]
    prior = min(max(known or 0.5, 1e-4), 1 - 1e-4)
    chosen = sample(documents, labels, "toxic", most, balanced=True)
    bags = chosen.mapInArrow(_bags, "doc_id long, part int, target int, bucket binary, weight binary")
    model = bags.withColumn("all", F.lit(True)).groupBy("all").applyInPandas(_fitter(prior), "weight binary, bias double").first()
    if model is None:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(bytes(model["weight"]), np.float32), model["bias"]


def scored(documents, model):
    """``doc_id`` and the probability of label 1; a text without words gets the bias alone."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def one(text, weight):
        total, words = 0.0, 0
        for codes in _pieces(text):
            bucket, share, n = subwords(codes)
            total += float(np.dot(weight[bucket], share))
            words += n
        return total / words if words else 0.0

    def run(batches):
        weight, bias = shared.value
        for batch, texts in text_slices(batches, "text"):
            logits = np.array([one(t.as_py().decode("utf-8", "replace"), weight) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array(sigmoid(logits + bias).astype(np.float64), pa.float64()),
                ],
                names=["doc_id", "score"],
            )

    return documents.mapInArrow(run, "doc_id long, score double")


def toxicity_scores(documents, labels, most=SAMPLE, threshold=THRESHOLD):
    """Toxicity of every text: ``(doc_id, held_out, score, predicted)``, a row per input row.

    Learns from ``labels`` ``(doc_id, toxic)``, without the rows whose
    ``crc32(doc_id) mod 5`` is 0. Only the text enters the score.

    * NULL, empty and wordless texts score by the bias; equal texts score alike.
    * NULL ``doc_id``: scored, counted as held out. Repeated rows give repeated results.
    * No labels: 0.5 for all. An empty table gives an empty result.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scored(rows, train(rows, labels, most)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
