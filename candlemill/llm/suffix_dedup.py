"""Repeated passages by sparse suffix arrays.

Suffixes are kept only at content-selected positions: in every run of ``gap`` word positions
the one whose ``MARK``-word hash is least. A passage of ``min_words`` words that occurs twice
has such a position among its first ``gap`` words, the same in both places, and the
``min_words - gap + 1`` words from there on lie inside it. Suffixes that agree in these words
are brought together by their hash. There they are sorted by the words that follow and, once
more, by the words that precede, read backwards. Neighbours of either order are compared word
by word, which tells how far matches extend to the right and to the left; occurrences whose
extensions together reach ``min_words`` words hold the same passage. A passage longer than that
holds further positions, each of which adds its own part, so the parts join to the whole passage.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlemill.llm.common import staged, text_slices
from candlemill.llm.wordhash import as_long, batch_words, grams, mix

#: Words hashed to select positions.
MARK = 8
#: Suffixes with equal heads that one task sorts in memory; larger groups are compared by
#: their windows, one row each, with the same outcome.
GROUP = 20_000
_U = np.uint64


def _sliding(values, width, least):
    """Least or greatest value of every window of ``width`` positions."""
    pick = np.minimum if least else np.maximum
    span = 1
    while span * 2 <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def _anchors(words, gap):
    """Positions selected in one text; the leftmost of equal hashes."""
    marks = grams(words, MARK)
    if len(marks) < gap:
        return np.zeros(0, np.int64)
    low = _U((1 << 24) - 1)
    order = (marks & ~low) | (np.arange(len(marks), dtype=_U) & low)
    least = _sliding(order, gap, True)
    pad = np.zeros(gap - 1, _U)
    # Selected: least of some window that holds the position.
    return np.flatnonzero(_sliding(np.concatenate((pad, least, pad)), gap, False) == order)


def _heads(min_words, gap):
    head = min_words - gap + 1

    def run(batches):
        for batch, texts in text_slices(batches, "text"):
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_numpy(zero_copy_only=False)
            hashes, first, *_ = batch_words(texts)
            variants = batch.column(batch.schema.get_field_index("variant")).to_numpy(zero_copy_only=False)
            docs, kinds, places, keys = [], [], [], []
            for i in range(len(ids)):
                words = hashes[first[i] : first[i + 1]]
                if len(words) < min_words:
                    continue
                at = _anchors(words, gap)
                at = at[at + head <= len(words)]
                docs.append(np.full(len(at), ids[i]))
                kinds.append(np.full(len(at), variants[i]))
                places.append(at)
                keys.append(as_long(grams(words, head)[at]))
            join = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(join(keys)),
                    pa.array(join(docs)),
                    pa.array(join(kinds)),
                    pa.array(join(places), pa.int64()).cast(pa.int32()),
                ],
                names=["head", "doc_id", "variant", "place"],
            )

    return run


def _contexts(min_words, gap):
    """For each shared head its surrounding words, four bytes a word, and how many there are."""

    def run(batches):
        for batch, texts in text_slices(batches, "text"):
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            variants = batch.column(batch.schema.get_field_index("variant"))
            heads = batch.column(batch.schema.get_field_index("heads"))
            hashes, first, *_ = batch_words(texts)
            out = {"head": [], "copies": [], "doc_id": [], "variant": [], "place": [], "left": [], "right": [], "words": []}
            for i in range(len(ids)):
                words = (hashes[first[i] : first[i + 1]] >> _U(32)).astype(np.uint32)
                for head in heads[i].as_py():
                    place = head["place"]
                    lo, hi = max(0, place - gap + 1), min(len(words), place + min_words)
                    out["head"].append(head["head"])
                    out["copies"].append(head["copies"])
                    out["doc_id"].append(ids[i].as_py())
                    out["variant"].append(variants[i].as_py())
                    out["place"].append(place)
                    out["left"].append(place - lo)
                    out["right"].append(hi - place)
                    out["words"].append(words[lo:hi].tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=_CONTEXT)

    return run


_CONTEXT = pa.schema(
    [
        ("head", pa.int64()),
        ("copies", pa.int64()),
        ("doc_id", pa.int64()),
        ("variant", pa.int64()),
        ("place", pa.int32()),
        ("left", pa.int32()),
        ("right", pa.int32()),
        ("words", pa.binary()),
    ]
)
_SPANS = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "variant", "start", "end", "first_doc_id")]
)
_SPAN_TYPE = "doc_id long, variant long, start long, end long, first_doc_id long"


def _windows(frame, min_words, gap):
    """Hash of each window of ``min_words`` words around each position.

    Column o is the window that begins o words before the position; windows that leave the
    text are marked in the second array. The head goes in, for windows stay within a group.
    """
    n, width = len(frame["place"]), min_words + gap - 1
    left, right = frame["left"], frame["right"]
    grid = np.zeros((n, width), np.uint32)
    sizes = left + right
    row = np.repeat(np.arange(n), sizes)
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    column = np.arange(int(sizes.sum())) - np.repeat(begin, sizes) + np.repeat(gap - 1 - left, sizes)
    grid[row, column] = np.frombuffer(b"".join(frame["words"]), np.uint32)
    step = _U(0xD6E8FEB86659FD93)
    found = np.zeros((n, gap), _U)
    for o in range(gap):
        at = gap - 1 - o
        if o == 0:
            total = np.zeros(n, _U)
            for k in range(min_words):
                total = total * step + mix(grid[:, at + k].astype(_U) + _U(1))
        else:
            # One word further left: it joins in front, the last one leaves.
            total = (total - mix(grid[:, at + min_words].astype(_U) + _U(1))) * inverse(step)
            total = total + mix(grid[:, at].astype(_U) + _U(1)) * power(step, min_words - 1)
        found[:, o] = mix(total ^ frame["head"].view(_U))
    offset = np.arange(gap)[None, :]
    inside = (offset <= left[:, None]) & (min_words - offset <= right[:, None])
    return found, inside


def inverse(x):
    return _U(pow(int(x), -1, 1 << 64))


def power(x, n):
    return _U(pow(int(x), n, 1 << 64))


def _columns(batch):
    frame = {}
    for name in batch.schema.names:
        column = batch.column(batch.schema.get_field_index(name))
        frame[name] = column.to_pylist() if name == "words" else column.to_numpy(zero_copy_only=False)
    return frame


def _around(frame, min_words, gap):
    """The words after each position and those before it, read backwards; 0 where a text ends."""
    n, left, right = len(frame["place"]), frame["left"], frame["right"]
    after, before = np.zeros((n, min_words), np.uint32), np.zeros((n, gap - 1), np.uint32)
    sizes = left + right
    row = np.repeat(np.arange(n), sizes)
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    column = np.arange(int(sizes.sum())) - np.repeat(begin + left, sizes)
    words = np.maximum(np.frombuffer(b"".join(frame["words"]), np.uint32), 1)
    ahead = column >= 0
    after[row[ahead], column[ahead]] = words[ahead]
    before[row[~ahead], -1 - column[~ahead]] = words[~ahead]
    return after, before


def _neighbours(head, words, length):
    """The order of rows by head and words, and how many words each shares with the row before
    it in that order; -1 for the first row of a head."""
    keys = np.empty((len(head), words.shape[1] + 2), ">u4")
    keys[:, 0], keys[:, 1] = head.view(_U) >> _U(32), head.view(_U) & _U(0xFFFFFFFF)
    keys[:, 2:] = words
    order = np.argsort(keys.view(f"S{keys.shape[1] * 4}").ravel(), kind="stable")
    head, words, length = head[order], words[order], length[order]
    same = words[1:] == words[:-1]
    common = np.where(same.all(axis=1), words.shape[1], same.argmin(axis=1))
    common = np.minimum(common, np.minimum(length[1:], length[:-1]))
    common[head[1:] != head[:-1]] = -1
    return order, np.concatenate(([-1], common))


def _runs(order, common, least):
    """A number per row, the same for rows between which all neighbours share ``least`` words."""
    run = np.empty(len(order), np.int64)
    run[order] = np.cumsum(common < least)
    return run


def _compare(min_words, gap):
    """Spans that repeat an earlier document's, from rows sorted by head.

    Two occurrences hold the same window that begins o words before the position if they share
    o words to the left and the rest to the right: if they are in one run of either order. Of
    the occurrences in both runs the document that comes first owns the window, and every other
    document's occurrence is a repeat.
    """

    def spans(frame):
        head, docs, left, right = frame["head"], frame["doc_id"], frame["left"], frame["right"]
        after, before = _around(frame, min_words, gap)
        to_right, to_left = _neighbours(head, after, right), _neighbours(head, before, left)
        rows, offsets, owners = [], [], []
        for o in range(gap):
            row = np.flatnonzero((left >= o) & (right >= min_words - o))
            key = _runs(*to_right, min_words - o)[row] * (len(docs) + 1) + _runs(*to_left, o)[row]
            order = np.lexsort((docs[row], key))
            row, key = row[order], key[order]
            new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
            owner = docs[row][new][np.cumsum(new) - 1]
            again = docs[row] != owner
            rows.append(row[again])
            owners.append(owner[again])
            offsets.append(np.full(int(again.sum()), o))
        row, owner, offset = (np.concatenate(part) for part in (rows, owners, offsets))
        start = frame["place"][row].astype(np.int64) - offset
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (docs[row], frame["variant"][row], start, start + min_words, owner)],
            schema=_SPANS,
        )

    def merged(batch):
        """Overlapping spans of one position and one origin in one row."""
        table = pa.Table.from_batches([batch]).to_pandas()
        table = table.sort_values(["doc_id", "variant", "first_doc_id", "start"], kind="stable")
        far = table.groupby(["doc_id", "variant", "first_doc_id"], sort=False)["end"].cummax()
        fresh = (
            (table["doc_id"] != table["doc_id"].shift())
            | (table["variant"] != table["variant"].shift())
            | (table["first_doc_id"] != table["first_doc_id"].shift())
            | (table["start"] > far.shift())
        )
        joined = table.groupby(fresh.cumsum(), sort=False).agg(
            doc_id=("doc_id", "first"),
            variant=("variant", "first"),
            start=("start", "first"),
            end=("end", "max"),
            first_doc_id=("first_doc_id", "first"),
        )
        return pa.RecordBatch.from_pandas(joined, schema=_SPANS, preserve_index=False)

    def run(batches):
        rest = None
        for batch in batches:
            frame = _columns(batch)
            if rest is not None:
                frame = {c: rest[c] + v if c == "words" else np.concatenate((rest[c], v)) for c, v in frame.items()}
            head = frame["head"]
            cut = int(np.flatnonzero(head == head[-1])[0]) if len(head) else 0
            if cut:
                yield merged(spans({c: v[:cut] for c, v in frame.items()}))
            rest = {c: v[cut:] for c, v in frame.items()}
        if rest is not None and len(rest["head"]):
            yield merged(spans(rest))

    return run


def _as_rows(min_words, gap):
    """The windows of large groups, one row each."""

    def run(batches):
        for batch in batches:
            frame = _columns(batch)
            for at in range(0, len(frame["place"]), 4096):
                part = {c: v[at : at + 4096] for c, v in frame.items()}
                hashes, inside = _windows(part, min_words, gap)
                row, offset = np.nonzero(inside)
                start = part["place"][row].astype(np.int64) - offset
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (as_long(hashes[row, offset]), part["doc_id"][row], part["variant"][row], start)],
                    names=["window", "doc_id", "variant", "start"],
                )

    return run


def _joined(spans):
    """Overlapping or touching spans of a text as one; the least origin of each."""
    order = Window.partitionBy("doc_id", "variant").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)
    island = F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        spans.withColumn("fresh", fresh)
        .withColumn("island", island)
        .groupBy("doc_id", "variant", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("first_doc_id").alias("first_doc_id"))
    )


def _repeated_ids(documents):
    """``doc_id`` of more rows than one. Read from a table, so that Spark broadcasts few."""
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL")
    return staged(ids.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "repeated-ids")


def repeated_spans(documents, min_words=50, gap=25, group=GROUP):
    """Passages of ``min_words`` words or more that an earlier document holds too.

    Takes ``doc_id`` (long) and ``text``; other columns are ignored. Words are runs other than
    ASCII white space, compared as they stand. "Earlier" is by ``doc_id``: the first document
    of a passage keeps it. Returns ``(doc_id, start_word, end_word, n_words, first_doc_id)``,
    a row for each maximal run of words of which every window of ``min_words`` words or their
    union is repeated; ``first_doc_id`` is the least document that holds a part of it.

    * NULL, empty and short texts, and rows without ``doc_id``, have no spans.
    * A passage repeated inside one document only is no repeat.
    * Rows that share a ``doc_id`` count as one document, of which each distinct text has its own
      spans; equal rows give their spans once.
    * An empty table gives an empty result.
    """
    spans = _text_spans(documents, _repeated_ids(documents), min_words, gap, group)
    return spans.drop("variant")


def _text_spans(documents, repeated, min_words, gap, group):
    """``repeated_spans`` with ``variant``, which tells the texts of a repeated ``doc_id`` apart:
    the text's ``xxhash64``, 0 for other documents."""
    if not MARK <= min_words - gap + 1 or gap < 2:
        raise ValueError("gap must leave at least as many words as a position is selected by")
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).filter("doc_id IS NOT NULL")
    several = docs.join(repeated, "doc_id", "left_semi").withColumn("variant", F.xxhash64("text"))
    once = docs.join(repeated, "doc_id", "left_anti").withColumn("variant", F.lit(0).cast("long"))
    docs = once.unionByName(several.dropDuplicates(["doc_id", "variant"]))
    heads = docs.mapInArrow(_heads(min_words, gap), "head long, doc_id long, variant long, place int")
    # Read from a table, so that Spark can split the suffixes of a hot head in the join.
    shared = staged(heads.groupBy("head").agg(F.count("*").alias("copies")).filter("copies > 1"), "shared-heads")
    places = (
        heads.join(shared, "head")
        .groupBy("doc_id", "variant")
        .agg(F.collect_list(F.struct("head", "copies", "place")).alias("heads"))
    )
    contexts = staged(
        docs.join(places, ["doc_id", "variant"]).mapInArrow(
            _contexts(min_words, gap),
            "head long, copies long, doc_id long, variant long, place int, left int, right int, words binary",
        ),
        "contexts",
    )
    small = contexts.filter(F.col("copies") <= group).drop("copies").repartition("head")
    spans = small.sortWithinPartitions("head").mapInArrow(_compare(min_words, gap), _SPAN_TYPE)
    rows = contexts.filter(F.col("copies") > group).mapInArrow(
        _as_rows(min_words, gap), "window long, doc_id long, variant long, start long"
    )
    owners = rows.groupBy("window").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"))
    # Read from a table, so that Spark can split the windows of a hot key in the join.
    owners = staged(owners.filter("first_doc_id != last").select("window", "first_doc_id"), "owners")
    large = (
        rows.join(owners, "window")
        .filter("doc_id != first_doc_id")
        .select("doc_id", "variant", "start", (F.col("start") + min_words).alias("end"), "first_doc_id")
        .distinct()
    )
    return _joined(spans.union(large)).select(
        "doc_id",
        "variant",
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        (F.col("end") - F.col("start")).alias("n_words"),
        "first_doc_id",
    )


def _cut(batches):
    """Texts without their repeated spans; text between words stays with the word before it."""
    for batch, texts in text_slices(batches, "text"):
        spans = batch.column(batch.schema.get_field_index("spans"))
        _, first, starts, ends, base = batch_words(texts)
        kept = []
        for i in range(len(texts)):
            if not spans[i].is_valid:
                kept.append(batch.column(batch.schema.get_field_index("text"))[i].as_py())
                continue
            data = texts[i].as_py()
            at, parts = 0, []
            for span in spans[i].as_py():
                lo = first[i] + span["start_word"]
                hi = first[i] + span["end_word"]
                parts.append(data[at : starts[lo] - base[i]])
                at = starts[hi] - base[i] if hi < first[i + 1] else len(data)
            parts.append(data[at:])
            kept.append(b"".join(parts).decode("utf-8"))
        names = [n for n in batch.schema.names if n != "spans"]
        columns = [
            pa.array(kept, pa.string()) if n == "text" else batch.column(batch.schema.get_field_index(n)) for n in names
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def without_repeats(documents, min_words=50, gap=25):
    """The documents with every repeated span cut out but in the first document that has it.

    All columns stay as they are but ``text``. Documents without repeats are unchanged; a
    document that was all repeats keeps an empty text. Of texts that share a ``doc_id`` each
    loses its own spans.
    """
    repeated = _repeated_ids(documents)
    spans = _text_spans(documents, repeated, min_words, gap, GROUP)
    of_text = spans.groupBy(F.col("doc_id").alias("span_doc"), "variant").agg(
        F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias("spans")
    )
    told = documents.join(repeated.select(F.col("doc_id").alias("told_doc")), F.col("doc_id") == F.col("told_doc"), "left")
    variant = F.when(F.col("told_doc").isNotNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    same = (F.col("doc_id") == F.col("span_doc")) & (F.col("text_variant") == F.col("variant"))
    joined = told.withColumn("text_variant", variant).join(of_text, same, "left").select(*documents.columns, "spans")
    return joined.mapInArrow(_cut, documents.schema)
