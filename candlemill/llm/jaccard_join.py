"""N-gram Jaccard self-join by universe partition and the pigeonhole principle.

Two sets that are similar enough differ in at most H shingles, H following from their
sizes. Hashing the shingles into more than H segments therefore leaves a segment in which
they agree, and if some segments may differ in one shingle, fewer agreements will do: a
pair within H must agree in a segment i up to ``v_i - 1`` shingles, as soon as the ``v_i``
add up to H + 1. Every document publishes, for the size band it is in, the hash of each
segment; it asks, in its own band and in the next smaller one, documents no larger than
itself, with the cheapest choice of ``v`` (``_allocate``): 0 leaves a segment out, 1 asks
for equality, 2 asks for the segment and for its one-deletion neighbours, which the first
segments of a band publish too.

Empty segments agree everywhere and say nothing, so a band has some ``spare`` segments more
than H + 1, and a document with at most ``spare`` empty segments doesn't publish those:
documents that agree in ``spare`` + 1 segments then agree in one that is not empty in either.
A document with more empty segments publishes them as well, and two of this kind may meet there.

Documents that ask for and publish such a hash are candidates; they are verified exactly, on
their whole sets of 64-bit shingle hashes, in blocks of bounded size.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from candlemill.llm.common import staged, text_slices
from candlemill.llm.components import connected
from candlemill.llm.wordhash import as_long, batch_words, grams, mix

#: Ratio of the ends of a size band.
BAND = 1.25
#: Documents of one block of a group; a task compares two blocks.
BLOCK = 256
#: Expected crowd behind an empty segment, against which the cost of a hash is weighed.
CROWD = 1000.0
#: Marks of a hash, in its lowest two bits.
ASKED, PUBLISHED = 1, 2
_U = np.uint64


class Bands:
    """Size bands and, for each, the number of segments, how many of them are spare, and how
    many publish deletions."""

    def __init__(self, percent):
        self.percent = percent
        self.lows, self.segments, self.spare, self.deletions = [1], [], [], []

    def largest(self, size):
        """The largest set that a set of ``size`` shingles may be linked with."""
        return size * 100 // self.percent

    def differing(self, a, b):
        """How many shingles linked sets of these sizes may differ in."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def band(self, size):
        while self.lows[-1] <= size:
            low = self.lows[-1]
            # A linked pair lies in one band or in two neighbouring ones.
            high = max(int(low * BAND), self.largest(low) + 1)
            h = self.differing(high - 1, self.largest(high - 1))
            # As many more as are likely to be empty in the smallest sets; any number is right.
            m = h + 1
            while h and m < 2 * h and m * (1 - (1 - 1 / m) ** low) - m**0.5 / 2 < h + 1:
                m += 1 + m // 50
            self.lows.append(high)
            self.segments.append(m)
            self.spare.append(m - h - 1)
            self.deletions.append(0 if h == 0 else 1 + h // 64)
        return int(np.searchsorted(self.lows, size, side="right")) - 1

    def high(self, band):
        return self.lows[band + 1] - 1


def _allocate(counts, need, raisable):
    """Segments to ask with, and those of them to ask with one-deletion neighbours.

    ``counts`` are the shingles in each segment. An agreement by chance grows rarer with
    every shingle, so a hash costs ``1 + CROWD * exp(-count)``. The ``need`` cheapest
    segments are asked; while a segment left in costs more than raising one of the first
    ``raisable`` segments to its deletion neighbours, it is left out for that. A segment of one
    shingle isn't raised, as its neighbour would be empty.
    """
    cost = 1 + CROWD * np.exp(-counts.astype(float))
    order = np.argsort(cost, kind="stable")[:need]
    chosen = list(order)
    raised = []
    able = sorted((s for s in chosen if s < raisable and counts[s] > 1), key=lambda s: cost[s])
    for s in able:
        worst = chosen[-1]
        price = counts[s] + CROWD * (counts[s] + 1) * np.exp(1.0 - counts[s])
        if worst == s or worst in raised or cost[worst] <= price:
            break
        chosen.pop()
        raised.append(s)
    return np.array(chosen, int), np.array(raised, int)


def _signatures(shingles, bands):
    """Hashes a set publishes and asks with, each once, with its marks in the lowest bits."""
    n = len(shingles)
    band = bands.band(n)
    hashes, marks = [], []

    def say(found, mark):
        hashes.append(found)
        marks.append(np.full(len(found), mark, _U))

    for b in (band, band - 1):
        if b < 0 or bands.largest(bands.high(b)) < n:
            continue
        m, raisable = bands.segments[b], bands.deletions[b]
        place = mix(shingles ^ _U(b + 1))
        segment = ((place >> _U(33)) * _U(m) >> _U(31)).astype(np.int64)
        sums = np.zeros(m, _U)
        np.add.at(sums, segment, place)
        salt = mix((np.arange(m, dtype=_U) << _U(16)) + _U(b + 1))
        counts = np.bincount(segment, minlength=m)
        whole = mix(sums ^ salt)

        def without_one(segments):
            drop = np.isin(segment, segments)
            at = segment[drop]
            return mix((sums[at] - place[drop]) ^ salt[at])

        # The partner is no larger, so the sizes bound how much the two may differ.
        need = bands.differing(n, min(bands.high(b), n)) + 1
        asked, raised = _allocate(counts, need, raisable)
        say(whole[asked], ASKED)
        say(without_one(raised), ASKED)
        if b == band:
            full = counts > 0
            say(whole if m - full.sum() > bands.spare[b] else whole[full], PUBLISHED)
            # Neighbours are asked for with two shingles or more.
            say(without_one(np.flatnonzero(counts[:raisable] > 2)), PUBLISHED)
    found, place = np.unique(np.concatenate(hashes) & ~_U(3), return_inverse=True)
    np.bitwise_or.at(found, place, np.concatenate(marks))
    return found


def _sets(texts, n):
    """Distinct shingle hashes of each text, sorted; a shorter text is one shingle."""
    hashes, first, *_ = batch_words(texts, lower=True)
    for i in range(len(first) - 1):
        words = hashes[first[i] : first[i + 1]]
        if not len(words):
            yield words
            continue
        # The length goes in, so that a short text equals only texts of as many words.
        size = min(n, len(words))
        yield np.unique(grams(words, size) + _U(size))


def _sketches(n, percent):
    """Per document its set's size, a 64-bit name of the set, and the set's hashes."""

    def run(batches):
        bands, seen = Bands(percent), set()
        for batch, texts in text_slices(batches, "text"):
            sizes, names, lists = [], [], []
            for shingles in _sets(texts, n):
                size = len(shingles)
                name = int(as_long(mix(shingles).sum(keepdims=True) ^ _U(size))[0]) if size else None
                sizes.append(size)
                names.append(name)
                # Equal sets act as one; a task says each set's hashes once while it remembers it.
                if not size or name in seen:
                    lists.append(None)
                    continue
                if len(seen) < 1_000_000:
                    seen.add(name)
                lists.append(as_long(_signatures(shingles, bands)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    batch.column(batch.schema.get_field_index("text_id")),
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.int64()),
                    pa.array(lists, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_id", "n_shingles", "set_id", "hashes"],
            )

    return run


def _whole_sets(n):
    """The sets themselves, as bytes, of documents to be verified."""

    def run(batches):
        for batch, texts in text_slices(batches, "text"):
            sets = [s.tobytes() for s in _sets(texts, n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("set_id")), pa.array(sets, pa.binary())],
                names=["set_id", "shingles"],
            )

    return run


def _shared(left, right):
    """Sizes of the intersections of two lists of sets, as a matrix."""
    lists = left + right
    tokens = np.concatenate(lists)
    owner = np.repeat(np.arange(len(lists)), [len(s) for s in lists])
    _, column, times = np.unique(tokens, return_inverse=True, return_counts=True)
    often = times > 1
    number = np.cumsum(often) - 1
    keep = often[column]
    column, owner = number[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for at in range(0, int(often.sum()), width):
        lo, hi = np.searchsorted(column, [at, at + width])
        grid = np.zeros((len(lists), width), np.float32)
        grid[owner[lo:hi], column[lo:hi] - at] = 1
        total += grid[: len(left)] @ grid[len(left) :].T
    return total


def _forest(n, pairs):
    """A spanning forest of the pairs: as connected as they are, fewer than ``n`` of them."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            yield i, j


def _verify(percent, count):
    """Links between two blocks of a group, as many as keep linked documents connected.

    With ``count``, also how many rows each set is linked to in this cell (as ``a``, ``n``); a
    pair of sets that meets in several groups counts in the first of them, which the members'
    ``earlier`` groups tell.
    """

    def linked(common, a, b):
        return 100 * common >= percent * (a + b - common)

    def pairs_of(frame):
        ids = frame["set_id"].to_numpy()
        sets = [np.frombuffer(x, _U) for x in frame["shingles"]]
        sides = frame["side"].to_numpy()
        if len(ids) == 2 and not count:
            common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
            return ([(ids[0], ids[1])] if linked(common, len(sets[0]), len(sets[1])) else []), []
        # Side 2 marks the only block of a pair of a block with itself.
        left, right = np.flatnonzero(sides != 1), np.flatnonzero(sides != 0)
        if not len(left) or not len(right):
            return [], []
        sizes = np.array([len(s) for s in sets], float)
        common = _shared([sets[i] for i in left], [sets[i] for i in right])
        joint = sizes[left][:, None] + sizes[right][None, :] - common
        near = (100 * common >= percent * joint) & (left[:, None] != right[None, :])
        rows, columns = np.nonzero(near)
        links = [(ids[i], ids[j]) for i, j in _forest(len(ids), zip(left[rows], right[columns]))]
        if not count or not len(rows):
            return links, []
        earlier = [np.asarray(x, np.int64) for x in frame["earlier"]]
        near &= _shared([earlier[i] for i in left], [earlier[i] for i in right]) == 0
        copies = frame["copies"].to_numpy()
        counts = list(zip(ids[left], near @ copies[right]))
        if sides[0] != 2:
            counts += zip(ids[right], near.T @ copies[left])
        return links, [(i, n) for i, n in counts if n]

    def run(batches):
        """Rows come sorted by cell; a cell may go on in the next batch."""
        rest = None
        for batch in batches:
            frame = batch.to_pandas()
            if rest is not None:
                frame = pd.concat([rest, frame], ignore_index=True)
            cells = frame[["hub", "i", "j"]].to_numpy()
            cuts = np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1
            bounds = [0, *cuts]
            yield _found([pairs_of(frame.iloc[a:b]) for a, b in zip(bounds, cuts) if b - a > 1])
            rest = frame.iloc[bounds[-1] :]
        if rest is not None and len(rest) > 1:
            yield _found([pairs_of(rest)])

    def _found(cells):
        rows = [(a, b, None) for links, _ in cells for a, b in links]
        rows += [(a, None, n) for _, counts in cells for a, n in counts]
        a, b, n = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], names=["a", "b", "n"])

    return run


def _candidates(said):
    """``(hub, set_id)``: the sets that share a hash one of them asks for and one publishes,
    grouped by the least of them.

    ``said`` has ``set_id`` and a hash with its marks in one number. It is shuffled once, by
    hash: nearly all hashes occur once, so what is found per hash stays small and is joined
    to the same shuffled rows.
    """
    hashed = F.shiftright("said", 2)
    rows = said.repartition(hashed).select("set_id", "said", hashed.alias("hash"))
    mark = F.col("said").bitwiseAND(3)
    hubs = (
        rows.groupBy("hash")
        .agg(F.min("set_id").alias("hub"), F.max("set_id").alias("last"), F.bit_or(mark).alias("marks"))
        .filter((F.col("hub") != F.col("last")) & (F.col("marks") == ASKED | PUBLISHED))
        .select("hash", "hub")
    )
    return rows.join(hubs.hint("shuffle_hash"), "hash").select("hub", "set_id").distinct()


def _placed(members):
    """Every member with the number of blocks of its group and its own block."""
    sizes = members.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    # Read from a table, so that Spark can split the members of a hot hub in the join.
    sizes = staged(sizes, "group-sizes")
    return members.join(sizes, "hub").withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")))


def _cells(placed, columns):
    """Every member once for each pair of blocks it takes part in, with the pair's numbers.

    Two blocks meet in one cell, so a group of any size is compared in tasks of at most
    two blocks; a member goes to as many cells as its group has blocks.
    """
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    side = F.when(F.col("other") == F.col("block"), 2).when(F.col("block") < F.col("other"), 0)
    return placed.withColumn("other", other).select(
        "hub",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        side.otherwise(1).alias("side"),
        *columns,
    )


def near_sets(documents, n=3, percent=90):
    """Links documents whose sets of ``n``-word shingles have a Jaccard index of
    ``percent`` / 100 or more, names the connected classes and counts the links.

    Takes ``doc_id`` (long) and ``text``; other columns are ignored. Words are runs other
    than ASCII white space, A-Z lower-cased. Returns ``(doc_id, n_shingles, component_id,
    n_links)``, a row per input row; ``component_id`` is the least ``doc_id`` of the class,
    ``n_links`` the number of other rows that the row is linked to itself.

    * NULL, empty and blank texts: no shingles, linked with nothing.
    * Fewer than ``n`` words: the whole sequence is the one shingle.
    * Equal sets are always linked. Repeated rows of one ``doc_id`` give as many rows.
    * NULL ``doc_id``: the row is kept with its class; it never names one.
    * Different texts under one ``doc_id`` are linked each by its own set.
    * An empty table gives an empty result.
    """
    return near_texts(documents, n, percent, count=True).drop("text_id")


def near_texts(documents, n, percent, count=False):
    """``near_sets`` with ``text_id``, the text's ``xxhash64``, which tells rows of one
    ``doc_id`` apart, and with ``n_links`` only if asked to ``count``."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("text_id", F.xxhash64("text"))
    sketches = staged(
        docs.mapInArrow(
            _sketches(n, percent), "doc_id long, text_id long, n_shingles long, set_id long, hashes array<long>"
        ),
        "sketches",
    )
    said = sketches.select("set_id", F.explode("hashes").alias("said"))
    members = staged(_candidates(said), "members")
    # One text stands for each set that has to be verified; its row may have no doc_id.
    wanted = members.select("set_id").distinct()
    stand_ins = (
        sketches.filter("set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(F.min(F.struct("text_id", "doc_id")).alias("row"))
        .join(wanted, "set_id")
        .select("set_id", F.col("row.text_id").alias("of_text"), F.col("row.doc_id").alias("of_doc"))
    )
    met = (F.col("text_id") == F.col("of_text")) & F.col("doc_id").eqNullSafe(F.col("of_doc"))
    texts = docs.join(stand_ins, met).select("set_id", "text")
    sets = texts.mapInArrow(_whole_sets(n), "set_id long, shingles binary").dropDuplicates(["set_id"])
    # Joined as members, before they go to cells.
    placed = _placed(members).join(sets, "set_id")
    told = ["set_id", "shingles"]
    if count:
        # A set is in at most as many groups as it has hashes.
        groups = members.groupBy("set_id").agg(F.collect_list("hub").alias("hubs"))
        copies = sketches.groupBy("set_id").agg(F.count("*").alias("copies"))
        placed = placed.join(groups, "set_id").join(copies, "set_id")
        placed = placed.withColumn("earlier", F.filter("hubs", lambda h: h < F.col("hub")))
        told += ["earlier", "copies"]
    cells = _cells(placed, told).repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")
    found = cells.mapInArrow(_verify(percent, count), "a long, b long, n long")
    found = staged(found, "verified") if count else found
    classes = connected(found).select(F.col("node").alias("set_id"), F.col("component").alias("class"))
    named = (
        sketches.filter("set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("doc_id"), (F.count("*") - 1).alias("n_links"))
        .join(classes, "set_id", "left")
        .withColumn("class", F.coalesce("class", "set_id"))
    )
    if count:
        others = found.filter("n IS NOT NULL").groupBy(F.col("a").alias("set_id")).agg(F.sum("n").alias("n"))
        named = named.join(others, "set_id", "left").withColumn("n_links", F.col("n_links") + F.coalesce("n", F.lit(0)))
    least = named.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    of_set = staged(named.join(least, "class").select("set_id", "component_id", "n_links"), "classes")
    rows = sketches.select("doc_id", "text_id", "n_shingles", "set_id").join(of_set, "set_id", "left")
    rows = rows.withColumns(
        {
            "component_id": F.coalesce("component_id", "doc_id"),
            "n_links": F.coalesce("n_links", F.lit(0).cast("long")),
        }
    )
    return rows.select("doc_id", "text_id", "n_shingles", "component_id", *(["n_links"] if count else []))
