"""Joins, repeats and decontamination against brute force, with awkward rows among the input."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlemill.llm import decontaminate, jaccard_join, suffix_dedup
from candlemill.llm.components import connected

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, hash string, hub long, start int"


def frame(spark, texts, first=0):
    """Documents with extra columns that clash with names the operators use inside."""
    rows = [(first + i, t, "x", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def words(rng, n):
    return [rng.choice("abcdefghij") + str(rng.randrange(60)) for _ in range(n)]


def edited(rng, source, times):
    out = list(source)
    for _ in range(times):
        at = rng.randrange(len(out))
        out[at : at + rng.randrange(2)] = words(rng, rng.randrange(2))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    found = [None, "", " \n\t ", "One", "one", "one two", "ONE  two", "one two\u00a0three", "x " * 3000]
    for size in (8, 25, 60, 130, 400):
        base = words(rng, size)
        for times in (0, 0, 1, 1, 2, 3, 5, 9, 15):
            found.append(" ".join(edited(rng, base, times)))
    chain = words(rng, 120)
    for _ in range(25):
        chain = edited(rng, chain, 1)
        found.append("  ".join(chain))
    return found


def shingles(text, n):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


@pytest.mark.parametrize("n, percent, block", [(3, 90, 256), (5, 80, 4)])
def test_near_sets(spark, texts, monkeypatch, n, percent, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    sets = [shingles(t, n) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    rows = [*range(len(sets)), 1, 4, 12]  # those of the union below
    links = [0] * len(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
                links[i] += rows.count(j)
    docs = frame(spark, texts)
    same = docs.filter("doc_id IN (1, 4)")  # repeated rows
    nameless = docs.filter("doc_id = 12").withColumn("doc_id", F.lit(None).cast("long"))
    got = jaccard_join.near_sets(docs.union(same).union(nameless), n, percent).collect()
    assert len(got) == len(texts) + 3
    for r in got:
        at = 12 if r.doc_id is None else r.doc_id
        assert (r.n_shingles, r.component_id) == (len(sets[at]), find(at))
        assert r.n_links == max(links[at] - 1, 0)  # not to itself
    assert max(links) > 9


def test_near_sets_of_two_texts_under_one_id(spark):
    import corpus_pipeline

    rng = random.Random(4)
    x, y, m = words(rng, 100), words(rng, 100), words(rng, 100)
    new = [f"new{i}" for i in range(8)]
    rows = [
        (2, " ".join([*x[:-1], "new"])),
        (5, " ".join(x)),
        (5, " ".join(y)),
        (9, " ".join([*y[:-1], "new"])),
        # Only the row without an id links the two around it.
        (20, " ".join([*m[:-8], *new])),
        (None, " ".join([*m[:-4], *new[4:]])),
        (21, " ".join(m)),
    ]
    sets = [shingles(t, 3) for _, t in rows]
    near = lambda i, j: 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    assert near(4, 5) and near(5, 6) and not near(4, 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id or 0), r.component_id) for r in jaccard_join.near_sets(docs, 3, 85).collect())
    assert got == [(0, 20), (2, 2), (5, 2), (5, 5), (9, 5), (20, 20), (21, 20)]
    kept = {tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs.filter("doc_id < 10"), None).collect()}
    assert kept == {rows[0], rows[2]}


@pytest.mark.parametrize("percent", [50, 70, 80, 90, 95])
def test_linked_sets_meet_in_a_hash(percent):
    """Pairs at the border of the similarity, many with more empty segments than are spare."""
    draw = np.random.default_rng(percent)
    bands, met = jaccard_join.Bands(percent), 0
    for _ in range(600):
        size = int(np.exp(draw.uniform(0, 6)))
        one = draw.integers(0, 2**63, size).astype(np.uint64)
        lost = int(draw.integers(0, size * (100 - percent) // 100 + 1))
        room = 100 * (size - lost) // percent - size
        other = np.concatenate([one[lost:], draw.integers(0, 2**63, max(room, 0)).astype(np.uint64)])
        common = len(np.intersect1d(one, other))
        if room < 0 or not lost + room or 100 * common < percent * (len(one) + len(other) - common):
            continue
        said = [{int(h) >> 2: int(h) & 3 for h in jaccard_join._signatures(np.unique(s), bands)} for s in (one, other)]
        both = said[0].keys() & said[1].keys()
        assert any((said[0][h] | said[1][h]) == 3 for h in both), (percent, len(one), len(other), common)
        met += 1
    assert met > 100


def test_allocation_reaches_what_is_needed():
    import numpy as np

    counts = np.array([9, 8, 0, 10, 7, 0, 9])
    chosen, raised = jaccard_join._allocate(counts, 7, 2)
    assert len(chosen) + len(raised) == 7 and set(raised) <= {0, 1} and 5 not in chosen


def test_components_of_a_long_path(spark):
    rng = random.Random(1)
    ids = rng.sample(range(1000), 60)
    links = spark.createDataFrame([*zip(ids, ids[1:]), (5000, 5001), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in connected(links).collect()}
    assert got == {**dict.fromkeys(ids, min(ids)), 5000: 5000, 5001: 5000}


def repeats(texts, n):
    """Positions covered by a window of n words that an earlier document has."""
    first, covered = {}, {}
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        marks = [False] * len(w)
        for k in range(len(w) - n + 1):
            if first.setdefault(tuple(w[k : k + n]), i) != i:
                marks[k : k + n] = [True] * n
        covered[i] = marks
    return covered


@pytest.mark.parametrize("group", [2, 20_000])
def test_repeated_spans(spark, texts, group):
    rng = random.Random(9)
    passage = words(rng, 70)
    more = [" ".join([*words(rng, 9), *passage[:k], *words(rng, 9)]) for k in (70, 50, 49, 70, 60)]
    more.append(" ".join([*passage[20:], "é", *passage[:30]]))
    every = texts + more
    want = repeats(every, 50)
    docs = frame(spark, every)
    nameless = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    got = {i: [False] * len(m) for i, m in want.items()}
    rows = suffix_dedup.repeated_spans(docs.union(nameless), group=group).collect()
    for r in rows:
        assert r.first_doc_id < r.doc_id and r.n_words == r.end_word - r.start_word >= 50
        got[r.doc_id][r.start_word : r.end_word] = [True] * r.n_words
    assert got == want and any(map(any, want.values()))
    if group > 2:
        cut = suffix_dedup.without_repeats(docs)
        assert cut.columns == docs.columns
        for r in cut.collect():
            kept = [w for w, gone in zip(WORD.findall(every[r.doc_id] or ""), want[r.doc_id]) if not gone]
            assert WORD.findall(r.text or "") == kept
            if not any(want[r.doc_id]):
                assert r.text == every[r.doc_id]


def test_repeats_of_two_texts_under_one_id(spark):
    rng = random.Random(6)
    passage, own = words(rng, 60), words(rng, 300)
    rows = [
        (1, " ".join(passage)),
        (2, " ".join([*own[:200], *passage, *own[200:]])),
        (2, "short text"),
        (2, " ".join(own[100:200])),
        *[(3, " ".join([*passage, "end"]))] * 3,
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spans = sorted(tuple(r) for r in suffix_dedup.repeated_spans(docs).collect())
    assert spans == [(2, 200, 260, 60, 1), (3, 0, 60, 60, 1)]
    kept = sorted((r.doc_id, r.text) for r in suffix_dedup.without_repeats(docs).collect())
    want = [rows[0], (2, " ".join(own)), rows[2], rows[3], *[(3, "end")] * 3]
    assert kept == sorted(want)


ITEMS = [
    (1, "A train leaves Paris at 9 and travels 120 km to reach Lyon before 12 if nothing stops it on the way to Lyon today."),
    (2, "Short item of five words."),
    (3, None),
    (4, "The shop sold 5 red apples then bought 5 green pears and counted everything again that same evening."),
]
DOCS = [
    (10, "Intro text here. " + ITEMS[0][1] + " The end."),
    # Other numbers and names, one for one.
    (11, "A train leaves Rome at 7 and travels 300 km to reach Milan before 11 if nothing stops it on the way to Milan today."),
    # Punctuation, case and a unit written otherwise.
    (12, "THE words; a train leaves Paris, at 9, and travels 120km to reach Lyon before 12 if nothing stops it on the way to Lyon"),
    (13, "Nothing here is like a question about trains and shops, for it only tells of the weather in the north."),
    (14, "He read: short item of five words! and left"),
    # The item has the same number twice, the document has not: the windows of one are lost.
    (15, "The shop sold 6 red apples then bought 9 green pears and counted everything again that same evening."),
    (16, "The shop sold 7 red apples then bought 7 green pears and counted everything again that same evening."),
    (17, None),
    (18, ""),
    (None, ITEMS[0][1]),
]


def test_contaminated(spark, monkeypatch):
    docs = spark.createDataFrame([(*r, "x", 1) for r in DOCS], "doc_id long, text string, shift string, place int")
    items = spark.createDataFrame([*ITEMS, ITEMS[1]], "item_id long, text string")
    for most in (decontaminate.BROADCAST_WINDOWS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", most)
        got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, items).collect()}
        assert set(got) == {(10, 1), (11, 1), (12, 1), (14, 2), (15, 4), (16, 4)}
    assert got[10, 1].changed_slots == 0 and got[10, 1].share > 0.8
    # All but the unit.
    assert got[11, 1].changed_slots == got[11, 1].slots - 1 == 6
    assert got[16, 4].changed_slots == 2
    assert got[15, 4].matched_windows < got[16, 4].matched_windows == got[16, 4].item_windows


def test_contaminated_with_drift(spark):
    words_of = lambda text, at, by: " ".join([*text.split()[:at], *by, *text.split()[at:]])
    long = ITEMS[0][1]
    slim = "When Anna left home she gave Anna's old red bicycle to the boy next door because Anna no longer had any use for it."
    docs = [
        (1, words_of(long, 12, ["really"])),
        (2, " ".join(w for i, w in enumerate(long.split()) if i != 12)),
        (3, slim.replace("Anna", "Mary Ann")),
        # Two copies in a row with a word put in and other names, each with its own substitution.
        (4, " ".join(words_of(long, 12, ["really"]).replace("Lyon", b).replace("Paris", a) for a, b in (("Rome", "Milan"), ("Berlin", "Munich")))),
        # The halves lie further apart than the item is long.
        (5, words_of(long, 12, ["filler"] * 60)),
    ]
    items = spark.createDataFrame([(1, long), (2, slim)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {(1, 1), (2, 1), (3, 2), (4, 1)}


def test_contaminated_in_other_writing(spark):
    rich = "Then Anna met Boris and Carla in Dover before David drove Elena and Frank to Genoa where Heidi sold Ivan a boat."
    john = "John has 5 apples. John buys 7 more. How many apples does John have?"
    w = rich.split()
    docs = [
        (1, "\n".join(" ".join(w[i : i + 6]) for i in range(0, len(w), 6))),
        (2, "\u00a0 ".join(w)),
        (3, rich.lower()),
        (4, rich.upper()),
        (5, john.replace("John", "Mary")),
        (6, "They ask: \u201c" + john.replace("John", "Mary Ann") + "\u201d Nobody knows."),
        (7, john.upper()),
        # Short items of little but names fit only their own words.
        (8, "Peter runs. It is Paris."),
    ]
    items = spark.createDataFrame([(1, rich), (2, john), (3, "Anna runs."), (4, "Rome.")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, 2), (7, 2)}


def test_empty_tables(spark):
    none = frame(spark, ["a"]).limit(0)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert jaccard_join.near_sets(none).isEmpty()
    assert suffix_dedup.repeated_spans(none).isEmpty()
    assert decontaminate.contaminated(none, items).isEmpty()
    assert decontaminate.contaminated(frame(spark, ["a"]), items.limit(0)).isEmpty()


# --- choosing documents before templates are made ----------------------------


def edited_copies(seed):
    """Items, and documents that hold them whole, edited, renamed, in part or not at all."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bdgklmnprst" for b in "aeiou" for c in "lmnrst"]
    word = lambda: str(rng.choice(vocabulary))
    items, docs = [], []
    for i in range(24):
        size = int(rng.integers(3, 40))
        words = [word() for _ in range(size)]
        for at in range(2, size, 5):
            words[at] = str(rng.choice(["Anna", "Bob Lee", "7", "12 km", "3.5", "%", "x1y"]))
        words[0] = words[0].capitalize()
        items.append((i, " ".join(words)))
        other = [{"Anna": "Mary", "7": "9", "Bob Lee": "Jo"}.get(w, w) for w in words]
        cut = int(rng.integers(0, size))
        edits = [words, other, words[:cut] + [word()] + words[cut:], words[: size // 2], [w.upper() for w in words], words[::-1]]
        for edit in edits:
            around = [[word() for _ in range(int(rng.integers(0, 30)))] for _ in range(2)]
            docs.append((len(docs), " ".join([*around[0], *edit, *around[1]])))
    return docs, items


@pytest.mark.parametrize("share", [0.5, 0.05])
def test_no_pair_is_lost_by_choosing_documents(spark, monkeypatch, share):
    docs, items = edited_copies(3)
    # Items of placeholders and short ones, and copies under ids that repeat.
    items += [(100, "7 8 9"), (100, "the answer"), (101, None), (101, "it is 5 km")] if share < 0.5 else []
    items += [(0, items[1][1]), (1, None)]
    frames = [spark.createDataFrame(rows, f"{key} long, text string") for rows, key in ((docs, "doc_id"), (items, "item_id"))]
    found = lambda: sorted(map(tuple, decontaminate.contaminated(*frames, share=share).collect()))
    got = found()
    monkeypatch.setattr(decontaminate, "_candidates", lambda docs, items, share: docs)
    assert got == found() and len({d for d, *_ in got}) >= 24


def test_texts_that_share_an_item_id_are_items(spark):
    long = "Please compute the total price of all green apples in the small shop near the old bridge today."
    docs = spark.createDataFrame([(1, long), (2, "something else")], "doc_id long, text string")
    for texts in ([None, long], [long, None], ["a wholly other question about the weather in spring", long], [long, long]):
        items = spark.createDataFrame([(1, t) for t in texts], "item_id long, text string")
        got = decontaminate.contaminated(docs, items).collect()
        assert [(r.doc_id, r.item_id, r.matched_windows == r.item_windows) for r in got] == [(1, 1, True)]
