"""Benchmark decontamination by templates.

Texts become templates: numbers, units after numbers and capitalised words inside a sentence
are replaced by a placeholder of their kind, the other words are lower-cased, punctuation
goes. A run of capitalised words is one name, so that names of other lengths fit. Windows of
template tokens are joined by hash, and the values in the slots of a match must follow one
substitution: wherever the benchmark item repeats a value, the document repeats the value that
stands for it. So a question with other numbers or names is caught. Words put in or left out
move the windows behind them, so a match may drift.

Capitals tell names only inside a sentence of mixed case. So each text has three templates
(``FORMS``), compared each with its like: one takes the capitalised words inside sentences as
names, one takes none, so that case says nothing, and one takes those that begin a sentence too.

Templates are costly, so documents are chosen by their words first (``_candidates``): a window
that a document holds brings along every run of words in it, whatever the form of template. Of
each item window one such run is looked up among the runs of as many words of each document,
and only documents that hold the runs of enough windows of an item go on. No pair is
lost by this, as the windows that a pair must share are counted over a superset of them.

Only DataFrame functions are used.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlemill.llm.common import staged

#: Template tokens in a window.
WINDOW = 8
#: Share of an item's windows that a document must hold.
SHARE = 0.5
#: Most windows of benchmark items, and ids of chosen documents, that are sent to every
#: executor (32 bytes each, so some 60 MB); more are joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000
#: Words of a window that a document is chosen by.
RUN = 4

# Placeholders are private-use characters, which are taken out of texts first.
NAME, NUMBER, UNIT, POINT, JOINT = "\ue001", "\ue002", "\ue003", "\ue004", "\ue005"
#: Templates of a text, by what is a name. A pair that several of them tell equally well is
#: reported by the first.
FORMS = INNER, PLAIN, ALL = 0, 1, 2
_SYMBOLS = "%\u20ac$\u00a3\u00b0"
#: Units are recognised only after a number.
UNITS = (
    "km cm mm m kg mg g l ml s min h ms kb mb gb tb w kw kwh v hz khz mhz ghz j kj cal kcal pa bar "
    "mi ft in yd lb oz gal mph kmh usd eur gbp percent dollars euros pounds cents hours minutes "
    "seconds days weeks months years meters metres kilometers kilometres miles grams kilograms liters litres"
).split()

_WORD = r"\p{L}\p{M}"
_OPENING = "\"'(\\[{\u201c\u201e\u2018\u201a\u00ab\u2039"
_NAME_RE = {
    INNER: rf"\p{{Lu}}(?<=[{_WORD}\d,;:] [{_OPENING}]{{0,2}}.)[{_WORD}{JOINT}]*",
    ALL: rf"(?<![{_WORD}\d])\p{{Lu}}[{_WORD}{JOINT}]*",
}
_UNIT_RE = rf"(\d) ?((?i:{'|'.join(UNITS)})(?![{_WORD}])|[{_SYMBOLS}])"
_NUMBER_RE = rf"\d[\d{POINT}]*"
_BETWEEN = rf"[^{_WORD}\d{NAME}-{JOINT}{_SYMBOLS}]+"


def _folded(text):
    # Capitals have no sharp s.
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def _tokens(text, values, form):
    """Template tokens of one form; with ``values`` a slot's token is its placeholder and its value.

    Both forms have the same number of tokens, in the same places.
    """
    told = lambda mark, group: f"{mark}${group}" if values else mark
    t = F.regexp_replace(F.coalesce(text, F.lit("")), rf"[{NAME}-{JOINT}\s\p{{Z}}]+", " ")
    t = F.regexp_replace(t, r"(\d)[.,:/](?=\d)", f"$1{POINT}")
    if form != PLAIN:
        t = F.regexp_replace(t, rf"({_NAME_RE[form]}) (?=\p{{Lu}})", f"$1{JOINT}")
        t = F.regexp_replace(t, _NAME_RE[form], f" {told(NAME, 0)} ")
    t = F.regexp_replace(t, _UNIT_RE, f"$1 {told(UNIT, 2)} ")
    t = F.regexp_replace(t, _NUMBER_RE, f" {told(NUMBER, 0)} ")
    # Only a text's beginning and end can give an empty piece.
    return F.array_remove(F.split(_folded(t), _BETWEEN), "")


def _windows(docs, wanted):
    """A row ``(doc_id, place, hash)`` for each window of the ``(form, length)`` wanted.

    The hashes are made in one array per text, so that exploding it carries nothing else; the
    one-element transform names the tokens' hashes, so that they are made once.
    """

    def hashes(codes, form, length):
        spots = F.sequence(F.lit(0), F.size(codes) - length)
        hashed = lambda i: F.xxhash64(F.lit(form), F.lit(length), *[F.get(codes, i + k) for k in range(length)])
        many = F.transform(spots, lambda i: F.struct(i.alias("place"), hashed(i).alias("hash")))
        return F.when(F.size(codes) >= length, many).otherwise(F.array().cast("array<struct<place:int,hash:bigint>>"))

    def of_form(form):
        lengths = [length for f, length in wanted if f == form]
        every = lambda codes: F.concat(*[hashes(codes, form, length) for length in lengths])
        return F.get(F.transform(F.array(_codes(F.col("text"), form)), every), 0)

    found = F.concat(*[of_form(form) for form in sorted({f for f, _ in wanted})])
    return docs.select("doc_id", F.explode(found).alias("found")).select("doc_id", "found.*")


def _codes(text, form):
    """Token hashes: windows then hash numbers instead of strings."""
    return F.transform(_tokens(text, False, form), lambda t: F.xxhash64(t))


def _run_hash(words, at, n):
    return F.xxhash64(F.lit(n), *[F.get(words, at + k) for k in range(n)])


def _best_runs(tokens):
    """For 1 to ``RUN`` plain words in a row: the hash of the run of most letters, or NULL."""
    plain = lambda t: t.rlike(rf"^[{_WORD}]+$")

    def of_size(n):
        spots = F.when(F.size(tokens) >= n, F.sequence(F.lit(0), F.size(tokens) - n))
        whole = F.filter(spots, lambda i: F.forall(F.slice(tokens, i + 1, n), plain))
        letters = lambda i: F.length(F.array_join(F.slice(tokens, i + 1, n), ""))
        best = F.array_max(F.transform(whole, lambda i: F.struct(letters(i), _run_hash(tokens, i, n).alias("run"))))
        return best["run"]

    return F.array(*[of_size(n) for n in range(1, RUN + 1)])


def _candidates(docs, items, share):
    """``docs`` without those that can't hold ``share`` of an item's windows, written to the
    shared folder.

    Runs of one size are looked up: the most words for which every item has more windows with
    such a run than it may miss. Its windows without one count as held. If there is no such
    size, as some item has hardly a plain word, all documents are kept.
    """
    of_item = ["item_id", "form"]
    least = F.greatest(F.ceil(F.count("*") * share), F.lit(1))
    needs = [(least - F.count_if(F.get("runs", F.lit(n - 1)).isNull())).alias(f"need{n}") for n in range(1, RUN + 1)]
    need = staged(items.groupBy(*of_item).agg(*needs), "needs")
    worst = need.agg(*[F.min(f"need{n}") for n in range(1, RUN + 1)]).first()
    if worst[0] is None:
        return docs.filter("false")  # no items
    size = max((n for n in range(1, RUN + 1) if worst[n - 1] > 0), default=None)
    if size is None:
        return docs
    keys = items.select(*of_item, F.col("hash").alias("window"), F.get("runs", F.lit(size - 1)).alias("run"))
    words = F.array_remove(F.split(_folded(F.col("text")), rf"[^{_WORD}]+"), "")

    def runs(words):
        return F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: _run_hash(words, i, size))

    found = F.get(F.transform(F.filter(F.array(words), lambda w: F.size(w) >= size), runs), 0)
    said = docs.select("doc_id", F.explode(found).alias("run"))
    distinct = keys.select("run").filter("run IS NOT NULL").distinct()
    asked = F.broadcast(distinct) if distinct.count() <= BROADCAST_WINDOWS else distinct
    held = staged(said.join(asked, "run", "left_semi").distinct(), "runs")
    counts = held.join(keys, "run").groupBy("doc_id", *of_item).agg(F.countDistinct("window").alias("held"))
    enough = counts.join(need, of_item).filter(F.col("held") >= F.col(f"need{size}")).select("doc_id").distinct()
    chosen = staged(enough, "chosen")
    if chosen.count() <= BROADCAST_WINDOWS:
        chosen = F.broadcast(chosen)
    return staged(docs.join(chosen, "doc_id", "left_semi"), "candidates")


def _item_windows(benchmark, window):
    """``(item_id, form, length, drift, hash, item_place, runs)``; items of fewer tokens are one
    window, and ``runs`` are the ``_best_runs`` of the window.

    A window counts if at least half of its tokens are words, as placeholders alone say
    nothing; an item without such a window keeps all. Where sentences may begin with a name,
    half of ``window`` must be words, lest a short item fit anything.
    """
    items = _of_forms(benchmark, "item_id", False).filter(F.size("tokens") > 0)
    items = items.withColumn("length", F.least(F.size("tokens"), F.lit(window)))
    items = items.withColumn("drift", F.greatest(F.floor(F.size("tokens") / 2), F.lit(1)))
    spots = F.explode(F.sequence(F.lit(0), F.size("tokens") - F.col("length"))).alias("place")
    rows = items.select("item_id", "form", "length", "drift", "tokens", spots)
    part = F.slice("tokens", F.col("place") + 1, F.col("length"))
    words = F.size(F.filter(part, lambda t: ~t.isin(NAME, NUMBER, UNIT)))
    # The same chain of hashes as in _windows, with the form and the length first.
    chained = reduce(
        lambda found, n: F.when(F.col("length") == n, F.xxhash64("form", F.lit(n), *[F.xxhash64(F.get(part, F.lit(k))) for k in range(n)])).otherwise(found),
        range(1, window + 1),
        F.lit(None).cast("long"),
    )
    least = F.when(F.col("form") == ALL, F.lit(window)).otherwise(F.col("length"))
    rows = rows.select(
        "item_id", "form", "length", "drift", "place", (words * 2 >= least).alias("telling"), chained.alias("hash"), _best_runs(part).alias("runs")
    )
    of_item = Window.partitionBy("item_id", "form")
    rows = rows.withColumn("some", F.max("telling").over(of_item)).filter(f"telling OR NOT some AND form != {ALL}")
    return rows.groupBy("item_id", "form", "length", "drift", "hash").agg(
        F.min("place").alias("item_place"), F.min("runs").alias("runs")
    )


def _of_forms(rows, key, values):
    """``(key, form, tokens)``: the templates of the rows' texts."""
    each = [F.struct(F.lit(f).alias("form"), _tokens(F.col("text"), values, f).alias("tokens")) for f in FORMS]
    return rows.select(key, F.explode(F.array(*each)).alias("each")).select(key, "each.*")


def _slots(rows, key):
    """``(key, form, slot, kind, value)`` of every slot of the rows' texts."""
    told = _of_forms(rows, key, True).select(key, "form", F.posexplode("tokens").alias("slot", "token"))
    kind = F.substring("token", 1, 1)
    return told.filter(kind.isin(NAME, NUMBER, UNIT)).select(
        key, "form", "slot", kind.alias("kind"), F.expr("substring(token, 2)").alias("value")
    )


def contaminated(documents, benchmark, window=WINDOW, share=SHARE):
    """Pairs of a document and a benchmark item of which it holds the windows.

    Takes documents ``(doc_id, text)`` and items ``(item_id, text)``; other columns are
    ignored. Returns ``(doc_id, item_id, matched_windows, item_windows, share, slots,
    changed_slots)`` for the pairs of which at least ``share`` of the item's windows occur in
    the document, with consistent slots and in one place: their distances from where the item
    has them differ by no more than half of the item's tokens, so that words may be put in or
    left out. ``slots`` and ``changed_slots`` count the slots in the matched part and those with
    other values. All counts are of the form of template that tells the pair best.

    * NULL or empty texts, and rows without an id, match nothing.
    * Texts that share an ``item_id`` are items of their own, of which the best found is
      reported; rows sharing a ``doc_id`` are one document. Equal windows within an item count once.
    * An item of fewer than ``window`` tokens matches as a whole.
    * White space says nothing. Other names are found where both texts write them with capitals
      among words without; a copy in other case only with the item's names.
    * Empty tables give an empty result.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    named = benchmark.select(F.col("item_id").cast("long").alias("own"), F.col("text").cast("string").alias("text"))
    named = named.filter("own IS NOT NULL AND text IS NOT NULL").distinct()
    # An item is a text under an id.
    named = staged(named.withColumn("item_id", F.xxhash64("own", "text")), "items")
    benchmark = named.select("item_id", "text")
    items = staged(_item_windows(benchmark, window), "item-windows")
    docs = _candidates(docs, items, share)
    # At most ``window`` lengths of each form and one count come to the driver.
    wanted = {(r["form"], r["length"]): r["n"] for r in items.groupBy("form", "length").agg(F.count("*").alias("n")).collect()}
    small = sum(wanted.values()) <= BROADCAST_WINDOWS
    asked = F.broadcast(items) if small else items
    hits = _windows(docs, sorted(wanted) or [(INNER, window)]).join(asked.drop("runs"), "hash").select(
        "doc_id", "item_id", "form", "item_place", "length", "drift", (F.col("place") - F.col("item_place")).alias("shift")
    )
    hits = staged(hits.distinct(), "hits")
    totals = items.groupBy("item_id", "form").agg(F.count("*").alias("item_windows"))
    # The same item may begin at several places of a document; each is judged by itself, first
    # without drift, then in overlapping ranges of shifts, two of which hold each shift. A range
    # is as wide as the item, so that whole copies in a row don't share one.
    step = F.floor(F.col("shift") / F.col("drift"))
    sites = [F.struct(F.lit(w).alias("wide"), s.cast("long").alias("site")) for w, s in ((0, F.col("shift")), (1, step), (1, step - 1))]
    placed = hits.withColumn("at", F.explode(F.array(*sites))).select("*", "at.*").drop("at", "drift")
    at = ["doc_id", "item_id", "form", "wide", "site"]
    places = (
        placed.groupBy(*at)
        .agg(F.countDistinct("item_place").alias("held"), (F.min("shift") != F.max("shift")).alias("drifts"))
        .join(totals, ["item_id", "form"])
        .filter((F.col("held") >= F.col("item_windows") * share) & (F.col("drifts") | (F.col("wide") == 0)))
    )
    pairs = staged(places.select(*at, "item_windows"), "leaks")
    item_slots = staged(_slots(benchmark, "item_id"), "item-slots")
    wanted = pairs.join(item_slots.select("item_id").distinct(), "item_id", "left_semi").select("doc_id").distinct()
    doc_slots = staged(_slots(docs.join(wanted, "doc_id", "left_semi"), "doc_id").distinct(), "doc-slots")
    covered = placed.join(pairs.select(*at), at)
    mine = item_slots.withColumnRenamed("value", "asked")
    # Slots are few per item and each lies in at most ``window`` windows.
    met = (
        covered.join(mine, ["item_id", "form"])
        .filter("slot BETWEEN item_place AND item_place + length - 1")
        .withColumn("doc_slot", F.col("slot") + F.col("shift"))
        .join(doc_slots.withColumnRenamed("slot", "doc_slot"), ["doc_id", "form", "doc_slot", "kind"])
    )
    same = [*at, "kind", "asked"]
    votes = met.groupBy(*same, "value").agg(
        F.countDistinct("slot").alias("times"), F.count("*").alias("held"), (-F.min("shift")).alias("early")
    )
    chosen = votes.groupBy(*same).agg(F.max_by("value", F.struct("times", "held", "early", "value")).alias("stands"))
    judged = met.join(chosen, same).withColumn("off", F.col("value") != F.col("stands"))
    # An occurrence of a window with a slot that breaks the substitution doesn't count.
    broken = judged.filter("off").select(*at, "item_place", "shift").distinct()
    sound = covered.join(broken, [*at, "item_place", "shift"], "left_anti")
    sound = sound.groupBy(*at).agg(F.countDistinct("item_place").alias("matched_windows"))
    slots = judged.groupBy(*at).agg(
        F.countDistinct("slot").alias("slots"),
        F.countDistinct(F.when(F.col("value") == F.col("asked"), F.col("slot"))).alias("as_asked"),
    )
    final = pairs.join(sound, at).join(slots, at, "left").fillna(0, ["slots", "as_asked"])
    final = final.withColumn("changed_slots", F.col("slots") - F.col("as_asked"))
    final = final.filter(F.col("matched_windows") >= F.col("item_windows") * share)
    final = final.withColumn("share", F.col("matched_windows") / F.col("item_windows"))
    order = [(-F.col(c)).alias(c) for c in ("changed_slots", "form")]
    least = [(-F.col(c)).alias(c) for c in ("wide", "site")]
    best = F.struct("share", *order, "slots", *least, "matched_windows", "item_windows")
    own = named.select("item_id", "own")
    return (
        final.join(own, "item_id")
        .drop("item_id")
        .withColumnRenamed("own", "item_id")
        .groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("best"))
        .select(
            "doc_id",
            "item_id",
            "best.matched_windows",
            "best.item_windows",
            "best.share",
            "best.slots",
            (-F.col("best.changed_slots")).alias("changed_slots"),
        )
    )
