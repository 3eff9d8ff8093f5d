r"""Benchmark decontamination by canonical templates.

A text becomes words (runs of letters and digits), and these become templates in three forms. In the
``cased`` one, words that re-parameterise a question get typed placeholders: numbers ``#``, units after
a number ``%``, names (capitalised words) ``@``. In the ``folded`` one numbers and units do, and all
other words are in lower case, so that copies in other letter case are found. In the ``exact`` one no
word does. Windows of ``width`` words of each form that start at every word, of the benchmark and of the
documents, are hashed and hash-joined.

A window with fewer than ``min_literals`` words that are no placeholders says too little: it is widened to
twice, four times ... its words, as far as its item goes. Where the folded window says too little, its
exact words are joined as well, so that items of numbers and names are found where they are copied.

Matching windows of a document and an item on one diagonal (place in the document less place in
the item) are one alignment. In it the placeholders' values must be consistent: a value of the
item always becomes the same value, and no two values the same, in at least ``min_agreement`` of
the places of each kind. An item is found where the consistent windows of all forms cover
``min_covered`` of its words, or all of a shorter one.

Everything is DataFrame functions. The benchmark's window hashes are broadcast up to
``BROADCAST_WINDOWS`` rows, and joined by a shuffle beyond.

Defined cases: null and empty texts match nothing; documents are told apart by their text, so
repeated rows and rows without an id are found like any other; items with the same text count as
the one with the smallest id, and items without one are left out; an item shorter than a window is one window, and
one of fewer than ``min_literals`` words is never found; texts of any length are worked on whole, a row at a time; columns
of the caller may have any names; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideload.llm.common import OWN, filled, quoted
from tideload.session import staged

WIDTH = 8
MIN_LITERALS = 5
MIN_COVERED = 12
MIN_AGREEMENT = 0.8
BROADCAST_WINDOWS = 200_000
# Texts with hits whose keys (128 bits each) are broadcast to the scan that fetches their words.
BROADCAST_TEXTS = 500_000

# Words that count as units after a number, in any letter case.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles g kg mg gram grams kilogram kilograms pound pounds ounce ounces "
    "ton tons l ml litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years percent dollar dollars euro euros cent cents degree degrees"
)
NUMBER, UNIT, NAME = "#", "%", "@"
NOT_A_WORD = r"[^\p{L}\p{N}]+"
QUANTITIES = (
    (r"(^| )\p{N}[^ ]*", "$1" + NUMBER),
    (rf"{NUMBER} (?i:{UNITS.replace(' ', '|')})(?= |$)", f"{NUMBER} {UNIT}"),
)
NAMES = (r"(^| )\p{Lu}[^ ]*", "$1" + NAME)
CASED, FOLDED, EXACT = 0, 1, 2
KEY = [f"{OWN}k1", f"{OWN}k2"]


def plain_words(text: Column) -> Column:
    """The words of a text, one space between them."""
    return F.trim(F.regexp_replace(filled(text), NOT_A_WORD, " "))


def templates(words: Column) -> dict[int, Column]:
    """The words of each form, as many as before, one space between them."""
    quantified = words
    for pattern, replacement in QUANTITIES:
        quantified = F.regexp_replace(quantified, pattern, replacement)
    return {CASED: F.regexp_replace(quantified, *NAMES), FOLDED: F.lower(quantified), EXACT: F.lower(words)}


def _hashes(words: Column, form: int) -> Column:
    """The hash of each word; another one in each form, so that only windows of one form are equal."""
    return F.transform(F.split(words, " "), lambda w: F.xxhash64(w, F.lit(form)))


def _is_slot(word: Column) -> Column:
    return word.isin(NUMBER, UNIT, NAME)


def _combined(level: Column, step: int) -> Column:
    """The hash of each element and the one ``step`` places on; null-padded at the end."""
    return F.zip_with(level, F.slice(level, step + 1, F.size(level)), lambda x, y: F.xxhash64(x, y))


def _steps(length: int, size: int = 1) -> list[int]:
    """How far the second half of a window begins after the first, from ``size`` words up to ``length``."""
    steps = []
    while size < length:
        steps.append(min(size, length - size))
        size += steps[-1]
    return steps


def _window_hash(hashes: Column, length: int) -> Column:
    """The hash of a window of exactly ``length`` words, as :func:`_with_window_hashes` gives it."""
    for step in _steps(length):
        hashes = _combined(hashes, step)
    return F.get(hashes, F.lit(0))


def _with_window_hashes(df: DataFrame, kinds: list[tuple[int, int]]) -> DataFrame:
    """Add, for each (length, form), the hashes of the windows that start at each word of ``hashes<form>``.

    A window is hashed as two halves, each level in a projection of its own: it is used twice. Windows of
    twice the words are made of those of once the words.
    """
    for form in sorted({f for _, f in kinds}):
        made, size = f"hashes{form}", 1
        for length in sorted(n for n, f in kinds if f == form):
            if length % size:
                made, size = f"hashes{form}", 1
            name = f"windows{length}_{form}"
            for step in _steps(length, size):
                df = df.withColumn(name, _combined(F.col(made), step))
                made = name
            size = length
            if length == 1:
                df = df.withColumn(name, F.col(made))
    return df


def _lengths(width: int, most: int, min_literals: int) -> list[int]:
    """The lengths of windows: those of items shorter than a window, and its multiples by powers of two."""
    lengths = [*range(min_literals, width), width]
    while lengths[-1] * 2 <= most:
        lengths.append(lengths[-1] * 2)
    return lengths


def benchmark_windows(
    benchmark: DataFrame, id_col: str, text_col: str, width: int = WIDTH, min_literals: int = MIN_LITERALS
) -> DataFrame:
    """``hash, item, form, words, length, place, template, values`` of the windows that are looked for."""
    plain = (
        benchmark.select(quoted(id_col).alias("item"), plain_words(quoted(text_col)).alias("plain"))
        .groupBy("plain")
        .agg(F.min("item").alias("item"))
        .where("plain <> '' AND item IS NOT NULL")
        .withColumn("words", F.size(F.split("plain", " ")))
        .where(F.col("words") >= min_literals)
    )
    lengths = _lengths(width, plain.agg(F.max("words")).first()[0] or 0, min_literals)
    forms = templates(F.col("plain"))
    raw = {CASED: F.col("plain"), FOLDED: F.lower("plain"), EXACT: F.lower("plain")}
    form = F.explode(F.array(*[F.struct(F.lit(f).alias("form"), forms[f].alias("canon"), raw[f].alias("raw")) for f in forms]))
    items = plain.select("item", "words", form.alias("form")).select(
        "item", "words", "form.form", F.split("form.canon", " ").alias("canon"), F.split("form.raw", " ").alias("raw")
    )
    # Every place of an item with every length that fits; a window that would pass the end ends there.
    shortest = F.least("words", F.lit(width))
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: (n <= F.col("words")) & (n >= shortest))
    windows = (
        items.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("words") - shortest)))
        .withColumn("length", F.explode(fits))
        .withColumn("place", F.least("at", F.col("words") - F.col("length")))
        .withColumn("template", F.slice("canon", F.col("place") + 1, F.col("length")))
        .withColumn("literals", F.size(F.filter("template", lambda w: ~_is_slot(w))))
    )
    chosen = ["item", "words", "form", "at"]
    telling = (
        windows.where((F.col("form") != EXACT) & (F.col("literals") >= min_literals))
        .groupBy(*chosen).agg(F.min("length").alias("length"))
    )
    poor = windows.where((F.col("form") == FOLDED) & (F.col("literals") < min_literals) & (F.col("length") == shortest))
    wanted = telling.unionByName(poor.select("item", "words", F.lit(EXACT).alias("form"), "at", "length"))
    hashes = F.transform("template", lambda w: F.xxhash64(w, F.col("form")))
    by_length = F.coalesce(*[F.when(F.col("length") == n, _window_hash(hashes, n)) for n in lengths])
    found = windows.join(wanted, [*chosen, "length"], "left_semi").withColumn("hash", by_length)
    values = F.slice("raw", F.col("place") + 1, F.col("length")).alias("values")
    return found.select("hash", "item", "form", "words", "length", "place", "template", values).dropDuplicates(
        ["item", "form", "length", "place"]
    )


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(filled(text)).alias(KEY[0]), F.xxhash64(F.lit(7), filled(text)).alias(KEY[1])]


def window_hits(docs: DataFrame, text_col: str, windows: DataFrame) -> DataFrame:
    """``length, hash, at`` of every window of a text that hashes like a benchmark window, once a text.

    Only hashes and places are exploded: a row that carried its text's words would copy them for
    every window. All forms are taken from one pass over the texts.
    """
    # One row per form and length: a few.
    kinds = sorted({(r.length, r.form) for r in windows.select("length", "form").distinct().collect()}) or [(WIDTH, CASED)]
    wanted = windows.select("length", "hash").distinct()
    small = wanted.count() <= BROADCAST_WINDOWS
    text = quoted(text_col)
    forms = templates(F.col("plain"))
    used = sorted({f for _, f in kinds})
    plain = docs.select(*text_key(text), plain_words(text).alias("plain"))
    words = plain.select(*KEY, *[forms[f].alias(f"words{f}") for f in used])
    hashed = words.select(*KEY, *[_hashes(F.col(f"words{f}"), f).alias(f"hashes{f}") for f in used])
    hashed = hashed.withColumn("size", F.size(f"hashes{used[0]}")).where(F.col("size") >= kinds[0][0])
    placed = _with_window_hashes(hashed, kinds)
    every = [
        F.struct(
            F.lit(n).alias("length"),
            F.slice(f"windows{n}_{f}", F.lit(1), F.greatest(F.col("size") - (n - 1), F.lit(0))).alias("hashes"),
        )
        for n, f in kinds
    ]
    # The outer form: for the other one Catalyst infers a filter that computes the array once more.
    placed = placed.select(*KEY, F.explode(F.array(*every)).alias("kind"))
    placed = placed.select(*KEY, "kind.length", F.posexplode_outer("kind.hashes").alias("at", "hash"))
    found = placed.join(F.broadcast(wanted) if small else wanted, ["length", "hash"], "left_semi")
    return found.dropDuplicates([*KEY, "hash", "at"])


def matched_windows(docs: DataFrame, text_col: str, windows: DataFrame) -> DataFrame:
    """One row per window of a text that has the template of a benchmark window and its plain words."""
    windows = staged(windows, "benchmark-windows")
    hits = staged(window_hits(docs, text_col, windows), "window-hits")
    # Only texts with hits go on, each once. Few have any; where they are many, the texts are shuffled.
    keys = hits.select(*KEY).distinct()
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_TEXTS else keys
    text = quoted(text_col)
    texts = docs.select(*text_key(text), text.alias("text")).join(keys, KEY, "left_semi").dropDuplicates(KEY)
    raw = texts.select(*KEY, F.split(plain_words(F.col("text")), " ").alias("raw"))
    places = F.sequence(F.lit(0), F.col("length") - 1)
    pairs = F.transform(
        places,
        lambda i: F.struct(
            (F.col("place") + i).alias("spot"), F.get("template", i).alias("kind"),
            F.get("values", i).alias("theirs"), F.get("found", i).alias("ours"),
        ),
    )
    found = hits.join(raw, KEY).withColumn("found", F.slice("raw", F.col("at") + 1, F.col("length"))).drop("raw")
    # A hash that many items share meets its texts once and its items here.
    found = found.join(windows, ["length", "hash"])
    own = F.when(F.col("form") == CASED, F.col("found")).otherwise(F.transform("found", lambda w: F.lower(w)))
    found = found.where(F.size("found") == F.col("length")).withColumn("found", own).withColumn("pairs", pairs)
    same = F.forall("pairs", lambda p: _is_slot(p["kind"]) | (p["theirs"] == p["ours"]))
    slots = F.filter("pairs", lambda p: _is_slot(p["kind"]))
    return found.where(same).select(
        *KEY, "item", "words", "length", "place", (F.col("at") - F.col("place")).alias("diagonal"), slots.alias("slots")
    )


def _agreement(counts: DataFrame, alignment: list[str], of: str) -> DataFrame:
    """For each kind, the share of an alignment's slots that hold the most frequent partner of their value."""
    per_value = counts.groupBy(*alignment, "kind", of).agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    return per_value.groupBy(*alignment, "kind").agg((F.sum("most") / F.sum("n")).alias("share"))


def contaminated_texts(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    min_covered: int = MIN_COVERED,
    min_agreement: float = MIN_AGREEMENT,
) -> DataFrame:
    """One row per text and item found in it: the text's key, ``item, covered_words, item_words``."""
    windows = benchmark_windows(benchmark, item_id_col, item_text_col)
    matched = staged(matched_windows(docs, text_col, windows), "matched-windows")
    alignment = [*KEY, "item", "diagonal"]
    slots = matched.select(*alignment, F.explode("slots").alias("slot")).select(*alignment, "slot.*")
    # A place counts once, however many windows and forms it is in; letter case tells names apart, not quantities.
    folded = {c: F.when(F.col("kind") == NAME, F.col(c)).otherwise(F.lower(c)) for c in ("theirs", "ours")}
    slots = slots.withColumns(folded).distinct()
    counts = slots.groupBy(*alignment, "kind", "theirs", "ours").agg(F.count(F.lit(1)).alias("n"))
    shares = _agreement(counts, alignment, "theirs").unionByName(_agreement(counts, alignment, "ours"))
    unlike = shares.where(F.col("share") < min_agreement).select(*alignment).distinct()
    good = matched.join(unlike, alignment, "left_anti")
    # An item's windows number no more than a few times its words.
    per_item = good.groupBy(*KEY, "item").agg(
        F.max("words").alias("item_words"),
        F.sort_array(F.collect_set(F.struct("place", (F.col("place") + F.col("length")).alias("end")))).alias("spans"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            (acc["sum"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["end"], s["place"]))).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    found = per_item.select(*KEY, "item", covered.alias("covered_words"), "item_words")
    return found.where(F.col("covered_words") >= F.least(F.lit(min_covered), F.col("item_words")))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``id, item, covered_words, item_words`` for every document and benchmark item found in it."""
    found = contaminated_texts(docs, benchmark, text_col, **options)
    ids = docs.select(quoted(id_col).alias("id"), *text_key(quoted(text_col)))
    return ids.join(found, KEY).select("id", "item", "covered_words", "item_words").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents in which no benchmark item is found."""
    found = contaminated_texts(docs, benchmark, text_col, **options).select(*KEY).distinct()
    marked = docs.select("*", *text_key(quoted(text_col)))
    return marked.join(found, KEY, "left_anti").select(*[quoted(c) for c in docs.columns])
