import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tideload.llm.divergence import _pieces, count_terms, count_words, source_divergence, word_pointers

DOCS = "doc_id long, text string, lang string, source string"
WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        group = (lang or "", source or "")
        groups.add(group)
        words = WORD.findall(lower(text or ""))
        counts[group].update(words)
        docs[group[0]].update(set(words))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        own = [s for x, s in groups if x == lang]

        def p_of(sources, kept=kept, lang=lang):
            n = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
            total = sum(n.values())
            return {t: 1 + 10**9 * (n[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = p_of([source]), p_of(own)
        parts = {"pair": [], "term": [(q[t] - p[t], t.encode(), t) for t in kept if counts[lang, source][t] and p[t] > q[t]]}
        for other in own:
            if other != source:
                theirs = p_of([other])
                parts["pair"].append((-sum(abs(p[t] - theirs[t]) for t in kept), other.encode(), other))
        for part, found in parts.items():
            for rank, (value, _, item) in enumerate(sorted(found), 1):
                if part == "pair" or rank <= top:
                    out.append((lang, source, part, item, -value, rank))
    return sorted(out)


def rows_for(seed, n=400):
    rng = random.Random(seed)
    words = ["a", "B", "é", "naïve", "ÀB", "eightlet", "eightletx", "eightlety", "EIGHTLET", "sixteenletterswo", "sixteenletterswos",
             "x" * 40, "x" * 41, "日本", "l'eau", "a1b", "_c_", "Zed", "🙂", "tail"] + [f"w{chr(97 + i)}" for i in range(20)]
    out = []
    for i in range(n):
        source = rng.choices(["hot", "b", "c", "d", None, ""], [6, 2, 2, 2, 1, 1])[0]
        text = rng.choice([" ", "\n", ", "]).join(rng.choices(words, k=rng.randrange(12)))
        out.append((i % 300, rng.choice([text, text, text, None, ""]) if i % 9 == 0 else text, rng.choice(["en", "en", "de", None]), source))
    return [*out, (None, "a a a", "xx", "only"), (1, None, "yy", "one"), (1, "rare", "yy", "two")]


@pytest.mark.parametrize(("min_docs", "cells"), [(30, 1 << 20), (3, 64), (1, 7)])
def test_equals_brute_force(spark, min_docs, cells):
    rows = rows_for(min_docs)
    table = spark.createDataFrame(rows, DOCS).repartition(4)
    got = sorted(tuple(r) for r in source_divergence(table, min_docs=min_docs, top_terms=5, cells=cells).collect())
    assert got == brute(rows, min_docs, 5)


def test_many_sources(spark):
    """More sources than one block holds."""
    rows = [(i, f"common w{chr(97 + i % 7)} {'x' * (i % 5)}", "en", f"s{i % 150}") for i in range(600)]
    got = sorted(tuple(r) for r in source_divergence(spark.createDataFrame(rows, DOCS), min_docs=20, top_terms=3).collect())
    assert got == brute(rows, 20, 3)


def test_long_text_in_pieces(spark):
    rows = rows_for(4, 60) + [(900, " ".join(f"é{chr(97 + i % 26)}{chr(97 + i % 7)} common" for i in range(3000)) + " " + "y" * 5000, "en", "b")]
    table = spark.createDataFrame(rows, DOCS)
    got = {tuple(r)[:3]: (r.n, r.docs) for r in count_terms(table, "text", "lang", "source", slice_bytes=200).collect()}
    counts, docs = Counter(), Counter()
    for _, text, lang, source in rows:
        words = WORD.findall(lower(text or ""))
        counts.update((lang or "", source or "", w) for w in words)
        docs.update((lang or "", source or "", w) for w in set(words))
    empty = {(lang or "", source or "", ""): (0, 0) for _, _, lang, source in rows}
    assert got == {k: (n, docs[k]) for k, n in counts.items()} | empty


def test_pieces_cut_between_words():
    raw = np.frombuffer(b"ab cd efghijklmnop  q " + b"z" * 30, dtype=np.uint8)
    pieces = [bytes(p) for p in _pieces(raw, 4)]
    assert b"".join(pieces) == bytes(raw)
    assert [w for p in pieces for w in p.split()] == bytes(raw).split()


def test_runs_of_a_slice():
    texts = [b"Abc abc", b"", b"abcabcabcabc ABCABCABCABC abcabcabc", b"abc"]
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    starts, ends = word_pointers(raw, offsets)
    assert [bytes(raw[a:b]) for a, b in zip(starts, ends, strict=True)] == [w for t in texts for w in t.split()]
    terms, term, group, n, docs = count_words(raw, offsets, np.array([0, 0, 1, 1]))
    found = sorted((terms[t], g, c, d) for t, g, c, d in zip(term, group, n, docs, strict=True))
    assert found == [(b"abc", 0, 2, 1), (b"abc", 1, 1, 1), (b"abcabcabc", 1, 1, 1), (b"abcabcabcabc", 1, 2, 1)]


def test_empty_table_and_other_columns(spark):
    assert source_divergence(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(i, "common words", "en", "ab"[i % 2], "t", 1, 1.0) for i in range(40)]
    table = spark.createDataFrame(rows, DOCS + ", term string, n int, p double")
    assert [(r.source, r.item, r.value) for r in source_divergence(table).orderBy("source").collect()] == [("a", "b", 0), ("b", "a", 0)]
