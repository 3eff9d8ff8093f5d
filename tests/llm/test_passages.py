import random

import numpy as np
from llm_fixtures import docs_of  # noqa: F401

from tideload.llm import passages
from tideload.llm.passages import K, align, chain, shared_passages, word_hashes

def words(n, seed):
    r = random.Random(seed)
    return ["".join(r.choices("abcdefghijklmnop", k=r.randrange(2, 9))) for _ in range(n)]


def spans(df):
    return sorted((r.doc, r.start, r.end, r.holder, r.holder_start, r.holder_end) for r in df.collect())


def test_word_hashes():
    texts = [b"One two\tTWO", b"", b" \n", "é É one".encode(), b"x" * 5000]
    hashed, owner = word_hashes(texts)
    assert owner.tolist() == [0, 0, 0, 3, 3, 3, 4]
    assert hashed[1] == hashed[2] and hashed[0] == hashed[5] and hashed[3] != hashed[4]
    assert len(set(hashed.tolist())) == 5


def test_chains_are_the_best():
    """The Fenwick recurrence against all pairs."""
    for seed in range(60):
        r = random.Random(seed)
        pairs = sorted({(r.randrange(40), r.randrange(40)) for _ in range(r.randrange(2, 40))})
        b, a = (np.array(x) for x in zip(*pairs, strict=True))
        best = []
        for i in range(len(b)):
            gains = [best[j] - passages.GAP_COST * (b[i] - b[j] + a[i] - a[j]) for j in range(i) if b[j] < b[i] and a[j] < a[i]]
            best.append(K + max([0, *gains]))
        found = chain(b, a)
        assert sorted(np.concatenate(found).tolist()) == list(range(len(b)))
        first = found[0]
        assert (np.diff(b[first]) > 0).all() and (np.diff(a[first]) > 0).all()
        score = K * len(first) - passages.GAP_COST * (b[first[-1]] - b[first[0]] + a[first[-1]] - a[first[0]])
        assert abs(score - max(best)) < 1e-6


def test_planted_passages(docs_of):
    passage = words(60, 1)
    fuzzy = [*passage[:20], "inserted", *passage[20:35], *passage[37:50], "changed", *passage[51:]]
    rows = [(10 + i, " ".join(words(100, 50 + i) + passage + words(80, 90 + i))) for i in range(5)]
    rows.append((30, " ".join(words(40, 7) + fuzzy + words(30, 8))))
    rows.append((31, " ".join(words(40, 17) + passage[:30] + words(30, 18))))  # too short
    rows += [(40 + i, " ".join(words(300, 200 + i))) for i in range(10)]  # clean
    rows += [(60, rows[0][1]), (61, rows[0][1].upper().replace(" ", "\n\t"))]  # copies
    got = spans(shared_passages(docs_of(*rows)))
    by_doc = {g[0]: g for g in got}
    assert set(by_doc) == {11, 12, 13, 14, 30, 60, 61}
    for i in range(1, 5):
        assert by_doc[10 + i][1:] == (100, 160, 10, 100, 160)
    assert by_doc[60][1:] == by_doc[61][1:] == (0, 240, 10, 0, 240)
    assert by_doc[30][3] == 10 and abs(by_doc[30][1] - 40) <= 1 and abs(by_doc[30][2] - 99) <= 1


def test_defined_cases(docs_of, spark):
    text = " ".join(words(80, 3))
    rows = [(1, text), (1, text), (2, text), (None, text), (3, None), (4, ""), (5, "few words"), (6, "same " * 400), (7, "same " * 300)]
    got = spans(shared_passages(docs_of(*rows)))
    assert [g for g in got if g[0] == 2] == [(2, 0, 80, 1, 0, 80)]
    assert {g[0] for g in got} == {2, 7}
    assert shared_passages(docs_of()).collect() == []
    clash = spark.createDataFrame([(1, text, 1, 2), (2, text, 3, 4)], "doc_id long, text string, doc int, seed int")
    assert spans(shared_passages(clash)) == [(2, 0, 80, 1, 0, 80)]


def test_long_texts(docs_of):
    long = " ".join(words(30_000, 5))
    got = spans(shared_passages(docs_of((1, long), (2, "before it " + long), (3, " ".join(words(30_000, 6))))))
    assert got == [(2, 2, 30_002, 1, 0, 30_000)]


def test_two_passages_with_a_long_unequal_stretch():
    left, right = np.arange(100, 160, dtype=np.uint32), np.arange(300, 360, dtype=np.uint32)
    b = np.concatenate([left, np.arange(1000, 1035, dtype=np.uint32), right])
    a = np.concatenate([left, np.arange(2000, 2030, dtype=np.uint32), right])
    at = np.array([0, 20, 55, 95, 120, 150])
    holder_at = np.array([0, 20, 55, 90, 115, 145])
    assert align(b, a, at, holder_at, 50, 0.8) == [(0, 60, 0, 60, 60), (95, 155, 90, 150, 60)]


def test_recall_of_unlike_passages(docs_of):
    """Planted passages with scattered unequal words, of the share the operator promises."""
    r = random.Random(11)
    for length, identity, least in ((100, 0.8, 0.92), (100, 0.85, 0.97), (60, 0.85, 0.85), (60, 0.9, 0.97), (60, 0.95, 0.97)):
        rows = []
        for i in range(60):
            passage = words(length, 5000 + i)
            other = list(passage)
            for at in r.sample(range(length), round((1 - identity) * length)):
                other[at] = f"other{at}"
            rows.append((2 * i, " ".join(words(70, 6000 + i) + passage + words(50, 7000 + i))))
            rows.append((2 * i + 1, " ".join(words(40, 8000 + i) + other + words(60, 9000 + i))))
        got = {(g[0], g[3]) for g in spans(shared_passages(docs_of(*rows)))}
        assert len(got & {(2 * i + 1, 2 * i) for i in range(60)}) >= least * 60, (length, identity)


def test_parts_held_by_smaller_documents(docs_of):
    """A passage is found though every seed of it has a smaller holder with a part of it only."""
    passage = words(60, 21)
    part = {1: passage[:26], 2: passage[22:48], 3: passage[44:]}  # also the seeds across the cuts
    rows = [(i, " ".join(words(30, 300 + i) + part[i] + words(30, 310 + i))) for i in part]
    rows += [(i, " ".join(words(40, 320 + i) + passage + words(50, 330 + i))) for i in (50, 51, 52, 53)]
    got = spans(shared_passages(docs_of(*rows)))
    assert {(i, 40, 100, 50, 40, 100) for i in (51, 52, 53)} <= set(got)
    assert {g[1:3] + g[4:] for g in got} == {(40, 100, 40, 100)} and len(got) == len(set(got))


def test_further_links_do_not_grow_with_the_square_of_equal_parts(docs_of):
    """A short line in many documents costs a link each; two of them that share more around it are found."""
    line, more = words(12, 41), words(50, 42)
    rows = [(i, " ".join(words(60, 400 + i) + line + words(60, 800 + i))) for i in range(200)]
    rows += [(i, " ".join(words(60, 1200 + i) + line + more + words(60, 1300 + i))) for i in (300, 301)]
    rows.append((10_000, " ".join(words(60, 43) + more[:25] + words(60, 44) + more[22:] + words(60, 45))))
    docs = docs_of(*rows)
    shared = passages.shared_seeds(passages.seed_table(passages._rows(docs, "doc_id", "text")))
    found = shared_passages(docs)
    places = passages.neighbourhoods(shared, found.limit(0), 45)
    assert 0 < passages.further_anchors(places).count() < 10 * len(rows)
    assert [(g[0], g[3]) for g in spans(found)] == [(301, 300)]


def test_further_links_are_linear_in_crowds_of_unlike_neighbourhoods(docs_of):
    """A line of two distant seeds, next to another one each time, costs links by the place, not by the pair."""
    line, more = words(30, 61), words(40, 62)
    rows = [(i, " ".join(words(60, 2000 + i) + line + words(14, 2600 + i % 75) + words(60, 3000 + i))) for i in range(150)]
    rows += [(i, " ".join(words(60, 3600 + i) + line + more + words(60, 3700 + i))) for i in (300, 301)]
    rows += [(200, " ".join(words(60, 63) + more[:25] + words(60, 64) + more[22:] + words(60, 65)))]
    docs = docs_of(*rows)
    shared = passages.shared_seeds(passages.seed_table(passages._rows(docs, "doc_id", "text")))
    found = shared_passages(docs)
    groups = passages.neighbourhoods(shared, found.limit(0), 45)
    assert passages.further_anchors(groups).count() < 40 * len(rows)
    assert [(g[0], g[1], g[2], g[3]) for g in spans(found)] == [(301, 60, 130, 300)]


def test_equal_passages_settle_what_lies_well_inside():
    at = np.arange(0, 300, 3)
    none, every = np.zeros(100, dtype=bool), np.ones(100, dtype=bool)
    seed = np.arange(100, dtype=np.int64)
    span = np.array([0]), np.array([200]), np.array([True])
    first, _, opened, kept = passages._open_groups(at, seed, every, every, *span, 45)
    assert first.tolist() == [0] and at[opened].min() == 198 - 45 and opened[at > 195].all()
    assert at[kept].min() == 153  # the rest also lies in the smaller document
    whole = np.array([0]), np.array([302]), np.array([True])
    assert not passages._open_groups(at, seed, every, every, *whole, 45)[3].any()
    whole = np.array([0]), np.array([302]), np.array([False])
    assert passages._open_groups(at, seed, none, none, *whole, 45)[3].all()
