import random

import numpy as np
import pytest
import xxhash
from llm_fixtures import docs_of  # noqa: F401

from tideload.llm import simhash
from tideload.llm.components import components
from tideload.llm.simhash import fingerprint, fingerprint_links, keep_one, simhash_components


def plain_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids, fps):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, f in zip(ids, fps, strict=True):
        for j, g in zip(ids, fps, strict=True):
            if j < i and (f ^ g).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprint():
    for text in (None, "", " \t\n", "one", "One TWO", "a b c", "a b c d\x0be\x0cf", "É é É é", "x y z w", "w " * 999):
        assert fingerprint(text) == plain_fingerprint(text), text


@pytest.mark.parametrize("limit", [250_000, 5])
def test_links_imply_all_near_pairs(spark, monkeypatch, limit):
    """Both prefix forms, on clusters of fingerprints a few bits apart."""
    monkeypatch.setattr(simhash, "PREFIX_ROWS", limit)
    rng = random.Random(limit)
    fps = {0, (1 << 64) - 1, 1, 6, 7 << 61}
    for _ in range(25):
        centre = rng.getrandbits(64)
        fps.add(centre)
        for _ in range(12):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))))
    fps = sorted(fps)
    ids = list(range(len(fps)))
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame(list(zip(ids, signed, strict=True)), "node long, fp long")
    links = fingerprint_links(nodes)
    assert all((fps[r.u] ^ fps[r.v]).bit_count() <= 64 for r in links.collect())
    found = {r.node: r.component for r in components(links).collect()}
    assert {i: found.get(i, i) for i in ids} == classes(ids, fps)


def test_small_passes_change_nothing(monkeypatch):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = np.array(sorted({centre ^ sum(1 << b for b in rng.sample(range(20), 2)) for _ in range(60)}), dtype=np.uint64)
    used = np.zeros(len(fps), dtype=np.int64)
    whole = [x.tolist() for x in simhash._met(fps, used, 56)]
    monkeypatch.setattr(simhash, "PASS_VARIANTS", 1000)
    assert [x.tolist() for x in simhash._met(fps, used, 56)] == whole


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(500, 300), (300, 400), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {400: 300, 500: 300}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_documents(docs_of, spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(9, base), (4, base + " more"), (2, "quite another text of a few words"), (8, None), (6, ""), (6, ""), (None, base)]
    rows += [(11, "Word " * 4000), (12, base.upper())]
    got = {(r.id, r.fp % (1 << 64), r.component) for r in simhash_components(docs_of(*rows)).collect()}
    fps = {i: plain_fingerprint(t) for i, t in rows if i is not None}
    want = classes(sorted(fps), [fps[i] for i in sorted(fps)])
    assert got == {(i, f, want[i]) for i, f in fps.items()} | {(None, plain_fingerprint(base), None)}
    kept = sorted(str(r.doc_id) for r in keep_one(docs_of(*rows)).collect())
    assert kept == sorted([*{str(c) for c in want.values()}, "None"])
    assert simhash_components(docs_of()).collect() == [] and keep_one(docs_of()).collect() == []
    clash = spark.createDataFrame([(1, "a b", 1, 2, 3)], "doc_id long, text string, fp int, id int, component int")
    assert keep_one(clash).collect() == clash.collect()
