import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from llm_fixtures import docs_of  # noqa: F401

from tideload.llm.encoding import PATTERN, encode, load_encoder
from tideload.llm.packing import SEQUENCE_COST, best_cuts, cut_candidates, pack, pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_vocabulary_file(reference):
    encoder = load_encoder(PATH)
    assert PATTERN == public_tokenizers.PATTERN
    rng = random.Random(5)
    for _ in range(1500):
        text = "".join(rng.choice("ab Z'\n\t  .!?é中🙂　\xa0\x1f\x85 09'sll١<|>") for _ in range(rng.randrange(50)))
        text += rng.choice(["", "<|endoftext|>", " <|endoftext|>\n"]) + "x"
        assert encode(encoder, text).tolist() == reference.encode(text, add_special_tokens=False).ids, text


def least_cost(places, penalty, limit):
    cost = [0] + [10**9] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            n = places[j] - places[i]
            if n <= limit:
                cost[j] = min(cost[j], cost[i] + (0 if n & (n - 1) == 0 else limit - n) + SEQUENCE_COST + penalty[j])
    return cost[-1]


def test_cuts_are_the_cheapest():
    rng = random.Random(1)
    for _ in range(200):
        lengths = np.array([rng.choice([1, 3, 17, 40, 100, 200]) for _ in range(rng.randrange(1, 30))])
        total = int(lengths.sum())
        soft = np.unique([rng.randrange(1, total + 1) for _ in range(rng.randrange(1, 60))])
        limit = rng.choice([16, 64, 128])
        places, penalty = cut_candidates(np.cumsum(lengths), soft[soft < total], limit)
        cuts = best_cuts(places, penalty, limit)
        of = dict(zip(places, penalty, strict=True))
        steps = np.diff(cuts)
        assert steps.max() <= limit
        padding = sum(0 if n & (n - 1) == 0 else limit - n for n in steps)
        assert padding + len(steps) * SEQUENCE_COST + sum(of[c] for c in cuts[1:]) == least_cost(places, penalty, limit)


@pytest.mark.parametrize("block", [1 << 20, 700])
def test_pieces_hold_every_id_once(docs_of, reference, block):
    rows = [(1, "One sentence. Another one!\n" * 300), (2, None), (3, ""), (None, "no id"), (4, "x" * 9000), (5, "same"), (5, "same")]
    rows += [(i, "short text " * (i % 40)) for i in range(10, 60)]
    packed = pack(docs_of(*rows), PATH, limit=256, block=block)
    got = packed.collect()
    digests = pieces(packed).collect()
    assert [zlib.crc32(r.ids) for r in got] == [r.ids_crc32 for r in digests]
    by_doc, by_sequence = {}, {}
    for r in got:
        assert len(r.ids) == 4 * r.length > 0
        by_doc.setdefault(r.id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in rows:
        own = sorted(by_doc[i], key=lambda r: r.start)
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 0]
        assert all(r.doc_tokens == len(ids) for r in own)
        if i != 5:
            assert np.frombuffer(b"".join(r.ids for r in own), dtype="<u4").tolist() == ids
    assert sum(r.length for r in by_doc[5]) == 2 * by_doc[5][0].doc_tokens
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in own])
        assert [r.offset for r in own] == [0, *ends[:-1]] and ends[-1] <= 256


def test_empty_table(docs_of):
    assert pack(docs_of(), PATH).collect() == []


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = pack(docs, PATH).groupBy("sequence_id").sum("length").toPandas()["sum(length)"].to_numpy()
    padding = np.where(sizes & (sizes - 1), 1024 - sizes, 0)
    assert padding.sum() < 0.03 * sizes.sum()
