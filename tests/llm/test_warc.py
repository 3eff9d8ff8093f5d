import gzip
import hashlib
import os

import pytest

from tideload.llm.warc import payload_digest, read_archives, records, write_archives

SCHEMA = "page_id long, url string, html string"
ROWS = [
    (5, "http://a/é x\n", "same"), (3, "http://b/", "same"), (9, None, "same"), (4, "http://c", None), (6, "http://d", ""),
    (None, "http://e", "same"), (None, "http://f", "alone"), (7, "http://g", "é" * 400_000), (8, "http://h", "\r\n\r\nWARC/1.1\r\n"),
    (3, "http://b/", "same"), (3, "http://a/", "other"),
] + [(100 + i, f"http://x/{i}", f"<p>page {i % 40}</p>" * 50) for i in range(300)]


def brute(rows):
    holder = {}
    for i, _, html in rows:
        if i is not None:
            holder[html or ""] = min(i, holder.get(html or "", i))
    out, first = [], set()
    for i, url, html in rows:
        html = html or ""
        keep = holder.get(html)
        response = keep is None or (i == keep and html not in first)
        if i == keep:
            first.add(html)
        data = html.encode()
        out.append((i, len(data), payload_digest(data), "response" if response else "revisit", None if response else keep))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def files(path):
    return {n: hashlib.sha1(open(f"{path}/{n}", "rb").read()).hexdigest() for n in os.listdir(path) if n.endswith(".gz")}


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 20_000, "file_bytes": 2_000}])
def test_round_trip(spark, scratch, options):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    manifest = write_archives(pages, f"{scratch}/a", **options).collect()
    back = read_archives(spark, f"{scratch}/a")
    assert found(back) == brute(ROWS)
    texts = sorted((str(r.id), bytes(r.payload).decode()) for r in back.collect() if r.record_type == "response")
    want = {(str(i), (html or "")) for i, _, html in ROWS}
    assert set(texts) <= want and {t for _, t in texts} == {t for _, t in want}
    assert files(f"{scratch}/a") == {r.file: r.sha1 for r in manifest}
    assert sum(r.n_records for r in manifest) == len(ROWS)
    if options:
        assert len(manifest) > 5
        spans = sorted((r.shard, r.first_id, r.last_id) for r in manifest if r.first_id is not None)
        assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:], strict=False))
    # The same rows in another order and other partitions give the same files.
    write_archives(spark.createDataFrame(ROWS[::-1], SCHEMA).repartition(2), f"{scratch}/b", **options)
    assert files(f"{scratch}/b") == files(f"{scratch}/a")
    # A second run over what a lost one left.
    write_archives(pages, f"{scratch}/a", **options)
    assert found(read_archives(spark, f"{scratch}/a")) == brute(ROWS)


def test_small_payloads_stay_responses(spark, scratch):
    write_archives(spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], SCHEMA), scratch, min_bytes=3)
    assert [r.record_type for r in read_archives(spark, scratch).orderBy("id").collect()] == ["response"] * 3 + ["revisit"]


def test_records_are_gzip_members(spark, scratch):
    manifest = write_archives(spark.createDataFrame(ROWS[:3], SCHEMA), scratch).collect()
    with gzip.open(f"{scratch}/{manifest[0].file}") as stream:
        kinds = [head["warc-type"] for head, _ in records(stream)]
    assert kinds == ["warcinfo", "response", "revisit", "revisit"]


def test_empty_table_and_clashing_columns(spark, scratch):
    assert write_archives(spark.createDataFrame([], SCHEMA), f"{scratch}/e").collect() == []
    assert read_archives(spark, f"{scratch}/e").collect() == []
    clash = spark.createDataFrame([(1, "u", "h", 2, 3, 4, 5)], SCHEMA + ", id int, size int, shard int, digest int")
    write_archives(clash, f"{scratch}/c")
    assert found(read_archives(spark, f"{scratch}/c")) == brute([(1, "u", "h")])


def test_far_ids_and_many_pages_without_one(spark, scratch):
    rows = [(i, f"http://x/{i}", f"page {i} " * 40) for i in range(1000)] + [(10**15, "http://far", "far"), (-(10**12), "http://low", "low")]
    rows += [(None, f"http://n/{i}", f"nameless {i} " * 40) for i in range(400)]
    manifest = write_archives(spark.createDataFrame(rows, SCHEMA), f"{scratch}/a", shard_bytes=20_000).collect()
    named = [r for r in manifest if r.first_id is not None]
    assert len(named) > 10 and max(r.n_records for r in named) < 150
    assert len([r for r in manifest if r.first_id is None]) > 5
    back = read_archives(spark, f"{scratch}/a")
    assert found(back) == brute(rows)
    # A task per file reads them back.
    assert back.rdd.getNumPartitions() == len(manifest)
    write_archives(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3), f"{scratch}/b", shard_bytes=20_000)
    assert files(f"{scratch}/b") == files(f"{scratch}/a")


def test_one_id_with_all_pages(spark, scratch):
    rows = [(7, f"http://x/{i}", f"page {i}" * 50) for i in range(100)]
    manifest = write_archives(spark.createDataFrame(rows, SCHEMA), scratch, shard_bytes=1000, file_bytes=2000).collect()
    assert {r.shard for r in manifest} == {0} and found(read_archives(spark, scratch)) == brute(rows)
