import zlib
from collections import Counter, defaultdict

import pytest

from ledgerframe.llm import sharding as S

from .conftest import rows_of


def check(docs, shards, **options):
    source = docs.collect()
    got = rows_of(S.shard(docs, shards, **options))
    size = {}
    for r in source:
        size.setdefault(str(r.doc_id), []).append((len((r.text or "").encode()) + 16,
                                                   zlib.crc32((r.text or "").encode())))
    mine = defaultdict(list)
    for r in got:
        mine[str(r["doc_id"])].append((r["size"], r["text_crc32"]))
    assert {k: sorted(v) for k, v in mine.items()} == {k: sorted(v) for k, v in size.items()}
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    loads = Counter()
    for r in got:
        loads[r["shard"]] += r["size"]
    return got, loads


def test_sizes_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got, loads = check(docs, 40)
    mean, most = sum(loads.values()) / 40, max(r["size"] for r in got)
    assert len(loads) == 40
    assert all(abs(v - mean) <= most + 0.02 * mean for v in loads.values())


def test_hot_group_is_split_and_small_groups_stay_together(spark):
    rows = [(i, "hot text " * 20 if i % 3 == 0 else f"own text {i % 2500} " * 15) for i in range(6000)]
    got, loads = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 40,
                       group_share=0.05)
    mean = sum(loads.values()) / 40
    assert all(abs(v - mean) < 0.05 * mean for v in loads.values())
    places = defaultdict(set)
    for r in got:
        places[r["text_crc32"]].add(r["shard"])
    assert len(places.pop(zlib.crc32(b"hot text " * 20))) >= 12
    assert all(len(p) == 1 for p in places.values())


def test_one_repeated_row_fills_all_shards(spark):
    docs = spark.createDataFrame([(7, "same")] * 2000, "doc_id long, text string")
    _, loads = check(docs, 10)
    assert max(loads.values()) - min(loads.values()) <= 2 * 20


@pytest.mark.parametrize("shards", [1, 4])
def test_edge_rows(edge_docs, shards):
    check(edge_docs, shards)


def test_empty_table_and_written_shards(spark, no_docs, tmp_dir):
    assert S.shard(no_docs).count() == 0
    docs = spark.createDataFrame([(i, "t" * i) for i in range(100)], "doc_id long, text string")
    S.write_shards(docs, f"{tmp_dir}/out", 4)
    back = spark.read.parquet(f"{tmp_dir}/out")
    assert back.count() == 100 and back.select("shard").distinct().count() == 4
