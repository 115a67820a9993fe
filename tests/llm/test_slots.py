"""Virtual slots: places without gaps, near equal bytes, growth into the new shard only."""

import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import slots as S


def test_rows_get_gapless_places(documents, nothing):
    got = S.shard(documents, 4, slots=64).collect()
    want = sorted((r.doc_id or -1, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in documents.collect())
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in got) == want
    of = defaultdict(list)
    for r in got:
        of[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in of.values()) and set(of) <= set(range(4))
    assert S.shard(nothing, 4).isEmpty()


def test_shards_are_of_near_equal_size():
    rng = random.Random(1)
    sizes = [rng.randint(0, 2000) for _ in range(S.SLOTS)]
    held = [0] * 40
    for size, shard in zip(sizes, S.assign(sizes, 40)):
        held[shard] += size
    assert max(held) - min(held) <= 50


def test_growth_moves_slots_into_the_new_shard_only():
    rng = random.Random(2)
    sizes = [rng.choice([0, 10, 500, 9000]) for _ in range(S.SLOTS)]
    before = S.assign(sizes, 40)
    after = S.grow(before, sizes)
    assert all(b in (a, 40) for a, b in zip(before, after))
    held = [0] * 41
    for size, shard in zip(sizes, after):
        held[shard] += size
    mean = sum(sizes) / 41
    assert abs(held[40] - mean) < 0.02 * mean and max(held) < 1.05 * mean
    assert S.grow([0, 0], [0, 0]) == [0, 0]


def test_versions_of_a_map_stay_side_by_side(spark, tmp_path):
    path = f"file://{tmp_path}/map"
    S.write_map(spark, path, [0, 1, 0], 1)
    S.write_map(spark, path, [0, 1, 2], 2)
    maps = [sorted((r.virtual_slot, r.shard) for r in S.read_map(spark, path, v).collect()) for v in (1, 2)]
    assert maps == [[(0, 0), (1, 1), (2, 0)], [(0, 0), (1, 1), (2, 2)]]


def test_a_stored_map_is_edited_and_rows_follow_their_slots(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = f"file://{tmp_path}/map"
    first = {r.doc_id: r for r in S.shard(docs, 4, slots=256, map_path=path).collect()}
    second = {r.doc_id: r for r in S.rebalance(docs, path, 6).collect()}
    assert S.latest_version(spark, path) == 2 and {r.map_version for r in second.values()} == {2}
    maps = [{r.virtual_slot: r.shard for r in S.read_map(spark, path, v).collect()} for v in (1, 2)]
    moved = {slot for slot in maps[0] if maps[0][slot] != maps[1][slot]}
    assert moved and {maps[1][slot] for slot in moved} == {4, 5}
    for doc, row in second.items():
        assert row.virtual_slot == first[doc].virtual_slot and row.shard == maps[1][row.virtual_slot]
        assert (row.shard != first[doc].shard) == (row.virtual_slot in moved)
    held = defaultdict(int)
    places = defaultdict(list)
    for row in second.values():
        held[row.shard] += row["size"]
        places[row.shard].append(row.slot)
    assert max(held.values()) < 1.3 * sum(held.values()) / 6 and all(sorted(x) == list(range(len(x))) for x in places.values())
    same = S.rebalance(docs, path, 6).collect()
    assert S.latest_version(spark, path) == 2 and {r.doc_id: r.shard for r in same} == {d: r.shard for d, r in second.items()}
    with pytest.raises(ValueError, match="6 shards"):
        S.rebalance(docs, path, 5)
