import math
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from tessera.llm import queries, shards


def rows():
    return [(i, f"text {i % 7}") for i in range(3000)] + [(None, None), (5, "text 5"), (5, "text 5"), (6, "")]


def test_growth_fills_the_new_shard_only(table):
    root = shards.tree()
    d = shards.placed(shards.placed(table(rows()), root, "doc_id"), shards.grown(root), "doc_id", "g").collect()
    assert all(r.g in (r.shard, 24) for r in d)
    n = Counter(r.shard for r in d)
    assert set(n) == set(range(24)) and max(n.values()) < 2 * min(n.values())
    assert 3000 / 25 * 0.6 < sum(r.g == 24 for r in d) < 3000 / 25 * 1.5


def test_weights_move_rows_only_between_changed_subtrees(table):
    """Raising a shard's weight moves rows only into its region, rack and shard, level by level."""
    a, b = shards.tree(), shards.tree(weights={0: 3.0})
    d = shards.placed(shards.placed(table(rows()), a, "doc_id"), b, "doc_id", "g").collect()
    moved = [(r.shard, r.g) for r in d if r.shard != r.g]
    assert moved
    for old, new in moved:
        assert new // 12 == 0  # only region 0 got heavier
        if old // 12 == 0:
            assert new // 4 == 0  # inside it only rack 0 did
            if old // 4 == 0:
                assert new == 0
    lone = shards.placed(table(rows()), shards.tree(weights={i: 0.0 for i in range(12)}), "doc_id").collect()
    assert min(r.shard for r in lone) >= 12


def test_shares_follow_weights(table):
    d = shards.placed(table(rows()), shards.tree(1, 1, 2, {0: 3.0, 1: 1.0}), "doc_id").collect()
    n = Counter(r.shard for r in d)
    assert 0.7 < n[0] / len(d) < 0.8


def test_slots_have_no_gaps(table):
    d = shards.with_slots(shards.placed(table(rows()), shards.tree(), "doc_id"), "shard", ["doc_id", "text"]).collect()
    slots = defaultdict(list)
    for r in d:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(d) == len(rows()) and "kept" in d[0]


def test_empty_table(table):
    e = shards.placed(table([]), shards.tree(), "doc_id")
    assert shards.with_slots(e, "shard", ["doc_id"]).count() == 0


MASK = (1 << 64) - 1


def drawn(name, key, seed=0):
    """ln of the keyed uniform of (node, key); a null key leaves the hash as it is."""
    h = xxhash.xxh64_intdigest(f"{seed}/{name}".encode(), seed=42)
    if key is not None:
        h = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=h)
    return math.log(((h >> 11) + 0.5) / 2.0 ** 53)


def descended(node, key):
    while node.children:
        node = max((c for c in node.children if c.weight > 0), key=lambda c: drawn(c.name, key) / c.weight)
    return node.shard


@pytest.mark.parametrize("weights", [None, {0: 3.0, 5: 0.0, 17: 0.25}])
def test_descent_by_hand(table, weights):
    root = shards.tree(weights=weights)
    d = shards.placed(shards.placed(table(rows()), root, "doc_id"), shards.grown(root), "doc_id", "g").collect()
    for r in d:
        assert (r.shard, r.g) == (descended(root, r.doc_id), descended(shards.grown(root), r.doc_id))
    assert len(d) == len(rows())


def test_query_by_hand(table, tmp_path):
    """The registered query: sizes, checksums, shards and slots, with null, empty, wide and very long texts."""
    given = [*rows()[::10], (None, None), (None, "no id"), (5, "é€😀"), (5, "é€😀"), (7, "long text " * 300_000), (8, "")]
    table(given).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op6_hash_tree_shards"](table([]).sparkSession, str(tmp_path)).collect()
    root, bigger = shards.tree(), shards.grown(shards.tree())
    want = Counter()
    for i, text in given:
        raw = (text or "").encode()
        want[i, len(raw) + 8, zlib.crc32(raw), "key", descended(root, i), descended(bigger, i)] += 1
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
