"""Near-duplicates by SimHash against fingerprints and links found pair by pair."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash
from millrace.llm.components import components


def plain_fingerprint(text, shingle=4):
    data = (text or "").encode()
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    words = data.split()
    if not words:
        return 0
    lines = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(line, seed=42).intdigest() for line in lines]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, bits, limit=4):
    root = {i: i for i in range(len(ids))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= limit:
                root[find(i)] = find(j)
    least = {}
    for i, key in enumerate(ids):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(ids))]


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key string, bits int")
    found = sorted(map(tuple, simhash.near_duplicates(docs, **options).collect()), key=repr)
    shingle = options.get("shingle", 4)
    bits = [plain_fingerprint(r[1], shingle) for r in rows]
    groups = plain_components([r[0] for r in rows], bits, options.get("max_bits", 4))
    expected = [(r[0], f"{b:016x}", g) for r, b, g in zip(rows, bits, groups)]
    assert found == sorted(expected, key=repr)


def test_given_documents(spark):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(spark, [(r.doc_id, r.text, "x", 1) for r in texts.collect()])


@pytest.mark.parametrize("max_bits", [0, 4, 7])
def test_edited_copies(spark, max_bits):
    rng = random.Random(5)
    rows = []
    for group in range(12):
        base = [rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(rng.choice([3, 40, 300]))]
        for _ in range(8):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(["x", "Yy", "zzz"])
            rows.append((len(rows) * 3, " ".join(words), None, None))
    rng.shuffle(rows)
    check(spark, rows, max_bits=max_bits)


def test_edge_rows(spark):
    rows = [(1, None, "a", 1), (2, "", "a", 1), (3, " \t\n", None, None), (4, "Ab cD", "b", 2),
            (4, "ab\ncd", "b", 2), (5, "ab cd", "b", 2), (None, "ab cd", None, 3),
            (None, "quite another text of more words", None, 3), (-7, "Ä Ö a b c d e", "c", 4),
            (8, "word " * 30000, "d", 5), (9, "word " * 30000, "d", 5)]
    check(spark, rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    result = simhash.near_duplicates(docs)
    assert result.columns == ["doc_id", "fingerprint", "component_id"] and result.count() == 0


def test_every_near_pair_meets_at_an_anchor():
    rng = np.random.default_rng(3)
    one = rng.integers(0, 1 << 63, 400, np.uint64) << np.uint64(1)
    two = one.copy()
    for i in range(len(two)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            two[i] ^= np.uint64(1) << np.uint64(bit)
    at, keys, home = simhash.anchors(np.concatenate([one, two]))
    reached = [set() for _ in range(2 * len(one))]
    homes = [set() for _ in range(2 * len(one))]
    for row, key, own in zip(at.tolist(), keys.tolist(), home.tolist()):
        reached[row].add(key)
        if own:
            homes[row].add(key)
    assert all(homes[i] & reached[i + len(one)] for i in range(len(one)))
    assert len(at) == sum(map(len, reached))


def test_dense_group_gives_a_forest(spark):
    rng = random.Random(2)
    bits = {0}
    while len(bits) < 1500:
        bits.add(sum(1 << rng.randrange(40) for _ in range(3)) % (1 << 40))
    points = spark.createDataFrame([(i, b) for i, b in enumerate(sorted(bits))],
                                   "node bigint, bits bigint").repartition(3)
    links = simhash.near_links(points)
    assert links.count() < 60 * len(bits)
    assert components(links).select("component").distinct().count() == 1


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(20, 60)] + [(5, 5), (None, 3)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert set(found.values()) == {100, 7} and len(found) == 61 + 41


def crowd(n, seed=4):
    """Distinct fingerprints near each other in groups, most of them at a few anchors."""
    rng, bits = random.Random(seed), set()
    while len(bits) < n:
        base = rng.choice([0, 0, 0xFF, 0x3FFFF0000]) | rng.randrange(6) << 50
        bits.add(base ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (1 << 64) - 1)
    return sorted(bits)


def test_home_anchors_are_those_marked():
    bits = np.array(crowd(500), np.uint64)
    at, keys, home = simhash.anchors(bits)
    marked = sorted(zip(keys[home].tolist(), at[home].tolist()))
    assert marked == sorted(zip(simhash.home_anchors(bits).tolist(), list(range(len(bits))) * 3))


def test_pairs_of_a_hot_anchor_meet_in_one_cell():
    """Every pair of a hot anchor with a member at home meets, and no cell has the whole anchor."""
    bits = np.array(crowd(600), np.uint64)
    at, keys, home = simhash.anchors(bits)
    values, homes = np.unique(simhash.home_anchors(bits), return_counts=True)
    hot = values[homes > 20], -(-homes[homes > 20] // 20)
    assert len(hot[0]) >= 3 and hot[1].max() > 5
    met, sizes = {}, {}
    for rows, cell, own in simhash.cells(bits, at, keys, home, hot):
        for row, code, is_home in zip(rows.tolist(), cell.tolist(), own.tolist()):
            met.setdefault(code, []).append((row, is_home))
    pairs = {}
    for code, members in met.items():
        assert len({r for r, _ in members}) == len(members)
        sizes.setdefault(code >> 32, []).append(len(members))
        found = pairs.setdefault(code >> 32, set())
        found |= {frozenset((a, b)) for a, mine in members if mine for b, _ in members if a != b}
    wanted = {}
    for row, key, own in zip(at.tolist(), keys.tolist(), home.tolist()):
        wanted.setdefault(key, []).append((row, own))
    for key, members in wanted.items():
        assert pairs[key] == {frozenset((a, b)) for a, mine in members if mine for b, _ in members if a != b}
    for key, side in zip(*hot):
        assert max(sizes[key]) < 0.8 * len(wanted[key])


@pytest.mark.parametrize("hot_homes", [7, 1 << 14])
def test_hot_anchors_lose_no_link(spark, hot_homes):
    bits = crowd(700, seed=8)
    points = spark.createDataFrame([(i, b - (1 << 64) if b >> 63 else b) for i, b in enumerate(bits)],
                                   "node bigint, bits bigint").repartition(5)
    found = dict(map(tuple, components(simhash.near_links(points, hot_homes=hot_homes)).collect()))
    expected = plain_components(list(range(len(bits))), bits)
    assert [found.get(i, i) for i in range(len(bits))] == expected
