import random

import numpy as np
import pytest
import xxhash

from marketframe.llm import simhash

SCHEMA = "doc_id long, text string, fp string, root string"


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(
    "text", [None, "", " \n", "One", "one TWO", "a b c", "a b c d a b c", "ÉTÉ  x y\x1cz", "w\x0bx\x0cy z " * 50]
)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_long_texts_are_read_whole(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(4000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 97)
    assert simhash.fingerprint(text) == whole == slow_fingerprint(text)


def brute_groups(points, reach=2):
    parent = {p: p for p in points}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for p in points:
        for q in points:
            if p < q and (p ^ q).bit_count() <= reach:
                a, b = find(p), find(q)
                parent[max(a, b)] = min(a, b)
    return {p: find(p) for p in points}


def crowd(seed, n=600):
    """Fingerprints in chains and clusters around a few centres, and some far from all."""
    rng = random.Random(seed)
    points = [rng.getrandbits(64) for _ in range(n // 3)]
    while len(points) < n:
        p = rng.choice(points)
        for _ in range(rng.choice([1, 1, 2, 3, 5])):
            p ^= 1 << rng.randrange(64)
        points.append(p)
    return sorted(set(points))


@pytest.mark.parametrize("seed", range(3))
def test_trees_lose_no_pair(seed, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 40)
    points = crowd(seed)
    array = np.array(points, np.uint64)
    nodes = simhash.grow(array[::3], 20)
    places = {}
    for leaf, here in simhash.route(array, nodes):
        for p in here.tolist():
            places.setdefault(p, set()).add(leaf)
    assert len({leaf for s in places.values() for leaf in s}) > 4
    for p in points:
        for q in points:
            if p < q and (p ^ q).bit_count() <= 2:
                assert places[p] & places[q]
    members, roots = simhash.linked(array)
    want = {p: r for p, r in brute_groups(points).items() if list(brute_groups(points).values()).count(r) > 1} if seed == 0 else None
    if want is not None:
        assert dict(zip(members.tolist(), roots.tolist())) == want


def test_components_against_brute_force(spark):
    points = crowd(7)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    frame = spark.createDataFrame([(p,) for p in signed + signed[:50]], "fp long").repartition(5)
    got = {r.fp: r.root for r in simhash.components(frame, shard=60, sample=300).collect()}
    want = brute_groups(points)
    sizes = {}
    for p, r in want.items():
        sizes.setdefault(r, []).append(p)
    groups = {frozenset(m) for m in sizes.values() if len(m) > 1}
    found = {}
    for fp, root in got.items():
        found.setdefault(root, []).append(fp % (1 << 64))
    assert {frozenset(m) for m in found.values()} == groups


def test_a_long_chain_is_one_component(spark):
    points = [(1 << i) - 1 for i in range(64)]
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = simhash.components(frame, shard=8, sample=64).collect()
    assert len(got) == 64 and len({r.root for r in got}) == 1


TEXT = " ".join(f"word{i}" for i in range(300))


def test_documents(spark):
    other = " ".join(f"other{i}" for i in range(300))
    rows = [(5, TEXT), (3, TEXT + " more"), (9, TEXT.upper()), (4, other), (None, TEXT), (7, None), (6, ""), (4, other), (None, "alone alone")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = simhash.label(frame).collect()
    assert len(found) == len(rows)
    prints = {r: slow_fingerprint(t) for r, t in enumerate(t for _, t in rows)}
    assert sorted(r.fp % (1 << 64) for r in found) == sorted(prints.values())
    component = {(r.doc_id, r.fp): r.component_id for r in found}
    assert component[6, 0] == component[7, 0] == 6
    near = (slow_fingerprint(TEXT) ^ slow_fingerprint(TEXT + " more")).bit_count() <= 2
    assert {c for (d, _), c in component.items() if d in (5, 9)} == {3 if near else 5}
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    want = [3, 4, 6, None] if near else [3, 4, 5, 6, None]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)
    assert simhash.label(frame.limit(0)).count() == 0 and simhash.drop_near_duplicates(frame.limit(0)).count() == 0
