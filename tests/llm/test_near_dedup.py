import random
import re

import numpy as np
import pytest

from tillroll.llm import near_dedup as nd


def brute(rows, percent=85, size=5):
    """Components of all linked pairs, pair by pair, on the shingles themselves."""
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                parent[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def corpus(seed, n_base=12, copies=9):
    random.seed(seed)
    words = ["w%d" % k for k in range(400)]
    rows, i = [], 0
    shared = " ".join(random.choices(words, k=60))
    for b in range(n_base):
        base = random.choices(words, k=random.choice([3, 8, 60, 200]))
        for _ in range(random.randint(1, copies)):
            text = list(base)
            for _ in range(random.randint(0, max(1, len(text) // 40))):
                text[random.randrange(len(text))] = random.choice(words)
            out = " ".join(text)
            rows.append((i, (out.upper() if random.random() < 0.2 else out) + (" " + shared if b % 3 == 0 else "")))
            i += 7
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(make, seed):
    rows = corpus(seed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in nd.near_duplicates(make(rows)).collect()}
    assert got == brute(rows)


def test_large_group_dealt_as_blocks(make):
    """Near copies of one text, pairwise near the threshold, in groups larger than a block."""
    random.seed(5)
    words = ["w%d" % k for k in range(300)]
    base, rows = random.choices(words, k=120), []
    for i in range(160):
        text = list(base)
        for _ in range(random.randint(0, 3)):
            text[random.randrange(120)] = random.choice(words)
        rows.append((i, " ".join(text)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in nd.near_duplicates(make(rows), params=nd.NearDedupParams(block=16)).collect()}
    assert got == brute(rows)


def test_signatures_estimate_similarity_and_sketches_lose_no_link():
    random_state = np.random.default_rng(4)
    params = nd.NearDedupParams()
    for share in (0.3, 0.7, 0.85, 0.95):
        pool = random_state.integers(0, 2 ** 63, 2000).astype(np.uint64)
        both = int(1000 * share)
        a, b = np.unique(pool[:1000]), np.unique(np.concatenate([pool[:both], pool[1000:2000 - both]]))
        low = nd.minima(np.concatenate([a, b]), np.array([0, len(a)]), params)
        packed = nd.pack_low_bits(low, params.bits)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(nd.estimate(packed[:1], packed[1:], params.minima, params.bits)[0] - true) < 0.15
        sketch = [nd.parity_sketch(s, params.parity_bits)[None] for s in (a, b)]
        may = nd.may_link(np.array([len(a)]), np.array([len(b)]), *sketch, params.percent)[0]
        assert may or true < 0.85


def test_rows_without_an_id_are_linked(make):
    a, b, c = (" ".join(f"{w}{k}" for k in range(60)) for w in "abc")
    rows = [(None, a), (None, a), (None, a + " end"), (None, b), (3, b), (4, b), (None, c), (5, ""), (None, ""), (None, None)]
    got = [tuple(r) for r in nd.near_duplicates(make(rows)).collect()]
    assert sum(kept for i, n, component, kept in got if component is None and n in (56, 57)) == 2  # one of a's, and c
    assert {(i, kept) for i, n, component, kept in got if component == 3} == {(3, True), (4, False), (None, False)}
    assert [kept for i, n, component, kept in got if not n] == [True] * 3 and len(got) == len(rows)
