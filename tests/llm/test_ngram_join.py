"""The shingle join against all pairs, and its parts."""

from collections import Counter

import numpy as np
import pytest

from marketlake.llm import exchange
from tests.llm.helpers import SCHEMA, odd_docs, words

SF = "/root/testdata/sf0.001"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def shingle_set(t):
    w = words(lower(t))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingle_set(r["text"]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * min(len(sets[i]), len(sets[j])) >= 75 * max(len(sets[i]), len(sets[j])):
                o = len(sets[i] & sets[j])
                if 100 * o >= 75 * (len(sets[i]) + len(sets[j]) - o):
                    root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            low[find(i)] = min(low.get(find(i), r["doc_id"]), r["doc_id"])
    return Counter((r["doc_id"], len(sets[i]), low.get(find(i)) if sets[i] else r["doc_id"]) for i, r in enumerate(rows))


def chained(spark):
    """Near copies that are linked only through others, groups that share a common passage, hubs with many spokes."""
    rng = np.random.default_rng(3)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(80)]
        for k in range(12):
            w = list(base)
            for j in range(k + 1):
                w[(7 * j + g) % 80] = f"x{k if g % 2 else 0}y{j}"
            rows.append(" ".join(w[: 80 - int(rng.integers(0, 4))] + (passage if g % 3 == 0 else [])))
    rows += [" ".join(passage + [f"u{i}v{j}" for j in range(i + 2)]) for i in range(25)]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


@pytest.mark.parametrize("which", ["odd", "table", "chained"])
def test_components(spark, which):
    from marketlake.llm.ngram_join import near_duplicates

    docs = {"odd": lambda: odd_docs(spark), "table": lambda: spark.read.parquet(f"{SF}/documents.parquet"), "chained": lambda: chained(spark)}[which]()
    got = Counter(map(tuple, near_duplicates(docs).collect()))
    assert got == brute(docs.collect())
    assert which != "chained" or len({k[2] for k in got}) < 60


def test_empty(spark):
    from marketlake.llm.ngram_join import near_duplicates

    assert near_duplicates(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_large_group_of_near_copies_takes_few_pairs(spark, monkeypatch):
    """Pairs that are verified grow with the copies, not with their square, and the group is one component."""
    from marketlake.llm import ngram_join

    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    rows = [" ".join(base)]
    for k in range(600):
        w = list(base)
        for j in rng.choice(120, int(rng.integers(1, 4)), replace=False):
            w[j] = f"x{k}y{j}"
        rows.append(" ".join(w))
    seen, old = [], ngram_join.verify
    monkeypatch.setattr(ngram_join, "verify", lambda pairs, nodes, percent: (seen.append(pairs.count()), old(pairs, nodes, percent))[1])
    out = ngram_join.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    assert {r["component_id"] for r in out} == {0}
    assert sum(seen) <= 20 * len(rows)


def test_codec():
    rng = np.random.default_rng(1)
    for n, high in ((0, 10), (1, 1 << 63), (1000, 1 << 63), (1000, 5000), (3, 4)):
        keys = np.unique(rng.integers(0, high, n, dtype=np.uint64))
        assert (exchange.decode(exchange.encode(keys)) == keys).all()


def test_required_matches_hold():
    """Whatever prefixes two similar sets choose, they share as many prefix shingles as the smaller choice asks for."""
    from marketlake.llm.ngram_join import best_matches

    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(4, 80))
        freq = rng.integers(2, 50, 400)
        base = rng.choice(300, n, replace=False)
        other = np.concatenate((base[: n - n // 9], 300 + rng.choice(100, n // 9, replace=False)))
        if len(np.intersect1d(base, other)) * 100 < 75 * len(np.union1d(base, other)):
            continue
        prefixes = []
        for s in (base, other):
            order = s[np.lexsort((s, freq[s]))]
            l, k = best_matches(len(s), freq[order], 75)
            prefixes.append((l, set(order[:k])))
        assert len(prefixes[0][1] & prefixes[1][1]) >= min(prefixes[0][0], prefixes[1][0])


def test_counts_round_trip():
    from marketlake.llm import exchange

    for counts in ([], [0], [1, 1, 2], [255, 256, 0], [1 << 40, 3], [(1 << 62) + 5]):
        counts = np.array(counts, np.int64)
        assert (exchange.decode_counts(exchange.encode_counts(counts)) == counts).all()
    assert len(exchange.encode_counts(np.ones(1000, np.int64))) == 1001
