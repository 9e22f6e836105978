import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from marketlake.llm import attention, queries
from tests.llm.helpers import SCHEMA, odd_docs, words
from tests.llm.test_ngram_join import lower

SF = "/root/testdata/sf0.001"


def base(rows):
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter()
    for r in rows:
        if not out(r["doc_id"]):
            c.update([*words(lower(r["text"])), None])
    n, v = sum(c.values()), len(c)
    for r in rows:
        t = [*words(lower(r["text"])), None]
        yield r["doc_id"], out(r["doc_id"]), len(t), sum(c[x] > 0 for x in t), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)


@pytest.mark.parametrize("which", ["odd", "table"])
def test_scores(spark, which):
    from marketlake.llm.lm_scoring import score

    docs = odd_docs(spark) if which == "odd" else spark.read.parquet(f"{SF}/documents.parquet")
    out = score(docs, queries.tokenizer_path()).collect()
    want = defaultdict(list)
    for x in base(docs.collect()):
        want[x[0]].append(x)
    got = defaultdict(list)
    for r in out:
        got[r["doc_id"]].append(tuple(r)[:6])
        assert r["score"] < 0 and math.isfinite(r["score"])
    assert got.keys() == want.keys()
    for k in want:
        for a, b in zip(sorted(got[k]), sorted(want[k])):
            assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    if which == "table":  # held-out texts: better than subwords by their frequency alone
        from marketlake.llm.lm_scoring import ids

        path, rows = queries.tokenizer_path(), docs.collect()
        c = Counter(int(i) for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 10 for i in ids(path, r["text"])[1:])
        n = sum(c.values())
        plain = sum(math.log10((c[int(i)] + 0.5) / (n + 0.5 * 50257)) for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for i in ids(path, r["text"])[1:])
        ours = sum(r["score"] for r in out if r["held_out"])
        print("plain", plain, "ours", ours, "base", sum(r["base_score"] for r in out if r["held_out"]))
        assert ours > plain


def test_each_token_is_scored_once():
    """Windows of any length give what one pass over the text gives when nothing but the previous token matters."""
    net = attention.fresh(np.arange(300)[::-1])
    for k in net.weights:
        net.weights[k][:] = 0
    r = np.random.default_rng(0)
    bias = r.standard_normal((attention.BUCKETS, attention.CLASSES)).astype(np.float32)
    lp = attention.log_softmax(bias)
    texts = [r.integers(0, 300, n) for n in (1, 2, 47, 48, 49, 50, 64, 65, 80, 81, 82, 112, 113, 500)]
    want = [sum(lp[net.bucket[a], net.cls[b]] for a, b in zip(t, t[1:])) for t in texts]
    assert attention.class_scores(net, bias, texts, batch=3) == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_attention_is_causal_and_learns():
    r = np.random.default_rng(1)
    net = attention.fresh(np.ones(300))
    x = net.bucket[r.integers(0, 300, (4, 20))]
    y = x.copy()
    y[:, 12:] = 7
    assert np.allclose(attention.forward(net.weights, x)[0][:, :12], attention.forward(net.weights, y)[0][:, :12], atol=1e-5)
    assert np.allclose(attention.forward(net.weights, x, 5)[0], attention.forward(net.weights, x)[0][:, 5:], atol=1e-5)
    start = r.integers(0, 50, (400, 1))
    w = np.concatenate([np.tile(np.concatenate([start, r.integers(50, 60, (400, 1))], 1), (1, attention.WINDOW // 2)), start], 1)
    loss = attention.train(net, w, np.zeros((attention.BUCKETS, attention.CLASSES), np.float32), steps=200)
    assert np.mean(loss[-10:]) < 0.6 * loss[0]


def test_empty(spark):
    from marketlake.llm.lm_scoring import score

    assert score(spark.createDataFrame([], SCHEMA), queries.tokenizer_path()).isEmpty()


def test_context_and_classes_are_not_cut():
    """The score of the last token depends on a token 16 places before its own previous one, wherever a window begins; half of 128 classes are single ids."""
    net = attention.fresh(np.arange(300)[::-1])
    assert len(np.unique(net.cls)) > 64 and (np.bincount(net.cls) == 1).sum() >= 64
    r = np.random.default_rng(3)
    bias = np.zeros((attention.BUCKETS, attention.CLASSES), np.float32)
    for n in range(40, 140):
        x = r.integers(0, 250, n)
        y = x.copy()
        y[n - 17] = 299 - y[n - 17]
        last = [attention.class_scores(net, bias, [t])[0] - attention.class_scores(net, bias, [t[:-1]])[0] for t in (x, y)]
        assert last[0] != pytest.approx(last[1], abs=1e-6), n


def test_gradients():
    """Against differences of the loss."""
    net = attention.fresh(np.arange(300)[::-1])
    r = np.random.default_rng(4)
    w = {k: v.astype(float) for k, v in net.weights.items()}
    x, y = r.integers(0, 20, (3, 9)), r.integers(0, 128, (3, 9))
    live, bias = r.random((3, 9)) < 0.8, r.standard_normal((attention.BUCKETS, attention.CLASSES))
    _, g = attention.gradients(w, x, y, live, bias)
    for k, v in w.items():
        i = np.unravel_index(np.abs(g[k]).argmax(), v.shape)
        loss = []
        for d in (1e-3, -1e-3):
            v[i] += d
            loss.append(attention.gradients(w, x, y, live, bias)[0])
            v[i] -= d
        assert g[k][i] == pytest.approx((loss[0] - loss[1]) / 2e-3, rel=2e-2), k


def test_model_learns_from_all_training_documents(spark, monkeypatch, tmp_path):
    """900 documents: buckets, classes and training windows come from every document that is not held out."""
    from marketlake.llm import lm_scoring

    docs = spark.createDataFrame([(i, f"number {i} of many words") for i in range(900)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/docs")  # a size that Spark knows
    docs = spark.read.parquet(f"{tmp_path}/docs")
    told, counts = [], []
    learn, fresh = lm_scoring.learn, attention.fresh
    monkeypatch.setattr(lm_scoring, "learn", lambda *a: told.append(learn(*a)) or told[-1])
    monkeypatch.setattr(attention, "fresh", lambda c: counts.append(c) or fresh(c))
    path = queries.tokenizer_path()
    out = lm_scoring.score(docs, path).collect()
    n = sum(len(lm_scoring.ids(path, r["text"])) - 1 for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 10)
    assert len(out) == 900 and counts[0].sum() == n and told[0][1].sum() == n and told[0][2] >= n


def test_windows_hold_each_pair_once():
    sizes = np.array([2, 48, 49, 50, 97, 98, 200])
    w = attention.windows_of(np.arange(sizes.sum()), sizes)
    a, b = w[:, :-1].ravel(), w[:, 1:].ravel()
    ok = (a >= 0) & (b >= 0)
    ends = np.cumsum(sizes) - 1
    assert sorted(a[ok]) == [i for i in range(sizes.sum()) if i not in set(ends)] and (b[ok] == a[ok] + 1).all()


def test_logits_are_held_few_times():
    """Peak memory of a step and of scoring, in arrays of a batch's logits: no copies of live rows, blocks that stay near the cores."""
    net = attention.fresh(np.arange(300)[::-1])
    r = np.random.default_rng(5)
    x, y, live = r.integers(0, 20, (48, 48)).astype(np.int32), r.integers(0, 128, (48, 48)), r.random((48, 48)) < 0.9
    bias = np.zeros((attention.BUCKETS, attention.CLASSES), np.float32)
    texts = [r.integers(0, 300, 1000) for _ in range(100)]
    for most, f in ((4.3, lambda: attention.gradients(net.weights, x, y, live, bias)), (12, lambda: attention.class_scores(net, bias, texts))):
        tracemalloc.start()
        f()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * 48 * 48 * attention.CLASSES * 4


def test_units_are_of_one_size():
    """A rest of a block is no unit of its own, whose few windows are passed over several times."""
    from marketlake.llm.lm_scoring import dealt

    r = np.random.default_rng(6)
    for n in (0, 1, 7, 99, 101, 640):
        texts = [bytes(2 * k) for k in r.integers(2, 30, n)]
        units = list(dealt(texts, 1000))
        size = [sum(map(len, u)) // 2 for u in units]
        assert [x for u in units for x in u] == texts and len(units) == -(-sum(size) // 1000)
        assert max(size, default=0) <= min(size, default=0) + 30 * len(size)


def test_only_wanted_windows_are_built():
    sizes = np.array([2, 48, 49, 50, 97, 98, 200])
    ids, order = np.arange(sizes.sum()), np.array([9, 0, 3, 3, 12])
    assert (attention.windows_of(ids, sizes, order) == attention.windows_of(ids, sizes)[order]).all()


def test_rare_classes_cost_no_maxima():
    """Only the largest entries of log shares count, and logits too large for float32 keep their probabilities."""
    bias = attention.log_softmax(np.random.default_rng(7).standard_normal((attention.BUCKETS, attention.CLASSES)) * 6).astype(np.float32)
    assert np.abs(bias).max() > 20 and attention.reach(bias) < 5
    h, out, x, y = np.eye(3, 16, dtype=np.float32) * 20, np.ones((16, attention.CLASSES), np.float32) * 30, np.arange(3), np.arange(3)
    lp = attention.log_shares(h, out, x, y, bias, True)[0]
    assert lp == pytest.approx(bias[x, y], abs=1e-3)


def test_steep_attention():
    """Attention logits beyond float32's exponential: the same as in float64 from the definition."""
    r = np.random.default_rng(8)
    w = {k: v.astype(np.float32) * (20 if k in ("q", "k") else 1) for k, v in attention.fresh(np.ones(300)).weights.items()}
    x = r.integers(0, 300, (2, 20))
    e = (w["emb"][x] + w["pos"][:20]).astype(float)
    z = (e @ w["q"]) @ (e @ w["k"]).transpose(0, 2, 1) / 4
    assert np.abs(z).max() > 100
    a = np.exp(attention.log_softmax(np.where(np.tril(np.ones((20, 20), bool)), z, -np.inf)))
    h = e + np.tanh(a @ (e @ w["v"]) @ w["o"])
    assert np.allclose(attention.forward(w, x)[0], h, atol=1e-3)


def test_word_hashes():
    """The hash by its definition, and with a few arrays of 8 bytes a byte."""
    from marketlake.llm import textops

    texts = ["", " ", "A bc\n\nd  é", "x" * 300, "ab ab"]
    w = textops.words(texts, True)
    want = []
    for t in "\n".join(texts).lower().split():
        b, mask = t.encode(), (1 << 64) - 1
        v = sum(int(textops._CODE[c]) * pow(int(textops._BASE), i + 1, 1 << 64) for i, c in enumerate(b)) + len(b)
        want.append(int(textops.mix(np.array([v & mask], np.uint64))[0]))
    assert w.hashes().tolist() == want and want[-1] == want[-2]
    w = textops.words(["some words here " * 20_000], True)
    w.hashes()
    tracemalloc.start()
    w.hashes()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 26 * len(w.raw)


def test_distinct_keys():
    from marketlake.llm import exchange

    for n in (0, 1, 500):
        x = np.random.default_rng(n).integers(0, 90, n).astype(np.uint64)
        keys, place = exchange.distinct(x)
        assert (keys == np.unique(x)).all() and (keys[place] == x).all()
