"""Whitening, licence scans and cross-tokenizer alignment against plain forms."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from marketlake.llm import alignment, licenses, queries, whitening
from tests.llm.helpers import SCHEMA, odd_docs

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def docs_of(spark, which):
    return odd_docs(spark) if which == "odd" else spark.read.parquet(f"{SF}/documents.parquet")


# whitening


def plain_whitening(vectors, k=32):
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    dev = [int(t) for t in ((n * x - s) ** 2).sum(axis=1)]
    c = ((n * x - s) / n).astype(float)
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, dev, e, (c @ v) / np.sqrt(e), e / np.trace(c.T @ c / n)


def held(got, vectors, k):
    n, dev, e, w, explained = plain_whitening(vectors, k)
    k = len(e)
    assert len(got) == n * k
    by = defaultdict(dict)
    for r in got:
        by[r["vec_id"]][r["component"]] = r
    for c in range(1, k + 1):
        mine = np.array([by[i][c]["whitened"] for i in sorted(by)])
        sign = np.sign(mine @ w[:, c - 1])
        assert np.abs(mine * sign - w[:, c - 1]).max() < 1e-6
        assert all(abs(by[i][c]["explained"] - explained[c - 1]) <= 1e-9 for i in by)
    assert [by[i][1]["deviation"] for i in sorted(by)] == dev
    assert {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-8 and len({r["identity_error"] for r in got}) == 1


@pytest.mark.parametrize("k", [32, 3])
def test_whitening_table(spark, k):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = [r["embedding"] for r in table.orderBy("vec_id").collect()]
    got = whitening.whiten(table, k).collect() if k != 32 else queries.op11_whitening(spark, SF).collect()
    held(got, vectors, k)


def test_whitening_odd_rows(spark):
    rng = random.Random(3)
    good = [[rng.gauss(0, s) for s in (1, 2, 50, 0.3)] for _ in range(200)]
    rows = [(i, v, 1, "x") for i, v in enumerate(good)]
    rows += [(900, None, 1, "x"), (901, [1.0, None, 2.0, 3.0], 1, "x"), (902, [1.0, float("nan"), 2.0, 3.0], 1, "x"), (903, [math.inf, 0.0, 0.0, 0.0], 1, "x"), (904, [None, None, None, None], 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int, whitened string").repartition(5)
    held(whitening.whiten(df).collect(), good, 32)
    # repeated rows and null ids count; short vectors count as 0 where they end
    more = spark.createDataFrame([(None, good[0], 1, "x"), (5, good[5], 1, "x"), (7, [], 1, "x"), (7, good[7][:2], 1, "x")], df.schema)
    got = whitening.whiten(df.unionByName(more)).collect()
    assert len(got) == 4 * 204 and sum(r["vec_id"] is None for r in got) == 4 and {r["n"] for r in got} == {204}
    assert whitening.whiten(df.limit(0)).collect() == [] and whitening.whiten(df.limit(0)).columns == whitening.whiten(df).columns


def test_whitening_dependent_and_constant_columns(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-500, 500, (300, 3))
    x = np.column_stack([base, base[:, 0] + base[:, 1], np.full(300, 7), base[:, 2] * 3]) / 64
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id int, embedding array<float>")
    got = whitening.whiten(df).collect()
    assert {r["component"] for r in got if r["whitened"] is not None} == {1, 2, 3} and {r["component"] for r in got} == set(range(1, 7))
    assert got[0]["identity_error"] < 1e-8
    w = np.zeros((300, 3))
    for r in got:
        if r["component"] <= 3:
            w[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(np.cov(w.T, bias=True) - np.eye(3)).max() < 1e-8
    one = spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id int, embedding array<float>")
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in whitening.whiten(one).collect()] == [(0, None, None, None)] * 6
    wide = spark.createDataFrame([(i, [1e300 * (-1) ** i, float(i)]) for i in range(6)], "vec_id int, embedding array<double>")
    assert all(r["deviation"] is None and r["n"] == 6 for r in whitening.whiten(wide).collect())


# licences


def plain_words(t):
    return WORD.findall((t or "").translate(FOLD))


@pytest.mark.parametrize("which", ["odd", "table"])
def test_licenses_base(spark, which):
    docs = docs_of(spark, which)
    if which == "odd":
        extra = ["CC BY cc by-NC", "x\ncc\n\nby general Public LICENSE all rights reserved", "éCC by", "allrights reserved all rights", "w " * 7000 + "all rights reserved " * 300]
        docs = docs.unionByName(spark.createDataFrame([(1000 + i, t, None, None, 1, "d", 1, 1, "t") for i, t in enumerate(extra)], SCHEMA))
    want = Counter()
    for r in docs.collect():
        w = plain_words(r["text"])
        places = [(i, label) for p, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in places]
        want[r["doc_id"], len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))] += 1
    got = licenses.scan_licenses(docs) if which == "odd" else queries.op12_licenses(spark, SF)
    rows = got.collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows) == want
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) for r in rows)
    assert licenses.scan_licenses(docs.limit(0)).collect() == []


def test_automaton_gives_matching_statistics():
    rng = random.Random(7)
    for _ in range(60):
        templates = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(3)]
        text = [rng.randrange(4) for _ in range(30)]
        a = licenses.Automaton(templates)
        for i, (length, state) in enumerate(a.statistics(text)):
            inside = lambda n: {(k, e) for k, t in enumerate(templates) for e in range(n, len(t) + 1) if t[e - n : e] == text[i + 1 - n : i + 1]}
            best = max((n for n in range(i + 2) if n == 0 or inside(n)), default=0)
            assert length == best and (not length or set(a.ends[state]) == inside(length))


def test_license_spans(spark):
    mit = next(t for k, t in licenses.TEMPLATES if k == "mit" and len(t) > 100)
    gap = mit.replace("including without limitation", "including some words that nobody knows without limitation").replace("furnished", "supplied").upper()
    apache = next(t for k, t in licenses.TEMPLATES if k == "apache-2.0" and len(t) > 100)
    texts = [
        ("prose of an old house and the software of the day " * 5, "", 0),
        (f"Intro words.\n{mit}\nTail", "mit", 1),
        (gap, "mit", 0.8),
        (mit[: len(mit) // 2], "", 0),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0", 1),
        ("licensed under the gnu general public license version 2", "gpl,gpl-2.0", 1),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0", 1),
        (f"{apache} zzz {mit} All rights reserved.", "apache-2.0,mit,reserved", 1),
        (f"{mit} " * 200, "mit", 1),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(texts)], "doc_id int, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(df).collect()}
    for i, (_, labels, least) in enumerate(texts):
        assert got[i]["labels"] == labels and got[i]["score"] >= least and (least or got[i]["score"] == 0), (i, got[i])
    n = len(plain_words(mit))
    assert [(s["first_word"], s["end_word"]) for s in got[1]["spans"]] == [(2, 2 + n)]
    assert [(s["first_word"], s["end_word"]) for s in got[8]["spans"]] == [(k * n, (k + 1) * n) for k in range(200)]


# alignment


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a_of = Tokenizer.from_file(queries.tokenizer_path())
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    from marketlake.llm.tokens import _byte_of

    byte = _byte_of()
    count, docs = Counter(), []
    for doc_id, text in rows:
        a = b = []
        if text:
            got = a_of.encode(" " + text, add_special_tokens=False)
            a = [(i, len(bytes(byte[c] for c in t)), bytes(byte[c] for c in t)) for i, t in zip(got.ids, got.tokens)]
            pieces = [(i, b_of.id_to_piece(i)) for i in b_of.encode(text)]
            b = [(i, 0, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()) for i, p in pieces]
            raw = (" " + text).encode()
            if b"".join(x[2] for x in a) != raw or b"".join(x[2] for x in b) != raw:
                a = b = []
        ends = []
        for side in (a, b):
            at, e = 0, []
            for x in side:
                at += len(x[2])
                e.append(at)
            ends.append(e)
        shared = sorted(set(ends[0]) & set(ends[1]))
        said, low = [], 0
        for s in shared:
            said.append(",".join(str(x[0]) for x, e in zip(a, ends[0]) if low < e <= s) + "|" + ",".join(str(x[0]) for x, e in zip(b, ends[1]) if low < e <= s))
            low = s
        links, i = [], 0
        for x, e in zip(a, ends[0]):
            for y, f in zip(b, ends[1]):
                if e - len(x[2]) < f and f - len(y[2]) < e:
                    links.append((x[0], y[0]))
        count.update(links)
        docs.append((doc_id, len(a), len(b), len(shared), links, hashlib.sha256(";".join(said).encode()).hexdigest() if a else ""))
    top = defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return Counter((d, na, nb, ng, len(k), sum(count[p] == top[p[1]] for p in k), sum(count[p] for p in k), sha) for d, na, nb, ng, k, sha in docs)


@pytest.mark.parametrize("which", ["odd", "table"])
def test_alignment(spark, which):
    docs = docs_of(spark, which)
    if which == "odd":
        extra = ["a▁b", "a  b\t c\r\n", " lead", "trail ", "<s> <unk> <0x41> <|endoftext|>", "日本語 テキスト 🙂🙂", "don't  we'll\n\n\nx", "\x00 odd 　 ｆｕｌｌ", "ab" * 300, "1234567 89"]
        docs = docs.unionByName(spark.createDataFrame([(1000 + i, t, None, None, 1, "d", 1, 1, "t") for i, t in enumerate(extra)], SCHEMA))
        docs = docs.where("text IS NULL OR length(text) < 5000").repartition(3)
    else:
        docs = docs.where("length(text) < 3000")
    want = brute_alignment([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    got = alignment.align(docs, queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model"))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == want


def test_alignment_blocks_agree(spark, monkeypatch):
    """Small blocks and an empty memory of windows give the same rows; groups as text have the digest; an empty table is empty."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    paths = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")
    whole = Counter(map(tuple, queries.op13_alignment(spark, SF).collect()))
    said = alignment.align(docs.repartition(7), *paths, said=True).collect()
    assert Counter(tuple(r)[:8] for r in said) == whole and all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in said)
    texts = [r["text"] or "" for r in docs.limit(40).collect()]
    few, many = alignment.Aligner(*paths, most=5), alignment.Aligner(*paths)
    parts = [few.block([t], True) for t in texts]
    all_ = many.block(texts, True)
    assert [p["groups"][0] for p in parts] == all_["groups"] and sum((Counter(dict(zip(p["codes"].tolist(), p["counts"].tolist()))) for p in parts), Counter()) == Counter(dict(zip(all_["codes"].tolist(), all_["counts"].tolist())))
    assert alignment.align(docs.limit(0), *paths).collect() == []
