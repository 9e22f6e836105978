"""The operators against plain-Python forms, on odd rows and on a small table."""

import hashlib
import re
import struct
import time
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marketlake.llm import queries
from tests.llm.helpers import SCHEMA, odd_docs, words

SF = "/root/testdata/sf0.001"


def docs_of(spark, which):
    return odd_docs(spark) if which == "odd" else spark.read.parquet(f"{SF}/documents.parquet")


def by_id(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["doc_id"]].append(r)
    return out


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("which", ["odd", "table"])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("bits", [256, 4])
def test_exact_dedup(spark, which, keep, bits):
    from marketlake.llm.exact_dedup import deduplicate, exact_dedup

    docs = docs_of(spark, which)
    rows = docs.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    want = Counter()
    for r in rows:
        ids = [x for x in groups[r["text"] or ""] if x is not None]
        keep_id = (min if keep == "smallest" else max)(ids) if ids else None
        want[r["doc_id"], keep_id, len(groups[r["text"] or ""]), r["doc_id"] == keep_id, hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, exact_dedup(docs, keep, bits=bits).collect())) == want
    if keep == "smallest" and bits == 256:
        got = deduplicate(docs)
        assert got.columns == docs.columns
        got = got.collect()
        assert Counter(r["text"] or "" for r in got) == Counter(dict.fromkeys(groups, 1))
        low = {t: min((x is None, x or 0) for x in ids) for t, ids in groups.items()}
        assert all((r["doc_id"] is None, r["doc_id"] or 0) == low[r["text"] or ""] for r in got) and set(got) <= set(rows)


def test_exact_dedup_runs_merge(spark, tmp_path):
    """Runs that come one after the other give the entries of one run; filters let no entry of two runs pass as final."""
    from marketlake.llm.exact_dedup import compact, flush, memtable, probe

    docs = docs_of(spark, "table")
    for part in (docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")):
        runs = flush(memtable(part, memtables=2), f"file://{tmp_path}/index")
    assert runs.select("run").distinct().count() == 4
    a = {tuple(r) for r in compact(runs).collect()}
    b = {tuple(r) for r in memtable(docs).select("digest", "keep_id", "ties", "n").collect()}
    assert a == b
    seen = defaultdict(list)
    for r in probe(runs).collect():
        seen[r["digest"]].append(r["hit"])
    assert all(all(h) for h in seen.values() if len(h) > 1)
    assert sum(h[0] for h in seen.values() if len(h) == 1) <= 0.4 * len(seen)  # three other filters of 16 bits an entry


def mixed(sizes, weights=(1, 2, 3)):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > 3 * sizes[s]]
        if not over:
            return target | {s: left * w[s] / total for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            free.discard(s)
        left = float(sum(sizes.values())) - sum(target.values())
    return target


@pytest.mark.parametrize("which", ["odd", "table"])
def test_mixing(spark, which):
    from marketlake.llm.mixing import mix_sources

    docs = docs_of(spark, which)
    rows = docs.collect()
    out = mix_sources(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((r["doc_id"], len(words(r["text"]))) for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
    target = mixed(dict(sizes))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] % max(r["size"], 1) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in taken:
        assert abs(taken[s] - target[s]) <= 3 * largest[s] if which == "odd" else abs(taken[s] - target[s]) <= largest[s]
    assert Counter(map(tuple, mix_sources(docs).collect())) == Counter(map(tuple, out))


def pieces(rows, path, room):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    out = Counter()
    for r in rows:
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        first = len(ids) % room or room
        cuts = [0, *range(first, len(ids) + 1, room)] if len(ids) > room else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out[r["doc_id"], k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    return out


@pytest.mark.parametrize("which,room", [("odd", 64), ("table", 2048)])
def test_packing(spark, which, room):
    from marketlake.llm.packing import pack

    docs = docs_of(spark, which)
    out = pack(docs, queries.tokenizer_path(), room).collect()
    assert Counter(tuple(r)[:5] for r in out) == pieces(docs.collect(), queries.tokenizer_path(), room)
    seqs = defaultdict(list)
    for r in out:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    total = sum(r["length"] for r in out)
    assert len(seqs) <= -(-total // room) * 1.05 + 1


def test_packing_plan_uses_every_piece():
    from marketlake.llm.packing import plan

    counts = {1: 7, 3: 2, 10: 5, 33: 11, 50: 4, 64: 3, 31: 9, 60: 1, 2: 2, 61: 3}
    used = Counter()
    for lengths, times in plan(counts, 64):
        assert sum(lengths) <= 64 and times > 0
        for n in lengths:
            used[n] += times
    assert used == Counter(counts)


def rules_of(url, rules):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(r), r, v) for v, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return (host, path, *max(fit)[1:]) if fit else (host, path, None, None)


ODD_URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/en/1?x#y", "https://x.org", "http://x.org?q=/", "a://b://c/d", "http://example.org/es/1", "http://badexample.org/es/1", "ftp://fr.com/fr/", "http://É.com/de/é\n/z#f", "http://h.com/" + "a/" * 500] * 2


@pytest.mark.parametrize("which", ["odd", "table"])
def test_url_filter_rules(spark, which):
    from marketlake.llm.url_filter import url_filter

    pages = spark.createDataFrame([(i, u, None, "x", 1) for i, u in enumerate(ODD_URLS)], "page_id long, url string, html string, host string, n int") if which == "odd" else spark.read.parquet(f"{SF}/pages.parquet")
    out = url_filter(pages, queries.RULES).collect()
    want = Counter((r["page_id"], *rules_of(r["url"], queries.RULES)[:3]) for r in pages.collect())
    assert Counter(tuple(r)[:4] for r in out) == want
    verdicts = {r["page_id"]: rules_of(r["url"], queries.RULES)[3] for r in pages.collect()}
    assert all(r["verdict"] in ("allow", "block") and verdicts[r["page_id"]] in (None, r["verdict"]) for r in out)


def test_url_filter_tree(spark):
    """Blocked branches are kept apart and spread to unlabelled pages of the same template."""
    from marketlake.llm.url_filter import url_filter

    urls = [f"http://h.com/spam/{i}" for i in range(60)] + [f"http://h.com/news/{i}" for i in range(60)]
    rules = [("block", f"h.com/spam/{i}") for i in range(1, 10)] + [("allow", f"h.com/news/{i}") for i in range(1, 10)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = {r["page_id"]: r for r in url_filter(pages, rules).collect()}
    assert out[0]["template"] == "/spam/*" and out[0]["verdict"] == "block" and out[0]["rule"] is None
    assert out[60]["template"] == "/news/*" and out[60]["verdict"] == "allow"


def test_url_filter_deep_paths_cost_no_rounds(spark):
    """Segments below which nothing can split are wildcards at once, however many there are; what splits at depth still does."""
    from marketlake.llm.url_filter import splitting_depth, templates, url_filter

    urls = [f"http://h.com/{i}/{i}x/spam/{i}" for i in range(30)] + [f"http://h.com/{i}/{i}x/news/{i}" for i in range(30)]
    urls += ["http://deep.com" + "/s" * 5000, "http://h.com" + "/t" * 5000, "http://deep.com"]
    rules = [("block", f"h.com/{i}/{i}x/spam") for i in range(1, 10)] + [("allow", f"h.com/{i}/{i}x/news") for i in range(1, 10)] + [("block", "deep.com/s/s")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    start = time.time()
    out = {r["page_id"]: r for r in url_filter(pages, rules).collect()}
    assert time.time() - start < 60
    assert out[0]["template"] == "/*/*/spam/*" and out[0]["verdict"] == "block" and out[30]["template"] == "/*/*/news/*" and out[30]["verdict"] == "allow"
    assert out[60]["template"] == "/*" * 5000 and out[60]["verdict"] == "block" and out[61]["template"] == "/*" * 5000 and out[62]["template"] == ""
    paths = spark.createDataFrame([("h", "/a/b/c", 4, 1, 0), ("h", "/a/b", 1, 1, 1), ("h", "/a/b/c/d", 9, 1, 0)], "host string, path string, n long, labelled long, blocked long")
    at = paths.withColumn("segs", F.filter(F.split("path", "/"), lambda s: s != ""))
    assert splitting_depth(at, 5) == 3 and splitting_depth(at.limit(0), 5) == 0 and templates(paths.limit(0)).count() == 0


PII = [
    "mail a.b@c.de. or x@y@z.org a@b.c_d@e.f a@b a@b. q@w-e.r-t.z", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.000255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 1 2 3",
    "+1 (743) 555-3824 +12 +1234567890123456 +4912345678.", "é😀 a@b.cd 😀+1 (743) 555-3824😀", "1" * 5000 + " 4111111111111111", "a." * 3000 + "@x.y", "x@" + "a." * 5000 + "b", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "Mr. John Smith called",
    "\x00a@b.c\n@d.e", "@@@ +++ ...", "5500 0055 5555 5559x+44 20 7946 0958(",
]
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for kind, p in PLAIN.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("which", ["pii", "odd", "table"])
def test_pii_base(spark, which):
    from marketlake.llm import pii

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(PII)], "doc_id long, text string") if which == "pii" else docs_of(spark, which)
    got = pii.find(docs)
    rows = by_id(got.select("doc_id", "base", "added", *[f"n_{k}" for k in pii.BASE]).collect())
    for r in docs.collect():
        want = base_spans(r["text"])
        x = rows[r["doc_id"]]
        assert want in [[tuple(s) for s in y["base"]] for y in x]
        assert all(s["kind"] in pii.ADDED for y in x for s in y["added"])
    if which == "pii":
        assert any(s["kind"] == "secret" for s in rows[8][0]["added"])


def test_pii_expectation_maximisation():
    from marketlake.llm.pii import expectation_maximisation

    good = [((1, 1, 0), 80), ((-1, -1, 0), 80), ((1, -1, 1), 10), ((-1, 1, -1), 10)]
    table, prior, post = expectation_maximisation(good)
    assert 0.3 < prior < 0.7 and post[1, 1, 0] > 0.9 and post[-1, -1, 0] < 0.1
    assert table[0][1][1] > table[0][1][0]
    assert expectation_maximisation([]) == ([], 0.5, {})


def test_redact(spark):
    from pyspark.sql import functions as F

    from marketlake.llm import pii

    docs = spark.createDataFrame([(1, "é mail a@b.cd now"), (2, None)], "doc_id long, text string")
    got = pii.find(docs).join(docs, "doc_id").select("doc_id", pii.redact(F.coalesce("text", F.lit("")), F.col("base")).alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in got} == {1: "é mail <EMAIL> now", 2: ""}


def rule_figures(text):
    w = words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>") if text else 0, len(lines) - len(set(lines)), len(hit), failed


@pytest.mark.parametrize("which", ["odd", "table"])
def test_quality_rules(spark, which):
    from marketlake.llm.quality_rules import RULES, quality_rules

    docs = docs_of(spark, which)
    out = quality_rules(docs)
    want = Counter((r["doc_id"], *rule_figures(r["text"])) for r in docs.collect())
    assert Counter(tuple(r)[:7] for r in out.collect()) == want
    assert out.where("base_failed AND kept").isEmpty()
    back = quality_rules(docs, order=[r.name for r in reversed(RULES)])
    assert Counter((r["doc_id"], r["kept"]) for r in out.collect()) == Counter((r["doc_id"], r["kept"]) for r in back.collect())
    if which == "table":
        labels = spark.read.parquet(f"{SF}/labels.parquet")
        good = labels.where("quality = 1").join(out, "doc_id")
        assert good.where("NOT kept AND NOT base_failed").count() <= 0.02 * good.count()


CHAT = [
    (1, 0, "user", "How do I sort?\nPlease help me."), (1, 1, "assistant", "> How do I SORT\nUse sort()."), (1, 2, "user", "And strings?"),
    (1, 3, "assistant", ">> how do i sort\n> Use sort().\n\nYes, the same."), (1, 4, "user", "> never said this\nok"), (1, 4, "user", "twin"), (None, 0, "user", "> How do I sort?"), (2, None, None, None), (2, 0, "user", None),
]


def test_chat(spark):
    from marketlake.llm.chat import format_chats

    out = {(r["conv_id"], r["turn"], r["text"]): r for r in format_chats(spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string")).collect()}
    assert len(out) == len(CHAT)
    assert out[1, 1, "Use sort()."]["parent_turn"] == 0
    assert out[1, 3, "Yes, the same."]["parent_turn"] == 1 and out[1, 3, "Yes, the same."]["linked"] == 2
    assert out[1, 2, "And strings?"]["parent_turn"] == 1  # no quote: the turn before
    assert out[1, 4, "ok"]["parent_turn"] == 3 and out[1, 4, "ok"]["linked"] == 0
    assert {r["root_turn"] for k, r in out.items() if k[0] == 1} == {0}
    assert out[1, 3, "Yes, the same."]["depth"] == 2
    assert out[1, 2, "And strings?"]["formatted"] == "<|user|>\nAnd strings?\n"


def test_chat_passages_gaps_and_branches(spark):
    """Quotes link whatever their line breaks, turns may have gaps, replies of siblings do not interleave, long branches come in parts."""
    from marketlake.llm.chat import conversations, format_chats

    rows = [(1, 0, "user", "hello there\nold friend. How are\nyou today?"), (1, 10, "a", "> hello\n> there old\n> friend.\nFine."), (1, 20, "user", "Next?"), (1, 30, "a", "> how are you\n> today\nStill fine."), (1, 5000, "user", "Bye")]
    rows += [(2, i * 3, "user", f"m{i}") for i in range(700)] + [(3, 0, "u", " " * 300_000 + "x" + "\n" * 1000)]
    got = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS level", "2 AS up"))
    out = {(r["conv_id"], r["turn"]): r for r in got.collect()}
    assert [out[1, t]["parent_turn"] for t in (0, 10, 20, 30, 5000)] == [None, 0, 10, 0, 30]
    assert [(out[1, t]["branch_turn"], out[1, t]["position"]) for t in (0, 10, 20, 30, 5000)] == [(0, 0), (0, 1), (0, 2), (30, 0), (30, 1)]
    assert out[2, 699 * 3]["depth"] == 699 and out[3, 0]["text"] == "x"
    convs = conversations(got).collect()
    one = {(r["branch_turn"], r["part"]): r for r in convs if r["conv_id"] == 1}
    assert one[0, 0]["turns"] == [0, 10, 20] and one[30, 0]["turns"] == [30, 5000] and one[30, 0]["parent_turn"] == 0
    assert one[30, 0]["text"] == "<|a|>\nStill fine.\n<|user|>\nBye\n"
    assert sorted((r["part"], len(r["turns"])) for r in convs if r["conv_id"] == 2) == [(0, 256), (1, 256), (2, 188)]


def test_long_texts_take_linear_time(spark):
    """A million blanks and 32,000 spans in one text."""
    import time

    from marketlake.llm import pii
    from marketlake.llm.mixing import mix_sources

    docs = spark.createDataFrame([(1, "a" + " " * 1_000_000 + "b", "s"), (2, "x@y.zz 1234567 " * 16_000, "s")], "doc_id long, text string, source string")
    t = time.time()
    assert {r["doc_id"]: r["size"] for r in mix_sources(docs).collect()} == {1: 2, 2: 32_000}
    assert time.time() - t < 60
    t = time.time()
    assert {r["doc_id"]: r["n_email"] for r in pii.find(docs).collect()} == {1: 0, 2: 16_000}
    assert time.time() - t < 90


def test_alike_branches_merge(spark):
    from marketlake.llm.url_filter import url_filter

    urls = [f"http://h.com/{'bad' if k < 2 else 'good'}{k}/{i}" for k in range(6) for i in range(40)]
    rules = [("block" if k < 2 else "allow", f"h.com/{'bad' if k < 2 else 'good'}{k}/{i}") for k in range(6) for i in range(1, 10)]
    out = {r["page_id"]: (r["template"], r["verdict"]) for r in url_filter(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert out[0] == out[40] == ("/~4/*", "block") and out[80][1] == "allow"


def test_empty_tables(spark, empty):
    from marketlake.llm import pii
    from marketlake.llm.chat import format_chats
    from marketlake.llm.exact_dedup import deduplicate, exact_dedup
    from marketlake.llm.mixing import mix_sources
    from marketlake.llm.packing import pack
    from marketlake.llm.quality_rules import quality_rules
    from marketlake.llm.url_filter import url_filter

    assert exact_dedup(empty).isEmpty() and deduplicate(empty).isEmpty() and mix_sources(empty).isEmpty()
    assert pack(empty, queries.tokenizer_path()).isEmpty() and pii.find(empty).isEmpty() and quality_rules(empty).isEmpty()
    assert url_filter(spark.createDataFrame([], "page_id long, url string"), queries.RULES).isEmpty()
    assert format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).isEmpty()


def test_values_without_two_digits_side_by_side(spark):
    from marketlake.llm import pii

    texts = ["token=aB3dE5fGhJ7kLmN9pQrSt", "token=aB3dE5fGhJ7kLmN9pQrSt 20", "ssn: 1-2-3-4-5-6-7", "ssn: 1-2-3-4-5-6-7 20"]
    rows = {r["doc_id"]: joined for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), least=0.001).collect() for joined in [[(x["kind"], x["s"], x["e"]) for x in r["added"]]]}
    assert rows[0] == rows[1][:1] == [("secret", 6, 27)] and rows[2] and rows[2][0][0] == "number"


def test_deep_branches_have_their_own_path(spark):
    from marketlake.llm.url_filter import url_filter

    rows = [(i, f"http://h.org/a/b/c/d/e/f/g/{'bad' if i % 2 else 'good'}/{i}") for i in range(80)] + [(100 + i, f"http://sub.org/a/b/c/d/e/f/g/bad/{i}") for i in range(3)]
    rules = [("block" if i % 2 else "allow", f"h.org/a/b/c/d/e/f/g/{'bad' if i % 2 else 'good'}/{i}") for i in range(60)]
    out = {r["page_id"]: (r["template"], r["verdict"]) for r in url_filter(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert out[71] == ("/*/*/*/*/*/*/*/bad/*", "block") and out[70] == ("/*/*/*/*/*/*/*/good/*", "allow")
