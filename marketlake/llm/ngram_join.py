"""Self-join of documents on the Jaccard similarity of their word shingles, by adaptive multi-match prefixes.

1. Document frequencies of all shingles are counted by the packed exchange (:mod:`exchange`): each
   block of documents learns which of its shingles occur in another document too, and how often.  A
   document with partners shares at least ``threshold`` of its shingles, so all other documents are
   done here, and only shared shingles of the rest are kept.
2. Documents with equal sets are one node; frequencies are counted again among the nodes left.
3. A node's shingles are ordered by frequency, rarest first.  With prefix n - ceil(t n) + l, two
   similar nodes share at least l prefix shingles, l being the smaller of the two.  Each node takes
   the l with the least estimated cost: candidates its prefix meets, and verifications, of which a
   longer prefix with more required matches leaves fewer.
4. In rounds each prefix shingle has hubs.  In the first round this is its most
   central node (whose shingles are the most frequent on average), later that of its largest component
   and that of all its other components; every second round hubs are drawn by hash.  Nodes of other components are verified
   against the hubs, and the components are joined.  A group of near copies mostly ends in one round,
   at a few pairs a copy.  Rounds end when the postings of shingles in several components hardly shrink.
5. Then only nodes of different components that share a prefix shingle are paired, one of them outside
   the shingle's largest component, and only pairs with enough matches are verified, so no link between
   different components is lost.  Parity sketches of the sets bound the size of their difference from
   below, so most pairs that are not similar end inside the join.  Of all links between two components
   one is kept.

Frequencies use 48 bits of the hash (a clash can only make a shingle look less rare); sets are
compared by 64-bit hashes.

Defined results: null or empty text has an empty set and is linked with nothing; a text shorter than
the shingle is one shingle; repeated ids are rows of one document table and all stay; a null id takes
part in links, and its component is the smallest id there is in it (null if none); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import exchange
from marketlake.llm.common import Scratch, blocks, materialize
from marketlake.llm.components import components
from marketlake.llm.textops import chunks, mix, shingle_sets

_CUT = np.uint64(16)
#: Largest number of required matches that is considered.
MOST_MATCHES = 8
#: Share of the open postings that a round must leave at most, so that another one follows.
SHRINK = 0.9
#: 64-bit words of a parity sketch.
SKETCH_WORDS = 8
#: Cost of verifying a pair against that of making one.
VERIFY_COST = 4.0


def _need(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    return -(-n * percent // 100)


def shared_sets(docs: DataFrame, n_words: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """One row per document: ``doc_id, n, node`` (fingerprint of the set), ``shared`` and ``freqs`` (null unless it can have partners)."""
    nb = blocks(docs, text)
    id_type = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(nb)).cast("int"))

    def sets_of(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
        return [shingle_sets(texts, n_words) for _, texts in chunks(range(table.num_rows), table["text"].to_pylist())]

    def send(table: pa.Table) -> pa.Table:
        keys, counts = exchange.count_distinct([(h >> _CUT, None) for _, h in sets_of(table)])
        return pa.Table.from_pylist(exchange.pack(table["block"][0].as_py(), keys, counts, nb, 48), schema=pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))

    known = exchange.add_up(rows.groupBy("block").applyInArrow(send, exchange.SENT), least=2)

    def receive(mine: pa.Table, told: pa.Table) -> pa.Table:
        sets = sets_of(mine)
        keys, totals = exchange.answers(told, np.unique(np.concatenate([h >> _CUT for _, h in sets] or [np.zeros(0, np.uint64)])), nb, 48)
        n_, node, shared, freqs = [], [], [], []
        for off, h in sets:
            df = exchange.find(keys, totals, h >> _CUT)
            with np.errstate(over="ignore"):
                m1, m2 = mix(h ^ np.uint64(0xA5A5A5A5)), mix(h + np.uint64(0x1234567))
            for a, b in zip(off[:-1], off[1:]):
                n = int(b - a)
                n_.append(n)
                node.append((int(m1[a:b].sum(dtype=np.uint64)).to_bytes(8, "big") + int(m2[a:b].sum(dtype=np.uint64)).to_bytes(8, "big")) if n else None)
                held = df[a:b] >= 2
                ok = n and int(held.sum()) >= _need(n, percent)
                shared.append(h[a:b][held].tobytes() if ok else None)
                freqs.append(df[a:b][held].astype("<u4").tobytes() if ok else None)
        return pa.Table.from_arrays([mine["doc_id"], pa.array(n_, pa.int64()), pa.array(node, pa.binary()), pa.array(shared, pa.binary()), pa.array(freqs, pa.binary())], ["doc_id", "n", "node", "shared", "freqs"])

    got = rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(receive, f"doc_id {id_type}, n long, node binary, shared binary, freqs binary")
    return got


def recount(nodes: DataFrame, percent: int) -> DataFrame:
    """``nodes`` with ``shared`` and ``freqs`` counted among the nodes themselves; nodes that can have no partner there are left out.

    Copies are one node and documents without partners are gone, so frequencies only fall.
    """
    nb = blocks(nodes, "shared")
    rows = nodes.select("node", "n", "shared").withColumn("block", F.pmod(F.xxhash64("node"), F.lit(nb)).cast("int"))

    def send(table: pa.Table) -> pa.Table:
        keys, counts = exchange.count_distinct([(np.unique(np.frombuffer(x, "<u8") >> _CUT), None) for x in table["shared"].to_pylist()])
        return pa.Table.from_pylist(exchange.pack(table["block"][0].as_py(), keys, counts, nb, 48), schema=pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))

    known = exchange.add_up(rows.groupBy("block").applyInArrow(send, exchange.SENT), least=2)

    def receive(mine: pa.Table, told: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, "<u8") for x in mine["shared"].to_pylist()]
        keys, totals = exchange.answers(told, np.unique(np.concatenate(sets or [np.zeros(0, np.uint64)]) >> _CUT), nb, 48)
        at, shared, freqs = [], [], []
        for i, (n, h) in enumerate(zip(mine["n"].to_pylist(), sets)):
            df = exchange.find(keys, totals, h >> _CUT)
            held = df >= 2
            if int(held.sum()) >= _need(n, percent):
                at.append(i)
                shared.append(h[held].tobytes())
                freqs.append(df[held].astype("<u4").tobytes())
        at = pa.array(at, pa.int64())
        return pa.Table.from_arrays([mine["node"].take(at), mine["n"].take(at), pa.array(shared, pa.binary()), pa.array(freqs, pa.binary())], ["node", "n", "shared", "freqs"])

    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(receive, "node binary, n long, shared binary, freqs binary")


def best_matches(n: int, freqs: np.ndarray, percent: int, most: int = MOST_MATCHES) -> tuple[int, int]:
    """(required matches, shared shingles in the prefix) with the least estimated cost; ``freqs`` ascend."""
    own = n - len(freqs)
    met = np.concatenate(([0], np.cumsum(freqs.astype(np.float64) - 1)))
    best = None
    for l in range(1, min(most, _need(n, percent)) + 1):
        k = min(len(freqs), max(0, n - _need(n, percent) + l - own))
        cost = met[k] * (1 + VERIFY_COST / l)
        if best is None or cost < best[0]:
            best = (cost, l, k)
    return best[1], best[2]


def postings(nodes: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, l, left, weight) for the prefix shingles of each node.

    ``left``: shingles of the set from this one on, in the common order; ``weight``: mean frequency of the set's shingles.
    """

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens, at, ls, left, weight = [], [], [], [], []
            for i, (n, shared, freqs) in enumerate(zip(b["n"].to_pylist(), b["shared"].to_pylist(), b["freqs"].to_pylist())):
                h, df = np.frombuffer(shared, "<u8"), np.frombuffer(freqs, "<u4")
                order = np.lexsort((h, df))
                l, k = best_matches(n, df[order], percent)
                tokens.append(h[order[:k]].view("<i8"))
                at.append(np.full(k, i))
                ls.append(np.full(k, l))
                left.append(len(h) - np.arange(k))
                weight.append(np.full(k, df.sum(dtype=float) / n))
            if tokens:
                at_ = pa.array(np.concatenate(at))
                cat = [pa.array(np.concatenate(x).astype(t)) for x, t in ((ls, np.int32), (left, np.int64), (weight, np.float64))]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), b["node"].take(at_), b["n"].take(at_), *cat], ["token", "node", "n", "l", "left", "weight"])

    return nodes.mapInArrow(prefixes, "token long, node binary, n long, l int, left long, weight double")


def sketches(nodes: DataFrame) -> DataFrame:
    """(node, own, w0, w1, ..): shingles no other node has, and the parity of the number of shared shingles that fall on each bit."""
    bits = 64 * SKETCH_WORDS

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, words = np.zeros(b.num_rows, np.int64), np.zeros((b.num_rows, SKETCH_WORDS), np.int64)
            for i, (n, shared) in enumerate(zip(b["n"].to_pylist(), b["shared"].to_pylist())):
                h = np.frombuffer(shared, "<u8")
                odd = np.bincount((mix(h) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
                own[i], words[i] = n - len(h), np.packbits(odd.astype(np.uint8)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["node"], pa.array(own), *[pa.array(words[:, j]) for j in range(SKETCH_WORDS)]], ["node", "own", *[f"w{j}" for j in range(SKETCH_WORDS)]])

    return nodes.mapInArrow(fold, "node binary, own long, " + ", ".join(f"w{j} long" for j in range(SKETCH_WORDS)))


def _may_link(percent: int) -> str:
    """Sketch filter: two sets differ in at least their own shingles and the bits in which their sketches differ."""
    differ = " + ".join(f"bit_count(w{j}_a ^ w{j}_b)" for j in range(SKETCH_WORDS))
    return f"{100 + percent} * (own_a + own_b + {differ}) <= {100 - percent} * (n_a + n_b)"


def verify(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, ca, cb) whose sets are similar; ca and cb are their components."""
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("s_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("s_b"))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            n_a, n_b = b["n_a"].to_pylist(), b["n_b"].to_pylist()
            for i in range(b.num_rows):
                x, y = np.frombuffer(b["s_a"][i].as_py(), "<u8"), np.frombuffer(b["s_b"][i].as_py(), "<u8")
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                o = int((y[at] == x).sum())
                keep.append(100 * o >= percent * (n_a[i] + n_b[i] - o))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b["ca"].filter(mask), b["cb"].filter(mask)], ["ca", "cb"])

    both = pairs.select("a", "b", "ca", "cb").join(one, "a").join(two, "b").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    return both.select("ca", "cb", "n_a", "n_b", "s_a", "s_b").mapInArrow(similar, "ca binary, cb binary").distinct()


def _can_reach(n_a: str, n_b: str, left_a: str, left_b: str, l_a: str, l_b: str, percent: int) -> str:
    """Position filter: from one of the first ``l`` common shingles on, enough shingles are left in both sets for the overlap that is needed."""
    return f"{100 + percent} * (least({left_a}, {left_b}) + least({l_a}, {l_b}) - 1) >= {percent} * ({n_a} + {n_b})"


def _by_component(live: DataFrame, turn: int) -> DataFrame:
    """(token, component, best, rank, c): the component's node that can be the token's hub in this round, and how many nodes it has there."""
    rank = F.struct("weight", "node") if turn % 2 == 0 else F.struct(F.xxhash64("node", F.lit(turn)).cast("double").alias("weight"), F.col("node"))
    node = F.struct("node", "n", "l", "left", "component")
    return live.groupBy("token", "component").agg(F.max_by(node, rank).alias("best"), F.max(rank).alias("rank"), F.count(F.lit(1)).alias("c"))


def _main(per: DataFrame) -> DataFrame:
    """(token, main): the component with the most of the token's nodes."""
    return per.groupBy("token").agg(F.max(F.struct("c", "rank", "component"))["component"].alias("main"))


def _pairs_with_hubs(live: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b, ca, cb) of nodes with the hubs of their prefix shingles; in the first round each node is a component, so one hub does."""
    if turn == 0:
        hubs = live.groupBy("token").agg(F.max_by(F.struct("node", "n", "l", "left", "component"), F.struct("weight", "node")).alias("hub"))
    else:
        per = _by_component(live, turn)
        hubs = per.join(_main(per), "token").groupBy("token", (F.col("component") == F.col("main")).alias("in_main")).agg(F.max_by("best", "rank").alias("hub")).drop("in_main")
    spokes = live.drop("weight").join(hubs, "token").where("component <> hub.component").where(_can_reach("n", "hub.n", "left", "hub.left", "l", "hub.l", percent))
    first = F.col("node") < F.col("hub.node")
    side = lambda x, y: F.when(first, x).otherwise(y)
    n, h, c, hc = (F.col(x) for x in ("node", "hub.node", "component", "hub.component"))
    return spokes.select(side(n, h).alias("a"), side(h, n).alias("b"), side(c, hc).alias("ca"), side(hc, c).alias("cb")).distinct()


def _pairs_left(live: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b, ca, cb) of nodes of different components with enough matches, one of them outside the shingle's largest component."""
    live = live.join(_main(_by_component(live, 0)), "token").withColumn("minor", F.col("component") != F.col("main")).drop("main", "weight")
    held = [c for c in live.columns if c != "token"]
    one, two = (x.select("token", *[F.col(c).alias(f"{c}_{side}") for c in held]) for x, side in ((live.where("minor"), "a"), (live, "b")))
    pairs = one.join(two, "token").where("component_a <> component_b AND (NOT minor_b OR node_a < node_b)")
    pairs = pairs.where(_can_reach("n_a", "n_b", "left_a", "left_b", "l_a", "l_b", percent)).where(_may_link(percent))
    first = F.col("node_a") < F.col("node_b")
    side = lambda c: [F.when(first, F.col(f"{c}_a")).otherwise(F.col(f"{c}_b")), F.when(first, F.col(f"{c}_b")).otherwise(F.col(f"{c}_a"))]
    (a, b), (ca, cb) = side("node"), side("component")
    pairs = pairs.groupBy(a.alias("a"), b.alias("b"), ca.alias("ca"), cb.alias("cb")).agg(F.count(F.lit(1)).alias("matches"), F.min(F.least("l_a", "l_b")).alias("least"))
    return pairs.where("matches >= least")


def near_duplicates(docs: DataFrame, n_words: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (smallest id reachable by links, itself included)."""
    with Scratch(docs.sparkSession) as scratch:
        return materialize(_joined(docs, scratch, n_words, percent, doc_id, text), "components-of-documents")


def _joined(docs: DataFrame, scratch: Scratch, n_words: int, percent: int, doc_id: str, text: str) -> DataFrame:
    sets = scratch.table(shared_sets(docs, n_words, percent, doc_id, text), "sets")
    nodes = sets.where("shared IS NOT NULL").groupBy("node").agg(F.first("n").alias("n"), F.first("shared").alias("shared"), F.first("freqs").alias("freqs"))
    nodes = scratch.table(recount(scratch.table(nodes, "nodes"), percent), "nodes")
    live = scratch.table(postings(nodes, percent).withColumn("component", F.col("node")), "postings")
    links, turn, held, left = None, 0, math.inf, live.count()
    while left and left <= SHRINK * held:
        found = scratch.table(verify(_pairs_with_hubs(live, turn, percent), nodes, percent), "links")
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        step = components(found, "ca", "cb").select(F.col("node").alias("component"), F.col("component").alias("now"))
        live = live.join(step, "component", "left").withColumn("component", F.coalesce("now", "component")).drop("now")
        live = scratch.table(live, "postings")
        # what is left: shingles that nodes of different components share
        open_ = live.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
        live = scratch.table(live.join(open_, "token"), "postings")
        turn, held, left = turn + 1, left, live.count()
    live = scratch.table(live.join(sketches(nodes.join(live.select("node").distinct(), "node", "left_semi")), "node"), "postings")
    last = scratch.table(verify(_pairs_left(live, percent), nodes, percent), "links")
    links = last if links is None else links.unionByName(last)
    group = components(links, "ca", "cb")
    classes = sets.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("m")).join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = scratch.table(classes, "classes")
    low = classes.groupBy("component").agg(F.min("m").alias("component_id"))
    of_node = classes.join(low, "component").select("node", "component_id")
    full = sets.where("node IS NOT NULL").select("doc_id", "n", "node").join(of_node, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(sets.where("node IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
