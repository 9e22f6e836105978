"""Language-model scores of whole texts by a causal self-attention model on subword ids.

What is gathered from the corpus covers all training documents: word counts (for the base score) by
the packed exchange, so that each block of documents is told the counts of its own words and no
vocabulary is collected; and, as vectors of fixed length added up in a tree, the counts of subwords
and of (previous subword's bucket, class).  Buckets and classes follow the full subword counts.  The
attention is trained on every training window: in each of ``ROUNDS`` rounds all units of at most about
``UNIT`` subwords train on the next part of their windows from the same weights, and the results,
weighted by their tokens, are added up in the same tree.

Defined results: null or empty text is its end alone; repeated rows are scored alike; a null id is
hashed as the empty string; without training documents all counts are 0; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm import attention, exchange
from marketlake.llm.common import blocks, materialize
from marketlake.llm.textops import chunks, words
from marketlake.llm.tokens import ids_of

#: Rounds of training; subwords of one unit; windows that a unit should take in all, and passes over its windows at most where it has fewer.
ROUNDS, UNIT, LEAST_WINDOWS, MOST_PASSES = 4, 1 << 20, 14_400, 8
#: Fixed point of weights that are added up.
FIXED = 1 << 16
#: Ids of the vocabulary, and the id that starts and ends a text.
VOCABULARY, EDGE = 50257, 50256
#: Vectors that one task adds up.
FAN_IN = 64
_EDGE = EDGE.to_bytes(4, "little")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def ids(path: str, text: str | None) -> np.ndarray:
    """Edge, ids of the text with A-Z lower-cased, edge."""
    low = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes fold A-Z only
    packed = ids_of(path).packed(low)
    return np.frombuffer(_EDGE + packed + _EDGE, "<i4")


def dealt(texts: list[bytes], most: int) -> Iterator[list[bytes]]:
    """Units of about one size, of about ``most`` subwords (2 bytes each) or fewer: a small rest would be passed over several times."""
    total, held, unit = sum(map(len, texts)) // 2, 0, []
    share = total / max(1, -(-total // most))
    for x in texts:
        unit.append(x)
        held += len(x) // 2
        if held >= share:
            yield unit
            unit, held = [], 0
    if unit:
        yield unit


def learn(units: DataFrame, sub: np.ndarray) -> tuple[attention.Net, np.ndarray, int]:
    """Trained attention, counts of (bucket, class) and number of tokens trained on; ``units``: block, ids, sizes; ``sub``: counts of subwords."""
    net, sc = attention.fresh(sub), units.sparkSession.sparkContext
    size = attention.BUCKETS * attention.CLASSES
    fixed = sc.broadcast((net.bucket, net.cls))

    def over_units(f) -> np.ndarray:
        """Sum of the int64 vectors that ``f`` gives for (ids, sizes) of each unit."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, block = None, 0
            for b in batches:
                for block, x, n in zip(b["block"].to_pylist(), b["ids"].to_pylist(), b["sizes"].to_pylist()):
                    one = f(np.frombuffer(x, "<u2").astype(np.int64), np.frombuffer(n, "<u4").astype(np.int64))
                    total = one if total is None else total + one
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([total.astype("<i8").tobytes()], pa.binary())], ["block", "data"])

        return add_vectors(units.mapInArrow(run, "block long, data binary"))

    def count(x: np.ndarray, n: np.ndarray) -> np.ndarray:
        bucket, cls = fixed.value
        return np.bincount(np.delete(bucket[x[:-1]] * attention.CLASSES + cls[x[1:]], np.cumsum(n)[:-1] - 1), minlength=size)

    pairs = over_units(count)
    if not len(pairs):
        return net, np.zeros(size, np.int64), 0
    names, seen = sorted(net.weights), 0
    for turn in range(ROUNDS):
        now = sc.broadcast((net.weights, bias_of(pairs)))

        def step(x: np.ndarray, n: np.ndarray, now=now, turn=turn) -> np.ndarray:
            weights, bias = now.value
            mine = attention.Net({k: v.copy() for k, v in weights.items()}, *fixed.value)
            r, many = np.random.default_rng(len(x)), int(attention.n_windows(n).sum())
            passes = min(MOST_PASSES, -(-LEAST_WINDOWS // many))
            order = np.array_split(np.concatenate([r.permutation(many) for _ in range(passes)]), ROUNDS)[turn]
            w = attention.windows_of(x, n, order)
            attention.train(mine, w, bias, order=np.arange(len(w)), part=(turn / ROUNDS, (turn + 1) / ROUNDS))
            tokens = int((w[:, 1:] >= 0).sum())
            flat = np.concatenate([mine.weights[k].ravel() for k in names]).astype(float)
            return np.concatenate(([tokens], np.rint(flat * FIXED * tokens))).astype(np.int64)

        told = over_units(step)
        if told[0]:
            flat, at = (told[1:] / (float(told[0]) * FIXED)).astype(np.float32), 0
            for k in names:
                v = net.weights[k]
                net.weights[k], at = flat[at : at + v.size].reshape(v.shape), at + v.size
        seen += int(told[0])
    return net, pairs, seen


def bias_of(pairs: np.ndarray) -> np.ndarray:
    """Log shares of classes after each bucket, smoothed towards the classes' overall shares."""
    n = pairs.reshape(attention.BUCKETS, attention.CLASSES).astype(float)
    overall = (n.sum(0) + 0.5) / (n.sum() + 0.5 * attention.CLASSES)
    return np.log((n + 20 * overall) / (n.sum(1, keepdims=True) + 20)).astype(np.float32)


def add_vectors(parts: DataFrame) -> np.ndarray:
    """Sum of rows (block, data: int64 vector) of one length, in a tree of tasks of at most FAN_IN rows."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, "<i8") for x in pdf["data"]], axis=0)
        return pd.DataFrame({"block": [pdf["block"].iloc[0] // FAN_IN], "data": [total.astype("<i8").tobytes()]})

    while True:
        parts = materialize(parts.groupBy(F.floor(F.col("block") / FAN_IN).alias("g")).applyInPandas(add, "block long, data binary"), "vectors")
        if parts.count() <= FAN_IN:
            rows = parts.collect()
            return np.sum([np.frombuffer(r["data"], "<i8") for r in rows], axis=0) if rows else np.zeros(0, np.int64)


def score(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    nb = blocks(docs, text)
    id_type = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("block", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(nb)).cast("int"))

    def gather(table: pa.Table) -> pa.Table:
        """Word counts of a block (0 for words of held-out documents alone), its subword counts as a row of shard -1, and the subwords of its training documents as units."""
        parts, block = [], table["block"][0].as_py()
        counts, kept = np.zeros(VOCABULARY, np.int64), []
        out = table["held_out"].to_pylist()
        for at, texts in chunks(range(table.num_rows), table["text"].to_pylist()):
            w = words(texts, True)
            learns = ~np.array([out[i] for i in at])
            parts.append(exchange.count_distinct([(w.hashes(), np.repeat(learns, w.counts).astype(np.int64))]))
            for x in (ids(path, t) for t, use in zip(texts, learns) if use):
                kept.append(x.astype("<u2").tobytes())
        keys, n = exchange.count_distinct(parts)
        rows_ = exchange.pack(block, keys, n, nb)
        for unit in dealt(sorted(kept), UNIT):  # in an order of their own, so that rounds repeat
            lens = np.array([len(u) // 2 for u in unit], "<u4")
            packed = b"".join(unit)
            counts += np.bincount(np.delete(np.frombuffer(packed, "<u2"), np.cumsum(lens) - lens), minlength=VOCABULARY)
            rows_.append({"block": block, "shard": -2, "ids": packed, "sizes": lens.tobytes()})
        rows_.append({"block": block, "shard": -1, "counts": counts.astype("<i8").tobytes()})
        return pa.Table.from_pylist(rows_, schema=pa.schema([("block", pa.int32()), ("shard", pa.int32()), *[(c, pa.binary()) for c in ("keys", "counts", "ids", "sizes")]]))

    sent = materialize(rows.groupBy("block").applyInArrow(gather, exchange.SENT + ", ids binary, sizes binary"), "lm-counts")
    sub = add_vectors(sent.where("shard = -1").select(F.col("block").cast("long").alias("block"), F.col("counts").alias("data")))
    sub = sub if len(sub) else np.zeros(VOCABULARY, np.int64)
    net, pairs, _ = learn(sent.where("ids IS NOT NULL").select("block", "ids", "sizes"), sub)
    by_word = sent.where("shard >= 0").drop("ids", "sizes")
    ends = rows.where("NOT held_out").count()
    r = exchange.sizes(by_word).first()
    distinct, total = r["n_keys"] + (ends > 0), r["n_counts"] + ends
    per_class = np.bincount(net.cls, sub + 0.5, minlength=attention.CLASSES)
    within = np.log((sub + 0.5) / per_class[net.cls])
    model = rows.sparkSession.sparkContext.broadcast((net, bias_of(pairs), within))
    least = math.log10(total + 0.1 * (distinct + 1)) if total else 0.0

    def receive(mine: pa.Table, told: pa.Table) -> pa.Table:
        net, bias, within = model.value
        n_tokens, n_known, base, scores, parts, hashes = [], [], [], [], [], []
        for _, texts in chunks(range(mine.num_rows), mine["text"].to_pylist()):
            w = words(texts, True)
            parts.append((texts, w.counts))
            hashes.append(w.hashes())
        keys, place = exchange.distinct(np.concatenate(hashes or [np.zeros(0, np.uint64)]))
        totals, at = exchange.marked(told, keys, nb)[1], 0
        del hashes
        logs = np.log10(totals + 0.1)
        for texts, counts in parts:
            n, mine_ = len(texts), place[at : at + counts.sum()]
            doc, c, at = np.repeat(np.arange(n), counts), totals.take(mine_), at + len(mine_)
            n_tokens.append(counts + 1)
            n_known.append(np.bincount(doc, c > 0, minlength=n).astype(np.int64) + (ends > 0))
            base.append(np.bincount(doc, logs.take(mine_), minlength=n) + math.log10(ends + 0.1) - (counts + 1) * least)
            x = [ids(path, t) for t in texts]
            inside = np.array([within[i[1:]].sum() for i in x])
            scores.append((attention.class_scores(net, bias, x) + inside) / math.log(10))
        cat = lambda p, t: pa.array(np.concatenate(p) if p else np.zeros(0), t)
        return pa.Table.from_arrays([mine["doc_id"], mine["held_out"], cat(n_tokens, pa.int64()), cat(n_known, pa.int64()), pa.array([total] * mine.num_rows, pa.int64()), cat(base, pa.float64()), cat(scores, pa.float64())], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").cogroup(exchange.add_up(by_word).groupBy("block")).applyInArrow(receive, schema)
