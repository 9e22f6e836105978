"""Alignment of two tokenizers' tokens over whole documents.

A text is tokenised as a whole by both.  Token byte lengths give the offsets where tokens begin; an offset
where both have a token that begins with a space is an anchor, and anchors cut a document into windows
of token ids.  Windows repeat (most are one word), so a worker keeps the alignment of each window by its
ids: the groups between shared ends, and the linked id pairs.

How often a pair of ids is linked in the whole corpus is counted by Spark: each block of texts (about
``BLOCK`` characters) sends its distinct pairs with their counts, an aggregation adds them up, and each
block receives the totals of the pairs that it sent.  Documents keep their pairs as numbers within their
block meanwhile, so a pair that is everywhere costs one row a block, and no table meets in the driver.

Defined results: null and empty texts, and texts whose joined token bytes are not space and text, have no
tokens (zeros, empty digest); repeated rows and null ids are rows of their own and all count; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as Over
from pyspark.sql import functions as F

from marketlake.llm.common import materialize
from marketlake.llm.exchange import decode_counts, encode_counts
from marketlake.llm.textops import chunks, mix
from marketlake.llm.tokens import ids_of

#: Windows kept by each worker process, in two generations: a full one becomes the old one, and what is asked for again moves to the new one.
CACHE_WINDOWS = 200_000
#: A pair's code is the B id times this plus the A id.
WIDE = 1 << 32


#: Groups as text, their number, and the codes of the linked pairs.
Window = tuple[str, int, bytes]


def spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (n[0] of them), then those of begin[1], and so on."""
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


def numbered(ids: list[np.ndarray], cut: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(first window of each number, number of each window): windows have one number when their ids are the same for both.

    Windows are grouped by a hash of their ids, and each is compared with the first of its group; should one differ, ids decide.
    """
    sizes = [np.diff(c) for c in cut]
    with np.errstate(over="ignore"):
        h = np.zeros(len(cut[0]) - 1, np.uint64)
        for x, c, n in zip(ids, cut, sizes):
            place = np.arange(len(x)) - np.repeat(c[:-1], n)
            h = mix(h + np.add.reduceat(mix(x.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(32)) + np.uint64(1)), c[:-1]))
    _, first, number = np.unique(h, return_index=True, return_inverse=True)
    like = first[number]
    if all((n[like] == n).all() and (x[spread(c[:-1][like], n)] == x).all() for x, c, n in zip(ids, cut, sizes)):
        return first, number
    seen: dict[tuple[bytes, ...], int] = {}
    number = np.array([seen.setdefault(tuple(x[c[w] : c[w + 1]].tobytes() for x, c in zip(ids, cut)), len(seen)) for w in range(len(h))])
    return np.unique(number, return_index=True)[1], number


class Aligner:
    def __init__(self, path_a: str, path_b: str, most: int = CACHE_WINDOWS):
        import sentencepiece

        self.a = ids_of(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (max(self.a.ranks.values()) + 1)
        for piece, i in self.a.ranks.items():
            self.bytes_a[i] = piece
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        self.length = [np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b)]
        self.spaced = [np.array([x[:1] == b" " for x in t]) for t in (self.bytes_a, self.bytes_b)]
        self.flat = [np.frombuffer(b"".join(t), np.uint8) for t in (self.bytes_a, self.bytes_b)]
        self.at = [np.cumsum(x) - x for x in self.length]
        # ids as they stand inside and at the end of their side of a group; the last of a window has no mark
        self.inside = [np.array([f"{i}," for i in range(len(t))], object) for t in self.length]
        self.closing = [np.array([f"{i}{mark}" for i in range(len(t))], object) for t, mark in zip(self.length, "|;")]
        self.plain_b = np.array([str(i) for i in range(len(self.bytes_b))], object)
        self.kept: dict[tuple[bytes, bytes], Window] = {}
        self.old: dict[tuple[bytes, bytes], Window] = {}
        self.most = most

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """(numbers of the texts that have tokens, joined ids by tokenizer, in order of the texts): those whose bytes are a space and the text for both."""
        raws = [(" " + t).encode() if t else b"" for t in texts]
        size, good = np.array([len(r) for r in raws], np.int64), np.array([bool(t) for t in texts], bool)
        ids = [[np.frombuffer(self.a.plain(" " + t), "<u4") for t in texts], [np.array(x, "<u4") for x in self.b.encode(texts, num_threads=1)]]
        for k, of in enumerate(ids):
            good &= np.array([int(self.length[k][x].sum()) for x in of], np.int64) == size
        here = np.flatnonzero(good)
        if not len(here):
            return here, [np.zeros(0, "<u4")] * 2
        joined = [np.concatenate([of[d] for d in here]) for of in ids]
        raw = np.frombuffer(b"".join([raws[d] for d in here]), np.uint8)
        first = np.cumsum(size[here]) - size[here]
        same = np.ones(len(here), bool)
        for k, x in enumerate(joined):
            same &= ~np.logical_or.reduceat(self.flat[k][spread(self.at[k][x], self.length[k][x])] != raw, first)
        if same.all():
            return here, joined
        return here[same], [np.concatenate([of[d] for d in here[same]] or [np.zeros(0, "<u4")]) for of in ids]

    def align(self, ids: list[np.ndarray], cut: list[np.ndarray]) -> list[Window]:
        """Groups and links of several windows, whose ids are joined; window w has the ids from cut[w] to cut[w + 1].

        Between two neighbouring ends, of either side, lies one token of each: those are linked.  Ends of both sides close groups.
        """
        end = [np.cumsum(self.length[k][x]) for k, x in enumerate(ids)]
        marked = np.zeros((2, int(end[0][-1]) + 1), bool)
        for k in (0, 1):
            marked[k, end[k]] = True
        ends = np.flatnonzero(marked[0] | marked[1])
        of = [x[np.cumsum(marked[k, ends]) - marked[k, ends]].astype(np.int64) for k, x in enumerate(ids)]
        codes = (of[1] * WIDE + of[0]).tobytes()
        shared = np.flatnonzero(marked[0] & marked[1])
        # the words of the text: each group has its A ids, then its B ids
        group = [np.searchsorted(shared, e) for e in end]
        before = [np.concatenate(([0], np.cumsum(np.bincount(g, minlength=len(shared))))) for g in group]
        said = np.empty(len(ids[0]) + len(ids[1]), object)
        for k, (x, g, other) in enumerate(zip(ids, group, (before[1], before[0][1:]))):
            last = end[k] == shared[g]
            word = self.inside[k][x]
            word[last] = self.closing[k][x[last]]
            said[np.arange(len(x)) + other[g]] = word
        at = cut[0] + cut[1]
        bare = at[1:] - 1
        said[bare] = self.plain_b[ids[1][cut[1][1:] - 1]]
        said, at = said.tolist(), at.tolist()
        close = end[0][cut[0][1:] - 1]
        link = np.concatenate(([0], np.searchsorted(ends, close, "right"))).tolist()
        n_groups = np.diff(np.searchsorted(shared, close, "right"), prepend=0).tolist()
        return [("".join(said[i:j]), n, codes[8 * k : 8 * m]) for i, j, n, k, m in zip(at, at[1:], n_groups, link, link[1:])]

    def windows(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[Window]]:
        """(byte offset of each window, its number, distinct alignments by number) of the joined ids of several texts."""
        start = [np.cumsum(self.length[k][x]) - self.length[k][x] for k, x in enumerate(ids)]
        spaced = [start[k][self.spaced[k][x]] for k, x in enumerate(ids)]
        marked = np.zeros(int(spaced[0][-1]) + 1, bool)
        marked[spaced[0]] = True
        anchors = spaced[1][spaced[1] < len(marked)]
        anchors = anchors[marked[anchors]]  # the first tokens of a text begin with a space for both, so texts are parted
        cut = [np.append(np.searchsorted(start[k], anchors), len(x)) for k, x in enumerate(ids)]
        first, number = numbered(ids, cut)
        raw = [x.tobytes() for x in ids]
        (a0, a1), (b0, b1) = ((4 * c[first], 4 * c[first + 1]) for c in cut)
        keys = [(raw[0][i:j], raw[1][k:m]) for i, j, k, m in zip(a0.tolist(), a1.tolist(), b0.tolist(), b1.tolist())]
        found = [self.kept.get(key) or self.old.get(key) for key in keys]
        new = [w for w, got in enumerate(found) if got is None]
        if new:
            n = [np.diff(c)[first[new]] for c in cut]
            parts = [x[spread(c[first[new]], m)] for x, c, m in zip(ids, cut, n)]
            for w, got in zip(new, self.align(parts, [np.concatenate(([0], np.cumsum(m))) for m in n])):
                found[w] = got
        for key, got in zip(keys, found):
            if 2 * len(self.kept) >= self.most:
                self.kept, self.old = {}, self.kept
            self.kept[key] = got
        return anchors, number, found

    def block(self, texts: list[str], said: bool) -> dict[str, list]:
        """Figures of each text of a block, with its pairs as numbers among the block's distinct pairs, and those with their counts."""
        has, ids = self.tokens(texts)
        zero = np.zeros(len(texts), np.int64)
        out = {"n_a": zero.copy(), "n_b": zero.copy(), "n_groups": zero.copy(), "sha": [""] * len(texts), "groups": ["" if said else None] * len(texts), "pairs": [b""] * len(texts), "times": [b""] * len(texts), "codes": np.zeros(0, np.int64), "counts": np.zeros(0, np.int64)}
        if not len(has):
            return out
        sizes = np.array([len(texts[k].encode()) + 1 for k in has])
        firsts = np.cumsum(sizes) - sizes
        offset, number, groups = self.windows(ids)
        at = np.append(np.searchsorted(offset, firsts), len(offset))
        n_codes = np.array([len(g[2]) // 8 for g in groups])
        distinct, code = np.unique(np.frombuffer(b"".join([g[2] for g in groups]), np.int64), return_inverse=True)
        # the pairs of each window occurrence, one after the other
        begin = np.cumsum(n_codes) - n_codes
        n = n_codes[number]
        flat = code[spread(begin[number], n)]
        text_of = np.repeat(np.arange(len(has)), np.diff(at))
        key, times = np.unique(np.repeat(text_of, n) * len(distinct) + flat, return_counts=True)
        cut = np.searchsorted(key, np.arange(len(has) + 1) * len(distinct))
        n_groups = np.add.reduceat(np.array([g[1] for g in groups])[number], at[:-1])
        said_by = [g[0] for g in groups]
        n_a, n_b = (np.diff(np.append(np.searchsorted(np.cumsum(self.length[k][x]), firsts, "right"), len(x))) for k, x in enumerate(ids))
        for k, d in enumerate(has.tolist()):
            whole = ";".join([said_by[w] for w in number[at[k] : at[k + 1]].tolist()])
            out["n_a"][d], out["n_b"][d], out["n_groups"][d] = n_a[k], n_b[k], n_groups[k]
            out["sha"][d] = hashlib.sha256(whole.encode()).hexdigest()
            if said:
                out["groups"][d] = whole
            p = key[cut[k] : cut[k + 1]] - k * len(distinct)
            out["pairs"][d] = encode_counts(np.diff(p, prepend=0))
            out["times"][d] = encode_counts(times[cut[k] : cut[k + 1]])
        out["codes"], out["counts"] = distinct, np.bincount(flat, minlength=len(distinct))
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner_of(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner; kept between tasks."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


#: Characters of text in one block.
BLOCK = 2 << 20
_DOC = "n_a:bigint,n_b:bigint,n_groups:bigint,sha:string,groups:string,pairs:binary,times:binary"


def _blocks(docs: DataFrame, path_a: str, path_b: str, said: bool) -> DataFrame:
    """One row per block: its documents, and its distinct pairs with their counts."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kinds = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("sha", pa.string()), ("groups", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, aligner = TaskContext.get().partitionId() << 32, aligner_of(path_a, path_b)
        for b in batches:
            texts = b.column(1).to_pylist()
            for at, part in chunks(range(b.num_rows), texts, BLOCK):
                got = aligner.block(part, said)
                docs = pa.StructArray.from_arrays([b.column(0).slice(at[0], len(at)), *[pa.array(got[k], t) for k, t in kinds]], ["doc_id", *[k for k, _ in kinds]])
                cells = [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), docs)]
                cells += [pa.ListArray.from_arrays(pa.array([0, len(got[k])], pa.int32()), pa.array(got[k], pa.int64())) for k in ("codes", "counts")]
                yield pa.RecordBatch.from_arrays(cells, ["block", "docs", "codes", "counts"])
                number += 1

    return docs.mapInArrow(run, f"block bigint, docs array<struct<doc_id:{id_type},{_DOC}>>, codes array<bigint>, counts array<bigint>")


def align(docs: DataFrame, path_a: str, path_b: str, said: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, and with ``said`` the groups as text."""
    table = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = table.schema["doc_id"].dataType.simpleString()
    stored = materialize(_blocks(table, path_a, path_b, said), "alignment")
    sent = stored.select("block", F.explode(F.arrays_zip("codes", "counts")).alias("p")).select("block", F.col("p.codes").alias("code"), F.col("p.counts").alias("count"))
    total = sent.groupBy("code").agg(F.sum("count").alias("total"))
    best = F.max("total").over(Over.partitionBy(F.floor(F.col("code") / WIDE)))
    total = total.select("code", "total", (F.col("total") == best).alias("best"))
    told = sent.select("block", "code").join(total, "code").groupBy("block").agg(F.collect_list(F.struct("code", "total", "best")).alias("told"))
    # a struct of arrays, so the task reads three flat columns
    told = told.select("block", *[F.col(f"told.{c}").alias(c) for c in ("code", "total", "best")])
    both = stored.select("block", "docs").join(told, "block", "left")

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                docs = batch.column(1).slice(r, 1).flatten()
                code, total, best = (batch.column(k).slice(r, 1).flatten().to_numpy(zero_copy_only=False) for k in (2, 3, 4))
                order = np.argsort(code)
                total, best = total[order], best[order].astype(bool)
                col = {f.name: docs.field(k) for k, f in enumerate(docs.type)}
                n_best, count_sum = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
                for d, (p, t) in enumerate(zip(col["pairs"].to_pylist(), col["times"].to_pylist())):
                    if p:
                        at, times = np.cumsum(decode_counts(p)), decode_counts(t)
                        n_best[d], count_sum[d] = times[best[at]].sum(), (times * total[at]).sum()
                n = [col[k].to_numpy() for k in ("n_a", "n_b", "n_groups")]
                links = pa.array(n[0] + n[1] - n[2])
                cells = [col["doc_id"], col["n_a"], col["n_b"], col["n_groups"], links, pa.array(n_best), pa.array(count_sum), col["sha"], col["groups"]]
                yield pa.RecordBatch.from_arrays(cells, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"])

    out = both.mapInArrow(receive, f"doc_id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, groups string")
    return out if said else out.drop("groups")
