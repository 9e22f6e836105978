"""Quality rules as a short-circuit cascade.

Every text is measured once (the base figures, for which the contract asks in all rows).  The
remaining rules look at whole texts too, but a rule only sees the texts that no earlier rule has rejected.  Their order is fitted: each rule's cost
and selectivity are measured on a bounded sample drawn by hash from all rows, and rules run by rejections per second.  A verdict
does not depend on the order, so reruns agree.

Defined results: a null or empty text has no words and fails the base rule; repeated rows and ties
are judged alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.textops import Words, chunks, shingles, words

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True


@dataclass
class Measured:
    """A batch of texts with what the base rule has counted."""

    texts: list[str]
    words: Words
    figures: dict[str, np.ndarray]
    hashes: np.ndarray  # of all words; the base rule's repeats have needed them


def _per_text(w: Words, flags: np.ndarray) -> np.ndarray:
    c = np.concatenate(([0], np.cumsum(flags)))
    ends = np.minimum(w.text_at, len(flags))
    return np.diff(c[ends])


def measure(texts: list[str]) -> Measured:
    w = words(texts, lower=False)
    n = len(texts)
    solid = ~w.space
    h = w.hashes()
    doc, shingle, at = shingles(w, 5, short=False, hashes=h)
    repeat = np.zeros(n, np.int64)
    if len(doc):
        order = np.lexsort((shingle, doc))
        d, s = doc[order], shingle[order]
        same = (d[1:] == d[:-1]) & (s[1:] == s[:-1])
        twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
        hit = np.zeros(len(w.starts) + 1, np.int64)
        np.add.at(hit, at[order][twice], 1)
        np.add.at(hit, at[order][twice] + 5, -1)
        c = np.concatenate(([0], np.cumsum(np.cumsum(hit[:-1]) > 0)))
        repeat = np.diff(c[w.first])
    lines = np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        parts = [x for x in t.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
        lines[i] = len(parts) - len(set(parts))
    figures = {
        "n_words": w.counts.astype(np.int64),
        "word_chars": _per_text(w, solid & ((w.buf & 0xC0) != 0x80)),
        "n_symbols": _per_text(w, _SYMBOLS[w.buf]),
        "n_dup_lines": lines,
        "n_repeat_words": repeat,
    }
    return Measured(texts, w, {k: v.astype(np.int64) for k, v in figures.items()}, h)


@dataclass(frozen=True)
class Rule:
    """``rejects(measured, rows)`` says which of the given rows of a batch are rejected."""

    name: str
    rejects: Callable[[Measured, np.ndarray], np.ndarray]


def _share(f: str, by: str, most: float) -> Callable:
    return lambda m, rows: m.figures[f][rows] > most * np.maximum(m.figures[by][rows], 1)


def _upper(m: Measured, rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), bool)
    for i, r in enumerate(rows):
        b = m.words.buf[m.words.text_at[r] : m.words.text_at[r + 1] - 1]
        out[i] = _UPPER[b].sum() > 0.5 * max(1, _LETTER[b].sum())
    return out


def _mean_word(m: Measured, rows: np.ndarray) -> np.ndarray:
    mean = m.figures["word_chars"][rows] / np.maximum(m.figures["n_words"][rows], 1)
    return (mean < 2) | (mean > 20)


def _few_distinct(m: Measured, rows: np.ndarray) -> np.ndarray:
    """Under a tenth as many distinct words as a text of its length can be expected to have."""
    out = np.zeros(len(rows), bool)
    for i, r in enumerate(rows):
        x = m.hashes[m.words.first[r] : m.words.first[r + 1]]
        out[i] = len(np.unique(x)) < 0.1 * min(len(x), 500)
    return out


def _stutter(m: Measured, rows: np.ndarray) -> np.ndarray:
    """Over a quarter of the words equal the word before them."""
    out = np.zeros(len(rows), bool)
    for i, r in enumerate(rows):
        x = m.hashes[m.words.first[r] : m.words.first[r + 1]]
        out[i] = np.count_nonzero(x[1:] == x[:-1]) > 0.25 * max(len(x), 1)
    return out


RULES: tuple[Rule, ...] = (
    Rule("symbols", _share("n_symbols", "n_words", 0.5)),
    Rule("duplicate_lines", lambda m, rows: 5 * m.figures["n_dup_lines"][rows] * 10 > m.figures["n_words"][rows]),
    Rule("upper_case", _upper),
    Rule("mean_word", _mean_word),
    Rule("few_distinct", _few_distinct),
    Rule("stutter", _stutter),
)
#: Rows of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS = 400


def fit_order(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, text: str = "text") -> list[tuple[str, float, float]]:
    """(rule, seconds per text, share rejected) of each rule on at most ``sample_rows`` texts drawn by hash, best rejection per cost first."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in chunks(list(range(b.num_rows)), b[0].to_pylist()):
                m = measure(texts)
                rows = np.arange(len(texts))
                for r in rules:
                    t = time.process_time()
                    n = int(r.rejects(m, rows).sum())
                    yield pa.RecordBatch.from_pydict({"rule": [r.name], "texts": [len(texts)], "rejected": [n], "s": [time.process_time() - t]})

    sample = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).orderBy(F.xxhash64("t")).limit(sample_rows)
    got = sample.mapInArrow(probe, "rule string, texts long, rejected long, s double")
    rows = got.groupBy("rule").agg(F.sum("texts").alias("n"), F.sum("rejected").alias("r"), F.sum("s").alias("s")).collect()
    seen = {r["rule"]: (r["s"] / r["n"], r["r"] / r["n"]) for r in rows}
    out = [(r.name, *seen.get(r.name, (0.0, 0.0))) for r in rules]
    return sorted(out, key=lambda x: -(x[2] + 1e-6) / (x[1] + 1e-9))


def quality_rules(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    order: Sequence[str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: base figures, ``base_failed``, ``kept`` and the first rule that rejects it (``rejected_by``).

    ``order`` is a fitted order of rule names; without it the order is fitted here.
    """
    order = list(order) if order is not None else [x[0] for x in fit_order(docs, rules, text=text)]
    by_name = {r.name: r for r in rules}
    cascade = [by_name[x] for x in order]
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, rejected_by string"
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in chunks(list(range(b.num_rows)), b[1].to_pylist()):
                m = measure(texts)
                f = m.figures
                failed = (f["n_words"] < 10) | (100 * f["n_repeat_words"] > 20 * f["n_words"])
                by = np.full(len(texts), None, object)
                alive = np.flatnonzero(~failed)
                for r in cascade:
                    if not len(alive):
                        break
                    hit = r.rejects(m, alive)
                    by[alive[hit]] = r.name
                    alive = alive[~hit]
                kept = np.zeros(len(texts), bool)
                kept[alive] = True
                yield pa.RecordBatch.from_arrays(
                    [b[0].slice(ids[0], len(ids)), *(pa.array(f[k]) for k in f), pa.array(failed), pa.array(kept), pa.array(by, pa.string())],
                    ["doc_id", *f, "base_failed", "kept", "rejected_by"],
                )

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(judge, schema)
