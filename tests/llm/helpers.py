"""Fixtures of odd rows, and plain-Python forms of the contracts."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, keep_id long, size int, template string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def odd_texts() -> list:
    rng = random.Random(5)
    vocab = ["alpha", "beta", "gamma", "Delta", "éta", "zeta,", "ETA.", "θ", "iota", "kappa!", "lambda", "mu"]
    base = [" ".join(rng.choice(vocab) + str(rng.randrange(40)) for _ in range(60)) for _ in range(6)]
    near = [b.replace(b.split(" ")[7], "changed") for b in base] + [base[0].upper(), base[0].replace(" ", "  \n")]
    tail = ["", " ", "\n\t", None, "one", "one two three", "a a a a a a a a a a a a", "x " * 6000, "y" * 5000, "A\n\nB\nA\nA", "a|b#c$ <|endoftext|> d"]
    return [*base, *near, *base[:2], *tail, *tail]


def odd_docs(spark):
    texts = odd_texts()
    rows = [(i, t, "en" if i % 3 else None, [None, "s1", "s2", "ü"][i % 4], len(t or ""), "x", 3, 4, "t") for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, "no id", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def words(t):
    return WORD.findall(t or "")
