"""Personal data by weak supervision, in DataFrame functions only.

Base spans (email, ip, card, phone) are pattern matches with checks, and always stay.  Further
candidates (secrets, numbers, names) are voted on by labelers: shape patterns, gazetteers, context
words and symbols before the span, variety of characters.  A labeler says yes (1), no (-1) or
abstains (0).  Expectation-maximisation on the counts of vote patterns (at most 3^labelers rows a kind)
estimates each labeler's reliability for each kind without any labels; its posteriors are the soft labels on which
the final span classifier (naive Bayes on kind, length, digits and neighbours) is trained, again from
counts of feature combinations.  Both tables are bounded by the number of labelers and features, not
by the corpus; both count every candidate.

Positions are code points, end exclusive.  They come from the gaps that ``split`` leaves and the
matches that ``regexp_extract_all`` finds with the same pattern.  Repetitions in the patterns are
possessive where the next character cannot be taken by them, so that a match takes linear time and
no stack.

Defined results: null or empty text has no spans and the digest of the empty string; repeated rows
are judged alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import materialize, text_or_empty

_RUN = "A-Za-z0-9._%+-"
#: Patterns that find what the plain ones find (see tests): the plain one of email is
#: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, and a match may begin inside a run only where the last one ended.
EMAIL = rf"(?:\G|(?<![{_RUN}]))[{_RUN}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "number", "name")
_CANDIDATES = {
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{20,}+",
    "number": r"(?<![A-Za-z0-9.+])[0-9](?:[\x20-]?[0-9]){6,}+(?![A-Za-z0-9])",
    "name": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20\p{Lu}\p{Ll}+(?:\x20\p{Lu}\p{Ll}+)?",
}
#: Words that name what follows (fixed values).
GAZETTEER = ("token", "key", "secret", "password", "passwd", "api", "ssn", "iban", "passport", "account", "card", "phone", "tel", "mr", "mrs", "ms", "dr", "prof")
LABELERS = ("shape", "gazetteer", "assignment", "variety", "position")
_SPAN = "array<struct<s:int,e:int,v:string,c:string>>"


#: Elements of one chunk of a running total.
_CHUNK = 128


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _running(items: Column, zero: Column, op) -> Column:
    """For each element the total of all before it, by chunks and within them: no step copies what came before it."""
    total = lambda x: F.aggregate(x, zero, op)
    chunks = lambda x: F.transform(F.sequence(F.lit(0), ((F.size(x) - 1) / _CHUNK).cast("int")), lambda c: F.slice(x, c * _CHUNK + 1, F.lit(_CHUNK)))
    within = lambda x, base: F.transform(x, lambda _, i: op(base, total(F.slice(x, F.lit(1), i))))
    spread = lambda cs: _let(F.transform(cs, total), lambda sums: F.flatten(F.transform(cs, lambda x, c: _let(total(F.slice(sums, F.lit(1), c)), lambda base: within(x, base)))))
    return _let(items, lambda x: F.when(F.size(x) > 0, _let(chunks(x), spread)).otherwise(F.slice(x, 1, 0)))


def spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<s, e, v, c>>, in code points.

    ``c``: up to 24 characters before the match, back to where the match before it begins.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    length = lambda z: F.length(z["g"]) + F.coalesce(F.length(z["m"]), F.lit(0))

    def place(z: Column, at: Column, last: Column) -> Column:
        s = at + F.length(z["g"])
        before = F.right(F.concat(F.coalesce(last, F.lit("")), z["g"]), F.lit(24))
        return F.struct(s.alias("s"), (s + F.length(z["m"])).alias("e"), z["m"].alias("v"), before.alias("c"))

    found = lambda p: _let(_running(F.transform(p, length), F.lit(0), lambda a, x: a + x), lambda at: F.transform(p, lambda z, i: place(z, F.get(at, i), F.get(p, i - 1)["m"])))
    return F.filter(_let(pairs, found), lambda x: x["v"].isNotNull())


def _guarded(text: Column, needs: Column, pattern: str) -> Column:
    return F.when(needs, spans(text, pattern)).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    digit = text.rlike("[0-9]")
    octet = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
    card = F.filter(_guarded(text, digit, CARD), lambda x: F.length(_digits(x["v"])).between(13, 19))
    return {
        "email": _guarded(text, F.contains(text, F.lit("@")), EMAIL),
        "ip": F.filter(_guarded(text, digit, IP), lambda x: x["v"].rlike(rf"^{octet}\.{octet}\.{octet}\.{octet}$")),
        "card": F.filter(card, lambda x: luhn(_digits(x["v"]))),
        "phone": F.filter(_guarded(text, F.contains(text, F.lit("+")), PHONE), lambda x: F.length(_digits(x["v"])).between(9, 15)),
    }


def _votes(kind: str, x: Column) -> Column:
    """Votes of LABELERS on one candidate as an array."""
    v = x["v"]
    before = x["c"]
    words = "|".join(GAZETTEER)
    yes_no = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    if kind == "secret":
        shape = yes_no(v.rlike("^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|sk-.*|[A-Z0-9]{20})$"), v.rlike("^[0-9-]+$"))
        variety = yes_no(F.size(F.array_distinct(F.split(v, ""))) >= 10, F.size(F.array_distinct(F.split(v, ""))) <= 6)
    elif kind == "number":
        shape = yes_no(v.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), v.rlike("^[0-9]{7,}$"))
        variety = yes_no(F.size(F.array_distinct(F.split(_digits(v), ""))) >= 5, F.size(F.array_distinct(F.split(_digits(v), ""))) <= 2)
    else:
        shape = yes_no(v.rlike(r"\x20\p{Lu}\p{Ll}+\x20\p{Lu}\p{Ll}+$"), F.length(v) < 5)
        variety = F.lit(0)
    named = before.rlike(rf"(?i)\b(?:{words})\b[^\n]*$") | v.rlike(rf"(?i)^(?:{words})\b")
    assigned = yes_no(before.rlike("[=:][\\x20\"']*$"), before.rlike(r"[.!?]\x20*$"))
    position = yes_no(before.rlike("[\"'(]$"), before.rlike(r"[,.][0-9]*$"))
    listed = F.lit(0) if kind == "name" else yes_no(named, F.lit(False))  # a name's pattern asks for the title itself
    return F.array(shape, listed, assigned, variety, position)


def _features(x: Column) -> Column:
    n, d = x["e"] - x["s"], F.length(_digits(x["v"]))
    prev = F.right(x["c"], F.lit(1))
    return F.array(
        F.when(n < 10, "len<10").when(n < 20, "len<20").when(n < 36, "len<36").otherwise("len36+"),
        F.when(d == 0, "digits0").when(2 * d < n, "digits<half").when(d < n, "digits<all").otherwise("digits"),
        F.when(prev == "", "start").when(prev.rlike("[\"'=:]"), "mark").when(prev.rlike(r"\s"), "space").otherwise("other"),
    )


def free_of(found: Column, base: Column) -> Column:
    """The spans of ``found`` that overlap none of ``base``: in order of starts, the furthest end before and the next start after each."""
    row = lambda x, b: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(b).alias("b"), *[(F.lit("") if b else x[n]).alias(n) for n in ("v", "c")])
    both = F.sort_array(F.concat(F.transform(found, lambda x: row(x, False)), F.transform(base, lambda x: row(x, True))))
    end = F.lit(2**31 - 1)
    upto = lambda z: _running(F.transform(z, lambda x: F.when(x["b"], x["e"]).otherwise(0)), F.lit(0), lambda a, x: F.greatest(a, x))
    after = lambda z: _running(F.transform(F.reverse(z), lambda x: F.when(x["b"], x["s"]).otherwise(end)), end, lambda a, x: F.least(a, x))
    free = lambda z, a, b: F.filter(z, lambda x, i: ~x["b"] & (x["s"] >= F.get(a, i)) & (x["e"] <= F.get(b, F.size(b) - 1 - i)))
    kept = _let(both, lambda z: _let(upto(z), lambda a: _let(after(z), lambda b: free(z, a, b))))
    bare = F.transform(kept, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v"), x["c"].alias("c")))
    return F.when((F.size(found) == 0) | (F.size(base) == 0), found).otherwise(bare)


#: Candidates that what is known of all kinds weighs in one kind's reliabilities.
POOLED = 100


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50, prior: float = 0.5, anchor: tuple[list, float] | None = None) -> tuple[list[dict[int, tuple[float, float]]], float, dict[tuple[int, ...], float]]:
    """Reliabilities P(vote | not, is), the share of true candidates, and the posterior of each vote pattern.

    ``anchor``: reliabilities and share over all kinds, which count like ``POOLED`` candidates.
    """
    total = sum(n for _, n in patterns)
    k = len(patterns[0][0]) if patterns else 0
    table: list[dict[int, tuple[float, float]]] = []

    def posterior(v: tuple[int, ...]) -> float:
        z = math.log(prior / (1 - prior)) + sum(math.log(table[j][v[j]][1] / table[j][v[j]][0]) for j in range(k))
        return 1 / (1 + math.exp(-max(-30, min(30, z))))

    if anchor is None:
        post = {v: min(0.95, max(0.05, 0.5 + 0.25 * sum(v))) for v, _ in patterns}
    else:
        table, prior = anchor
        post = {v: posterior(v) for v, _ in patterns}
    known = (0.0, 0.0) if anchor is None else (POOLED * (1 - anchor[1]), POOLED * anchor[1])
    for _ in range(rounds if total else 0):
        yes = sum(n * post[v] for v, n in patterns)
        share = [(total - yes) + known[0], yes + known[1]]
        prior = (share[1] + 1) / (sum(share) + 2)
        table = []
        for j in range(k):
            of = {}
            for vote in (-1, 0, 1):
                a = sum(n * (1 - post[v]) for v, n in patterns if v[j] == vote)
                b = sum(n * post[v] for v, n in patterns if v[j] == vote)
                if anchor is not None:
                    a, b = a + known[0] * anchor[0][j][vote][0], b + known[1] * anchor[0][j][vote][1]
                of[vote] = ((a + 1 + (vote < 0)) / (share[0] + 4), (b + 1 + (vote > 0)) / (share[1] + 4))
            table.append(of)
        post = {v: posterior(v) for v, _ in patterns}
    return table, prior, post


def train_classifier(rows: list[tuple[str, tuple[str, ...], float, float]]) -> tuple[float, dict[str, float]]:
    """Naive Bayes log odds from (kind, features, weight as not, weight as is)."""
    no, yes = sum(r[2] for r in rows) + 1, sum(r[3] for r in rows) + 1
    of: dict[str, list[float]] = {}
    for kind, features, a, b in rows:
        for f in (kind, *(f"{kind}/{x}" for x in features)):
            w = of.setdefault(f, [0.5, 0.5])
            w[0] += a
            w[1] += b
    return math.log(yes / no), {f: math.log((b / yes) / (a / no)) for f, (a, b) in of.items()}


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """One row per document: ``doc_id, found`` (array of kind, s, e; base kinds first) and counts of base kinds ``n_<kind>``."""
    t = F.col("text")
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    rows = rows.select("doc_id", "text", *[c.alias(k) for k, c in base_spans(t).items()], *[_guarded(t, t.rlike(r"[0-9]" if k != "name" else r"(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20"), p).alias(f"c_{k}") for k, p in _CANDIDATES.items()])
    every = F.concat(*[F.col(k) for k in BASE])

    def judged(kind: str) -> Column:
        return F.transform(free_of(F.col(f"c_{kind}"), every), lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), _votes(kind, x).alias("votes"), _features(x).alias("features")))

    bare = [F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(k) for k in BASE]
    seen = materialize(rows.select("doc_id", *bare, F.concat(*[judged(k) for k in ADDED]).alias("candidates")), "pii")
    # bounded: vote patterns times feature combinations
    counts = seen.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes", "c.features").agg(F.count(F.lit(1)).alias("n")).collect()
    def patterns(kinds: tuple[str, ...]) -> list[tuple[tuple[int, ...], int]]:
        out: dict[tuple[int, ...], int] = {}
        for r in counts:
            if r["kind"] in kinds:
                out[tuple(r["votes"])] = out.get(tuple(r["votes"]), 0) + r["n"]
        return sorted(out.items())

    *pooled, _ = expectation_maximisation(patterns(ADDED))
    # a labeler's reliability is its own for each kind, drawn towards that over all kinds
    post = {(kind, v): p for kind in ADDED for v, p in expectation_maximisation(patterns((kind,)), anchor=tuple(pooled))[2].items()} if counts else {}
    bias, odds = train_classifier(sorted((r["kind"], tuple(r["features"]), r["n"] * (1 - post[r["kind"], tuple(r["votes"])]), r["n"] * post[r["kind"], tuple(r["votes"])]) for r in counts))
    cut = math.log(least / (1 - least)) - bias
    combos = sorted({(r["kind"], tuple(r["features"])) for r in counts})
    accepted = [f"{k}/{'/'.join(f)}" for k, f in combos if odds[k] + sum(odds[f"{k}/{x}"] for x in f) >= cut]
    taken = F.filter("candidates", lambda c: F.concat_ws("/", c["kind"], c["features"]).isin(accepted) if accepted else F.lit(False))

    def named(kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))

    added = F.transform(taken, lambda c: F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e")))
    return seen.select("doc_id", F.concat(*map(named, BASE)).alias("base"), added.alias("added"), *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE])


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(text: Column, found: Column) -> Column:
    """``text`` with each span of ``found`` (sorted by start here) replaced by its kind in angle brackets."""
    order = F.array_sort(F.transform(found, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        clear = F.concat(acc["out"], F.substr(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit("<"), F.upper(x["kind"]), F.lit(">"))
        return F.when(x["s"] < acc["at"], acc).otherwise(F.struct(x["e"].alias("at"), clear.alias("out")))

    return F.aggregate(order, start, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1, F.length(text))))
