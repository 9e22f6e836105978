"""URL filters by path-template trees, in DataFrame functions only.

Rules judge first: a rule fits its host and all subdomains when the path starts with the rule's, and
the longest fitting rule wins.  Pages that a rule has judged label the tree of their host.  Level by
level, a branch keeps its own segment only if it has support and its labels differ from its
siblings' by a two-proportion test; all other branches of a node are variable and become one wildcard.
Of the branches that keep apart, those of one node whose smoothed shares fall in the same quarter are
statistically alike: they are merged into one branch (``~`` and the quarter) with a common subtree.  A template of host and segments is rejected when its smoothed share of
blocked labels reaches a threshold; shares are smoothed towards the host's, the host's towards the
whole table's.

The trees are built on distinct (host, path) with counts, so a hot host or page costs one row for each
task before the shuffle.

Defined results: null url or one without ``://`` has empty host and path, fits no rule and is judged
by its (empty) template; repeated rows are judged alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import materialize


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url.cast("string"), F.lit(""))
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    lower = F.translate(F.regexp_extract(u, whole, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(u, whole, 2)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does.  ``rules``: (verdict, ``host/path``)."""
    rule = verdict = None
    for v, r in sorted(rules, key=lambda x: (-len(x[1]), x[1])):
        h, p = r.split("/", 1)
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        rule = F.when(fits, r) if rule is None else rule.when(fits, r)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def splitting_depth(paths: DataFrame, support: int) -> int:
    """Levels of the trees that can keep a branch: at each, some host has ``support`` pages that go as deep, two of them labelled.

    Below, every segment is a wildcard, so a few very deep urls cost no rounds.
    """
    sizes = paths.groupBy("host", F.size("segs").alias("s")).agg(F.sum("n").alias("n"), F.sum("labelled").alias("l"))
    deeper = Window.partitionBy("host").orderBy(F.desc("s"))  # one row for each length of a host's paths
    sizes = sizes.select("s", F.sum("n").over(deeper).alias("n"), F.sum("l").over(deeper).alias("l"))
    return sizes.where((F.col("n") >= support) & (F.col("l") >= 2)).agg(F.max("s")).first()[0] or 0


def templates(paths: DataFrame, support: int = 5, z: float = 1.96) -> DataFrame:
    """``paths`` (host, path, n, labelled, blocked) with the ``template`` of each path."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    state = materialize(paths.withColumn("segs", segments).withColumn("template", F.lit("")), "url-paths")
    deep = splitting_depth(state, support)
    key = ["host", "template", "seg"]
    for level in range(deep):
        at = state.withColumn("seg", F.get("segs", F.lit(level)))
        child = at.where("seg IS NOT NULL").groupBy(*key).agg(F.sum("n").alias("n"), F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
        node = child.groupBy("host", "template").agg(F.sum("l").alias("nl"), F.sum("b").alias("nb"))
        both = child.join(node, ["host", "template"])
        rest_l, rest_b = F.col("nl") - F.col("l"), F.col("nb") - F.col("b")
        p = (F.col("nb") + 0.5) / (F.col("nl") + 1)
        gap = F.abs(F.col("b") / F.col("l") - rest_b / rest_l) / F.sqrt(p * (1 - p) * (1 / F.col("l") + 1 / rest_l))
        own = (F.col("n") >= support) & (F.col("l") > 0) & (rest_l > 0) & (F.when((F.col("l") > 0) & (rest_l > 0), gap) >= z)
        kept = both.where(own).select(*key, F.round((F.col("b") + 0.5) / (F.col("l") + 1) * 4).cast("int").alias("quarter"))
        alike = kept.groupBy("host", "template", "quarter").agg((F.count(F.lit(1)) > 1).alias("merged"))
        label = F.when(F.col("merged"), F.concat(F.lit("~"), F.col("quarter").cast("string"))).otherwise(F.col("seg"))
        kept = kept.join(alike, ["host", "template", "quarter"]).select(*key, label.alias("own"))
        step = F.when(F.col("seg").isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), F.coalesce("own", F.lit("*"))))
        state = at.join(kept, key, "left").withColumn("template", F.concat("template", step)).drop("seg", "own")
        state = materialize(state, "url-level")
    rest = F.repeat(F.lit("/*"), F.greatest(F.size("segs") - deep, F.lit(0)))
    return state.withColumn("template", F.concat("template", rest)).drop("segs")


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str]], page_id: str = "page_id", url: str = "url", threshold: float = 0.7, smoothing: float = 4.0, support: int = 5) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, template, purity``."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("ruled"))
    paths = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.count("ruled").alias("labelled"), F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"))
    known = templates(paths, support)
    sums = [F.sum("labelled").alias("l"), F.sum("blocked").alias("b")]
    by_template = known.groupBy("host", "template").agg(*sums)
    by_host = by_template.groupBy("host").agg(F.sum("l").alias("hl"), F.sum("b").alias("hb"))
    total = by_host.agg(F.sum("hl").alias("l"), F.sum("hb").alias("b")).first()
    overall = ((total["b"] or 0) + 1) / ((total["l"] or 0) + 2)
    of_host = (F.col("hb") + smoothing * overall) / (F.col("hl") + smoothing)
    purity = (F.col("b") + smoothing * of_host) / (F.col("l") + smoothing)
    judged = by_template.join(by_host, "host").select("host", "template", purity.alias("purity"))
    judged = known.select("host", "path", "template").join(judged, ["host", "template"])
    out = rows.join(judged, ["host", "path"])
    own = F.when(F.col("purity") >= threshold, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "template", "purity")
