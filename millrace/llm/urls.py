"""URL filter: rules first, then a path-template tree judged by labelled purity.

Per host the path segments form a tree. Variable segments become wildcards in two ways: by shape
(numbers, hex ids, UUIDs, dates, each with its extension), and by statistics, alike at any number of
siblings: labelled children whose labels and next segments look like those of the other labelled ones merge
into ``<+>``, where both sides have ``evidence`` labels; unlabelled children followed like the other unlabelled
ones merge into ``<*>``. A child that differs keeps its name. What remains are templates such as ``/en/<n>.html``.

Pages that a rule decides are the labelled ones. A template's purity is its share of allowed labels
with one pseudo-label of either kind added. One without labels takes that of the nearest node above with at
least two labelled branches, each counting once: one branch alone says nothing about others. Where there is
none, purity is 0.5. Templates below ``least_purity`` are rejected. Pages shrink to one row per host and token
path before any other shuffle; everything is counted there, level by level from the root, with a stored
table after each level.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged by
the template of the empty path; segments beyond ``most_levels`` count as one; equal urls get equal verdicts
and one row each; ties of purity with the limit are allowed; very long urls are read whole; null ids are carried; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (pattern of a whole segment without extension, wildcard), tried in this order.
SHAPES = (
    (r"[0-9]{4}-[0-9]{2}-[0-9]{2}", "<date>"),
    (r"[0-9]+", "<n>"),
    (r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}", "<uuid>"),
    (r"(?=[a-fA-F]*[0-9])[0-9a-fA-F]{8,}", "<hex>"),
    (r"(?=[^0-9]*[0-9]{3,})[\w-]*[0-9]+", "<slug>"),
)


@dataclass(frozen=True)
class Tree:
    evidence: int = 5  # labels that a child and the others need to be compared
    z: float = 2.0  # standard errors of the difference of label shares within which a child looks like the others
    shape_gap: float = 0.5  # greatest difference in the shares of what follows
    least_purity: float = 0.5
    pseudo: float = 1.0
    most_levels: int = 8


def host_of(url: Column) -> Column:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    options = []
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, _, prefix = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + prefix)
        options.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*options) if options else F.lit(None).cast("struct<rule:string,verdict:string>")


def token(segment: Column) -> Column:
    """A segment with its variable part replaced by a wildcard; the extension stays."""
    parts = r"(?s)^(.*?)(\.[A-Za-z][A-Za-z0-9]{0,5})?$"
    name, extension = F.regexp_extract(segment, parts, 1), F.regexp_extract(segment, parts, 2)
    out = segment
    for pattern, mark in reversed(SHAPES):
        out = F.when(name.rlike(f"^(?:{pattern})$"), F.concat(F.lit(mark), extension)).otherwise(out)
    return out


def token_path(path: Column, most_levels: int) -> Column:
    """Tokens of the segments; a final slash is an empty last segment, a long tail is one token."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", -1)
    head = F.transform(F.slice(parts, 1, most_levels), token)
    return F.when(F.size(parts) > most_levels, F.concat(head, F.array(F.lit("<rest>")))).otherwise(head)


def read_pages(pages: DataFrame, rules=RULES, tree: Tree = Tree()) -> DataFrame:
    """(page_id, host, path, rule, decided, tokens) per page."""
    out = pages.select(F.col("page_id").cast("long"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    out = out.withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules))
    return out.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("decided"),
        token_path(F.col("path"), tree.most_levels).alias("tokens"),
    )


def templates(read: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """(host, tokens, template, n, good, bad): the final template of every token path."""
    label = lambda verdict: F.count(F.when(F.col("decided") == verdict, 1))
    base = read.groupBy("host", "tokens").agg(F.count("*").alias("n"), label("allow").alias("good"), label("block").alias("bad"))
    base = stored(base.withColumn("template", F.col("tokens")), "url-paths")
    levels = base.agg(F.max(F.size("template"))).first()[0] or 0
    for level in range(levels):
        base = stored(merge_level(base, level, tree), "url-level")
    return base


def merge_level(base: DataFrame, level: int, tree: Tree) -> DataFrame:
    """Replace the segment at ``level`` by ``<+>`` (labelled) or ``<*>`` where it looks like its siblings of the same kind."""
    here, after = F.get("template", F.lit(level)), F.get("template", F.lit(level + 1))
    named = base.withColumn("_up", F.slice("template", 1, level)).withColumn("_seg", here).withColumn(
        "_next", F.when(after.isNull(), "end").when(after.startswith("<"), "wild").otherwise("name")
    )
    sums = [F.sum(c).alias(c) for c in ("n", "good", "bad")]
    follows = [F.sum(F.when(F.col("_next") == kind, F.col("n")).otherwise(0)).alias(kind) for kind in ("end", "wild")]
    literal = named.filter(F.col("_seg").isNotNull() & ~F.col("_seg").startswith("<"))
    children = literal.groupBy("host", "_up", "_seg").agg(*sums, *follows)
    children = children.withColumn("_known", F.col("good") + F.col("bad") > 0)
    whole = children.groupBy("host", "_up", "_known").agg(
        F.count("*").alias("_children"), *[F.sum(c).alias(f"_{c}") for c in ("n", "good", "bad", "end", "wild")]
    ).filter("_children > 1")
    joined = children.join(whole, ["host", "_up", "_known"])
    others = {c: F.col(f"_{c}") - F.col(c) for c in ("n", "good", "bad", "end", "wild")}
    labels, rest = F.col("good") + F.col("bad"), others["good"] + others["bad"]
    own = (F.col("good") + tree.pseudo) / (labels + 2 * tree.pseudo)
    share = (others["good"] + tree.pseudo) / (rest + 2 * tree.pseudo)
    error = F.sqrt(own * (1 - own) / (labels + 2 * tree.pseudo) + share * (1 - share) / (rest + 2 * tree.pseudo))
    enough = (labels >= tree.evidence) & (rest >= tree.evidence)
    alike = ~F.col("_known") | (enough & (F.abs(own - share) <= tree.z * error))
    for kind in ("end", "wild"):
        alike &= F.abs(F.col(kind) / F.col("n") - others[kind] / others["n"]) <= tree.shape_gap
    mark = F.when(F.col("_known"), "<+>").otherwise("<*>")
    merged = joined.filter(alike).select("host", "_up", "_seg", mark.alias("_merged"))
    out = named.join(merged, ["host", "_up", "_seg"], "left")
    renamed = F.transform("template", lambda part, at: F.when(at == level, F.col("_merged")).otherwise(part))
    return out.withColumn("template", F.when(F.col("_merged").isNotNull(), renamed).otherwise(F.col("template"))).select(*base.columns)


def branch_purity(paths: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """(host, node, value): mean purity of the labelled branches of nodes that have two or more, merged ones by their own names."""
    branch = F.concat("tokens", F.array(F.lit("<end>")))  # pages that end at a node are a branch of it
    steps = F.transform(branch, lambda name, at: F.struct(F.slice("template", 1, at).alias("node"), name.alias("branch")))
    nodes = paths.filter(F.col("good") + F.col("bad") > 0).select("host", "good", "bad", F.inline(steps))
    own = (F.sum("good") + tree.pseudo) / (F.sum("good") + F.sum("bad") + 2 * tree.pseudo)
    branches = nodes.groupBy("host", "node", "branch").agg(own.alias("_own"))
    value = (F.sum("_own") + tree.pseudo) / (F.count("*") + 2 * tree.pseudo)
    return branches.groupBy("host", "node").agg(value.alias("value"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")


def judged_templates(paths: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """(host, template, n, good, bad, purity, rejected) per template."""
    total = paths.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")])
    labels = F.col("good") + F.col("bad")
    above = F.transform(F.sequence(F.lit(0), F.size("template")), lambda k: F.slice("template", 1, k))
    bare = total.filter(labels == 0).select("host", "template", F.explode(above).alias("node"))
    nearest = bare.join(branch_purity(paths, tree), ["host", "node"]).groupBy("host", "template").agg(F.max_by("value", F.size("node")).alias("_value"))
    own = (F.col("good") + tree.pseudo) / (labels + 2 * tree.pseudo)
    purity = F.when(labels > 0, own).otherwise(F.coalesce("_value", F.lit(0.5)))
    out = total.join(nearest, ["host", "template"], "left").withColumn("purity", purity).drop("_value")
    return out.withColumn("rejected", F.col("purity") < tree.least_purity)


def filter_urls(pages: DataFrame, rules=RULES, tree: Tree = Tree()) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) per page."""
    read = stored(read_pages(pages, rules, tree), "url-read")
    paths = templates(read, tree)
    verdicts = judged_templates(paths, tree).select("host", "template", "purity", "rejected")
    known = paths.join(verdicts, ["host", "template"]).select("host", "tokens", "template", "purity", "rejected")
    method = F.when(F.coalesce(F.col("rejected"), F.lit(False)), "block").otherwise("allow")
    return read.join(known, ["host", "tokens"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("decided", method).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity",
    )
