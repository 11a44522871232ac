"""Exact near-dedup by the Jaccard similarity of word shingles, with prefix filtering.

Two sets of similarity ``4/5`` or more share a shingle among the first ``n - ceil(4n/5) + 1`` of each (``n`` its
size), whatever the order, as long as it is one order for all. Shingles are ordered by hash, those that
a sample finds common last, so that repeated lines seldom make candidates; the sample decides the
amount of work, not the result. No pair at the threshold is missed, and every link is verified on whole sets.

Equal sets collapse first. SimHash fingerprints of the same shingles are linked first, by the generalised pigeonhole search of
``simhash.py``, and verified on whole sets; sets that this connects need no other comparison. What fingerprints
miss, the prefixes find: in each bucket (documents with a prefix shingle in common; buckets with the same
members count once) all are compared with one leader. Members that this links need not be compared
with one another; the remaining ones meet the members of other components. There the join itself compares sizes and
parity bitmaps: two sets whose bitmaps differ in d bits differ in d shingles or more, and sets of similarity 4/5 in at most
a ninth of both sizes. Pairs that share a common passage and little else therefore leave no row.

Defined results: null texts and texts without words equal one another; fewer words than a shingle form one shingle; very long
texts are read whole; repeated rows keep one result row each; documents without id take part but never name a component;
other columns pass unchanged, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import TEXTS, map_rows, scratch, stored, texts
from millrace.llm.simhash import components, fingerprint
from millrace.llm.simhash import links as fingerprint_links
from millrace.session import cut_lineage, scoped_conf

WIDTH = 5
PARTS, OF = 4, 5  # similarity 4/5, in whole numbers
SAMPLE = 16  # one document in so many is searched for common shingles; results do not depend on it
COMMON_USES, MOST_COMMON = 8, 200_000
SALT = 200  # pairs of one document that meet in one task
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # each step is stored, so its shuffle files can go
TURNS = 2  # rounds of few pairs before all that are still apart; results do not depend on it
DISTANCE = 4  # bits between fingerprints that are compared first; results do not depend on it
MIX = np.uint64(0x9E3779B97F4A7C15)
BITS = 1024  # of a parity bitmap; results do not depend on it


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 19:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


WORDS = WordHashes()


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    words = text.encode().lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return np.zeros(0, np.int64)
    each = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    width = min(width, len(each))
    out = np.full(len(each) - width + 1, width, np.uint64)
    for k in range(width):
        out = (out ^ each[k : k + len(out)]) * MIX
        out ^= out >> np.uint64(29)
    return np.unique(out.view(np.int64))


def key_of(values: np.ndarray) -> int:
    return int(np.array(xxhash.xxh64_intdigest(values.tobytes()), np.uint64).view(np.int64))


def prefix(values: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles of a set, common ones last, of which similar sets share one."""
    n = len(values)
    if not n:
        return values
    late = np.zeros(n, bool)
    if len(common):  # both are sorted
        late = common[np.minimum(np.searchsorted(common, values), len(common) - 1)] == values
    return np.concatenate([values[~late], values[late]])[: n + (-PARTS * n) // OF + 1]


def parities(values: np.ndarray) -> np.ndarray:
    """For each bit, whether an odd number of shingles falls on it, as longs."""
    odd = np.bincount(values.view(np.uint64) * MIX >> np.uint64(64 - BITS.bit_length() + 1), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def common_shingles(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    def run(batch: pa.RecordBatch):
        yield [[shingles(text, width) for text in texts(batch)]]

    some = docs.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    uses = map_rows(some, run, "shingles array<long>", TEXTS).select(F.explode("shingles").alias("s")).groupBy("s").count()
    rows = uses.filter(F.col("count") >= COMMON_USES).orderBy(F.desc("count"), "s").limit(MOST_COMMON).select("s").collect()
    return np.sort(np.array([r["s"] for r in rows], np.int64))


def distinct_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(key, rep, size, prefix, bits, fp), one row per distinct shingle set; rep is its smallest id, fp its SimHash fingerprint."""
    common = common_shingles(docs, width)

    def run(batch: pa.RecordBatch):
        whole = texts(batch)
        found = [shingles(text, width) for text in whole]
        prints = np.array([fingerprint(text, width) for text in whole], dtype=np.uint64)
        yield [
            batch.column("doc_id"), [key_of(s) for s in found], [len(s) for s in found], [prefix(s, common) for s in found], [parities(s) for s in found],
            prints.view(np.int64),
        ]

    marked = map_rows(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, key long, size int, prefix array<long>, bits array<long>, fp long", TEXTS)
    # Equal sets of unequal texts may differ in repeats, which fingerprints count: the smallest is as good as any.
    firsts = [*[F.first(c).alias(c) for c in ("size", "prefix", "bits")], F.min("fp").alias("fp")]
    return stored(marked.groupBy("key").agg(F.min("doc_id").alias("rep"), *firsts), "jaccard-sets", keep=True)


def buckets(sets: DataFrame) -> DataFrame:
    """(token, key, size, low): the sets that share a prefix shingle, with the bucket's leader."""
    rows = sets.select("key", "size", F.explode("prefix").alias("token"))
    shared = rows.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1").select("token")
    members = stored(rows.join(shared, "token"), "jaccard-shared")
    each = members.groupBy("token").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "size")).alias("low"), F.max("key").alias("high"), F.bit_xor(F.xxhash64("key")).alias("all")
    )
    once = each.groupBy("n", "low", "high", "all").agg(F.min("token").alias("token")).select("token", "low")
    return stored(members.join(once, "token"), "jaccard-buckets")


def near_in_size(a, b):
    return F.least(a, b) * OF >= F.greatest(a, b) * PARTS


def slot(column, bits: int):
    return F.pmod(F.xxhash64(column), F.lit(bits))


def bitmap(ids: DataFrame) -> np.ndarray:
    """Bits of the ids' slots, at least 16 for each: lets all wanted documents through, and few others."""
    bits = 1 << max(10, (16 * ids.count()).bit_length())
    one = F.expr("shiftleft(1L, cast(slot % 64 AS int))")
    rows = ids.select(slot(F.col("rep"), bits).alias("slot")).groupBy(F.expr("slot div 64").alias("at")).agg(F.bit_or(one).alias("word"))
    out = np.zeros(bits // 64, np.int64)
    for row in rows.collect():  # at most a word for four ids
        out[row["at"]] = row["word"]
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def whole_sets(docs: DataFrame, sets: DataFrame, keys: DataFrame, width: int = WIDTH) -> DataFrame:
    """(key, shingles) of the wanted keys, once each, and of a few more. The texts never move."""
    wanted = sets.select("key", "rep").join(keys, "key", "left_semi")
    found = bitmap(wanted.filter("rep IS NOT NULL").select("rep"))

    def run(batch: pa.RecordBatch):
        at = batch.column("slot").to_numpy(zero_copy_only=False)
        free = batch.column("slot").is_null().to_numpy(zero_copy_only=False)
        some = batch.filter(pa.array(free | found[np.where(free, 0, at).astype(np.int64)]))
        values = [shingles(text, width) for text in texts(some)]
        yield [[key_of(s) for s in values], values]

    marked = docs.select(F.when(F.col("doc_id").isNotNull(), slot(F.col("doc_id").cast("long"), len(found))).alias("slot"), "text")
    rows = map_rows(marked, run, "key long, shingles array<long>", TEXTS)
    return stored(rows.groupBy("key").agg(F.first("shingles").alias("shingles")), "jaccard-whole")


def with_set(pairs: DataFrame, whole: DataFrame, side: str, other: str) -> DataFrame:
    """Add the set of one side; one that many pairs need is repeated, so that they meet in several tasks."""
    copies = pairs.groupBy(side).agg(F.ceil(F.count("*") / SALT).alias("_copies"))
    hot = cut_lineage(pairs.sparkSession, copies.filter("_copies > 1"))
    salted = pairs.join(hot, side, "left").withColumn("_salt", F.pmod(F.xxhash64(other), F.coalesce("_copies", F.lit(1)))).drop("_copies")
    named = whole.withColumnsRenamed({"key": side, "shingles": f"_{side}"}).join(hot, side, "left")
    spread = named.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_copies", F.lit(1)) - 1))).drop("_copies")
    return salted.join(spread, [side, "_salt"]).drop("_salt")


def compared(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """(a, b, _shared, _n, _m): the number of common values, and the sizes."""
    both = with_set(with_set(pairs, values, "b", "a"), values, "a", "b")
    return both.select("a", "b", F.size(F.array_intersect("_a", "_b")).alias("_shared"), "_n", "_m")


def verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The pairs (a, b) of similarity 4/5 or more.

    Bitmaps go first, then prefixes. Beyond the earlier end of the two prefixes one set has ``ceil(4n/5) - 1`` shingles at most,
    and up to there all common shingles are in both prefixes: fewer of them than is missing from
    the overlap that the threshold asks for, 4/9 of both sizes, rule a pair out.
    """
    with scratch(docs.sparkSession):
        return _verified(docs, sets, pairs, width)


def linked(docs: DataFrame, sets: DataFrame, pairs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Pairs (a, b) of similarity 4/5 or more, with the components of all such pairs among ``pairs``.

    In a group of near copies all meet all. Each set meets one set of each component it has not met yet first; in the end
    all pairs are verified that are still apart, so no link between components is lost.
    """
    left = stored(pairs.select("a", "b", "_n", "_m").distinct(), "jaccard-met").withColumn("_root", F.lit(0).cast("long"))
    found = None
    for _ in range(TURNS):
        some = left.groupBy("b", "_root").agg(F.min(F.struct("a", "_n", "_m")).alias("pair")).select("pair.a", "b", "pair._n", "pair._m")
        some = stored(some, "jaccard-turn")
        alike = verified(docs, sets, some, width)
        found = alike if found is None else found.unionByName(alike)
        roots = cut_lineage(sets.sparkSession, components(found))
        ends = left.drop("_root").join(roots.withColumnsRenamed({"id": "a", "root": "_root"}), "a", "left")
        ends = ends.join(roots.withColumnsRenamed({"id": "b", "root": "_other"}), "b", "left").withColumn("_root", F.coalesce("_root", "a"))
        apart = ends.filter(F.col("_root") != F.coalesce("_other", "b")).drop("_other")
        left = stored(apart.join(some, ["a", "b"], "left_anti"), "jaccard-apart")
        if left.isEmpty():
            return found
    return found.unionByName(verified(docs, sets, left, width))


def _verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    met = stored(pairs.select("a", "b", "_n", "_m").distinct(), "jaccard-pairs")
    marks = stored(sets.select("key", F.col("bits").alias("shingles")).join(ends_of(met), "key", "left_semi"), "jaccard-bits")
    close = with_set(with_set(met, marks, "b", "a"), marks, "a", "b").filter(few_bits("_a", "_b", F.col("_n") + F.col("_m")))
    pairs = stored(close.select("a", "b", "_n", "_m"), "jaccard-close")
    ends = ends_of(pairs)
    heads = stored(sets.select("key", F.col("prefix").alias("shingles")).join(ends, "key", "left_semi"), "jaccard-heads")
    most = F.col("_shared") - 1 + F.ceil(F.greatest("_n", "_m") * PARTS / OF)
    likely = compared(pairs, heads).filter(most * (PARTS + OF) >= (F.col("_n") + F.col("_m")) * PARTS)
    likely = stored(likely.drop("_shared"), "jaccard-likely")
    whole = whole_sets(docs, sets, likely.select(F.explode(F.array("a", "b")).alias("key")).distinct(), width)
    alike = F.col("_shared") * OF >= (F.col("_n") + F.col("_m") - F.col("_shared")) * PARTS
    return stored(compared(likely, whole).filter(alike).select("a", "b"), "jaccard-links", keep=True)


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()


def few_bits(a: str, b: str, sizes: Column) -> Column:
    """The bitmaps ``a`` and ``b`` differ in no more bits than sets of similarity 4/5 may differ in shingles."""
    bits = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BITS // 64)]
    return reduce(Column.__add__, bits) * (PARTS + OF) <= sizes * (OF - PARTS)


def differ_little(a: str, b: str) -> Column:
    return few_bits(f"{a}.bits", f"{b}.bits", F.col(f"{a}.size") + F.col(f"{b}.size"))


def print_links(docs: DataFrame, sets: DataFrame, width: int = WIDTH) -> DataFrame:
    """Pairs (a, b) of keys of similar sets that SimHash finds: equal fingerprints by the smallest key, others within ``DISTANCE`` bits."""
    prints = stored(sets.groupBy("fp").agg(F.min("key").alias("rep")), "jaccard-prints")
    same = sets.select("key", "fp").join(prints, "fp").filter("key <> rep").select(F.col("rep").alias("a"), F.col("key").alias("b"))
    found = same.unionByName(fingerprint_links(prints, DISTANCE)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    sizes = sets.select("key", "size")
    sized = found.join(sizes.withColumnsRenamed({"key": "a", "size": "_n"}), "a").join(sizes.withColumnsRenamed({"key": "b", "size": "_m"}), "b")
    return linked(docs, sets, sized.filter(near_in_size(F.col("_n"), F.col("_m"))), width)


def links(docs: DataFrame, sets: DataFrame, width: int = WIDTH) -> DataFrame:
    """Pairs (a, b) of keys of similar sets; their components are those of all similar pairs."""
    near_prints = print_links(docs, sets, width)
    known = cut_lineage(sets.sparkSession, components(near_prints))
    members = buckets(sets)
    joined = members.join(known.withColumnsRenamed({"id": "key", "root": "_known"}), "key", "left")
    lows = known.select(F.col("id").alias("_low"), F.col("root").alias("_known_low"))
    joined = joined.withColumn("_low", F.col("low.key")).join(lows, "_low", "left")
    apart = F.coalesce("_known", "key") != F.coalesce("_known_low", "_low")
    starred = joined.filter(apart & near_in_size(F.col("size"), F.col("low.size")))
    stars = verified(docs, sets, starred.select(F.col("low.key").alias("a"), F.col("key").alias("b"), F.col("low.size").alias("_n"), F.col("size").alias("_m")), width)
    stars = stars.unionByName(near_prints)
    roots = cut_lineage(sets.sparkSession, components(stars))
    members = members.join(roots.withColumnsRenamed({"id": "key", "root": "_root"}), "key", "left").withColumn("_root", F.coalesce("_root", "key"))
    leaders = roots.select(F.col("id").alias("_low"), F.col("root").alias("_main"))
    members = members.withColumn("_low", F.col("low.key")).join(leaders, "_low", "left").withColumn("_main", F.coalesce("_main", "_low"))
    members = stored(members.select("token", "key", "size", "_root", "_main", "_low"), "jaccard-members")
    apart = F.col("_root") != F.col("_main")
    open_buckets = members.filter(apart).select("token").distinct()
    near = members.join(open_buckets, "token", "left_semi").join(sets.select("key", "bits"), "key")
    near = stored(near, "jaccard-near")
    x, y = near.filter(apart).alias("x"), near.alias("y")
    once = (F.col("y._root") == F.col("y._main")) | (F.col("x.key") < F.col("y.key"))
    rest = x.join(
        y,
        (F.col("x.token") == F.col("y.token")) & (F.col("x._root") != F.col("y._root")) & (F.col("y.key") != F.col("y._low"))
        & once & near_in_size(F.col("x.size"), F.col("y.size")) & differ_little("x", "y"),
    ).select(
        F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b"),
        F.when(F.col("x.key") < F.col("y.key"), F.col("x.size")).otherwise(F.col("y.size")).alias("_n"),
        F.when(F.col("x.key") < F.col("y.key"), F.col("y.size")).otherwise(F.col("x.size")).alias("_m"),
    )
    return stars.unionByName(linked(docs, sets, rest, width))


def one_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents with the smallest id of their component, with all their columns.

    Repeated rows of a kept id and documents without id stay.
    """
    spark = docs.sparkSession
    with scoped_conf(spark, {CLEAN: "true"}), scratch(spark):
        sets = distinct_sets(docs, width)
        roots = stored(components(links(docs, sets, width)), "jaccard-roots", keep=True)
    grouped = sets.select("key", "rep").join(roots, sets["key"] == roots["id"], "left").groupBy(F.coalesce("root", "key").alias("root"))
    firsts = grouped.agg(F.min("rep").alias("rep")).select("rep").distinct()
    # The document as one column, so that none of its columns can clash.
    held = docs.select(F.col("doc_id").alias("rep"), F.struct("*").alias("document"))
    kept = held.filter("rep IS NOT NULL").join(firsts, "rep", "left_semi").unionByName(held.filter("rep IS NULL"))
    return kept.select("document.*")
