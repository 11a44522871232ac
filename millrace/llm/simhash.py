"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints of 64 bits are split into partitions of correlated bits. If the partitions' thresholds
``t_i`` (-1 skips one) satisfy ``sum(t_i + 1) = t + 1``, two fingerprints within ``t`` bits are within ``t_i`` in
some partition i. Dynamic programming picks the number of partitions and the thresholds with the
least estimated work; each fingerprint is then indexed under its partition values and probes those
within ``t_i``, and the join itself verifies the distance.

Copies collapse first (one row per fingerprint). Buckets with more than ``hot_bucket`` members never
form pairs. Their members and probers are dealt into blocks, every two blocks meet in one task, and only the edges of a
spanning forest leave it: a row for each member at most, however many lie near one another. Beyond ``MOST_BLOCKS``
blocks they meet at midpoints instead (two fingerprints within ``t`` bits
share one within ``ceil(t / 2)`` of both, and two that share one are within ``t``, or linked by it for even
``t``), a fixed number of rows each, reduced to the smallest id per midpoint. Components come from
alternating large-star / small-star rounds over checkpointed edges.

Defined results: null and empty texts and texts of blanks have fingerprint zero, linked like any
other; fewer words than a shingle form one shingle; repeated rows keep one result row each; documents
without id take part but never name a component (null where no other is linked); a bit set in exactly half of the shingles (a tie) is 0;
very long texts are read whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import TEXTS, map_rows, stored, texts
from millrace.session import cut_lineage

BITS = 64
SEED = 42
SAMPLE = 2000  # fingerprints from which work is estimated; results do not depend on it
HOT_BUCKET = 1500
BLOCK, MOST_BLOCKS = 1 << 13, 8  # members of a hot bucket that meet in one task by two blocks; results do not depend on it
NO_ID = 1 << 62  # ids are below
LOT = 1 << 19  # probes of one batch
PAIR_COST, PROBE_COST = 1.0, 6.0  # measured: about 0.5 and 2.5 microseconds


def fingerprint(text: str, width: int = 4) -> int:
    words = text.encode().lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes + 1) - sizes - 1
        ends = (starts + sizes)[width - 1 :]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: len(ends)].tolist(), ends.tolist(), strict=True)]
    values = np.array(hashes, dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(values), 1 << 15):
        bits = np.unpackbits(values[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    out = np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0]
    return int(out)


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch):
        prints = np.array([fingerprint(text, width) for text in texts(batch)], dtype=np.uint64)
        yield [batch.column("doc_id"), prints.view(np.int64)]

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, fp long", TEXTS)


# -- partitions and thresholds


def bit_agreement(prints: DataFrame) -> np.ndarray:
    """64 x 64 correlation of the bits over all fingerprints; each task sends 64 rows."""

    def run(batches):
        total = np.zeros((BITS, BITS + 1))
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32)
            total[:, :BITS] += bits.T @ bits
            total[:, BITS] += len(bits)
        yield pa.RecordBatch.from_pydict({"bit": pa.array(range(BITS), pa.int32()), "sums": total.tolist()})

    rows = prints.select("fp").mapInArrow(run, "bit int, sums array<double>")
    each = rows.select("bit", F.posexplode("sums").alias("other", "n")).groupBy("bit", "other").agg(F.sum("n").alias("n"))
    joint = np.zeros((BITS, BITS + 1))
    for row in each.collect():  # 64 x 65 numbers
        joint[row["bit"], row["other"]] = row["n"]
    n = max(joint[0, BITS], 1.0)
    share = np.diag(joint[:, :BITS]) / n
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    return np.abs((joint[:, :BITS] / n - np.outer(share, share)) / np.outer(spread, spread))


def group_bits(agreement: np.ndarray, parts: int) -> list[list[int]]:
    """Greedy groups of near-equal width: start at the most correlated free bit, add its friends."""
    strength = agreement.copy()
    np.fill_diagonal(strength, 0)
    free, groups = set(range(BITS)), []
    for number in range(parts):
        width = (BITS + number) // parts
        if number == parts - 1:
            width = len(free)
        order = sorted(free)
        seed = max(order, key=lambda b: (strength[b, order].sum(), -b))
        group = [seed]
        free.remove(seed)
        while len(group) < width:
            best = max(sorted(free), key=lambda b: (strength[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def mask_of(bits) -> int:
    return sum(1 << b for b in bits)


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def candidate_share(sample: np.ndarray, mask: int, width: int, radius: int) -> float:
    """Estimated share of pairs within ``radius`` on the masked bits: the sample's, at least a random one's."""
    random = sum(math.comb(width, k) for k in range(radius + 1)) / 2**width
    if len(sample) < 2:
        return random
    values, near = sample & np.uint64(mask), 0
    for value in values:
        near += int((np.bitwise_count(values ^ value) <= radius).sum()) - 1
    return max(random, near / (len(sample) * (len(sample) - 1)))


def allocate(sample: np.ndarray, groups: list[list[int]], rows: int, distance: int) -> tuple[float, list[int]]:
    """Thresholds of least estimated work with ``sum(t_i + 1) = distance + 1``, by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for bits in groups:
        work = [0.0]
        for radius in range(distance + 1):
            probes = sum(math.comb(len(bits), k) for k in range(radius + 1))
            share = candidate_share(sample, mask_of(bits), len(bits), radius)
            work.append(rows * (probes + 1) * PROBE_COST + rows * rows * share * PAIR_COST)
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for units in range(distance + 2 - used):
                option = (cost + work[units], [*chosen, units - 1])
                if used + units not in after or option < after[used + units]:
                    after[used + units] = option
        best = after
    return best[distance + 1]


def plan(prints: DataFrame, rows: int, distance: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the cheapest split into 2 to ``distance`` partitions.

    One more partition would leave all thresholds at 0 and buckets of few bits, whose candidates grow with
    the square of the input; it pays for small inputs only, and there by seconds.
    """
    sample = np.array(
        [r["fp"] for r in prints.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], dtype=np.int64
    ).view(np.uint64)
    agreement = bit_agreement(prints)
    options = []
    for parts in range(2, distance + 1):
        groups = group_bits(agreement, parts)
        cost, chosen = allocate(sample, groups, rows, distance)
        options.append((cost, parts, list(zip(groups, chosen, strict=True))))
    return min(options, key=lambda o: o[:2])[2]


# -- probe and verify


def flips(bits, radius: int) -> np.ndarray:
    return np.array([mask_of(combo) for k in range(radius + 1) for combo in combinations(bits, k)], np.uint64)


def flipped(prints: DataFrame, parts: list[tuple[int, np.ndarray]]) -> DataFrame:
    """(fp, rep, part, value): each fingerprint under all of a part's flips, on the bits of the part's mask.

    The masks travel with the function, so plans stay small whatever their number.
    """

    def run(batch: pa.RecordBatch):
        fps = batch.column("fp").to_numpy(zero_copy_only=False)
        reps = batch.column("rep").to_numpy(zero_copy_only=False)
        for number, (mask, turns) in enumerate(parts):
            step = max(1, LOT // len(turns))
            for at in range(0, len(fps), step):
                some = fps[at : at + step]
                values = (some.view(np.uint64)[:, None] ^ turns) & np.uint64(mask)
                repeated = [np.repeat(c, len(turns)) for c in (some, reps[at : at + step])]
                yield [*repeated, np.full(values.size, number, np.int32), values.ravel().view(np.int64)]

    return map_rows(prints.select("fp", "rep"), run, "fp long, rep long, part int, value long")


def links(prints: DataFrame, distance: int, hot_bucket: int = HOT_BUCKET, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between representatives whose fingerprints differ in at most ``distance`` bits.

    ``prints`` holds (fp, rep), one row per fingerprint. Pairs of hot buckets are replaced by forests, or by stars
    around midpoints, that connect the same fingerprints.
    """
    scheme = [(bits, t) for bits, t in plan(prints, prints.count(), distance) if t >= 0]
    index = flipped(prints, [(mask_of(bits), flips(bits, 0)) for bits, _ in scheme])
    probe = flipped(prints, [(mask_of(bits), flips(bits, t)) for bits, t in scheme])
    hot = cut_lineage(prints.sparkSession, index.groupBy("part", "value").count().filter(F.col("count") > hot_bucket).select("part", "value"))
    crowd = None
    if hot.take(1):
        # What probes a bucket includes its members, with no bit flipped.
        crowd = crowded(stored(probe.join(hot, ["part", "value"], "left_semi"), "simhash-hot"), distance, block)
        index = index.join(hot, ["part", "value"], "left_anti")
        probe = probe.join(hot, ["part", "value"], "left_anti")
    left, right = probe.alias("q"), index.alias("x")
    near = F.bit_count(F.col("q.fp").bitwiseXOR(F.col("x.fp"))) <= distance
    pairs = (
        left.join(right, (F.col("q.part") == F.col("x.part")) & (F.col("q.value") == F.col("x.value")) & (F.col("q.fp") < F.col("x.fp")) & near)
        .select(F.col("q.rep").alias("a"), F.col("x.rep").alias("b"))
    )
    return stored((pairs if crowd is None else pairs.unionByName(crowd)).filter("a <> b").distinct(), "simhash-links")


def crowded(members: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect what lies near in the hot buckets; ``members`` holds (fp, rep, part, value)."""
    spark = members.sparkSession
    blocks = F.ceil(F.count("*") / block).cast("int").alias("blocks")
    placed = members.join(cut_lineage(spark, members.groupBy("part", "value").agg(blocks)), ["part", "value"])
    forest = forests(placed.filter(F.col("blocks") <= MOST_BLOCKS), distance)
    vast = placed.filter(F.col("blocks") > MOST_BLOCKS)
    if not vast.take(1):
        return forest
    return forest.unionByName(midpoint_stars(stored(vast.select("fp", "rep").distinct(), "simhash-dense"), distance))


def forests(placed: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) of a spanning forest of every two blocks of a bucket (of its only one)."""
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda n: (F.col("blocks") == 1) | (n != own))
    met = placed.withColumn("_other", F.explode(others))
    keys = ["part", "value", F.least(own, "_other").alias("_i"), F.greatest(own, "_other").alias("_j")]

    def run(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        reps = group.column("rep").to_numpy()
        ends = spanning(fps, distance)
        return pa.table({"a": reps[ends[0]], "b": reps[ends[1]]})

    return met.select(*keys, "fp", "rep").groupBy("part", "value", "_i", "_j").applyInArrow(run, "a long, b long")


def spanning(fps: np.ndarray, distance: int) -> np.ndarray:
    """Two rows of positions: edges of at most ``distance`` bits that connect all that such edges connect."""
    open_, values = np.arange(len(fps)), fps
    ends: list[np.ndarray] = [np.zeros((2, 0), np.int64)]
    while len(open_):
        waiting, open_, values = [open_[0]], open_[1:], values[1:]
        while waiting and len(open_):
            at = waiting.pop()
            near = np.bitwise_count(values ^ fps[at]) <= distance
            if near.any():
                found = open_[near]
                ends.append(np.stack([np.full(len(found), at), found]))
                waiting.extend(found.tolist())
                open_, values = open_[~near], values[~near]
    return np.concatenate(ends, axis=1)


def midpoint_stars(dense: DataFrame, distance: int) -> DataFrame:
    """Edges (smallest rep at a midpoint, rep): a fixed number of rows per fingerprint, no pairs."""
    spark = dense.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    whole = [(mask_of(range(BITS)), flips(range(BITS), distance // 2))]
    marks = flipped(dense.repartition(tasks, "fp"), whole).select("rep", F.col("value").alias("mid"))
    least = marks.groupBy("mid").agg(F.min("rep").alias("low"), F.count("*").alias("n")).filter("n > 1")
    return marks.join(least, "mid").select(F.col("low").alias("a"), F.col("rep").alias("b")).filter("a <> b").distinct()


# -- components


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, root) for every id in an edge; root is the smallest id reachable.

    Large-star / small-star rounds: each keeps the components and moves edges towards the root, and
    the number of rounds grows with the logarithm of the size. Edges never leave the executors.
    """
    spark = edges.sparkSession
    now = cut_lineage(spark, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
            .filter("u <> v")
            .distinct()
        )
        now = cut_lineage(spark, small)
        after = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if after == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
            )
        before = after
    raise RuntimeError(f"components did not settle within {most_rounds} rounds")


def near_duplicates(docs: DataFrame, distance: int = 4, width: int = 4, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document."""
    if distance < 2 or distance % 2:
        raise ValueError("the distance must be even: midpoints of hot buckets lie half-way")
    marked = stored(fingerprints(docs, width), "simhash")
    prints = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    # A fingerprint whose documents all lack an id gets a name beyond all ids while linking.
    beyond = F.xxhash64("fp").bitwiseAND(F.lit(NO_ID - 1)).bitwiseOR(F.lit(NO_ID))
    named = prints.withColumn("rep", F.coalesce("rep", beyond))
    roots = components(links(named, distance, hot_bucket))
    classes = (
        named.join(roots, named["rep"] == roots["id"], "left")
        .select("fp", F.coalesce("root", "rep").alias("component_id"))
        .withColumn("component_id", F.when(F.col("component_id") < NO_ID, F.col("component_id")))
    )
    return marked.join(classes, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, distance: int = 4, width: int = 4) -> DataFrame:
    """The documents that name their component, with all their columns.

    Repeated rows of a kept id and documents without id stay.
    """
    firsts = near_duplicates(docs, distance, width).filter("doc_id = component_id").select("doc_id").distinct()
    # The document as one column, so that none of its columns can clash.
    held = docs.select("doc_id", F.struct("*").alias("document"))
    kept = held.join(firsts, "doc_id", "left_semi").unionByName(held.filter("doc_id IS NULL"))
    return kept.select("document.*")
