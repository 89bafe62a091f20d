"""SimHash near-duplicates, found by vantage-point trees over the Hamming space of the fingerprints.

1. Each text becomes a 64-bit fingerprint of its word shingles (a bit is set if more than half of the shingle hashes have it). Equal
   fingerprints form a class, named by its smallest doc_id; only classes go on.
2. Fingerprints with at most ``RADIUS`` differing bits agree in whole in one of RADIUS + 1 bands of bits. So the forest has one tree a
   band. Its upper levels partition by the Hamming distance from ``LEVELS`` vantage points inside the band. The radius there is 0, and
   by the triangle bound a fingerprint meets only the branch of its own distances: a shard.
3. Inside a shard the radius is RADIUS. A shard is partitioned by the distance of whole fingerprints from one more vantage point into
   blocks of at most ``BLOCK`` fingerprints; blocks whose ranges of distances are more than RADIUS apart are pruned by the triangle bound,
   all others (the neighbours over a boundary, and each block with itself) are queried, each pair of blocks a group of its own.
4. A task orders a pair of blocks by distance too, looks at the pairs inside that bound, and gives out links only between what it has
   not linked yet (a forest of at most as many links as fingerprints). Components come from all links.

Defined results: null, empty and word-less texts have fingerprint zero and are linked like any other; a text of fewer words than a
shingle has one shingle; rows with a null doc_id get a fingerprint but no component, and link nothing; rows of one doc_id are one node,
named by it, whatever their texts (their fingerprints are linked through it); ties cannot occur; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweave.llm import kernels as K
from eventweave.llm.components import components
from eventweave.llm.shared import discard, stored, table

SHINGLE = 5
RADIUS = 4
SEED = 42
#: Vantage points of the upper levels of each tree.
LEVELS = 12
#: Fingerprints of a block: two of them are what one task holds at a time (16 bytes each, and the pairs of a step).
BLOCK = 16_384
#: Pairs that a task looks at in one vectorised step.
STEP = 1 << 20
U64 = np.uint64


def fingerprint(text: bytes, size: int) -> int:
    """The fingerprint of one text, as an unsigned number."""
    words = text.lower().split()  # on bytes: lower-cases A-Z and splits at ASCII white space
    if not words:
        return 0
    flat = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    k = min(size, len(words))
    starts = (ends - lengths)[: len(words) - k + 1]
    hashes = np.array([xxhash.xxh64_intdigest(flat[i:j], SEED) for i, j in zip(starts.tolist(), ends[k - 1 :].tolist(), strict=True)], U64)
    total = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[lo : lo + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a long) of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint((t.as_py() or "").encode(), size) for t in b.column("text")), U64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(K.tidy(run), "doc_id long, fp long")


def bands(radius: int) -> list[int]:
    """Masks of radius + 1 bands that together hold all bits, each of nearly the same size."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def vantage_points(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, n, dtype=U64, endpoint=False)


def addresses(x: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint and band the branch it takes: its distances from the band's vantage points, 5 bits each."""
    out = np.zeros((len(x), radius + 1), np.int64)
    for k, mask in enumerate(bands(radius)):
        for v in vantage_points(LEVELS, 100 + k):
            out[:, k] = (out[:, k] << 5) | np.bitwise_count((x ^ v) & U64(mask)).astype(np.int64)
    return out


def placed(classes: DataFrame, radius: int) -> DataFrame:
    """band, shard, far, fp, node: each class once a tree; far is its distance from the vantage point of the shard."""
    if LEVELS > 12 or -(-64 // (radius + 1)) > 31:
        raise ValueError("an address holds twelve distances of up to 31")
    inner = vantage_points(1, 99)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("fp").to_numpy().view(U64)
            where = addresses(x, radius)
            far = np.bitwise_count(x ^ inner).astype(np.int32)
            for k in range(radius + 1):
                columns = [pa.array(np.full(len(x), k, np.int32)), pa.array(where[:, k]), pa.array(far), b.column("fp"), b.column("node")]
                yield pa.RecordBatch.from_arrays(columns, names=["band", "shard", "far", "fp", "node"])

    return classes.select("fp", "node").mapInArrow(run, "band int, shard long, far int, fp long, node long")


def dealt(points: DataFrame, radius: int, block: int) -> DataFrame:
    """band, shard, one, two, side, far, fp, node: each point in every pair of blocks (one <= two) that its block is queried in.

    Blocks are cut from the counts of a shard's distances, at most 65 rows a shard: a distance with more than ``block`` points is
    several blocks of its own."""
    cells = points.groupBy("band", "shard", "far").agg(F.count(F.lit(1)).alias("m"))
    shard = Window.partitionBy("band", "shard")
    cells = cells.withColumn("total", F.sum("m").over(shard)).where("total > 1")
    before = F.coalesce(F.sum("m").over(shard.orderBy("far").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a cell that alone fills a block is split by hash; others share one with the cells that begin in the same run of ``block`` points
    cells = cells.withColumn("parts", F.ceil(F.col("m") / block).cast("int")).withColumn("run", F.when(F.col("parts") > 1, -1 - F.col("far")).otherwise((before / block).cast("int")))
    runs = cells.groupBy("band", "shard", "run").agg(F.min("far").alias("lo"), F.max("far").alias("hi"), F.max("parts").alias("parts"))
    blocks = runs.select("band", "shard", "run", "lo", "hi", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    # names of blocks rise with the distance, so that each block lists the blocks at or after it that are in reach
    blocks = blocks.withColumn("name", F.row_number().over(shard.orderBy("lo", "hi", "part")))
    reach = F.collect_list(F.struct("name", "lo", "hi")).over(shard.orderBy("name").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    near = F.filter(reach, lambda o: (o["lo"] - F.col("hi") <= radius) & (F.col("lo") - o["hi"] <= radius))
    met = F.transform(near, lambda o: F.struct(F.least(o["name"], F.col("name")).alias("one"), F.greatest(o["name"], F.col("name")).alias("two")))
    blocks = blocks.withColumn("pairs", met)
    plan = cells.select("band", "shard", "far", "run", "parts").join(blocks.select("band", "shard", "run", "part", "name", "pairs"), ["band", "shard", "run"]).drop("run")
    rows = points.join(plan, ["band", "shard", "far"]).where("part = pmod(xxhash64(fp), parts)")
    out = rows.withColumn("p", F.explode("pairs"))
    return out.select("band", "shard", "p.one", "p.two", (F.col("name") != F.col("p.one")).cast("int").alias("side"), "far", "fp", "node")


def forest(x: np.ndarray, far: np.ndarray, side: np.ndarray, node: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (pairs of nodes) that join what is within the radius: between both sides, or on the one side if there is no other."""
    order = np.argsort(far, kind="stable")
    x, far, side, node = x[order], far[order], side[order], node[order]
    root = np.arange(len(x))
    out_a, out_b = [], []
    both = bool(side.any())
    stop = np.searchsorted(far, far + radius, "right")
    lo = 0
    while lo < len(x):
        hi = min(len(x), lo + max(1, STEP // max(1, int(stop[lo]) - lo)))
        hi = max(lo + 1, min(hi, lo + max(1, STEP // max(1, int(stop[hi - 1]) - lo))))
        top = int(stop[hi - 1])
        d = np.bitwise_count(x[lo:hi, None] ^ x[None, lo:top])
        i, j = np.nonzero(d <= radius)
        keep = j > i
        if both:
            keep &= side[lo + i] != side[lo + j]
        i, j = i[keep] + lo, j[keep] + lo
        while len(i):
            a, b = root[i], root[j]
            open_ = a != b
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            if not len(i):
                break
            # each tree with links hangs itself on the smallest tree it is linked with; what is left is looked at again
            low, high = np.minimum(a, b), np.maximum(a, b)
            pick = np.lexsort((low, high))
            first = pick[np.concatenate(([True], high[pick][1:] != high[pick][:-1]))]
            out_a.append(node[i[first]])
            out_b.append(node[j[first]])
            parent = np.arange(len(x))
            parent[high[first]] = low[first]
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up
            root = parent[root]
        lo = hi
    none = np.zeros(0, np.int64)
    return np.concatenate(out_a or [none]), np.concatenate(out_b or [none])


def links(classes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """a, b: links between nodes of classes (fp, node) that have the same components as all pairs within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = {c: b.column(c).to_numpy().astype(np.int64) for c in ("band", "shard", "one", "two", "side", "far", "fp", "node")}
            if held is not None:
                t = {c: np.concatenate((held[c], t[c])) for c in t}
            edge = np.zeros(len(t["fp"]) - 1, bool)
            for c in ("band", "shard", "one", "two"):
                edge |= t[c][1:] != t[c][:-1]
            cuts = np.concatenate(([0], np.flatnonzero(edge) + 1))
            yield from found(t, cuts)
            held = {c: v[cuts[-1] :] for c, v in t.items()}
        if held is not None:
            yield from found(held, np.array([0, len(held["fp"])]))

    def found(t: dict[str, np.ndarray], cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Links of the groups that end inside t."""
        a, b = [], []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi - lo > 1:
                one, two = forest(t["fp"][lo:hi].view(U64), t["far"][lo:hi], t["side"][lo:hi], t["node"][lo:hi], radius)
                a.append(one)
                b.append(two)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    rows = dealt(placed(classes, radius), radius, block)
    met = rows.repartition("band", "shard", "one", "two").sortWithinPartitions("band", "shard", "one", "two").mapInArrow(K.tidy(run), "a long, b long")
    return met.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable) for each row of docs."""
    each = stored(fingerprints(docs, size), "fingerprints")
    named = each.where("doc_id is not null")
    classes = stored(named.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    pairs = links(classes, radius, block)
    # rows of one doc_id with several fingerprints: the id links their classes
    several = named.groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select("doc_id")
    bridges = named.join(several, "doc_id").join(classes, "fp").where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    pairs = stored(pairs.union(bridges), "links")
    groups = components(pairs).groupBy("node").agg(F.min("component").alias("component"))
    own = classes.join(groups, "node", "left").select("fp", F.coalesce("component", "node").alias("c"))
    out = each.join(own, "fp", "left")
    discard(pairs)
    component: Column = F.when(F.col("doc_id").isNotNull(), F.col("c"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4)
