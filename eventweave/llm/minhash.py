"""MinHash near-duplicates by bottom-k sketches of one hash function.

1. Each text becomes its set of shingle hashes. Texts with equal sets form a class; only one member of a class goes on.
2. A class retains the smallest part of its set in one order that all texts share: rarer shingles first (by a small table of shingle
   frequencies), by hash within. The number retained follows the size n of the set, n - ceil(0.8 n) + 1 for a similarity of 0.8: two
   similar sets then have a retained value in common for certain (their first common one), and the smaller set has it among its first
   n - ceil(1.6 n / 1.8) + 1. A frequent line or passage is seldom retained, as it comes last in the order.
3. Inverted lists of the retained values give candidates, in three turns. First each list links its members to one hub, which contracts
   groups of copies: a list of n members makes n candidates there. Then all pairs of list members that are still in different
   components are met, in blocks of ``BLOCK`` members, inside the tasks, and each member gives out its most similar partner of a list;
   last, they are met again, and every pair is given out that sizes, places in the lists and the minima of ``PARTS`` parts of the hash
   space let pass. The number of steps is fixed, and no pair of similar sets in different components is left out.
4. Candidates pass the estimate from the union sketch of their ``SKETCH`` smallest hashes (five standard deviations below the threshold
   still pass), then exact similarity of the full sets decides, of
   64-bit shingle hashes that are independent of the first ones. Components come from the confirmed links.

Defined results: null, empty and word-less texts have no shingles and are linked with nothing; rows with a null doc_id are linked
with nothing, have no component and are not kept; rows of one doc_id count as one document; the smallest doc_id of a component is
kept; ties cannot occur otherwise; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.llm import kernels as K
from eventweave.llm.components import components
from eventweave.llm.shared import BROADCAST_IDS, discard, stored, table, with_ids

SHINGLE = 5
PERCENT = 80
SKETCH = 64
#: Slots of the table of shingle frequencies. Shingles that share a slot only change the common order, not what it assures.
RANK_BITS = 18
#: Members of a list on the smaller side that are met with the others in one group.
BLOCK = 1024
#: An estimate may fall short of the similarity by so many standard deviations.
DEVIATIONS = 5
#: Parts of the hash space, each with one byte of its smallest hash.
PARTS = 512
#: Pairs that a task looks at in one vectorised step.
STEP = 1 << 15
#: Seed of the word hashes that links are confirmed with: words that collide in the first ones differ in these.
VERIFY = 1
DESCRIBED = "doc_id long, n long, digest binary, sketch binary, minima binary, slot int, m long"


def slots(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - RANK_BITS)).astype(np.int64)


def part_minima(s: np.ndarray) -> bytes:
    """A byte (1 to 255) of the smallest hash in each of PARTS parts (0 in an empty one) of sorted hashes."""
    part = (s >> np.uint64(55)).astype(np.int64)
    out = np.zeros(PARTS, np.uint8)
    first = np.concatenate(([True], part[1:] != part[:-1])) if len(s) else np.zeros(0, bool)
    out[part[first]] = s[first] % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def described(docs: DataFrame, size: int) -> DataFrame:
    """Two kinds of rows: doc_id, n (distinct shingles), digest of the set, sketch (the smallest hashes' upper 32 bits) and part minima of
    each row of docs (slot null); and slot, m: how many sets of a task have a shingle of that slot."""
    names = ["doc_id", "n", "digest", "sketch", "minima", "slot", "m"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RANK_BITS, np.int64)
        for b in batches:
            n, digest, sketch, minima = [], [], [], []
            for _, _, data, offs in K.text_chunks(b.column("text")):
                for s in K.shingle_sets(data, offs, size):
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    sketch.append((s[:SKETCH] >> np.uint64(32)).astype(np.uint32).tobytes())
                    minima.append(part_minima(s))
                    np.add.at(total, slots(s), 1)
            k = len(n)
            columns = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sketch, pa.binary()), pa.array(minima, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        at = np.flatnonzero(total)
        for lo in range(0, len(at), 1 << 16):
            own = at[lo : lo + (1 << 16)]
            k = len(own)
            columns = [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), pa.array(own.astype(np.int32)), pa.array(total[own])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(K.tidy(run), DESCRIBED)


def frequencies(each: DataFrame) -> np.ndarray:
    """How many sets have a shingle of each slot; the driver gets one row for each slot."""
    summed = each.where("slot is not null").groupBy("slot").agg(F.sum("m").alias("m")).toArrow()
    out = np.zeros(1 << RANK_BITS, np.int64)
    out[summed.column("slot").to_numpy()] = summed.column("m").to_numpy()
    return out


def indexed(percent: int, n: str = "n") -> Column:
    """How many of its first retained values a set of n shares one of with every larger similar set."""
    return F.expr(f"{n} - (({2 * percent} * {n} + {99 + percent}) div {100 + percent}) + 1")


def retained(texts: DataFrame, often: np.ndarray, size: int, percent: int) -> DataFrame:
    """key, node, n, at: the first n - ceil(n * percent / 100) + 1 shingles of each text in the common order, and their place there."""
    sent = texts.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            for lo, _, data, offs in K.text_chunks(b.column("text")):
                keys, nodes, sizes, places = [], [], [], []
                for i, s in enumerate(K.shingle_sets(data, offs, size)):
                    n = len(s)
                    if not n:
                        continue
                    keep = n - (percent * n + 99) // 100 + 1
                    order = np.argsort(sent.value[slots(s)], kind="stable")[:keep]  # s is sorted, so equal frequencies go by hash
                    keys.append(s[order].view(np.int64))
                    nodes.append(np.full(keep, ids[lo + i], np.int64))
                    sizes.append(np.full(keep, n, np.int32))
                    places.append(np.arange(keep, dtype=np.int32))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, nodes, sizes, places)], names=["key", "node", "n", "at"])

    return texts.select("doc_id", "text").mapInArrow(K.tidy(run), "key long, node long, n int, at int")


def estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """a, b, est of the pairs that sizes and union sketches let pass."""
    side = classes.select("node", "n", "sketch")
    full = pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    j = percent / 100
    least = j - DEVIATIONS * (j * (1 - j) / SKETCH) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            est = np.zeros(b.num_rows)
            for i, (x, y) in enumerate(zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True)):
                both = np.sort(np.concatenate((np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32))))
                new = np.concatenate(([True], both[1:] != both[:-1]))
                count = np.diff(np.flatnonzero(np.concatenate((new, [True]))))
                est[i] = (count[:SKETCH] > 1).mean()
            ok = pa.array(est >= least)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(est)], names=["a", "b", "est"]).filter(ok)

    return full.select("a", "b", "sa", "sb").mapInArrow(K.tidy(run), "a long, b long, est double")


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """a, b, linked: exact similarity of the full sets. Only the texts of the pairs are read again."""
    ids = stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct(), "ids")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [s.tobytes() for _, _, data, offs in K.text_chunks(b.column("text")) for s in K.shingle_sets(data, offs, size, seed=VERIFY)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "s"])

    full = with_ids(docs.select("doc_id", "text"), ids).mapInArrow(K.tidy(sets), "doc_id long, s binary")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = []
            for x, y in zip(b.column("sa"), b.column("sb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                same = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(same > 0 and 100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    joined = pairs.select("a", "b").join(full.toDF("a", "sa"), "a").join(full.toDF("b", "sb"), "b")
    return joined.mapInArrow(K.tidy(compare), "a long, b long, linked boolean").groupBy("a", "b").agg(F.max("linked").alias("linked"))


def with_component(rows: DataFrame, groups: DataFrame | None) -> DataFrame:
    """rows (with a column node) and c, the node's component so far."""
    return rows.withColumn("c", F.col("node")) if groups is None else rows.join(groups, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")


def to_hubs(lists: DataFrame, percent: int) -> DataFrame:
    """a < b: each list links its members to one of them; lists with common members draw the same one."""
    hubs = lists.groupBy("key").agg(F.min_by(F.struct("node", "n"), F.xxhash64("node")).alias("h"))
    left = lists.join(hubs, "key").where(f"node <> h.node and least(n, h.n) * 100L >= greatest(n, h.n) * {percent}L")
    return left.select(F.least("node", "h.node").alias("a"), F.greatest("node", "h.node").alias("b")).distinct()


def met_in_lists(lists: DataFrame, groups: DataFrame | None, classes: DataFrame, percent: int, every: bool) -> DataFrame:
    """a < b: the pairs of list members in different components that can be similar by their sizes, places and part minima; all of them,
    or for each member of a list the most similar one of those above it there.

    Parts with different minima hold a hash that only one of both sets has. So there are at most as many as such hashes, and as a share
    of all parts about one less the similarity, give or take some standard deviations."""
    now = with_component(lists, groups).withColumn("inside", F.col("at") < indexed(percent))
    shared = now.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count_if("inside").alias("many")).where("lo < hi and many > 0")
    left = now.join(shared.select("key", F.ceil(F.col("many") / BLOCK).cast("int").alias("blocks")), "key")
    # a member of the smaller side has a block of its own, and meets those of the other blocks as one of the larger side
    own = F.when(F.col("inside"), F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).otherwise(-1)
    dealt = left.withColumn("own", own).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", (F.col("block") != F.col("own")).cast("int"))
    minima = classes.groupBy("node").agg(F.first("minima").alias("minima"))
    rows = dealt.join(minima, "node").select("key", "block", "side", "node", "n", "at", "c", "minima")
    most = PARTS * (100 - percent) / 100
    most += DEVIATIONS * (most * percent / 100) ** 0.5

    def near(t: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of rows (of rising j) can be similar."""
        ni, nj = t["n"][i], t["n"][j]
        smaller = (ni < nj) | ((ni == nj) & (t["node"][i] < t["node"][j]))  # of two on the smaller side either may be it
        ok = (t["c"][i] != t["c"][j]) & (smaller | (t["side"][j] == 0)) & (100 * np.minimum(ni, nj) >= percent * np.maximum(ni, nj))
        # what stands from here on in both is the most they can share, if this is their first common value
        ok &= (100 + percent) * np.minimum(ni - t["at"][i], nj - t["at"][j]) >= percent * (ni + nj)
        k = np.flatnonzero(ok)
        far = (t["minima"][i[k]] != t["minima"][j[k]]).sum(1)
        close = far <= np.minimum(most, (ni[k] + nj[k]) * (100 - percent) // (100 + percent))
        k, far = k[close], far[close]
        if every or not len(k):
            return k
        order = np.lexsort((far, j[k]))
        own = j[k][order]
        return k[order[np.concatenate(([True], own[1:] != own[:-1]))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for b in batches:
            if not b.num_rows:
                continue
            t = {c: b.column(c).to_numpy().astype(np.int64) for c in ("key", "block", "side", "node", "n", "at", "c")}
            t["minima"] = np.frombuffer(b"".join(b.column("minima").to_pylist()), np.uint64).reshape(-1, PARTS // 8).view(np.uint8)
            old = 0
            if held is not None:
                old = len(held["key"])
                t = {c: np.concatenate((held[c], t[c])) for c in t}
            n = len(t["key"])
            new = np.concatenate(([True], (t["key"][1:] != t["key"][:-1]) | (t["block"][1:] != t["block"][:-1])))
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            small = np.cumsum(t["side"] == 0)
            before = small - (t["side"] == 0) - (small[first] - (t["side"][first] == 0))  # rows of the smaller side above it in the group
            before[:old] = 0
            total = np.concatenate(([0], np.cumsum(before)))
            lo = 0
            while lo < n:
                hi = max(int(np.searchsorted(total, total[lo] + STEP, "right")) - 1, lo + 1)
                j = np.repeat(np.arange(lo, hi), before[lo:hi])
                i = first[j] + np.arange(len(j)) - (total[j] - total[lo])
                k = near(t, i, j)
                if len(k):
                    x, y = t["node"][i[k]], t["node"][j[k]]
                    both = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y)), 1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])
                lo = hi
            own = slice(int(first[-1]), None)
            keep = t["side"][own] == 0
            held = {c: v[own][keep] for c, v in t.items()}

    met = rows.repartition("key", "block").sortWithinPartitions("key", "block", "side", "node").mapInArrow(K.tidy(run), "a long, b long")
    return met.where("a < b").distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs."""
    docs = docs.select("doc_id", "text")
    both = stored(described(docs, size), "described")
    each = both.where("slot is null").select("doc_id", "n", "digest", "sketch", "minima")
    named = docs.where("doc_id is not null")
    whole = each.where("doc_id is not null and n > 0").groupBy("digest")
    classes = stored(whole.agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("minima").alias("minima")), "classes")
    nodes = stored(classes.select(F.col("node").alias("doc_id")).distinct(), "nodes")
    values = stored(retained(with_ids(named, nodes), frequencies(both), size, percent), "retained")
    shared = values.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count_if(F.col("at") < indexed(percent)).alias("inside")).where("lo < hi and inside > 0").select("key")
    lists = stored(values.join(shared, "key", "left_semi"), "lists")
    discard(values)
    groups, tested = None, None
    for turn in range(3):
        pairs = met_in_lists(lists, groups, classes, percent, every=turn == 2) if turn else to_hubs(lists, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        passed = stored(estimated(pairs, classes, percent), "passed")
        if turn == 0:  # the best partner of each is enough at first: most lists close by it
            ends = [passed.select("a", "b", "est", F.col(side).alias("node")) for side in ("a", "b")]
            best = ends[0].union(ends[1]).groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("est", "a", "b")).alias("p"))
            passed = stored(best.select("p.a", "p.b").distinct(), "passed")
        done = stored(verified(passed.select("a", "b"), named, size, percent), "verified")
        fresh = done.where("linked").select("a", "b")
        tested = done.select("a", "b") if tested is None else tested.union(done.select("a", "b"))
        if fresh.limit(1).count():
            groups = few_or_all(grown(groups, fresh))
        discard(passed)
    discard(lists, nodes)
    own = classes.select("digest", "node")
    if groups is not None:
        own = own.join(groups, "node", "left").select("digest", F.coalesce("component", "node").alias("c"))
    else:
        own = own.select("digest", F.col("node").alias("c"))
    out = each.join(own, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.least(F.coalesce("c", "doc_id"), F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def grown(groups: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """The components (node, component) after more links. Links between old components are contracted first, so only those are worked on."""
    if groups is None:
        return components(fresh)
    of = lambda side: groups.toDF(side, f"c{side}")
    links = fresh.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joined = few_or_all(components(links).toDF("component", "new"))
    old = groups.join(joined, "component", "left").select("node", F.coalesce("new", "component").alias("component"))
    added = joined.select(F.col("component").alias("node"), F.col("new").alias("component")).join(groups.select("node"), "node", "left_anti")
    return stored(old.union(added), "groups")


def few_or_all(df: DataFrame) -> DataFrame:
    """df, marked to be sent to the tasks if it has at most BROADCAST_IDS rows (two ids each)."""
    return F.broadcast(df) if df.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else df


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4)
