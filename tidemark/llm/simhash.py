"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints: XXH64 of every word shingle votes for 64 bits.  Two documents are
linked if their fingerprints differ in at most ``max_bits`` bits.

Search.  Distinct fingerprints are cut into ``max_bits + 2`` blocks of bits.  Two
that differ in at most ``max_bits`` bits agree on two blocks at least, so every
link lies inside some bucket of equal bits on a pair of blocks: Spark shuffles each
fingerprint once for each pair of blocks.  A task sorts its buckets by Gray rank, in
which neighbours differ in few bits, and builds a binary hierarchy over them.  An
upper node holds the bits that all its members share (a mask and a pattern).  Pairs
of nodes are descended together: only bits that became shared at this level are
compared, the differences add up along the way down, and a whole pair of groups is
dropped once they exceed the limit.  A pair whose groups can differ in no more
than the limit is linked as a whole, and a pair already in one component is
skipped, so neither copies nor dense groups are expanded into pairs.  The task
returns one edge for each linked fingerprint, towards the smallest of its component.

Hot buckets: one with more than ``block`` distinct fingerprints is dealt into
parts, and each pair of parts is a bucket of its own.  Copies share a fingerprint
and are collapsed by pre-aggregation before any of this.

Defined cases: null text counts as empty; a text without words has fingerprint zero
and is linked like any other; repeated rows are copies; a null id never is a
component's id unless all its ids are null.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, small_batches, written
from tidemark.llm.components import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
ROWS = 1 << 15      # shingles counted together
PAIRS = 1 << 17     # pairs of nodes descended together


def fingerprint(text: bytes, size: int, seed: int = 42) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes; zero without words."""
    w = text.translate(LOWER).split()
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    n = max(1, len(w) - size + 1)
    starts = np.r_[0, ends[:n - 1] + 1].tolist()
    stops = ends[min(size, len(w)) - 1:].tolist()
    one = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for k in range(0, n, ROWS):
        h = np.fromiter((one(joined[a:b], seed) for a, b in zip(starts[k:k + ROWS], stops[k:k + ROWS], strict=True)),
                        np.uint64)
        votes += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, size: int = 4, text_col: str = "text", out_col: str = "fp") -> DataFrame:
    """``df`` with the fingerprint as a long (the unsigned value's bits)."""

    @F.arrow_udf("long")
    def of(text: pa.Array) -> pa.Array:
        out: list[int] = []
        for k in range(0, len(text), 256):
            out.extend(fingerprint(t or b"", size) for t in text.slice(k, 256).cast(pa.binary()).to_pylist())
        return pa.array(np.array(out, np.uint64).view(np.int64))

    return small_batches(df).withColumn(fresh(df, out_col)[0], of(F.col(text_col)))


def block_masks(max_bits: int) -> list[int]:
    """One mask for each pair of blocks of bits."""
    edges = [round(64 * k / (max_bits + 2)) for k in range(max_bits + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [a | b for a, b in combinations(blocks, 2)]


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Position of each 64-bit word in the reflected Gray sequence."""
    rank = code.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Forest:
    """One binary hierarchy for each bucket, over its fingerprints in Gray order."""

    def __init__(self, bucket: np.ndarray, code: np.ndarray):
        order = np.lexsort((gray_rank(code), bucket))
        self.code, bucket = code[order], bucket[order]
        n = len(order)
        every, some = [self.code], [self.code]               # bits set in all members, in any member
        first, last = [np.arange(n)], [np.arange(n)]
        child = [np.full((n, 2), -1)]
        ids, group, base, roots = np.arange(n), bucket, n, []
        while len(ids):
            new = np.r_[True, group[1:] != group[:-1]]
            start = np.flatnonzero(new)
            size = np.diff(np.r_[start, len(ids)])
            alone = np.repeat(size == 1, size)
            roots.append(ids[alone])
            ids, group = ids[~alone], group[~alone]
            if not len(ids):
                break
            new = np.r_[True, group[1:] != group[:-1]]
            start = np.flatnonzero(new)
            at = np.arange(len(ids)) - np.repeat(start, np.diff(np.r_[start, len(ids)]))
            head = np.flatnonzero(at % 2 == 0)
            paired = np.r_[at[1:] % 2 == 1, False][head]
            low, high = ids[head], np.where(paired, ids[np.minimum(head + 1, len(ids) - 1)], ids[head])
            e, s, f, g = (np.concatenate(v) for v in (every, some, first, last))
            every, some = [e, e[low] & e[high]], [s, s[low] | s[high]]
            first, last = [f, f[low]], [g, g[high]]
            child.append(np.stack([low, np.where(paired, high, -1)], 1))
            ids, group = base + np.arange(len(head)), group[head]
            base += len(head)
        self.every, self.some, self.first, self.last = (np.concatenate(v) for v in (every, some, first, last))
        self.child, self.roots = np.concatenate(child), np.concatenate(roots) if roots else np.zeros(0, np.int64)

    def link(self, limit: int) -> np.ndarray:
        """For each fingerprint in order, the first position of its component inside its bucket."""
        label = np.arange(len(self.code))
        turns = np.zeros(len(label), np.int64)
        r = self.roots[self.child[self.roots, 0] >= 0]
        turns = np.arange(len(label))
        stack = [(r, r, np.zeros(len(r), np.uint64), np.zeros(len(r), np.int64))]
        while stack:
            a, b, seen, diff = stack.pop()
            if len(a) > PAIRS:
                stack.append((a[PAIRS:], b[PAIRS:], seen[PAIRS:], diff[PAIRS:]))
                a, b, seen, diff = a[:PAIRS], b[:PAIRS], seen[:PAIRS], diff[:PAIRS]
            # one component already: nothing to learn from this pair
            f, g = self.first, self.last
            same = (turns[f[a]] == turns[g[a]]) & (turns[f[b]] == turns[g[b]]) & (label[f[a]] == label[f[b]])
            ea, eb, sa, sb = self.every[a], self.every[b], self.some[a], self.some[b]
            shared = ~(ea ^ sa) & ~(eb ^ sb)                  # bits fixed on both sides
            diff = diff + np.bitwise_count((ea ^ eb) & shared & ~seen)
            most = np.bitwise_count((sa & ~eb) | (sb & ~ea))
            near = ~same & (diff <= limit)
            whole = near & (most <= limit)
            if whole.any():
                label = self._join(label, a[whole], b[whole])
                turns = np.cumsum(np.r_[0, label[1:] != label[:-1]])
            go = near & ~whole
            if not go.any():
                continue
            a, b, seen, diff = a[go], b[go], (seen | shared)[go], diff[go]
            own = a == b
            ca, cb = self.child[a], self.child[b]
            ca = np.where(ca[:, :1] < 0, np.stack([a, np.full(len(a), -1)], 1), ca)     # a leaf stays itself
            cb = np.where(cb[:, :1] < 0, np.stack([b, np.full(len(b), -1)], 1), cb)
            parts = []
            for i, j in ((0, 1), (1, 0), (0, 0), (1, 1)):
                ok = (ca[:, i] >= 0) & (cb[:, j] >= 0) & ~(own & (i > j))
                parts.append((ca[ok, i], cb[ok, j], seen[ok], diff[ok]))
            # the nearest pairs last, so that they come off the stack first
            stack.extend(p for p in parts if len(p[0]))
        return label

    def _join(self, label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """All members of the nodes ``a[k]`` and ``b[k]`` come into one component."""
        n = len(label)
        step = np.zeros(n + 1, np.int64)
        for node in (a, b):
            np.add.at(step, self.first[node], 1)
            np.add.at(step, self.last[node], -1)
        inside = np.flatnonzero(np.cumsum(step)[:n] > 0)      # members followed by a member of the same node
        x = np.r_[label[inside], label[self.first[a]]]
        y = np.r_[label[np.minimum(inside + 1, n - 1)], label[self.first[b]]]
        root = np.arange(n)
        while True:
            lo, hi = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
            if not (lo < hi).any():
                break
            np.minimum.at(root, hi, lo)
            while (root[root] != root).any():
                root = root[root]
        return root[label]


def bucket_edges(bucket: np.ndarray, code: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, first fingerprint of its component) inside the buckets."""
    forest = Forest(bucket, code)
    label = forest.link(limit)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return forest.code[moved], forest.code[label[moved]]


def link(fps: DataFrame, max_bits: int = 4, block: int = 100_000) -> DataFrame:
    """Edges (a, b) that connect the distinct long fingerprints ``fp`` as all links up to ``max_bits`` do."""
    spark = fps.sparkSession
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(max_bits)]
    by = F.array(*[F.struct(F.lit(t).cast("int").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                   for t, m in enumerate(masks)])
    rows = fps.select("fp", F.explode(by).alias("k")).select("fp", "k.t", "k.key")
    hot = written(rows.groupBy("t", "key").count().where(F.col("count") > block)
                  .select("t", "key", F.ceil(F.col("count") / block).cast("int").alias("parts")), "hot", narrow=True)
    if hot.isEmpty():
        dealt = rows.select("t", "key", F.lit(0).alias("part"), "fp")
    else:
        part = F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1),
                            lambda other: F.least(other, part) * F.lit(1 << 15) + F.greatest(other, part))
        dealt = rows.join(hot, ["t", "key"], "left").select("t", "key", F.explode(pairs).alias("part"), "fp")
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for x in it if x.num_rows]
        if not held:
            return
        t, key, part, fp = (np.concatenate([x.column(k).to_numpy(zero_copy_only=False) for x in held]) for k in range(4))
        held.clear()
        order = np.lexsort((part, key, t))
        new = np.r_[False, (np.diff(t[order]) != 0) | (key[order][1:] != key[order][:-1]) | (np.diff(part[order]) != 0)]
        bucket = np.cumsum(new)
        several = np.bincount(bucket)[bucket] > 1            # most buckets hold one fingerprint
        a, b = bucket_edges(bucket[several], fp[order][several].view(np.uint64), max_bits)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return dealt.repartition(width, "t", "key", "part").mapInArrow(search, "a long, b long")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, size: int = 4, max_bits: int = 4, block: int = 100_000,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, fp, root, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable by links, ``root`` the component's
    smallest fingerprint (unique even if ids repeat), ``row`` the XXH64 of the text.
    """
    narrow = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("row"), F.col(text_col).alias("_text"))
    fps = written(fingerprints(narrow, size, "_text").select("_id", "row", "fp"), "fingerprints")
    heads = written(fps.groupBy("fp").agg(F.min("_id").alias("head")), "distinct", narrow=True)
    roots = components(link(heads.select("fp"), max_bits, block))
    rooted = heads.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "head", F.coalesce("root", "fp").alias("root"))
    small = rooted.groupBy("root").agg(F.min("head").alias("component_id"))
    named = rooted.join(small, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select(F.col("_id").alias(id_col), "row", "fp", "root", "component_id")
