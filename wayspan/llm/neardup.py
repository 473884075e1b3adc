"""Near-duplicate documents: BagMinHash signatures, bands, verification, classes.

A document is the multiset of its five-word shingles.  A shingle with weight w
stands for a Poisson process on (0, w] x time.  The weight axis is discretised to
integers and cut into dyadic blocks [0, 1), [1, 2), [2, 4), ...; a block's points
come from one process at the block's full rate, and a point's place in the block,
read bit by bit, is its descent through halves of the block: it counts if it falls
below w.  Equal shingles therefore share their points up to the lesser weight, and
each register, the earliest point dealt to it, agrees between two documents with
probability sum(min) / sum(max), the weighted Jaccard similarity.

Links are verified on the multisets themselves (shingles of 48 bits).  Equal texts
are those of equal SHA-256.  Classes are the connected components of links; a class
is named by its least doc_id.

Within a bucket every text is compared with the least one, its centre.  A bucket
that this leaves in several classes is finished exactly: members outside the
centre's class meet all others, in blocks of bounded bytes, and a pair is passed
over only if both are in one class already or if their overlap is too small by a
bound that always holds.  So of the pairs that share a bucket no class is missed.

Defined cases: a text of one to four words has one shingle, all its words; a text
without words (null, empty) is alone in its class; equal texts form one class
through their digest, without any pairing; rows that share a doc_id share a class (of
their texts the greatest is compared, and ``keep_one`` keeps it); of equally good
names the least doc_id wins; a null doc_id has a null class; a very long text is
one row of every step, its bag 8 bytes a word; an empty table gives an empty result;
extra columns of any name and type are ignored, or kept by ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..tables import scope, settled
from . import textvec as tv

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Buckets up to this size that links with their centre leave in parts are finished pair by pair, larger ones in blocks.
SMALL = 24
#: Members and bytes of bags in a block, about; a text larger than that is a block with few others.
BLOCK, BLOCK_BYTES = 2048, 1 << 23
#: Texts that meet one copy of their centre's text.
STAR = 256
#: Parts of a bag whose sizes bound an overlap from above.
PARTS = 256


def shingles(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(48-bit shingle, row), sorted by row and shingle; repeats stand for weight."""
    starts, ends, row = tv.words(data, offs, ~tv.SPACE)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = tv.MAIN.ranges(tv.MAIN.prefix(data), starts, ends)
    five, at = tv.windows(h, row, SHINGLE)
    rows = row[at]
    # texts of fewer words than a shingle
    n = tv.by_row(row, len(offs) - 1)
    for k in range(1, SHINGLE):
        first = np.flatnonzero(n == k)
        if len(first):
            begin = np.searchsorted(row, first)
            short = h[begin].copy()
            for j in range(1, k):
                short = short * tv.U(0xF1357AEA2E62A9C5) + h[begin + j]
            five, rows = np.concatenate([five, tv.mix(short + tv.U(k))]), np.concatenate([rows, first])
    key = np.sort((rows.astype(np.uint64) << tv.U(48)) | (five >> tv.U(16)))
    return key & tv.U((1 << 48) - 1), (key >> tv.U(48)).astype(np.int64)


def weighted(shingle: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row with their weights."""
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return shingle[at], row[at], np.diff(np.append(at, len(shingle)))


def bag_minhash(shingle: np.ndarray, row: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """Earliest point of each register, n x registers; infinite in rows without shingles."""
    out = np.full(n * registers, np.inf)
    # (element, block): the first block is [0, 1); block j >= 1 is [2**(j - 1), 2**j)
    base, rows, low, width, top = [shingle], [row], [np.zeros(len(row))], [np.ones(len(row))], [weight]
    j, some = 1, np.flatnonzero(weight > 1)
    while len(some):
        base.append(tv.mix(shingle[some] + np.uint64(j * 0xA24BAED4963EE407 % 2**64)))
        rows.append(row[some])
        low.append(np.full(len(some), 2.0 ** (j - 1)))
        width.append(np.full(len(some), 2.0 ** (j - 1)))
        top.append(weight[some])
        some = some[weight[some] > 2**j]
        j += 1
    seed, rows = tv.mix(np.concatenate(base) + tv.U(1)), np.concatenate(rows)
    low, width, top = np.concatenate(low), np.concatenate(width), np.concatenate(top)
    total = np.bincount(row, weights=weight, minlength=n)
    todo = total > 0
    horizon = registers * (math.log(registers) + 3)
    while todo.any():
        limit = np.where(todo, horizon / np.maximum(total, 1), -1.0)
        on = todo[rows]
        s, r, lo, w, c = seed[on], rows[on], low[on], width[on], top[on]
        t = np.zeros(len(s))
        while len(s):
            s = s * tv.U(0xD1342543DE82EF95) + tv.U(0x9E3779B97F4A7C15)
            x = s ^ (s >> tv.U(32))
            x *= tv.U(0x9FB21C651E98DF25)
            x ^= x >> tv.U(29)
            t = t - np.log(((x >> tv.U(11)).astype(np.float64) + 0.5) * 2.0**-53) / w
            live = np.flatnonzero(t < limit[r])
            s, r, lo, w, c, t, x = s[live], r[live], lo[live], w[live], c[live], t[live], x[live]
            y = tv.mix(x + tv.U(0x632BE59BD9B4E019))
            place = lo + (y >> tv.U(32)).astype(np.float64) * (2.0**-32 * w)
            hit = np.flatnonzero(place < c)
            np.minimum.at(out, r[hit] * registers + ((y[hit] & tv.U(0xFFFFFFFF)) % tv.U(registers)).astype(np.int64), t[hit])
        todo &= np.isinf(out.reshape(n, registers)).any(axis=1)
        horizon *= 2
    return out.reshape(n, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band."""
    v = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), bands, -1)
    key = np.full(v.shape[:2], tv.U(17)) + np.arange(bands, dtype=np.uint64)
    for j in range(v.shape[2]):
        key = tv.mix(key * tv.U(0xF1357AEA2E62A9C5) + v[:, :, j])
    return key.view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, offs in tv.text_slices(b.column("text"), tv.CHUNK_BYTES // 2):
            n = hi - lo
            s, row = shingles(data, offs)
            filled = np.bincount(row, minlength=n) > 0
            keys = band_keys(bag_minhash(*weighted(s, row), n))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, n), b.column("k").slice(lo, n), pa.array(filled), lists], ["doc_id", "k", "filled", "bands"])


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, k, filled, bands): SHA-256 of the text and its band keys; the texts are not shuffled."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2("text", 256)).alias("k"), "text")
    return d.mapInArrow(_signatures, "doc_id long, k binary, filled boolean, bands array<long>")


def tagged(shingle: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Shingles made distinct within their row by numbering repeats: overlaps of multisets become overlaps of sets."""
    n = len(shingle)
    new = np.ones(n, bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    nth = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    return np.where(nth == 0, shingle, tv.mix(shingle + nth.astype(np.uint64) * tv.U(0xA24BAED4963EE407)))


def _bags(col: pa.Array) -> list[np.ndarray]:
    out = []
    for _, _, data, offs in tv.text_slices(col):
        s, row = shingles(data, offs)
        t, border = tagged(s, row), np.searchsorted(row, np.arange(len(offs)))
        out += [t[border[i] : border[i + 1]] for i in range(len(offs) - 1)]
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return 0.0
    both = np.sort(np.concatenate([a, b]))
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(a) + len(b) - common)


def _verify(least: float):
    """Rows (a, salt, b, text) in order: the centre's own, where b is null, before the texts to compare it with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = np.zeros(0, np.uint64)
        for batch in batches:
            known = batch.column("b").is_valid().to_numpy(zero_copy_only=False)
            ok = np.zeros(len(known), bool)
            for i, bag in enumerate(_bags(batch.column("text"))):
                if not known[i]:
                    centre = bag
                elif min(len(centre), len(bag)) >= least * max(len(centre), len(bag)):
                    ok[i] = similarity(centre, bag) >= least
            if ok.any():
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    return run


def verified(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose multisets are similar enough; texts: (node, text).

    A centre's pairs are dealt to groups of ``STAR``, and each group gets its text once.
    """
    many = settled(pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("groups")))
    dealt = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), F.col("groups")).alias("salt"), "b")
    heads = many.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"))
    asked = dealt.unionByName(heads).withColumn("node", F.coalesce("b", "a"))
    rows = asked.join(texts.select("node", "text"), "node").select("a", "salt", "b", "text")
    return rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "b").mapInArrow(_verify(least), "a long, b long")


def _stars(members: DataFrame, *key: str) -> DataFrame:
    """(a, b): every member of a bucket with the least one.

    Centres are settled first: their join then has two exchanges of its own, and
    adaptive execution can split a bucket that a third of all texts share.
    """
    centre = settled(members.groupBy(*key).agg(F.min("node").alias("a"), F.max("node").alias("__hi")).where("a < __hi").drop("__hi"))
    return members.join(centre, list(key)).where("node != a").select("a", F.col("node").alias("b"))


def _packed_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) -> (node, bag, bytes)."""
    for b in batches:
        at = 0
        for lo, hi, data, offs in tv.text_slices(b.column("text")):
            s, row = shingles(data, offs)
            t, border = tagged(s, row), np.searchsorted(row, np.arange(len(offs)))
            bags = [np.sort(t[border[i] : border[i + 1]]).tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([b.column("node").slice(at, hi - lo), pa.array(bags, pa.binary()), pa.array([len(x) for x in bags], pa.int64())], ["node", "bag", "bytes"])
            at = hi


class _Block:
    """Members of two blocks of one bucket: ``x`` outside the centre's class, and ``y`` that they meet."""

    def __init__(self, band: int, same: bool):
        self.band, self.same = band, same
        self.rows: list[tuple[int, int, int, list[int], np.ndarray]] = []

    def links(self, least: float = SIMILARITY) -> Iterator[tuple[int, int]]:
        """Pairs that join classes, once each: similar ones whose members no earlier pair of the block has joined."""
        if not self.rows:
            return
        side, node, of = (np.array([r[i] for r in self.rows]) for i in range(3))
        bands, bags = np.array([r[3][: self.band] for r in self.rows]), [r[4] for r in self.rows]
        size = np.array([len(b) for b in bags])
        parts = np.array([np.bincount((b & tv.U(PARTS - 1)).astype(np.int64), minlength=PARTS) for b in bags], np.int32)
        for i in np.flatnonzero(side == 0).tolist():
            other = (of != of[i]) & (np.arange(len(node)) > i if self.same else side == 1)
            other &= np.minimum(size, size[i]) >= least * np.maximum(size, size[i])
            y = np.flatnonzero(other)
            if self.band and len(y):  # a pair that shares an earlier band is given by that one's bucket
                y = y[~(bands[y] == bands[i]).any(axis=1)]
            if not len(y):
                continue
            # the parts of two bags overlap by the lesser size at most
            bound = np.minimum(parts[y], parts[i]).sum(axis=1)
            enough = bound * (1 + least) >= least * (size[y] + size[i]) - 1e-6
            for j in y[enough][np.argsort(-bound[enough], kind="stable")].tolist():
                if of[i] != of[j] and similarity(bags[i], bags[j]) >= least:
                    of[of == of[j]] = of[i]
                    yield min(int(node[i]), int(node[j])), max(int(node[i]), int(node[j]))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket, pair of blocks and side; one pair of blocks is held at a time."""
    last, block = None, _Block(0, False)
    for b in batches:
        found = []
        cols = [b.column(c).to_pylist() for c in ("band", "key", "i", "j", "side", "node", "label", "bands")]
        for r, bag in zip(zip(*cols, strict=True), b.column("bag"), strict=True):
            if r[:4] != last:
                found += block.links()
                last, block = r[:4], _Block(r[0], r[2] == r[3])
            block.rows.append((*r[4:], np.frombuffer(bag.as_py(), np.uint64)))
        if found:
            yield _pairs(found)
    if found := list(block.links()):
        yield _pairs(found)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _in_blocks(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links that join the classes of large buckets: members outside the centre's class against all, block by block.

    A member outside goes, as x, to the pairs (its block, j) and, as y, to those of
    earlier blocks; one inside goes, as y, to the pairs (i, its block).
    """
    bags = settled(texts.join(members.select("node").distinct(), "node", "left_semi").select("node", "text").mapInArrow(_packed_bags, "node long, bag binary, bytes long"))
    sized = members.join(bags.select("node", "bytes"), "node")
    need = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("bytes") / BLOCK_BYTES))
    centre = settled(sized.groupBy("band", "key").agg(F.min_by("label", "node").alias("main"), need.alias("blocks")))
    m = members.drop("n").join(centre, ["band", "key"])
    m = m.withColumns({"block": F.pmod(F.xxhash64("node"), F.col("blocks")), "out": F.col("label") != F.col("main"), "every": F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)})
    place = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    mine = F.col("block")
    as_x = F.transform("every", lambda k: place(mine, k, 0))
    as_y = F.transform("every", lambda k: place(k, mine, 1))
    to = F.when(F.col("out"), F.concat(as_x, F.filter(as_y, lambda p: p["i"] < mine))).otherwise(as_y)
    dealt = m.select("band", "key", "node", "label", "bands", F.explode(to).alias("p")).select("band", "key", "p.*", "node", "label", "bands")
    rows = dealt.join(bags.select("node", "bag"), "node").repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j", "side", "node")
    return rows.select("band", "key", "i", "j", "side", "node", "label", "bands", "bag").mapInArrow(_compare, "a long, b long")


def distinct_texts(sig: DataFrame) -> DataFrame:
    """One row for each text: its least doc_id (node), digest and bands."""
    return sig.where("filled and doc_id is not null").groupBy("k").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))


def labels_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label) of the distinct texts that have verified links."""
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    pairs = settled(_stars(buckets, "band", "key").distinct())
    # texts that are a candidate at all (the open members below are among them), by the same plan at any size
    asked = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(asked.hint("merge"), "doc_id", "left_semi").groupBy(F.col("doc_id").alias("node")).agg(F.max("text").alias("text"))
    texts = settled(texts)
    first = settled(verified(pairs, texts))
    # buckets that their centre did not join into one class
    labels = settled(components(first))
    at = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    parts = settled(at.groupBy("band", "key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")).where("lo < hi").drop("lo", "hi"))
    open_ = settled(at.join(parts, ["band", "key"]).join(nodes.select("node", "bands"), "node"))
    small = open_.where(F.col("n") <= SMALL).select("band", "key", "node", "label")
    other = small.select("band", "key", F.col("node").alias("b"), F.col("label").alias("label_b"))
    more = small.join(other, ["band", "key"]).where("node < b and label != label_b").select(F.col("node").alias("a"), "b")
    more = settled(more.distinct().join(pairs, ["a", "b"], "left_anti"))
    large = open_.where(F.col("n") > SMALL)
    # what they found joins classes of the first links
    found = settled(verified(more, texts).unionByName(_in_blocks(large, texts)))
    of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}"))
    found = found.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    joined = components(found).withColumnRenamed("label", "top")
    known = labels.join(joined, F.col("label") == joined["node"], "left").select(labels["node"], F.coalesce("top", "label").alias("label"))
    return known.unionByName(joined.join(labels.select("node"), "node", "left_anti").select("node", F.col("top").alias("label")))


def _named(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signatures (doc_id, k, filled, bands) of all rows, and (k, node, class_id) of the distinct texts with words."""
    sig = settled(signatures(docs))
    nodes = settled(distinct_texts(sig))
    label = labels_of(docs, nodes)
    # settled, so that the join with all rows can split a text that a third of them share
    return sig, settled(nodes.select("k", "node").join(label, "node", "left").select("k", "node", F.coalesce("label", "node").alias("class_id")))


def classes(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, class_id (least doc_id of its class), copy_of (least doc_id with the same text)."""
    with scope() as kept:
        sig, texts = _named(docs)
        out = sig.select("doc_id", "k").join(texts, "k", "left")
        known = F.col("doc_id").isNotNull()
        return kept.result(out.select("doc_id", F.when(known, F.coalesce("class_id", "doc_id")).alias("class_id"), F.when(known, F.coalesce("node", "doc_id")).alias("copy_of")))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, that of least doc_id, with all columns; rows with a null id stay.

    Of rows that share this doc_id the one of greatest text stays, of equal texts that
    of the greatest digest over all columns.  Only such rows are grouped.
    """
    with scope() as kept:
        sig, texts = _named(docs)
        # a class is kept by its least id; a text without words is alone
        first = texts.where("node = class_id").select(F.col("node").alias("doc_id")).unionByName(sig.where("not filled and doc_id is not null").select("doc_id")).distinct()
        many = sig.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
        once, more = kept.result(first.join(many, "doc_id", "left_anti")), kept.result(first.join(many, "doc_id", "left_semi"))

    def of(ids: DataFrame) -> DataFrame:
        return docs.alias("d").join(ids.alias("f"), F.col("d.doc_id").cast("long") == F.col("f.doc_id"), "left_semi")

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(F.col("text"), F.sha2(F.to_json(whole), 256))
    one = of(more).groupBy(F.col("doc_id").alias("key")).agg(F.max_by(whole, order).alias("row"))
    # by the same plan at any size
    return of(once.hint("merge")).unionByName(one.select("row.*")).unionByName(docs.where("doc_id is null"))
