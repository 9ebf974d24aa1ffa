"""Near-duplicates by SetSketch: banded registers, a joint likelihood, and full sets of shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netstats.llm.components import components
from netstats.llm.decontaminate import bounded
from netstats.llm.shared import cut, pieces_of

#: BANDS of ROWS registers each. Registers of sets of a Jaccard similarity of 0.8 are equal with probability 0.808, so such a pair
#: shares no band in about one of 900,000 cases.
BANDS, ROWS = 42, 6
REGISTERS = BANDS * ROWS
#: Registers hold floor(1 - log_BASE(h)), cut off to 0..255, of the minimum h of exponential values of rate RATE.
BASE, RATE = 1.1, 20.0
#: A pair goes to verification unless its estimated similarity is lower than the threshold by this: six standard deviations.
MARGIN = 0.15
#: Texts of a group that are compared block against block: so many in a block, about.
BLOCK = 256
#: Shingles hashed with all registers at a time.
STRIP = 128
_FACTORS = np.random.default_rng(20).integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of `width` words; of the whole sequence where it is shorter; none without words."""
    if not words:
        return np.zeros(0, np.uint64)
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    each = np.fromiter(map(xxhash.xxh64_intdigest, ids), np.uint64, len(ids))[code]
    width = min(width, len(words))
    n = len(words) - width + 1
    which, bound, hashed = code[:n], len(ids), np.full(n, width, np.uint64)
    for i in range(width):
        hashed = (hashed ^ each[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
        if i:
            if bound * len(ids) >= 1 << 62:
                which = np.unique(which, return_inverse=True)[1]
                bound = n
            which, bound = which * len(ids) + code[i : i + n], bound * len(ids)
    return np.sort(hashed[np.unique(which, return_index=True)[1]])


def registers(hashes: np.ndarray) -> np.ndarray:
    """The SetSketch of a set of hashes. Registers of a union are the larger ones of the parts'."""
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(small), STRIP):
        np.minimum(least, (small[at : at + STRIP, None] * _FACTORS).min(axis=0), out=least)
    h = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, 255).astype(np.uint8)


def similarity(above: np.ndarray, below: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarities of highest joint likelihood, where `above` and `below` registers are larger in sets of a and of b elements.

    With u and v the sizes as shares of their sum, a register of the first set is the larger one with probability p(u - vJ), of the
    second with p(v - uJ). The log-likelihood is concave in J, so thirds are cut off until the largest is met.
    """
    u, v = a / (a + b), b / (a + b)

    def larger(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = larger(u - v * j), larger(v - u * j)
        parts = ((above, p), (below, q), (REGISTERS - above - below, 1 - p - q))
        return sum(n * np.log(np.maximum(x, 1e-12)) for n, x in parts)

    low, high = np.zeros(len(u)), np.minimum(u, v) / np.maximum(u, v)
    for _ in range(24):
        one, two = low + (high - low) / 3, high - (high - low) / 3
        up = likelihood(one) < likelihood(two)
        low, high = np.where(up, one, low), np.where(up, high, two)
    return (low + high) / 2


def _similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have that Jaccard similarity."""
    if len(one) > len(other):
        one, other = other, one
    at = np.searchsorted(other, one)
    both = int((other[np.minimum(at, len(other) - 1)] == one).sum())
    return 100 * both >= percent * (len(one) + len(other) - both)


def _sketched(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, digest (of the text), key (of the words in order; null without words), n, regs for every row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            keys, sizes, regs = [], [], []
            for text in batch.column(2).to_pylist():
                words = text.encode().lower().split()
                hashes = shingle_hashes(words, width)
                keys.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                sizes.append(len(hashes))
                regs.append(registers(hashes).tobytes() if words else None)
            made = [pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(regs, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["doc_id", "digest", "key", "n", "regs"])

    rows = docs.select("doc_id", F.unhex(F.md5("text")).alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    kinds = [("digest", T.BinaryType()), ("key", T.BinaryType()), ("n", T.LongType()), ("regs", T.BinaryType())]
    return rows.mapInArrow(run, T.StructType([docs.schema["doc_id"], *(T.StructField(n, k) for n, k in kinds)]))


def _met(classes: DataFrame) -> DataFrame:
    """(band, c, pivot) for every class that shares a band's registers with another; pivot is the member with the smallest hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            found = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, BANDS, ROWS)
            value = np.zeros(found.shape[:2], np.int64) + np.arange(BANDS)
            for i in range(ROWS):
                value = value << 8 | found[:, :, i]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), BANDS)), pa.array(value.ravel())], ["c", "band"])

    rows = classes.select("c", "regs").mapInArrow(run, "c long, band long")
    first = F.min(F.struct(F.xxhash64("c").alias("order"), F.col("c").alias("pivot")))
    shared = rows.groupBy("band").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1").select("band", "first.pivot")
    return rows.join(shared, "band")


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(c, regs, hashes) of the classes in `wanted` (c): their full sets, from one text of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            hashes = [shingle_hashes(x.encode().lower().split(), width).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.binary())], ["c", "hashes"])

    asked = bounded(cut(classes.join(wanted, "c").select("digest", "c")))
    texts = docs.where("text IS NOT NULL").select(F.unhex(F.md5("text")).alias("digest"), "text")
    full = texts.join(asked, "digest").select("c", "text").dropDuplicates(["c"]).mapInArrow(run, "c long, hashes binary")
    return full.join(classes.select("c", "regs"), "c")


def _plausible(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, an, bn, ar, br) whose sketches do not speak against the similarity."""
    least = percent / 100 - MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, other = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, REGISTERS) for i in (4, 5))
                sizes = [batch.column(i).to_numpy().astype(float) for i in (2, 3)]
                found = similarity((one > other).sum(1), (one < other).sum(1), *sizes)
                yield batch.select([0, 1]).filter(pa.array(found >= least))

    return pairs.select("a", "b", "an", "bn", "ar", "br").mapInArrow(run, "a long, b long")


def _star_links(met: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): members of a band that are similar to its pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 100):
            pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            stays = [_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in pairs]
            yield batch.select([0, 1]).filter(pa.array(stays, pa.bool_()))

    pairs = met.where("c <> pivot").select(F.col("c").alias("a"), F.col("pivot").alias("b")).distinct()
    for m in "ab":
        pairs = pairs.join(classes.select(F.col("c").alias(m), F.col("n").alias(f"{m}n"), F.col("regs").alias(f"{m}r")), m)
    fits = 100 * F.least("an", "bn") >= percent * F.greatest("an", "bn")
    pairs = _plausible(pairs.where(fits), percent)
    for m in "ab":
        pairs = pairs.join(sets.select(F.col("c").alias(m), F.col("hashes").alias(f"{m}h")), m)
    return pairs.select("a", "b", "ah", "bh").mapInArrow(run, "a long, b long")


def _cross_links(met: DataFrame, rooted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): similar members of a band that belong to different components so far (`rooted`: c, root).

    A band's members join the group of the largest component among them, so that the bands of one crowd become one group. A group is cut into
    blocks of about BLOCK classes, and each two blocks are compared within a task: first their registers, then the
    full sets of those that these do not tell apart. So a crowd of any size costs a row for each class and block, no task holds more
    than two blocks, and only links come out.
    """
    least = percent / 100 - MARGIN

    def run(table: pa.Table) -> pa.Table:
        i, j = (table.column(x)[0].as_py() for x in ("i", "j"))
        blk, c, root = (table.column(x).to_numpy() for x in ("blk", "c", "root"))
        hashes = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("hashes")]
        regs = np.frombuffer(b"".join(table.column("regs").to_pylist()), np.uint8).reshape(-1, REGISTERS)
        size = np.array(list(map(len, hashes)), float)
        left, right = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
        links = []
        for x in left:
            fits = (root[right] != root[x]) & (100 * np.minimum(size[right], size[x]) >= percent * np.maximum(size[right], size[x]))
            ys = right[fits & (c[right] > c[x])] if i == j else right[fits]
            if len(ys):
                found = similarity((regs[ys] < regs[x]).sum(1), (regs[ys] > regs[x]).sum(1), np.full(len(ys), size[x]), size[ys])
                links += [(c[x], c[y]) for y in ys[found >= least] if _similar(hashes[x], hashes[y], percent)]
        ends = [pa.array([e[k] for e in links], pa.int64()) for k in (0, 1)]
        return pa.Table.from_arrays(ends, ["a", "b"])

    sizes = rooted.groupBy("root").agg(F.count("*").alias("size"))
    known = met.select("band", "c").join(rooted, "c").join(sizes, "root")
    by_band = known.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max(F.struct("size", "root")).alias("most"))
    mixed = by_band.where("low < high").select("band", F.col("most.root").alias("g"))
    entries = cut(known.join(mixed, "band").select("g", "c", "root").distinct())
    blocks = entries.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = entries.join(blocks, "g").withColumn("blk", F.pmod(F.xxhash64("c"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = placed.join(sets, "c").select("g", "c", "root", "blk", "regs", "hashes", other.alias("o"))
    dealt = dealt.select("g", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"), "blk", "c", "root", "regs", "hashes")
    return dealt.groupBy("g", "i", "j").applyInArrow(run, "a long, b long")


def set_duplicates(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles (long), component_id and kept (boolean) for every row of `docs`.

    A document's set holds the distinct shingles of `width` words of the whole text, A-Z in lower case; with fewer words the whole
    sequence. Documents are linked where 100 * intersection >= `percent` * union; component_id is the smallest doc_id that
    links lead to, and kept is true where that is the document's own. Texts without words, null and empty ones have an empty set and
    are linked with nothing. Texts of equal words in equal order are one class, so copies cost one row each; repeated rows stay, with
    the same result. A null doc_id is smallest only among nulls: component_id is then null, and kept true. Other columns are not read. No rows give no rows.

    Classes that share a band of registers are first compared with one of its members, which makes one component of most near copies;
    what is left apart within a band is compared in blocks. Links are confirmed on the full sets, as 64-bit hashes of their shingles.
    """
    rows = cut(_sketched(docs, width))
    grouped = rows.where("key IS NOT NULL").groupBy("key")
    classes = grouped.agg(F.min("doc_id").alias("first_id"), F.min("digest").alias("digest"), F.first("n").alias("n"), F.first("regs").alias("regs"))
    classes = cut(classes.withColumn("c", F.monotonically_increasing_id()))
    met = cut(_met(classes))
    sets = cut(_sets(docs, classes, met.select("c").distinct(), width))
    roots = components(_star_links(met, classes, sets, percent))
    root = F.coalesce("root", "c").alias("root")
    rooted = cut(classes.select("c").join(roots, F.col("c") == F.col("node"), "left").select("c", root))
    links = _cross_links(met, rooted, sets, percent)
    for m in "ab":
        links = links.join(rooted.select(F.col("c").alias(m), F.col("root").alias(f"{m}root")), m)
    joined = components(links.select(F.col("aroot").alias("a"), F.col("broot").alias("b"))).select("node", F.col("root").alias("top"))
    rooted = rooted.join(joined, F.col("root") == F.col("node"), "left").select("c", F.coalesce("top", "root").alias("root"))
    named = classes.select("c", "key", "first_id").join(rooted, "c")
    smallest = named.groupBy("root").agg(F.min("first_id").alias("smallest"))
    found = named.join(smallest, "root").select("key", "smallest")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    out = rows.select("doc_id", "key", "n").join(found, "key", "left").withColumn("component_id", component)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
