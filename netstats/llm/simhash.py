"""Near-duplicates by SimHash and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netstats.llm.components import components
from netstats.llm.shared import cut, pieces_of

#: Links differ in at most this many bits: one of two 32-bit segments then differs in one bit at most.
MAX_BITS = 3
#: A table bucket with more fingerprints than this is looked up by a finer key.
BUCKET = 512
#: Shingles whose bits are counted at a time, to bound the memory of a very long text.
BLOCK = 1 << 16


def simhash(text: str | None, shingle: int) -> int:
    """Signed 64-bit fingerprint: a bit is set where more than half of the shingle hashes set it."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.fromiter(map(len, words), np.int64, len(words))
    ends = (np.cumsum(ends + 1) - 1).tolist()
    starts = [0, *(x + 1 for x in ends)]
    width, digest = min(shingle, len(words)), xxhash.xxh64_intdigest
    counts, total = np.zeros(64, np.int64), len(words) - width + 1
    for at in range(0, total, BLOCK):
        to = min(at + BLOCK, total)
        hashes = [digest(joined[s:e], 42) for s, e in zip(starts[at:to], ends[at + width - 1 : to + width - 1], strict=True)]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fp of every document. A text without words has fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            fps = [simhash(x, shingle) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fp", T.LongType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _part(seg: Column, fp: Column) -> Column:
    """A 32-bit segment: 0 the lower half, 1 the upper half."""
    return F.when(seg == 0, fp.bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned(fp, 32))


def _fine(rest: Column, half: Column) -> Column:
    """Half of the segment that the bucket does not fix."""
    return F.when(half == 0, rest.bitwiseAND(F.lit(0xFFFF))).otherwise(F.shiftrightunsigned(rest, 16))


def near_pairs(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of the distinct `fp` that differ in one to three bits; a pair may appear twice.

    Each fingerprint stands in two tables, by its lower and its upper 32 bits. Two fingerprints
    with at most three different bits differ in at most one bit of one segment. So each looks up
    its own segment and those that set one more bit (of two segments that differ in one bit, exactly one has
    it unset), and every hit is verified over all 64 bits. Buckets of more than `bucket` fingerprints
    are divided by the halves of the other segment, where one half again differs in at most one
    bit: every such half is looked up with all its neighbours. No candidate is dropped.

    Spark does not see that unfolding makes many rows of one, so neither lookups nor the table are to be broadcast: these joins are by sort.
    """
    fp, seg = F.col("fp"), F.col("seg")
    table = fps.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("seg")).withColumn("value", _part(seg, fp))
    sizes = table.groupBy("seg", "value").agg(F.count("*").alias("n"))
    probes = (
        table.select("fp", "seg", F.col("value").alias("own"), F.explode(F.expr("array_append(transform(sequence(0, 31), b -> value | shiftleft(1L, b)), -1L)")).alias("value"))
        .where(F.col("value") != F.col("own"))
        .select(F.col("fp").alias("a"), "seg", F.when(F.col("value") == -1, F.col("own")).otherwise(F.col("value")).alias("value"), (F.col("value") == -1).alias("same"))
        .hint("merge")
        .join(sizes, ["seg", "value"])
        .where("NOT (same AND n = 1)")
    )
    light = probes.where(F.col("n") <= bucket).hint("merge").join(table.withColumnRenamed("fp", "b"), ["seg", "value"])
    halves = F.explode(F.array(F.lit(0), F.lit(1))).alias("half")
    rest, half = _part(1 - seg, F.col("b")), F.col("half")
    dense = (
        table.hint("merge").join(sizes.where(F.col("n") > bucket), ["seg", "value"])
        .select(F.col("fp").alias("b"), "seg", "value", halves)
        .withColumn("fine", _fine(rest, half))
    )
    asked = (
        probes.where(F.col("n") > bucket)
        .select("a", "seg", "value", "same", halves)
        .withColumn("own", _fine(_part(1 - seg, F.col("a")), half))
        .withColumn("fine", F.explode(F.expr("array_append(transform(sequence(0, 15), b -> own ^ shiftleft(1L, b)), own)")))
    )
    heavy = asked.hint("merge").join(dense, ["seg", "value", "half", "fine"])
    found = light.select("a", "b", "same").unionByName(heavy.select("a", "b", "same"))
    bits = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return found.where(bits.between(1, MAX_BITS) & (~F.col("same") | (F.col("a") < F.col("b")))).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id that links lead to, for every row of `docs`.

    Texts are read whole: A-Z in lower case, words between ASCII white space, shingles of `shingle` words
    with repeats, hashed by XXH64. Fingerprints with at most three different bits are linked. Equal
    fingerprints are one class, so copies cost one row each and no pairs. Null, empty and white texts have
    fingerprint zero and form one class. Repeated rows stay repeated. A null doc_id is in
    no way smaller than others: a component of nulls alone has component_id null. No rows give no rows.
    """
    prints = cut(fingerprints(docs, shingle))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(near_pairs(classes.select("fp")))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def hex_print(fp: Column) -> Column:
    """Sixteen lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
