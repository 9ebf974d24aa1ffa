"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netstats.llm.shared import cut, pieces_of

#: Buckets of hashed n-grams, and the bytes of an n-gram.
BUCKETS, GRAM = 1 << 16, 4
#: Labelled documents that the target model is fitted on, at most.
TARGET_DOCS = 20_000
#: Added to each bucket's count.
SMOOTHING = 1.0
#: Bytes whose n-grams are hashed at a time.
BLOCK = 1 << 20
#: Weights are those of a text of so many n-grams, whatever its length, so that long texts do not outweigh short ones.
LENGTH = 256
#: A text is as target-like as its least target-like stretch of so many n-grams (about a word), too: a few words that target
#: text never has would vanish in the mean. Logs of a stretch count so much more than those of LENGTH n-grams.
STRETCH, STRETCH_WEIGHT = 6, 4.0
#: A text counts as explained by the target model down to the log weights that all but this share of the sample reach,
#: less so much for an n-gram on average.
STRAY, SLACK = 0.001, 0.05
#: Bins of a pass that looks for the k-th largest value.
BINS = 4096


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the byte n-grams of the whole text, which is padded by a space on either side."""
    octets = np.frombuffer(b" " + text.encode() + b" ", np.uint8)
    for at in range(0, len(octets) - GRAM + 1, BLOCK):
        part = octets[at : at + BLOCK + GRAM - 1].astype(np.uint32)
        n = len(part) - GRAM + 1
        key = part[:n].copy()
        for i in range(1, GRAM):
            key |= part[i : i + n] << np.uint32(8 * i)
        key ^= key >> np.uint32(15)
        key *= np.uint32(0x9E3779B1)
        yield key >> np.uint32(16)


def counts(docs: DataFrame, targets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """N-gram counts over all texts of `docs`, and over those whose doc_id is in `targets`.

    Each task sums its texts into one row for each bucket; the driver gets BUCKETS rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in pieces_of(batches):
            for text, chosen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for found in grams(text or ""):
                    one = np.bincount(found, minlength=BUCKETS) if len(found) > 4096 else None
                    for row in total[: 1 + bool(chosen)]:
                        if one is None:
                            np.add.at(row, found, 1)
                        else:
                            row += one
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[0][used]), pa.array(total[1][used])], ["g", "raw", "target"])

    marked = docs.select("doc_id", "text").join(F.broadcast(targets), "doc_id", "left").select("text", F.col("chosen").isNotNull().alias("chosen"))
    rows = marked.mapInArrow(run, "g long, raw long, target long").groupBy("g").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for row in rows.collect():
        raw[row["g"]], target[row["g"]] = row["raw"], row["target"]
    return raw, target


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of the bucket's probability under the target model over that under the raw model."""
    share = [np.log((x + SMOOTHING) / (x.sum() + SMOOTHING * len(x))) for x in (target, raw)]
    return share[0] - share[1]


def log_weights(docs: DataFrame, ratio: np.ndarray, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns `also`, log_weight and lowest for every row of `docs`.

    log_weight is LENGTH times the mean `ratio` of the n-grams of the whole text; lowest is the least sum of `ratio` over
    STRETCH n-grams in a row, or over all if there are fewer. Both are 0 where there are none.
    """
    table = ratio.astype(np.float64)

    def weights(text: str | None) -> tuple[float, float]:
        total, n, lowest, tail = 0.0, 0, np.inf, np.zeros(0)
        for found in grams(text or ""):
            values = table[found]
            total, n = total + float(values.sum()), n + len(values)
            tail = np.concatenate([tail, values])
            if len(tail) >= STRETCH:
                lowest = min(lowest, float(sum(tail[i : len(tail) - STRETCH + 1 + i] for i in range(STRETCH)).min()))
            tail = tail[-(STRETCH - 1) :]
        return LENGTH * total / max(1, n), total if n < STRETCH else lowest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            found = np.array([weights(x) for x in batch.column(0).to_pylist()], np.float64).reshape(-1, 2)
            logs = [pa.array(found[:, i]) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *logs], ["doc_id", *also, "log_weight", "lowest"])

    kinds = [T.StructField(c, docs.schema[c].dataType) for c in ("doc_id", *also)]
    schema = T.StructType([*kinds, *[T.StructField(c, T.DoubleType()) for c in ("log_weight", "lowest")]])
    return docs.select("text", "doc_id", *also).mapInArrow(run, schema)


def gumbel(key: Column, seed: int) -> Column:
    """Gumbel noise that depends on `key` and `seed` alone, so that a repeated task draws the same."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double")
    return -F.log(-F.log((bits + 0.5) / F.lit(float(1 << 53))))


def kth_largest(values: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column without NaN; None if there are fewer than k.

    Each pass counts the values of BINS equal ranges and goes on within the one that holds the k-th.
    """
    low, high, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
    if k < 1 or n < k:
        return None
    while low < high:
        at = F.least(F.floor((F.col(column) - low) / F.lit((high - low) / BINS)), F.lit(BINS - 1))
        inside = values.where(F.col(column).between(low, high))
        bins = inside.groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for row in sorted(bins.collect(), key=lambda r: -r["at"]):
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
    return low


def good_sample(labels: DataFrame) -> DataFrame:
    """doc_id of the target sample: the TARGET_DOCS ids of label quality 1 with the smallest hash, without those labelled toxic."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL")
    if "toxic" in labels.columns:
        good = good.where("coalesce(toxic, 0) = 0")
    good = good.select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_DOCS).withColumn("chosen", F.lit(True))


def resample(
    docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 7, also: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, the columns `also`, log_weight, lowest, score and kept for every row of `docs`.

    The raw model is fitted on all of `docs`, the target model on the bounded sample of good ones. log_weight is the log
    of how much likelier a text of LENGTH n-grams like those of the document is as target text than as raw text, lowest that
    of its least target-like stretch. Both are measured from what all but STRAY of the target sample reach; score
    adds Gumbel noise to the smaller, and the `k` documents with the largest scores are kept: a sample without replacement
    in proportion to the weights. By default k is the number of documents that are about as target-like as that in
    both, so that all but borderline cases are decided by the models. Documents that tie with the
    k-th are kept too, so repeated rows stay together. Null and empty texts have logs of 0. Without good labels all
    have, and all are kept.
    """
    sample = cut(good_sample(labels))
    raw, target = counts(docs, sample)
    ratio = log_ratio(raw, target) if target.any() else np.zeros(BUCKETS)
    weighed = cut(log_weights(docs, ratio, also))
    marks = [F.percentile(c, F.lit(STRAY)) for c in ("log_weight", "lowest")]
    usual, usual_lowest = (x or 0.0 for x in weighed.join(F.broadcast(sample), "doc_id").agg(*marks).first())
    margin = F.least(F.col("log_weight") - usual, (F.col("lowest") - usual_lowest) * STRETCH_WEIGHT)
    scored = weighed.withColumn("score", margin + gumbel(F.col("doc_id"), seed))
    if k is None:
        k = weighed.where(margin >= -SLACK * LENGTH).count()
    least = kth_largest(scored, "score", min(k, scored.count()))
    return scored.withColumn("kept", F.lit(False) if least is None else F.col("score") >= least)
