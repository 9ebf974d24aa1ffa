"""Repeated passages by suffix automata of reference shards and matching statistics."""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netstats.llm.shared import pieces_of, shared_folder

#: Words of the grams that stand for a window.
GRAM = 8
#: An anchor that occurs more often is hot: its segments and windows are counted.
HOT = 2_000
#: Words in a reference shard, about; windows in a segment, at most.
SHARD_WORDS, SEGMENT = 60_000, 256


class SuffixAutomaton:
    """All subsequences of the sequences added, which never match across two of them."""

    def __init__(self) -> None:
        self.length, self.link, self.next = [0], [-1], [{}]
        self.inner = [True]  # copied, or some state's suffix link: ends at two or more places
        self.last = 0

    def add(self, words: Iterable[Hashable]) -> None:
        for word in words:
            self._extend(word)
        self._extend(len(self.length))  # a separator that occurs once

    def _extend(self, word: Hashable) -> None:
        length, link, steps, inner = self.length, self.link, self.next, self.inner
        new, p = len(length), self.last
        length.append(length[p] + 1)
        steps.append({})
        inner.append(False)
        link.append(0)
        while p >= 0 and word not in steps[p]:
            steps[p][word] = new
            p = link[p]
        if p >= 0:
            q = steps[p][word]
            if length[p] + 1 != length[q]:
                twin = len(length)
                length.append(length[p] + 1)
                steps.append(steps[q].copy())
                link.append(link[q])
                inner.append(True)
                while p >= 0 and steps[p].get(word) == q:
                    steps[p][word] = twin
                    p = link[p]
                link[q] = twin
                q = twin
            link[new] = q
            inner[q] = True
        self.last = new

    def repeated(self, words: list, width: int) -> list[int]:
        """Starts of the windows of `width` words that end at two or more places of the reference.

        The words are streamed once: the state is that of the longest match that ends here, cut to `width` words.
        """
        length, link, steps, inner = self.length, self.link, self.next, self.inner
        state, match, found = 0, 0, []
        for i, word in enumerate(words):
            while state and word not in steps[state]:
                state = link[state]
                match = length[state]
            if word not in steps[state]:
                continue
            state, match = steps[state][word], match + 1
            if match >= width:
                match = width
                while length[link[state]] >= width:
                    state = link[state]
                if inner[state]:
                    found.append(i - width + 1)
        return found


def anchors(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the smallest hash of its grams of GRAM words, its anchor; and the hashes of all grams.

    Equal windows have equal anchors, and neighbouring windows mostly the same.
    """
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    n = len(words) - GRAM + 1
    grams = hashes[:n].copy()
    for j in range(1, GRAM):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    least, span, goal = grams, 1, width - GRAM + 1
    while span * 2 <= goal:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < goal:
        least = np.minimum(least[: len(least) - (goal - span)], least[goal - span :])
    return least.view(np.int64), grams.view(np.int64)


def runs(least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of windows with the same anchor, SEGMENT windows long at most."""
    starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    ends = np.r_[starts[1:], len(least)]
    if (ends - starts).max() > SEGMENT:
        starts = np.concatenate([np.arange(a, b, SEGMENT) for a, b in zip(starts, ends, strict=True)])
        ends = np.r_[starts[1:], len(least)]
    return starts, ends


def _split(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def _anchor_rows(texts: DataFrame, width: int) -> DataFrame:
    """(m, k, n): each anchor of a text, the text's 64-bit hash, and how often the anchor's gram occurs in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            ms, ks, ns = [], [], []
            for k, text in zip(batch.column(0).to_numpy(), batch.column(1).to_pylist(), strict=True):
                words = _split(text)
                if len(words) < width:
                    continue
                least, grams = anchors(words, width)
                own = np.unique(least)
                at = np.minimum(np.searchsorted(own, grams), len(own) - 1)
                ns.append(np.bincount(at[own[at] == grams], minlength=len(own)))
                ms.append(own)
                ks.append(np.full(len(own), k))
            if ms:
                columns = [pa.array(np.concatenate(x)) for x in (ms, ks, ns)]
                yield pa.RecordBatch.from_arrays(columns, ["m", "k", "n"])

    return texts.select("k", "text").mapInArrow(run, "m long, k long, n long")


#: What the second reading of a text gives, by kind: D a document without repeats, R one with possible repeats,
#: S a segment of an anchor, H one of a hot anchor, as its hash and those of its windows.
_PARTS = (
    "kind string, n_words long, kept_sha256 string, text string, key binary, m long, words string, "
    "segment binary, windows array<binary>, start long"
)


def _parts(docs: DataFrame, id_type: T.DataType, width: int) -> DataFrame:
    schema = T.StructType([T.StructField("doc_id", id_type), *T._parse_datatype_string(_PARTS).fields])
    names = [f.name for f in schema]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.binary()), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            rows, ids = [], []
            for i, (text, light, hot) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True)):
                words = _split(text)
                ids.append(i)
                if len(words) < width or not (light or hot):
                    rows.append(("D", len(words), hashlib.sha256(b" ".join(words)).hexdigest(), *[None] * 7))
                    continue
                key = hashlib.md5(text.encode()).digest()
                rows.append(("R", len(words), None, text, key, *[None] * 5))
                starts, ends = runs(least := anchors(words, width)[0])
                of = least[starts]
                for a, b in zip(*(x[np.isin(of, light or [])].tolist() for x in (starts, ends)), strict=True):
                    segment = b" ".join(words[a : b + width - 1]).decode()
                    rows.append(("S", None, None, None, key, int(least[a]), segment, None, None, a))
                for a, b in zip(*(x[np.isin(of, hot or [])].tolist() for x in (starts, ends)), strict=True):
                    segment = xxhash.xxh3_128_digest(b" ".join(words[a : b + width - 1]))
                    windows = [xxhash.xxh3_128_digest(b" ".join(words[i : i + width])) for i in range(a, b)]
                    rows.append(("H", None, None, None, key, None, None, segment, windows, a))
                ids += [None] * (len(rows) - len(ids))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), *columns], names)

    return docs.mapInArrow(run, schema)


def _merged(starts: Iterable[int], width: int) -> Iterator[tuple[int, int]]:
    """Word spans that the windows at these ascending starts cover."""
    low = high = None
    for at in starts:
        if high is None or at > high:
            if high is not None:
                yield low, high
            low = at
        high = at + width
    if high is not None:
        yield low, high


def _stream(segments: DataFrame, width: int) -> DataFrame:
    """(key, low, high): word spans of the segments' windows that have a second place.

    Segments come in the order of their anchors. Those of some anchors at a time make a reference shard, which holds
    every distinct segment once; its automaton is built, its segments are streamed through it, and it is dropped.
    """

    def solve(rows: list[tuple]) -> Iterator[tuple]:
        copies = Counter((m, words) for m, words, _, _ in rows)
        automaton, split = SuffixAutomaton(), {}
        for m, words in copies:
            split[m, words] = sequence = words.split(" ")
            automaton.add(sequence)
        spans = {}
        for each, n in copies.items():
            sequence = split[each]
            starts = range(len(sequence) - width + 1) if n > 1 else automaton.repeated(sequence, width)
            spans[each] = list(_merged(starts, width))
        for m, words, key, start in rows:
            for low, high in spans[m, words]:
                yield key, start + low, start + high

    def batch(found: Iterable[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[], [], []]
        kinds = [pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["key", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, seen, held, last = [], set(), 0, None
        for part in pieces_of(batches):
            for row in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                if row[0] != last:
                    if held >= SHARD_WORDS:
                        yield batch(solve(rows))
                        rows, seen, held = [], set(), 0
                    last = row[0]
                rows.append(row)
                if (row[0], row[1]) not in seen:
                    seen.add((row[0], row[1]))
                    held += row[1].count(" ") + 1
        if rows:
            yield batch(solve(rows))

    ordered = segments.select("m", "words", "key", "start").repartition("m").sortWithinPartitions("m")
    return ordered.mapInArrow(run, "key binary, low long, high long")


def _counted(segments: DataFrame, width: int) -> DataFrame:
    """(key, low, high): as `_stream`, for hot anchors, by counting.

    Equal segments are counted before the shuffle; of those that have a copy, all windows do. Only the windows of the
    others are looked up among the windows of all distinct segments.
    """
    distinct = segments.groupBy("segment").agg(F.count("*").alias("copies"), F.first("windows").alias("windows"))
    windows = distinct.select("segment", "copies", F.posexplode("windows").alias("at", "window"))
    again = windows.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window")
    alone = windows.where("copies = 1").join(again, "window").groupBy("segment").agg(F.collect_set("at").alias("found"))
    places = segments.select("segment", "key", "start", F.size("windows").alias("n"))
    low = F.col("start")
    whole = places.join(distinct.where("copies > 1").select("segment"), "segment").select(
        "key", low.alias("low"), (low + F.col("n") + width - 1).alias("high")
    )
    some = places.join(alone, "segment").select("key", low, F.explode("found").alias("at"))
    return whole.unionByName(some.select("key", (low + F.col("at")).alias("low"), (low + F.col("at") + width).alias("high")))


def _finish(docs: DataFrame) -> DataFrame:
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    kinds = [T.LongType(), T.LongType(), T.StringType()]
    schema = T.StructType([docs.schema["doc_id"], *map(T.StructField, names[1:], kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            counts, removed, digests = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = _split(text)
                stays = np.ones(len(words), bool)
                for span in spans or []:
                    stays[span["low"] : span["high"]] = False
                counts.append(len(words))
                removed.append(int(len(words) - stays.sum()))
                digests.append(hashlib.sha256(b" ".join([w for w, s in zip(words, stays.tolist(), strict=True) if s])).hexdigest())
            columns = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return docs.mapInArrow(run, schema)


def repeats_removed(docs: DataFrame, width: int = 35, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 for every row of `docs`.

    Words stand between ASCII white space. A window is `width` consecutive words of a document; every word is removed that a
    window covers whose words also start anywhere else, in this or another document. Windows are judged on the input. Null
    and empty texts have no words; repeated rows are documents of their own, so each repeats the other. No rows give no rows.

    The reference is the whole table, too large for one automaton or for passing all of it through each. So it is
    divided by content: a window's anchor is the smallest hash of its grams, equal windows share it, and a run of windows
    with one anchor is a segment. An anchor whose gram occurs once cannot belong to a repeated window. Segments
    of the others are dealt to tasks by anchor, where reference shards of bounded size become suffix automata,
    and the segments are streamed through the shard that holds their anchor. Each window is judged by the
    automaton that has all windows equal to it. Segments of an anchor with more than `hot` occurrences would make one shard
    too large: these, and then their windows, are counted by 128-bit hash, combined before the shuffle.
    """
    spark, id_type = docs.sparkSession, docs.schema["doc_id"].dataType
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("k", F.xxhash64("text"))
    found = _written(_anchor_rows(texts, width), f"{folder}/anchors")
    often = found.groupBy("m").agg(F.sum("n").alias("total")).where("total > 1")
    light, heavy = F.col("total") <= hot, F.col("total") > hot
    flags = (
        found.join(often, "m")
        .groupBy("k")
        .agg(F.collect_set(F.when(light, F.col("m"))).alias("light"), F.collect_set(F.when(heavy, F.col("m"))).alias("hot"))
    )
    parts = _written(_parts(texts.join(flags, "k", "left").select("doc_id", "text", "light", "hot"), id_type, width), f"{folder}/parts")
    spans = _stream(parts.where("kind = 'S'"), width).unionByName(_counted(parts.where("kind = 'H'"), width))
    by_text = spans.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    suspects = parts.where("kind = 'R'").select("doc_id", "text", "key").join(by_text, "key", "left")
    clean = parts.where("kind = 'D'").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256")
    return clean.unionByName(_finish(suspects.select("doc_id", "text", "spans")))


def _written(df: DataFrame, path: str) -> DataFrame:
    """The same rows as a table in the shared folder."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
