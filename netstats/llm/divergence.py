"""How sources of a language differ in their words, by chunk factorization."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netstats.llm.decontaminate import bounded
from netstats.llm.shared import cut, pieces_of, written

#: Fixed values of the result's contract: what a term is, the documents of a language that it must be in, the least count, the
#: unit of probabilities, the terms reported.
TERM, LEAST_DOCS, ADDED, UNIT, TOP_TERMS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", 30, 5, 1_000_000_000, 50
#: Bytes of text that a task counts at a time; the bits of a document's place and group within these.
PIECE_BYTES, ROW_BITS = 8 << 20, 31
#: Bits of the filter of chunks that matter: 16 MB.
FILTER_BITS = 1 << 27
#: Occurrences of a chunk beyond which its terms' counts are summed in several tasks first.
HOT = 1_000_000


def numbered(docs: DataFrame) -> DataFrame:
    """(lang, source, gid): the groups that occur, with numbers from 0 without gaps."""
    rows = docs.select("lang", "source").distinct().orderBy("lang", "source").withColumn("at", F.monotonically_increasing_id())
    rows = cut(rows.withColumn("part", F.shiftright("at", 33)).withColumn("place", F.col("at").bitwiseAND(F.lit((1 << 33) - 1))))
    # A window over one row for each partition.
    sizes = rows.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    return cut(rows.join(first, "part").select("lang", "source", (F.col("first") + F.col("place")).cast("int").alias("gid")))


def gathered(batches: Iterator[pa.RecordBatch], most: int = 1 << 30) -> Iterator[pa.Table]:
    """The rows (text last) in tables of about PIECE_BYTES of text and at most so many rows."""
    held, size, rows = [], 0, 0
    for batch in batches:
        for part in pieces_of(iter([batch]), min(200, most)):
            if held and rows + part.num_rows > most:
                yield pa.Table.from_batches(held)
                held, size, rows = [], 0, 0
            held.append(part)
            size, rows = size + part.column(part.num_columns - 1).nbytes, rows + part.num_rows
            if size >= PIECE_BYTES:
                yield pa.Table.from_batches(held)
                held, size, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def chunked(texts: pa.ChunkedArray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The chunks of the texts one after the other, A-Z in lower case, and how many each text has.

    Chunks lie between ASCII white space. No term holds any, so terms lie within chunks. Empty chunks at the ends of a text count here.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pa.concat_arrays(texts.cast(pa.large_string()).chunks)))
    return parts.flatten().dictionary_encode(), pc.list_value_length(parts).to_numpy()


def dictionary(docs: DataFrame) -> DataFrame:
    """(chunk, term, k, total): the terms of each different chunk of all texts, tokenized once; their number in it, its occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches):
            found = chunked(table.column(0))[0]
            times = np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))
            yield pa.RecordBatch.from_arrays([found.dictionary.cast(pa.string()), pa.array(times, pa.int64())], ["chunk", "total"])

    chunks = docs.select("text").mapInArrow(run, "chunk string, total long").groupBy("chunk").agg(F.sum("total").alias("total"))
    terms = chunks.select("chunk", "total", F.explode(F.regexp_extract_all("chunk", F.lit(TERM), F.lit(0))).alias("term"))
    return terms.groupBy("chunk", "term").agg(F.count("*").alias("k"), F.first("total").alias("total"))


def filter_bits(chunks: DataFrame) -> np.ndarray:
    """One bit for each of FILTER_BITS hashes, set where one of `chunks` (chunk) has it: a filter of fixed size."""
    place = F.pmod(F.xxhash64("chunk"), F.lit(FILTER_BITS))
    bits = chunks.select(F.floor(place / 32768).alias("at"), (place % 32768).alias("bit"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for at, held in bits.groupBy("at").agg(F.bitmap_construct_agg("bit")).collect():
        out[at * 4096 : (at + 1) * 4096] = np.frombuffer(held, np.uint8)
    return out


def _counted(docs: DataFrame, shift: int, wanted: DataFrame, lists: Callable, kinds: str) -> DataFrame:
    """(piece, chunk, ...): what `lists` makes of the chunks of each piece of `docs` (gid, text) and the documents that hold them.

    A piece is a bounded number of texts that a task reads one after the other. A row stands for a document: its `gid`, and below, in `shift`
    bits, its place in the piece. So what is shuffled are lists, and a chunk that a third of all documents hold is one
    row for each piece. Chunks that are not in `wanted` (chunk) are left out, but for a few whose hashes meet.
    """
    bits = docs.sparkSession.sparkContext.broadcast(filter_bits(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId() << 33
        for table in gathered(batches, 1 << shift):
            found, many = chunked(table.column(1))
            hashes = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in found.dictionary.to_pylist()), np.uint64, len(found.dictionary))
            at = (hashes & np.uint64(FILTER_BITS - 1)).astype(np.int64)
            usable = bits.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
            row = table.column(0).to_numpy().astype(np.int64) << shift | np.arange(table.num_rows)
            codes = found.indices.to_numpy().astype(np.int64)
            pairs = (codes << ROW_BITS | np.repeat(row, many))[usable[codes]]
            pairs, ns = np.unique(pairs, return_counts=True)
            kept = np.flatnonzero(usable)
            if len(pairs):
                key, columns = lists(pairs, ns)
                offsets = pa.array(np.append(np.searchsorted(key >> ROW_BITS, kept), len(key)), pa.int32())
                made = [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in columns]
                chunks = found.dictionary.take(pa.array(kept)).cast(pa.string())
                names = ["piece", "chunk", *(f"x{i}" for i in range(len(made)))]
                batch = pa.RecordBatch.from_arrays([pa.array(np.full(len(kept), piece)), chunks, *made], names)
                for start in range(0, batch.num_rows, 20_000):
                    yield batch.slice(start, 20_000)
            piece += 1

    return docs.select("gid", "text").mapInArrow(run, f"piece long, chunk string, {kinds}")


def postings(docs: DataFrame, shift: int, wanted: DataFrame) -> DataFrame:
    """(piece, chunk, rows, ns): the documents of a piece that hold the chunk, and how often each holds it."""

    def lists(pairs: np.ndarray, ns: np.ndarray) -> tuple:
        return pairs, [(pairs & ((1 << ROW_BITS) - 1), pa.int32()), (ns, pa.int32())]

    found = _counted(docs, shift, wanted, lists, "x0 array<int>, x1 array<int>")
    return found.withColumnsRenamed({"x0": "rows", "x1": "ns"})


def group_counts(docs: DataFrame, shift: int, wanted: DataFrame) -> DataFrame:
    """(chunk, gids, counts): the groups of a piece's documents that hold the chunk; of each the documents, 32 bits up, and occurrences."""

    def lists(pairs: np.ndarray, ns: np.ndarray) -> tuple:
        # Rows begin with the group, so a group's documents lie together.
        group = pairs >> shift
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        docs = np.diff(np.append(first, len(pairs)))
        gids = (pairs[first] & ((1 << ROW_BITS) - 1)) >> shift
        return pairs[first], [(gids, pa.int32()), (docs << 32 | np.add.reduceat(ns, first), pa.int64())]

    found = _counted(docs, shift, wanted, lists, "x0 array<int>, x1 array<bigint>")
    return found.drop("piece").withColumnsRenamed({"x0": "gids", "x1": "counts"})


def _merged(placed: DataFrame, shift: int) -> DataFrame:
    """(term, gid, docs, n) of rows (term, piece, k, rows, ns) that lie together and in order by term and piece.

    Chunks of one document may share a term, so the lists of a piece are merged first. A task holds some of them, and at most one piece's
    lists of a term over.
    """

    def merge(table: pa.Table) -> pa.RecordBatch:
        term, piece = (table.column(c).combine_chunks() for c in ("term", "piece"))
        new_term = np.append(True, pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False))
        new = new_term | np.append(True, np.diff(piece.to_numpy()) != 0)
        rows, ns = (table.column(c).combine_chunks() for c in ("rows", "ns"))
        many = pc.list_value_length(rows).to_numpy()
        key = np.repeat(np.cumsum(new) - 1, many) << ROW_BITS | rows.flatten().to_numpy().astype(np.int64)
        times = ns.flatten().to_numpy() * np.repeat(table.column("k").to_numpy(), many)
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        one, total = key[first], np.add.reduceat(times, first)
        which = (np.cumsum(new_term) - 1)[np.flatnonzero(new)][one >> ROW_BITS]
        both = which << ROW_BITS | (one & ((1 << ROW_BITS) - 1)) >> shift
        order = np.argsort(both, kind="stable")
        both, total = both[order], total[order]
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        docs = np.diff(np.append(first, len(both)))
        names = term.take(pa.array(np.flatnonzero(new_term)[both[first] >> ROW_BITS]))
        gid = pa.array(both[first] & ((1 << ROW_BITS) - 1), pa.int32())
        return pa.RecordBatch.from_arrays([names, gid, pa.array(docs), pa.array(np.add.reduceat(total, first))], ["term", "gid", "docs", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in pieces_of(batches, 2_000):
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            term, piece = table.column("term"), table.column("piece")
            same = pc.and_(pc.equal(term, term[-1]), pc.equal(piece, piece[-1])).to_numpy()
            over = len(same) - int(same.sum())
            if over:
                yield merge(table.slice(0, over))
            held = table.slice(over)
        if held is not None:
            yield merge(held)

    return placed.select("term", "piece", "k", "rows", "ns").mapInArrow(run, "term string, gid int, docs long, n long")


def kept_terms(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, n, all_n) of the terms in LEAST_DOCS documents of their language, and (lang, source) of all groups.

    The dictionary's terms are joined back to the chunks. Occurrences add up. Documents do not, for chunks of one document may share a
    term; but a term is in no fewer documents than any one of its chunks, and in no more than all of them together. Where that
    does not tell whether there are LEAST_DOCS, the documents themselves are compared, piece by piece.
    """
    names = numbered(docs)
    shift = ROW_BITS - max(1, (names.count() - 1).bit_length())
    marked = docs.join(bounded(names), ["lang", "source"])
    known = written(dictionary(docs))
    totals = known.groupBy("term").agg(F.sum(F.col("total") * F.col("k")).alias("all")).where(F.col("all") >= LEAST_DOCS)
    known = written(known.join(totals.select("term"), "term", "left_semi"))
    found = group_counts(marked, shift, known.select("chunk").distinct()).join(known.drop("total"), "chunk")
    rows = found.select("chunk", "term", "k", F.inline(F.arrays_zip("gids", "counts")).alias("gid", "count"))
    each = rows.groupBy("chunk", "term", "k", "gid").agg(
        F.sum(F.shiftright("count", 32)).alias("docs"), F.sum(F.col("count").bitwiseAND(F.lit((1 << 32) - 1))).alias("n")
    )
    counts = each.groupBy("term", "gid").agg(F.sum("docs").alias("most"), F.max("docs").alias("least"), F.sum(F.col("n") * F.col("k")).alias("n"))
    together = Window.partitionBy("lang", "term")
    sums = {f"all_{c}": F.sum(c).over(together) for c in ("most", "least", "n")}
    likely = counts.join(bounded(names), "gid").withColumns(sums).where(F.col("all_most") >= LEAST_DOCS)
    likely = written(likely.select("lang", "source", "term", "n", "all_n", (F.col("all_least") >= LEAST_DOCS).alias("sure")))
    open_terms = likely.where("NOT sure").select("term").distinct()
    doubtful = written(known.join(open_terms, "term", "left_semi"))
    exact = _exact_docs(marked, doubtful, shift).join(bounded(names), "gid")
    exact = exact.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= LEAST_DOCS)
    more = likely.where("NOT sure").join(exact, ["lang", "term"], "left_semi")
    return written(likely.where("sure").unionByName(more).drop("sure")), names.drop("gid")


def _exact_docs(marked: DataFrame, known: DataFrame, shift: int) -> DataFrame:
    """(term, gid, docs) of the terms of `known`: documents, each counted once.

    All pieces of a term meet in one task, but for terms of very common chunks: these meet in several, whose counts are added up.
    """
    parts = F.ceil(F.sum("total") / HOT).alias("parts")
    hot = bounded(cut(known.where(F.col("total") > HOT).groupBy("term").agg(parts)))
    found = postings(marked, shift, known.select("chunk").distinct()).join(known.drop("total"), "chunk").join(hot, "term", "left")
    placed = found.withColumn("part", F.pmod(F.hash("piece"), F.coalesce("parts", F.lit(1)))).drop("chunk", "parts")
    merged = _merged(placed.repartition("term", "part").sortWithinPartitions("term", "piece"), shift)
    return merged.groupBy("term", "gid").agg(F.sum("docs").alias("docs"))


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + ADDED) / (total + ADDED * terms)), exact for any long counts."""
    return F.call_function("div", (count + ADDED).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), (total + ADDED * terms).cast("decimal(20,0)")) + 1


def _distance(a: Column, b: Column) -> Column:
    return F.abs(a - b)


def source_divergence(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value (long) and rank (int): how each source's terms differ from others' and its language's.

    Null text, lang and source read as ''. Each row is a document, repeated ones too. Part `pair` has, for every source of a
    language, each other one with the sum of absolute differences of all kept terms' probabilities; part `term` the kept terms that are more
    probable there than in the language, up to rank 50. Ranks go by value, then by the item's UTF-8. A language
    without kept terms gives pairs of value 0; a source alone in its language gives no pair. Other columns are not
    read. No rows give no rows.

    Sums run over the terms that occur: with z for the probability of a count of zero, a pair's sum over all V terms is V |za - zb|, plus what
    the terms of a alone add to that, of b alone, and what those of both change. The first follows from how many terms
    of a source have each count; only the last joins sources by term.
    """
    docs = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    held, names = kept_terms(docs)
    langs = held.groupBy("lang", "term").agg(F.first("all_n").alias("all_n")).groupBy("lang")
    langs = langs.agg(F.count("*").alias("v"), F.sum("all_n").alias("lang_n"))
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = names.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    v, size = F.coalesce("v", F.lit(0)), F.coalesce("size", F.lit(0))
    zero = F.when(v > 0, probability(F.lit(0), size, v)).otherwise(0)
    groups = cut(groups.select("lang", "source", v.alias("v"), size.alias("size"), "lang_n", zero.alias("z")))
    held = held.join(groups, ["lang", "source"])
    held = written(held.select("lang", "source", "term", "n", "z", probability(F.col("n"), F.col("size"), F.col("v")).alias("p"),
                           probability(F.col("all_n"), F.col("lang_n"), F.col("v")).alias("q")))

    def named(df: DataFrame, mark: str, *also: str) -> DataFrame:
        return df.select(*also, *[F.col(c).alias(mark + c) for c in ("source", "z", "p") if c in df.columns])

    a, b = [{c: F.col(m + c) for c in ("source", "z", "p")} for m in "ab"]
    apart = _distance(a["z"], b["z"])
    pairs = named(groups, "a", "lang", "v").join(named(groups.drop("v"), "b", "lang"), "lang").where(a["source"] != b["source"])
    base = pairs.select("lang", "asource", "bsource", (F.col("v") * apart).alias("value"))
    steps = held.groupBy("lang", "source", "z", "p").agg(F.count("*").alias("m"))
    alone = named(steps, "a", "lang", "m").join(named(groups, "b", "lang"), "lang").where(a["source"] != b["source"])
    alone = alone.groupBy("lang", "asource", "bsource").agg(F.sum(F.col("m") * (_distance(a["p"], b["z"]) - apart)).alias("value"))
    both = named(held, "a", "lang", "term").join(named(held, "b", "lang", "term"), ["lang", "term"]).where(a["source"] < b["source"])
    change = _distance(a["p"], b["p"]) - _distance(a["p"], b["z"]) - _distance(b["p"], a["z"]) + apart
    both = cut(both.groupBy("lang", "asource", "bsource").agg(F.sum(change).alias("value")))
    turned = [x.select("lang", F.col("bsource").alias("asource"), F.col("asource").alias("bsource"), "value") for x in (alone, both)]
    summed = base.unionByName(alone).unionByName(both).unionByName(turned[0]).unionByName(turned[1])
    summed = summed.groupBy("lang", F.col("asource").alias("source"), F.col("bsource").alias("item")).agg(F.sum("value").alias("value"))
    over = held.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pair_part = summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank).select(columns)
    term_part = over.select("lang", "source", F.lit("term").alias("part"), "item", "value", rank).where(F.col("rank") <= TOP_TERMS).select(columns)
    return pair_part.unionByName(term_part)
