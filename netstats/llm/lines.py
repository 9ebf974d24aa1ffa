"""Repeated line runs by a suffix array over line identifiers, made by distributed prefix doubling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netstats.llm.shared import cut

WORD = r"[^\x20\x09-\x0D]+"


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, dk, lines: dk stands for the row's doc_id and text."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keyed = docs.select("doc_id", "text", F.unhex(F.md5(F.concat_ws("\n", name, "text"))).alias("dk"))
    return keyed.withColumn("lines", F.when(F.col("text") != "", F.split("text", "\n")))


def _ranked(classes: DataFrame, *by: str) -> DataFrame:
    """The classes of two or more suffixes, with a `rank` in their order. Unique suffixes need none: no run goes on there.

    A sort by ranges and row numbers within them keep the order without bringing it into one task.
    """
    some = classes.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return cut(some.orderBy(*by).withColumn("rank", F.monotonically_increasing_id()))


def suffix_ranks(docs: DataFrame, depths: list[int]) -> dict[int, DataFrame]:
    """For each depth (dk, doc_id, pos, words, rank): the place in the suffix array, by the first `depth` lines, of each suffix
    that shares these, and how many words they have.

    Equal ranks are the intervals of the array whose longest common prefix is `depth` lines or more. The first ranks are those
    of the lines' MD5. A round joins each suffix ranked by half the depth with the one so many lines on, and ranks the pairs:
    every depth is made from its halves. Suffixes that are unique drop out.
    """
    levels: dict[int, DataFrame] = {}

    def level(depth: int) -> DataFrame:
        if depth not in levels:
            if depth == 1:
                rows = _keyed(docs).select("dk", "doc_id", F.posexplode("lines").alias("pos", "line"))
                words = F.regexp_count("line", F.lit(WORD)).alias("words")
                rows = rows.select("dk", "doc_id", "pos", words, F.unhex(F.md5("line")).alias("h")).dropDuplicates(["dk", "pos"])
                by, made = ["h"], rows
            else:
                front, back = level(depth - depth // 2), level(depth // 2)
                after = back.select(
                    "dk", (F.col("pos") - (depth - depth // 2)).alias("pos"), F.col("words").alias("more"), F.col("rank").alias("then")
                )
                both = front.withColumnRenamed("rank", "now").join(after, ["dk", "pos"])
                by, made = ["now", "then"], cut(both.withColumn("words", F.col("words") + F.col("more")).drop("more"))
            levels[depth] = cut(made.join(_ranked(made.select(*by), *by), by).select("dk", "doc_id", "pos", "words", "rank"))
        return levels[depth]

    return {depth: level(depth) for depth in depths}


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("dk"), F.col("pos"))


def without_repeated_runs(docs: DataFrame, min_lines: int = 3, min_words: int | None = None) -> DataFrame:
    """doc_id, n_lines, n_removed and text, without later copies, for every row of `docs`.

    A run of `min_lines` or more lines, or of fewer lines that have `min_words` words (`[^\\x20\\x09-\\x0D]+`) or more together,
    that also starts at an earlier place is removed, whole: every line of every such run. Places are ordered by doc_id
    (null last), then line; of texts that share a doc_id, by a hash. So the first copy of
    each run stays unless it is part of a later copy of another one. Lines end at a line feed and are compared as they
    are, by MD5. Null and empty texts have no lines, and give an empty text. Rows equal in doc_id and text are one
    document with one result, given for each of them. No rows give no rows.

    A maximal run of more than `min_lines` lines is the union of its windows of so many, each a later copy itself, so
    the array is ordered to that depth only. First places are minima, combined before the shuffle. A line or run that a third
    of all documents hold is a hot key of inner joins only, whose large partitions adaptive execution splits.
    """
    depths = [min_lines] if min_words is None else list(range(1, min_lines + 1))
    runs = [
        found.withColumn("depth", F.lit(depth)).where(F.lit(depth == min_lines) | (F.col("words") >= (min_words or 0)))
        for depth, found in suffix_ranks(docs, depths).items()
    ]
    suffixes = reduce(DataFrame.unionByName, runs)
    firsts = suffixes.groupBy("depth", "rank").agg(F.min(_place()).alias("first"))
    later = suffixes.join(firsts, ["depth", "rank"]).where(_place() != F.col("first"))
    covered = F.explode(F.sequence("pos", F.col("pos") + F.col("depth") - 1))
    gone = later.select("dk", covered.alias("line")).groupBy("dk").agg(F.collect_set("line").alias("gone"))
    none = F.array().cast("array<int>")
    rows = _keyed(docs).join(gone, "dk", "left").withColumn("gone", F.coalesce("gone", none))
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    rows = rows.withColumn("stays", F.when(F.size("gone") > 0, stays))
    kept = F.when(F.col("stays").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform("stays", lambda i: F.col("lines")[i]), "\n")
    )
    return rows.select(
        "doc_id",
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"),
        kept.alias("text"),
    )
