"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netstats.llm.shared import cut

#: A lookup with more rows than this is not broadcast but joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, marked for broadcast once its rows have been counted and are few."""
    return F.broadcast(df) if df.count() <= rows else df


def words(text: Column) -> Column:
    """Lower-case words between ASCII white space; null for a null text."""
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


#: Words of a shingle; an item of fewer words is one shingle of its own number of words.
WIDTH = 5


def _columns(width: int) -> list[str]:
    return [f"w{i}" for i in range(width)]


def shingled(texts: DataFrame, key: str, width: int = WIDTH) -> DataFrame:
    """`key` and the words w0, w1 ... of each shingle, a row for every start; texts of fewer words give none.

    The word arrays, each shifted by one, are zipped and unfolded within generated code.
    """
    split = texts.select(key, words(F.col("text")).alias("w"))
    starts = F.size("w") - (width - 1)
    shifted = [F.slice("w", F.lit(i + 1), starts) for i in range(width)]
    return split.where(F.size("w") >= width).select(key, F.inline(F.arrays_zip(*shifted)).alias(*_columns(width)))


def sketches(items: DataFrame, threshold: float, width: int = WIDTH) -> DataFrame:
    """(h, item_id): of each item the smallest shingle hashes, as many as its size partition asks for.

    Items are partitioned by the number of their distinct shingles, up to 1, 2, 4, 8 and so on. In a partition up to
    u, an item that is contained by `threshold` lacks at most (1 - threshold) * u shingles, so among one more than
    that many smallest hashes one must occur in the document. Hence the search misses nothing.
    """
    hashes = shingled(items, "item_id", width).select("item_id", F.xxhash64(*_columns(width)).alias("h"))
    sizes = hashes.groupBy("item_id").agg(F.array_sort(F.collect_set("h")).alias("hs"))
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("hs"))))
    most = (F.floor(F.round(upper * (1 - threshold), 9)) + 1).cast("int")
    return sizes.select(F.explode(F.slice("hs", F.lit(1), most)).alias("h"), "item_id")


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(key, item_id) for each text of `docs` that holds at least `threshold` of the distinct shingles of an item.

    key is the MD5 of the text, so copies are one text, whatever their ids. Shingles are five words; an item of
    fewer words is one shingle of its own number of words, so it is found wherever its words stand in a row. Items that share an
    id count each for itself where their texts differ: an item is its id and text. Texts are probed once for each number of words
    that shingles of the items have.
    """
    items = items.where("text IS NOT NULL").select("item_id", "text").distinct()
    named = F.struct(F.col("item_id").alias("id"), F.md5("text").alias("digest")).alias("item_id")
    items = items.select(named, "text", F.least(F.size(words(F.col("text"))), F.lit(WIDTH)).alias("width"))
    texts = docs.where("text IS NOT NULL").select(F.unhex(F.md5("text")).alias("key"), "text")
    widths = sorted(w for (w,) in items.select("width").distinct().collect() if w > 0)
    found = [_contained(texts, items.where(F.col("width") == w).drop("width"), threshold, w) for w in widths]
    return reduce(DataFrame.unionByName, found or [_contained(texts, items.drop("width"), threshold, WIDTH)])


def _contained(texts: DataFrame, items: DataFrame, threshold: float, width: int) -> DataFrame:
    """(key, item_id) of the texts (key, text) and items whose shingles have `width` words."""
    h = F.xxhash64(*_columns(width)).alias("h")
    stream = shingled(texts, "key", width).select("key", h)
    met = stream.join(bounded(sketches(items, threshold, width)), "h").select("key", "item_id").distinct()
    # Kept, for texts are probed for it: the dearest step.
    candidates = cut(met)
    shingle = F.concat_ws(" ", *_columns(width)).alias("shingle")
    wanted = shingled(items, "item_id", width).select("item_id", shingle).distinct()
    sizes = wanted.groupBy("item_id").agg(F.count("*").alias("n"))
    suspects = texts.join(bounded(candidates.select("key").distinct()), "key", "left_semi")
    hits = shingled(suspects, "key", width).select("key", shingle).join(bounded(wanted), "shingle").distinct()
    return (
        hits.join(candidates, ["key", "item_id"], "left_semi")
        .groupBy("key", "item_id")
        .agg(F.count("*").alias("k"))
        .join(bounded(sizes), "item_id")
        .where(F.col("k") >= F.ceil(F.round(F.col("n") * threshold, 9)))
        .select("key", F.col("item_id.id").alias("item_id"))
    )


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """All rows and columns of `docs`, with n_items (long) and first_item, the smallest id of an item held.

    Null and empty texts hold nothing: n_items 0, first_item null. Repeated rows stay repeated, with the same result.
    No items, or none with a word, leave every document clean. Columns of `docs` named n_items or first_item are replaced.
    """
    found = contained_items(docs, items, threshold).groupBy("key").agg(
        F.countDistinct("item_id").alias("n_items"), F.min("item_id").alias("first_item")
    )
    left = docs.drop("n_items", "first_item").alias("l")
    joined = left.join(found.alias("r"), F.unhex(F.md5(F.col("l.text"))) == F.col("r.key"), "left")
    return joined.select("l.*", F.coalesce("r.n_items", F.lit(0)).cast("long").alias("n_items"), "r.first_item")
