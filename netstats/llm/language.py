"""Language identification by compression with a dictionary for each language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netstats.llm.decontaminate import bounded
from netstats.llm.shared import pieces_of

#: Bytes of text in the dictionary of a language, at most.
DICTIONARY_BYTES = 65_536
#: Training documents of a language, at most, and the parts of equal length of which a long one gives a piece each.
TRAINING_DOCS, PARTS = 400, 4
#: A text is compressed in pieces of so many bytes, so that the dictionary, not the text's own past, decides.
PIECE_BYTES = 2_048
LEVEL = 5
#: A relative lead below this over the second language rejects a prediction.
MARGIN = 0.01


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def dictionaries(docs: DataFrame, held: Column) -> dict[str, bytes]:
    """Raw text for each lang of the training rows (not `held`, lang, text and doc_id not null).

    A bounded sample: of each language the TRAINING_DOCS documents with the smallest hash, whatever their length. All have the
    same share of the dictionary: a text within it is taken whole, of a longer one a piece of each of PARTS equal parts,
    at a place that its id picks. A count of each language bounds the hashes that are ranked at all, so a task ranks about four times
    TRAINING_DOCS rows however many there are; they are chosen by id alone, and only the pieces come to the driver.
    """
    usable = docs.where(~held & F.col("lang").isNotNull() & (F.length(F.trim("text")) > 0))
    by_lang = Window.partitionBy("lang")
    first = by_lang.orderBy(F.xxhash64("doc_id"), "doc_id")
    # Of a frequent language only ids with a small hash are ranked: about four times as many as are wanted.
    sizes = usable.groupBy("lang").agg(F.count("*").alias("size"))
    place = F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5
    small = usable.select("doc_id", "lang").join(bounded(sizes), "lang").where(place <= F.lit(4.0 * TRAINING_DOCS) / F.col("size"))
    picked = small.select("doc_id", "lang").withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= TRAINING_DOCS)
    picked = picked.select("doc_id", "lang", F.floor(F.lit(DICTIONARY_BYTES) / F.count("*").over(by_lang)).alias("share"))
    sample = usable.select("doc_id", "lang", "text").join(F.broadcast(picked.distinct()), ["doc_id", "lang"])
    size, octets = F.length("text"), F.octet_length("text")
    # A line feed follows each piece; sizes are of characters.
    piece = F.floor((F.floor(F.col("share") / PARTS) - 1) * size / octets).cast("int")
    part = F.floor(size / PARTS).cast("int")
    starts = [1 + i * part + F.pmod(F.xxhash64("doc_id", F.lit(i)), F.greatest(part - piece + 1, F.lit(1))).cast("int") for i in range(PARTS)]
    spread = F.array(*[F.substring("text", start, piece) for start in starts])
    sample = sample.select("lang", "doc_id", "share", F.when(octets < F.col("share"), F.array("text")).otherwise(spread).alias("parts"))
    texts: dict[str, dict] = {}
    for row in sample.orderBy("lang", "doc_id", "parts").toLocalIterator():
        most = row["share"] // len(row["parts"]) - 1
        texts.setdefault(row["lang"], {})[row["doc_id"]] = b"\n".join(x.lower().encode()[:most] for x in row["parts"])
    return {lang: b"\n".join(found.values())[:DICTIONARY_BYTES] for lang, found in texts.items()}


def pieces(text: bytes) -> Iterator[bytes]:
    """The whole text in pieces of about equal size, cut between characters' bytes if need be."""
    n = -(-len(text) // PIECE_BYTES)
    size = -(-len(text) // n)
    return (text[i : i + size] for i in range(0, len(text), size))


def classify(docs: DataFrame, known: dict[str, bytes]) -> DataFrame:
    """doc_id, lang_pred, score and rejected for every row of `docs`.

    The language whose dictionary compresses the whole text, in lower case, to the fewest bytes wins; equal sizes go to the first in
    alphabetical order. score is the lead over the second language as a share of the smallest size, mapped to 0..1 by
    lead / (lead + MARGIN); with one language it is 1. A lead below MARGIN is `rejected`, and
    lang_pred still names the best. Null texts and texts without a letter are `und` with
    score 0, and so are all where no language is known.
    """
    langs = sorted(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = []
        for lang in langs:
            held = zstandard.ZstdCompressionDict(known[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False).compress)
        for batch in pieces_of(batches):
            preds, scores, rejected = [], [], []
            for text in batch.column(1).to_pylist():
                if not langs or not text or not any(map(str.isalpha, text)):
                    preds.append("und")
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                parts = list(pieces(text.lower().encode()))
                sizes = np.array([sum(len(f(x)) for x in parts) for f in tools])
                best = int(sizes.argmin())
                second = np.delete(sizes, best).min() if len(langs) > 1 else None
                lead = float((second - sizes[best]) / sizes[best]) if second is not None else float("inf")
                preds.append(langs[best])
                scores.append(1.0 if second is None else lead / (lead + MARGIN))
                rejected.append(lead < MARGIN)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """Predictions and held_out for every row of `docs`, learnt from the rows that are not held out.

    Rows with a null doc_id are held out neither way: they are predicted, with held_out false, and never learnt from.
    """
    known = dictionaries(docs, F.coalesce(held_out(F.col("doc_id")), F.lit(True)))
    out = classify(docs, known)
    return out.withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
