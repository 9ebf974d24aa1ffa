"""Spelling variants by reduced-alphabet generation: words one edit apart, found through few-letter images of them."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstats.llm.shared import cut, pieces_of

#: Symbols of the reduced alphabet, as bits.
SYMBOL_BITS = 3
#: Reduced words are numbers; those of more than twenty letters are folded into 61 bits. A clash adds a candidate, no result.
FOLD = (1 << 61) - 1
#: Different words that a task counts before it hands on what it has.
HELD_WORDS = 500_000
#: Fixed values of the result's contract: a run's letters, the share of occurrences that lose one, the bounds of a word.
RUN, LOSES, LEAST_LETTERS, LEAST_COUNT = re.compile("[A-Za-zÀ-ÿ]+"), 97, 5, 3


def occurrences(doc_id: str, text: str) -> Iterator[tuple[str, int]]:
    """The runs of a text, each with its number of occurrences; A-Z in lower case, one letter lost where the hash asks for it."""
    for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        if h % LOSES == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words of LEAST_LETTERS or more code points that occur LEAST_COUNT times or more in all texts.

    Tasks count before the shuffle, so a very common word is a few rows from each of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return made

        for batch in pieces_of(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in occurrences(doc_id, text):
                    if len(word) >= LEAST_LETTERS:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
        yield out()

    rows = docs.where("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    found = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= LEAST_COUNT)


def symbol(letter: str) -> int:
    """The letter's symbol in the reduced alphabet."""
    return (zlib.crc32(letter.encode()) >> 7) & ((1 << SYMBOL_BITS) - 1)


def reduced(word: str) -> int:
    """The reduced word as a number: its symbols behind a leading one, so that lengths differ too."""
    out = 1
    for letter in word:
        out = out << SYMBOL_BITS | symbol(letter)
    return out


def neighbourhood(word: str) -> set[int]:
    """Reduced words one edit from the word's own: with a symbol less, or one symbol replaced by a larger one.

    The other half of the full neighbourhood, a symbol more or a smaller one, is the same relation seen from the other word, so
    each pair is generated from one side.
    """
    whole, bits = reduced(word), SYMBOL_BITS
    found = set()
    for i in range(len(word)):
        below = i * bits
        own = whole >> below & ((1 << bits) - 1)
        found.add((whole >> below + bits) << below | whole & ((1 << below) - 1))
        found.update(whole + (to - own << below) for to in range(own + 1, 1 << bits))
    return found


def near_words(words: DataFrame) -> DataFrame:
    """(a, an, b, bn): each pair of `words` (word, n) that differ by one inserted, deleted or replaced code point, once.

    One edit of a word is at most one edit of its reduced word. So the reduced words with their neighbourhoods are joined with the reduced
    vocabulary, and every candidate is verified on the original strings. A reduced word that many words share is a hot
    key of an inner join only, which adaptive execution splits.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [reduced(w) % FOLD for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *batch.columns], ["key", "word", "n"])

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            keys, at, same = [], [], []
            for i, word in enumerate(batch.column(0).to_pylist()):
                found = [reduced(word) % FOLD, *{x % FOLD for x in neighbourhood(word)}]
                keys += found
                at += [i] * len(found)
                same += [True] + [False] * (len(found) - 1)
            picked = batch.take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(same), *picked.columns], ["key", "same", "a", "an"])

    table = words.mapInArrow(own, "key long, word string, n long").select("key", F.col("word").alias("b"), F.col("n").alias("bn"))
    asked = words.mapInArrow(around, "key long, same boolean, a string, an long")
    # Words that share a reduced word meet from both sides; all other pairs meet once.
    hit = asked.join(table, "key").where(~F.col("same") | (F.col("a") < F.col("b")))
    return hit.where(F.levenshtein("a", "b", 1) == 1).select("a", "an", "b", "bn")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for `forms` (word, form): the last word that forms lead to. Each round doubles the steps taken.

    A form's count is at least twice that of its word, so chains have fewer than 64 steps and six rounds are enough.
    """
    steps = cut(forms.select("word", F.col("form").alias("root")))
    for _ in range(6):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")))
        steps = moved.select("word", "root")
        if moved.where("on").isEmpty():
            break
    return steps


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root (string), n, n_near and form_n (long) for every word of the texts of `docs`.

    Runs of letters are taken from whole texts (null: none); only A-Z are lower-cased; one occurrence set in 97, picked by the CRC-32 of the id
    and the run, loses a letter. A null doc_id reads as the empty string; repeated rows count again. Words are
    near if one code point inserted, deleted or replaced makes one the other. A word's form is its near word with the
    largest n (ties: the smallest in code-point order) if that is at least 2 * n, else null with form_n null. root is
    the last word that forms lead to, the word itself where it has none. Other columns are not read. No words give no rows.
    """
    words = cut(vocabulary(docs))
    pairs = near_words(words)
    sides = F.array(*[F.struct(F.col(x).alias("word"), F.col(y).alias("near"), F.col(f"{y}n").alias("m")) for x, y in ("ab", "ba")])
    best = F.min(F.struct((-F.col("m")).alias("less"), F.col("near").alias("form")))
    found = pairs.select(F.inline(sides)).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = -F.col("best.less") >= 2 * F.col("n")
    known = cut(
        words.join(found, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("best.form")).alias("form"),
            F.when(strong, -F.col("best.less")).alias("form_n"),
        )
    )
    last = roots(known.where("form IS NOT NULL"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
