"""Sharding, quality, tokens, languages, decontamination and the pipeline."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fixtures import documents, empty, rows_of, sentence
from netstats.llm import bpe, decontaminate, language, quality, sharding

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("items", [4096, 16])
def test_shards(spark, items):
    docs = documents(spark, clashing=True)
    rows = sharding.shard_by_bytes(docs, 4, items=items).collect()
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted(
        (len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect()
    )
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    text = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    groups = {}
    for r in rows:
        if r.doc_id is not None:
            assert groups.setdefault(text[r.doc_id], r.shard) == r.shard
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    assert sharding.shard_by_bytes(empty(spark), 4).count() == 0


def test_shards_of_many_groups_are_near_equal(spark):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randrange(1, 3000) + str(i)) for i in range(1500)] + [(i, "copy " * 40) for i in range(2000, 2300)]
    found = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 24)
    sizes = [r.b for r in found.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 2 or max(sizes) == 300 * 208


def test_differencing_places_each_weight_once():
    parts = np.zeros((7, 3), np.int64)
    parts[:, 0] = [8, 7, 6, 5, 4, 3, 3]
    places = sharding.differencing(parts)
    assert all(sorted(p) == [0, 1, 2] for p in places.tolist())
    assert sorted(np.bincount(places[:, 0], parts[:, 0]).tolist()) == [12, 12, 12]


def test_encoding_equals_the_library(spark):
    docs = documents(spark, clashing=True)
    library = Tokenizer.from_file(FILE)
    found = {(r.doc_id, r.n_tokens, tuple(r.ids)) for r in bpe.encode(docs, FILE).collect()}
    given = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]
    assert found == {(i, len(ids), tuple(ids)) for i, ids in given}
    assert bpe.token_digests(empty(spark), FILE).count() == 0


def test_encoding_of_odd_texts():
    with open(FILE, encoding="utf-8") as file:
        own = bpe.ByteBpe(file.read())
    library, rng = Tokenizer.from_file(FILE), random.Random(4)
    letters = "abcdefghij  \n\t\r\x1c\x85\xa0’'sét é0½٣漢🙂́ .,!-_<|>ABCth"
    cases = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(4000)]
    cases += ["a<|endoftext|>b", "<|endoftext|", " " * 50, "x" * 3000, "the" * 900, "ab" * 3000, "a  b   c \n d ", "\n a", "it's we'll"]
    for text in cases:
        ids, joined = own.encode(text)
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected and joined == ",".join(map(str, expected))
        assert own.decode(ids) == library.decode(expected, skip_special_tokens=False).encode() == text.encode()
    broken = own.decode(np.array([own.ids["é".encode()[:1]], own.ids[b"a"]], np.int32))
    assert broken == b"\xef\xbf\xbda"


@pytest.fixture(scope="module")
def two_languages(spark):
    rng = random.Random(6)

    known = {a: ["".join(rng.choice(a) for _ in range(rng.randrange(3, 9))) for _ in range(300)] for a in ("abcdefghijkl", "opqrstuvwxyz")}

    def text(letters):
        return " ".join(rng.choice(known[letters]) for _ in range(rng.randrange(20, 80)))

    rows = [(i, text("abcdefghijkl") if i % 2 else text("opqrstuvwxyz"), "xx" if i % 2 else "yy") for i in range(120)]
    rows += [(500, None, "xx"), (501, "123 ...", "yy"), (502, "", None), (None, text("abcdefghijkl"), None), (503, "abcde uvwxy", None), (7, rows[7][1], "xx")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages(spark, two_languages):
    rows = language.identify(two_languages.select("*", F.lit(1).alias("score"), F.lit(2).alias("rn"))).collect()
    assert len(rows) == two_languages.count()
    for r in rows:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id is not None and r.doc_id < 500:
            assert r.lang_pred == ("xx" if r.doc_id % 2 else "yy")
        if r.doc_id in (500, 501, 502):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert [r.lang_pred for r in rows if r.doc_id is None] == ["xx"]
    # Neither the lang nor the text of a held-out row changes what is learnt.
    changed = two_languages.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    assert rows_of(language.identify(changed), "doc_id", "lang_pred") == rows_of(language.identify(two_languages), "doc_id", "lang_pred")
    assert language.identify(two_languages.limit(0)).count() == 0


def test_dictionaries_hold_pieces_of_whole_texts(spark):
    rng = random.Random(12)
    header = " ".join(f"header{i}" for i in range(150))
    rows = [(i, f"{header} " + " ".join(f"{x}word{rng.randrange(50)}" for _ in range(400)), x) for i in range(80) for x in ["pq"[i % 2]]]
    rows += [(100 + i, " ".join(f"long{rng.randrange(5)}" for _ in range(3000)), "l") for i in range(3)]
    rows += [(200, "ж" * 70_000 + "я" * 70_000, "r")]
    found = language.dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(False))
    assert sorted(found) == ["l", "p", "q", "r"] and max(map(len, found.values())) <= language.DICTIONARY_BYTES
    for x in "pq":
        assert found[x].count(f"{x}word".encode()) > found[x].count(b"header")
    assert found["r"].count("ж".encode()) == found["r"].count("я".encode()) > 10_000


def test_all_of_a_long_text_counts(spark):
    known = {"xx": b"abc bca cab " * 200, "yy": b"uvw vwu wuv " * 200}
    docs = spark.createDataFrame([(1, "abc bca cab " * 300 + "uvw vwu wuv " * 9000)], "doc_id long, text string")
    assert language.classify(docs, known).first().lang_pred == "yy"


def test_quality_keeps_what_looks_like_the_target(spark):
    rng = random.Random(8)
    good = [(i, sentence(rng, 60)) for i in range(150)]
    junk = [(1000 + i, " ".join(rng.choice("#@!%$&*") * 4 for _ in range(60))) for i in range(30)]
    odd = [(2000, None), (2001, ""), (None, sentence(rng, 40)), good[3]]
    docs = spark.createDataFrame(good + junk + odd, "doc_id long, text string").withColumn("kept", F.lit(1))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(1000, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality.resample(docs, labels).collect()}
    assert sum(kept[i] for i, _ in good) >= 140 and not any(kept[i] for i, _ in junk)
    assert kept[2000] and kept[2001]
    few = quality.resample(docs, labels, k=10).where("kept").count()
    assert few in (10, 11)  # a repeated row ties
    assert quality.resample(docs, labels, k=0).where("kept").count() == 0
    assert quality.resample(docs, labels.limit(0)).where("kept").count() == docs.count()
    assert quality.resample(docs.limit(0), labels).count() == 0


def test_quality_rejects_a_few_words_that_target_text_never_has(spark):
    words = [f"{a}{b}{c}" for a in ("lor", "mab", "ten") for b in ("ip", "ol", "ar") for c in ("sum", "dem", "nit")]
    rng = random.Random(5)
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(300)]
    rows = [(i, f"{t[:900]} vilewretch {t[900:]}" if i >= 240 else t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i >= 240)) for i in range(100, 300)], "doc_id long, quality int, toxic int")
    found = quality.resample(docs, labels).collect()
    assert [r.doc_id for r in sorted(found) if r.kept] == list(range(240))


def test_log_weights_equal_brute_force(spark, monkeypatch):
    docs = documents(spark)
    monkeypatch.setattr(quality, "BLOCK", 1000)
    raw, target = quality.counts(docs, spark.createDataFrame([(20, True), (30, True)], "doc_id long, chosen boolean"))
    expected, some = np.zeros(quality.BUCKETS, np.int64), np.zeros(quality.BUCKETS, np.int64)
    weights = []
    ratio = np.random.default_rng(1).normal(size=quality.BUCKETS)
    for r in docs.collect():
        octets = f" {r.text or ''} ".encode()
        found = []
        for i in range(len(octets) - 3):
            key = int.from_bytes(octets[i : i + 4], "little")
            found.append((((key ^ key >> 15) * 0x9E3779B1) & 0xFFFFFFFF) >> 16)
        np.add.at(expected, found, 1)
        if r.doc_id in (20, 30):
            np.add.at(some, found, 1)
        least = min((sum(ratio[found[i : i + 6]]) for i in range(len(found) - 5)), default=sum(ratio[found]))
        weights.append((r.doc_id, round(quality.LENGTH * float(ratio[found].sum()) / max(1, len(found)), 6), round(float(least), 6)))
    assert (raw == expected).all() and (target == some).all()
    got = [(r.doc_id, round(r.log_weight, 6), round(r.lowest, 6)) for r in quality.log_weights(docs, ratio).collect()]
    assert sorted(got, key=repr) == sorted(weights, key=repr)


def test_kth_largest(spark):
    values = [1.0] * 5 + [2.5] * 3 + [-7.0, 1e300, 0.1]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    assert [quality.kth_largest(df, "s", k) for k in range(1, 12)] == sorted(values, reverse=True)
    assert quality.kth_largest(df, "s", 0) is None and quality.kth_largest(df, "s", 12) is None


def shingles(text, width):
    words = [w for w in (text or "").lower().replace("\n", " ").replace("\t", " ").split(" ") if w]
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def item_shingles(text):
    width = min(5, len((text or "").split()))
    return width, shingles(text, width) if width else set()


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(10)
    items = [(i, sentence(rng, n)) for i, n in enumerate([3, 5, 8, 20, 33, 59])] + [(6, None), (7, ""), (8, "one"), (3, sentence(rng, 20))]
    held = [(100 + i, f"{sentence(rng, 30)} {t}\n{sentence(rng, 30 * i)}") for i, t in items if t]
    part = [(200 + i, " ".join((t or "").split(" ")[: int(0.85 * len((t or "").split(" ")))])) for i, t in items]
    docs = documents(spark, clashing=True)
    extra = spark.createDataFrame(held + part, "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("text2", F.lit("x"))
    found = {(r.doc_id, r.text): (r.n_items, r.first_item) for r in decontaminate.contaminated(docs, table).collect()}
    for r in docs.collect():
        ids = {i for i, (k, s) in ((i, item_shingles(t)) for i, t in items) if s and len(s & shingles(r.text, k)) >= -(-len(s) * 4 // 5)}
        assert found[r.doc_id, r.text] == (len(ids), min(ids, default=None)), r
    assert decontaminate.contaminated(docs, table).count() == docs.count()
    assert decontaminate.contaminated(docs, table.limit(0)).where("n_items > 0").count() == 0
    assert decontaminate.contaminated(docs.limit(0), table).count() == 0


def test_pipeline(spark, tmp_path):
    # Two texts share an id; some rows are repeated; extra columns have names that the operators use.
    more = spark.createDataFrame([(25, "another text that has the id of an earlier one")], "doc_id long, text string")
    docs = documents(spark, clashing=True).unionByName(more, allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20, 60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    leaked = docs.where("doc_id = 40").select(F.col("doc_id").alias("item_id"), "text")
    leaked.write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = found.collect()
    ids = [r.doc_id for r in rows]
    assert 40 not in ids and len({8, 9, 10, 12} & set(ids)) == 1 and {26, 27} <= set(ids)
    assert ids.count(25) == 2 and len({(r.doc_id, r.ids_sha256) for r in rows}) == len(rows)
    assert {r.doc_id for r in rows if r.n_tokens == 0} == {0}
    assert not [x for x in (tmp_path / "..").rglob("quality") if x.is_dir()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "decontaminate", "encode"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty(spark), str(tmp_path))
        assert out.columns == empty(spark).columns and out.count() == 0, name
