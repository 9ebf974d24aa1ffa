"""SimHash, exact groups, repeated passages and lines against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from fixtures import documents, empty, rows_of, sentence
from netstats.llm import exact, lines, queries, simhash, substrings
from netstats.llm.components import components


def plain_simhash(text, width=3):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """component_id by row number: links of fingerprints with at most three different bits, followed to their end."""
    fps = [plain_simhash(t) for _, t in rows]
    seen, out = {}, {}
    for start in set(fps):
        if start in seen:
            continue
        reach, todo = {start}, [start]
        while todo:
            a = todo.pop()
            new = {b for b in set(fps) if (a ^ b).bit_count() <= 3} - reach
            reach |= new
            todo += new
        ids = [i for (i, _), fp in zip(rows, fps) if fp in reach and i is not None]
        seen |= dict.fromkeys(reach, min(ids, default=None))
    for (i, t), fp in zip(rows, fps):
        out.setdefault((i, t), (f"{fp:016x}", seen[fp]))
    return out


@pytest.mark.parametrize("clashing", [False, True])
def test_simhash_equals_brute_force(spark, clashing):
    docs = documents(spark, clashing=clashing)
    found = simhash.near_duplicates(docs).select("doc_id", simhash.hex_print(F.col("fp")), "component_id")
    given = [(r.doc_id, r.text) for r in docs.collect()]
    expected = plain_components(given)
    assert rows_of(found, "*") == sorted(((i, *expected[i, t]) for i, t in given), key=repr)


def test_simhash_of_a_long_text_in_blocks(monkeypatch):
    text = sentence(random.Random(3), 700)
    whole = simhash.simhash(text, 3)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.simhash(text, 3) == whole == (x - (1 << 64) if (x := plain_simhash(text)) >> 63 else x)


@pytest.mark.parametrize("bucket", [512, 3])
def test_near_pairs_miss_none(spark, bucket):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for c in centres for _ in range(40)}
    fps |= {0xFFFFFFFFFFFFFFFF, 0, 1, 1 << 63, 7, 15}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    found = simhash.near_pairs(spark.createDataFrame([(x,) for x in signed], "fp long"), bucket)
    pairs = {frozenset(r) for r in found.collect()}
    mask = (1 << 64) - 1
    assert pairs == {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3}


def test_unfolded_lookups_are_not_broadcast(spark):
    fps = spark.range(3000).select(F.xxhash64("id").alias("fp")).distinct()
    pairs = simhash.near_pairs(fps)
    assert pairs.count() == 0
    assert "BroadcastExchange" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (205, 200), (205, 210), (1, 0)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    expected = dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 130), 100) | {200: 200, 205: 200, 210: 200}
    assert found == expected
    assert components(links.limit(0)).count() == 0


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_groups(spark, clashing):
    docs = documents(spark, clashing=clashing)
    given = [(r.doc_id, r.text or "") for r in docs.collect()]
    squeezed = {t: t.translate({ord(c): None for c in " \t\n\x0b\x0c\r"}) for _, t in given}
    expected = []
    for i, t in given:
        group = [(-len(u), j is None, j) for j, u in given if squeezed[u] == squeezed[t]]
        best = min(group)
        digest = hashlib.sha256(squeezed[t].encode()).hexdigest()
        expected.append((i, best[2], len(group), i == best[2] and -len(t) == best[0], digest))
    found = exact.content_groups(docs)
    assert rows_of(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(expected, key=repr)


def test_exact_groups_tell_colliding_hashes_apart(spark, monkeypatch):
    monkeypatch.setattr(exact.F, "md5", lambda c: F.lit("00"))
    docs = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c"), (4, None)], "doc_id long, text string")
    found = rows_of(exact.content_groups(docs), "doc_id", "keep_id", "group_size", "kept")
    assert found == [(1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True), (4, 4, 1, True)]


def plain_repeats(rows, width):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    counts = Counter(tuple(w[a : a + width]) for _, w in split for a in range(len(w) - width + 1))
    out = []
    for i, w in split:
        gone = {b for a in range(len(w) - width + 1) if counts[tuple(w[a : a + width])] > 1 for b in range(a, a + width)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("hot", "clashing"), [(2000, True), (2, False)])
def test_repeated_passages(spark, hot, clashing, monkeypatch):
    monkeypatch.setattr(substrings, "SEGMENT", 30)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 300)
    docs = documents(spark, clashing=clashing)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    found = substrings.repeats_removed(docs, 35, hot)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == plain_repeats(given, 35)


def test_suffix_automaton_finds_windows_with_two_places():
    rng = random.Random(9)
    for _ in range(60):
        parts = [[rng.choice("ab") for _ in range(rng.randrange(1, 25))] for _ in range(3)]
        automaton = substrings.SuffixAutomaton()
        for p in parts:
            automaton.add(p)
        for width in (1, 3, 6):
            counts = Counter(tuple(p[i : i + width]) for p in parts for i in range(len(p) - width + 1))
            for p in parts:
                expected = [i for i in range(len(p) - width + 1) if counts[tuple(p[i : i + width])] > 1]
                assert automaton.repeated(p, width) == expected
    assert automaton.repeated(["never", "a", "seen"], 1) == [1]


def plain_lines(rows, least, words=None):
    """Rows equal in id and text are one document; ids are unique otherwise."""
    seen, gone = set(), {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        found = t.split("\n") if t else []
        for n in range(1, least + 1):
            for a in range(len(found) - n + 1):
                run = tuple(found[a : a + n])
                if n < least and (words is None or len(re.findall(lines.WORD, "\n".join(run))) < words):
                    continue
                if run in seen:
                    gone.setdefault((i, t), set()).update(range(a, a + n))
                seen.add(run)
    out = []
    for i, t in rows:
        found, less = (t.split("\n") if t else []), gone.get((i, t), set())
        out.append((i, len(found), len(less), "\n".join(x for j, x in enumerate(found) if j not in less)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(
    ("least", "words", "clashing"),
    [(1, None, False), (2, None, True), (3, None, False), (5, None, False), (3, 8, True), (5, 4, False)],
)
def test_repeated_lines(spark, least, words, clashing):
    docs = documents(spark, clashing=clashing).where("doc_id IS NOT NULL OR text LIKE 'alone%' OR text IS NULL")
    given = [(r.doc_id, r.text) for r in docs.collect()]
    found = lines.without_repeated_runs(docs, least, words)
    assert rows_of(found, "doc_id", "n_lines", "n_removed", "text") == plain_lines(given, least, words)


def test_short_runs_of_many_words(spark):
    passage, half = " ".join(f"p{i}" for i in range(60)), [" ".join(f"h{i}" for i in range(a, a + 30)) for a in (0, 30)]
    texts = [passage, f"own line\n{passage}\nshort", "short", "\n".join(half), "\n".join(["x", *half, half[0]]), passage + "!"]
    rows = list(enumerate(texts))
    found = lines.without_repeated_runs(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), 3, 50)
    assert rows_of(found, "doc_id", "n_lines", "n_removed", "text") == plain_lines(rows, 3, 50)
    assert {r.doc_id: r.text for r in found.collect()} == {
        0: passage, 1: "own line\nshort", 2: "short", 3: texts[3], 4: f"x\n{half[0]}", 5: texts[5]
    }


def test_no_rows(spark):
    docs = empty(spark)
    assert simhash.near_duplicates(docs).count() == 0
    assert exact.content_groups(docs).count() == 0
    assert substrings.repeats_removed(docs).count() == 0
    assert lines.without_repeated_runs(docs).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    try:
        for t in ("documents", "benchmark", "pages"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    except duckdb.IOException:
        pytest.skip("tables are not here")
    found = queries.QUERIES[name](spark, folder)
    order = ", ".join(f'"{c}"' for c in found.columns)
    assert rows_of(found, "*") == sorted(con.execute(f"SELECT {order} FROM ({queries.ORACLES[name]})").fetchall(), key=repr)
