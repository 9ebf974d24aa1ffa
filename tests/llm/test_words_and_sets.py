"""Spelling variants, set sketches and source divergence against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from fixtures import documents, empty, rows_of, sentence
from netstats.llm import divergence, setsketch, spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_spelling(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    close = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(close[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(((w, form[w], root(w), n, len(close[w]), words.get(form[w])) for w, n in words.items()), key=repr)


def spelled(spark):
    rng = random.Random(3)
    bases = ["colour", "ÀÉÎõü", "straße", "neighbour", "abcdefghijklmnopqrstuvwxyz", "aaaaaa", "organise", "Éclair"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(20):
            w = rng.choice(bases)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abé") + w[at:], w[:at] + rng.choice("xÿ") + w[at + 1 :]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i if i % 50 else None, rng.choice([" ", "1", "\n", "×"]).join(words)))
    rows += [(4, None), (5, ""), (6, "  "), (7, "tiny"), (8, "naïve " * 3 + "x" * 3000 + " long " * 500)] + rows[:5]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n", "3 AS form", "4 AS key", "5 AS root")


def test_spelling_equals_brute_force(spark):
    rows, docs = spelled(spark)
    found = spelling.spelling_variants(docs)
    expected = plain_spelling(rows)
    assert rows_of(found, "word", "form", "root", "n", "n_near", "form_n") == expected
    assert sum(r[1] is not None for r in expected) > 20 and any(r[2] != r[1] and r[1] for r in expected)
    assert spelling.spelling_variants(empty(spark)).count() == 0


def test_neighbourhood_meets_every_edit():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzßéÿ") for _ in range(rng.randrange(5, 30)))
        at = rng.randrange(len(a))
        b = rng.choice([a[:at] + a[at + 1 :], a[:at] + rng.choice("abcxyzÿ") + a[at + 1 :]])
        met = [spelling.reduced(y) in spelling.neighbourhood(x) for x, y in ((a, b), (b, a))]
        assert spelling.reduced(a) == spelling.reduced(b) or sum(met) == 1


def plain_sets(rows, width=4):
    def one(text):
        w = [x for x in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if x]
        return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    sets = [one(t) for _, t in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and root[i] != root[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    ids = defaultdict(list)
    for (i, _), r in zip(rows, root):
        ids[r].append(i)
    least = {r: min((i for i in x if i is not None), default=None) for r, x in ids.items()}
    out = []
    for (i, _), s, r in zip(rows, sets, root):
        c = least[r] if s else i
        out.append((i, len(s), c, i == c))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [256, 4])
def test_sets_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", block)
    rng = random.Random(17)
    given = [(r.doc_id, r.text) for r in documents(spark).collect()]
    passage = sentence(rng, 40, 4000)
    for b in range(30):
        base = sentence(rng, rng.choice([4, 9, 30, 120, 300]), 4000) + (f" {passage}" if b % 2 else "")
        for _ in range(12):
            words = base.split(" ")
            for _ in range(rng.randrange(1 + len(words) // 20)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            given.append((1000 + len(given), "  ".join(words).title() if b % 3 else " ".join(words)))
    # A crowd of copies of one text whose edits set many of them apart.
    crowd = sentence(rng, 100, 9000).split(" ")
    for i in range(150):
        words = list(crowd)
        for _ in range(rng.randrange(8)):
            words[rng.randrange(100)] = f"edit{rng.randrange(10**6)}"
        given.append((5000 + i, " ".join(words)))
    docs = spark.createDataFrame(given, "doc_id long, text string").selectExpr("*", "7 AS n", "8 AS c", "9 AS root", "1 AS key", "2 AS band")
    found = setsketch.set_duplicates(docs.repartition(5))
    assert rows_of(found, "doc_id", "n_shingles", "component_id", "kept") == plain_sets(given)
    assert setsketch.set_duplicates(empty(spark)).count() == 0


def test_sketches_estimate_and_merge():
    rng = np.random.default_rng(4)
    for n, share in ((60, 0.8), (400, 0.8), (3000, 0.5), (400, 0.0), (20_000, 0.9)):
        errors = []
        for _ in range(20):
            both = rng.integers(0, 2**64, round(n * share), dtype=np.uint64)
            one, other = (np.concatenate([both, rng.integers(0, 2**64, n - len(both), dtype=np.uint64)]) for _ in range(2))
            a, b = setsketch.registers(one), setsketch.registers(other)
            assert (np.maximum(a, b) == setsketch.registers(np.concatenate([one, other]))).all()
            sizes = np.array([float(n)])
            found = setsketch.similarity(np.array([(a > b).sum()]), np.array([(a < b).sum()]), sizes, sizes)[0]
            errors.append(found - len(both) / (2 * n - len(both)))
        assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < setsketch.MARGIN


def test_shingles_are_counted_exactly():
    words = [b"a", b"b", b"c"] * 50 + [b"d"]
    assert len(setsketch.shingle_hashes(words, 4)) == len({tuple(words[i : i + 4]) for i in range(len(words) - 3)})
    many = [b"%d" % (i % 70_000) for i in range(140_050)]
    assert len(setsketch.shingle_hashes(many, 4)) == 70_000
    assert len(setsketch.shingle_hashes([b"a", b"b"], 4)) == 1 and not len(setsketch.shingle_hashes([], 4))


def plain_divergence(rows, least):
    found = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)})))) for lang, source, t in rows]
    out = []
    for lang in {r[0] for r in found}:
        docs = Counter(t for g, _, c in found if g == lang for t in c)
        kept = sorted(t for t, n in docs.items() if n >= least)
        sums = defaultdict(Counter)
        for g, s, c in found:
            if g == lang:
                sums[s].update({t: c[t] for t in kept})
        total = sum(sums.values(), Counter())

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        mine, q = {s: p(c) for s, c in sums.items()}, p(total)
        for s in sums:
            pairs = [(-sum(abs(mine[s][t] - mine[o][t]) for t in kept), o) for o in sums if o != s]
            terms = [(q[t] - mine[s][t], t) for t in kept if sums[s][t] and mine[s][t] > q[t]]
            for part, values in (("pair", pairs), ("term", terms)):
                for rank, (v, item) in enumerate(sorted(values, key=lambda x: (x[0], x[1].encode())), 1):
                    if part == "pair" or rank <= 50:
                        out.append((lang, s, part, item, -v, rank))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least", "hot"), [(30, 1_000_000), (3, 20)])
def test_divergence_equals_brute_force(spark, least, hot, monkeypatch):
    monkeypatch.setattr(divergence, "LEAST_DOCS", least)
    monkeypatch.setattr(divergence, "HOT", hot)
    monkeypatch.setattr(divergence, "PIECE_BYTES", 4_000)
    rng = random.Random(8)
    rows = [(r.lang, r.source, r.text) for r in documents(spark).collect()]
    for i in range(400):
        words = [rng.choice(["The", "the,", "a-b", "é", "É", "x_y", "don't", "a/a/a", "漢字", "w%d" % rng.randrange(60)]) for _ in range(rng.randrange(30))]
        rows.append((rng.choice(["en", "fr"]), f"s{rng.randrange(5)}", rng.choice([" ", "\n", "  "]).join(words)))
    rows += [("lonely", "only", "a b"), ("none", "x", "1 2"), ("none", "y", None), (None, None, None), ("en", None, "the " * 5000)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string")
    docs = docs.selectExpr("*", "1 AS gid", "2 AS term", "3 AS chunk", "4 AS n", "5 AS piece", "6 AS part", "7 AS z").repartition(5)
    found = divergence.source_divergence(docs)
    assert rows_of(found, "lang", "source", "part", "item", "value", "rank") == plain_divergence(rows, least)
    assert divergence.source_divergence(empty(spark)).count() == 0


def test_probabilities_are_exact_for_large_counts(spark):
    n = 9 * 10**17
    df = spark.createDataFrame([(n, 3 * n + 1, 7)], "c long, t long, v long")
    found = df.select(divergence.probability(df.c, df.t, df.v).alias("p")).first().p
    assert found == 1 + 10**9 * (n + 5) // (3 * n + 1 + 35)
