"""Exact top-k search, hard negatives and phrases against brute force."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import collect, prose
from pyspark.sql import functions as F

from tideline.llm import hard_negatives, kd_search, phrases, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, row long, shard int, kind int, asks boolean, score string, least double, cell int, place int, scores string, x string"


def table(spark, rows):
    """Rows of (vec_id, embedding, label) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 0, 0, 0, False, "x", 0.0, 0, 0, "x", "x") for r in rows], SCHEMA)


def clustered(rng, n, dims, copies=0):
    centres = rng.normal(size=(8, dims))
    points = centres[rng.integers(0, 8, n)] + 0.2 * rng.normal(size=(n, dims))
    points[: copies] = points[0]
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    return [(i, [float(np.float32(x)) for x in p], int(rng.integers(0, 4))) for i, p in enumerate(points)]


ODD = [
    (100, [0.5, 0.5, 0.0], 1), (100, [0.5, 0.5, 0.0], 1), (101, [0.5, 0.5, 0.0], 1), (200, None, 1), (300, [0.1, None, 0.2], 1), (400, [float("nan"), 0.1, 0.1], 2),
    (500, [float("inf"), 0.0, 0.0], 2), (600, [], 1), (700, [0.25], 2), (None, [0.5, 0.4, 0.1], 1), (None, [0.4, 0.5, 0.1], 2), (800, [-0.5, -0.5, 0.1], None), (7, [0.3, 0.3, 0.3], 2),
    (900, [0.0, 0.0, 0.0], 3), (901, [-0.1, 0.2, 0.3], 3), (14, [0.45, 0.5, 0.0], 9),
]


def whole(embedding, scale):
    if embedding is None or any(x is None or not math.isfinite(x) for x in embedding):
        return None
    return [math.floor(scale * float(np.float32(x))) for x in embedding]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def last(vec_id):
    return (vec_id is None, vec_id or 0)


def brute_top(rows, k, scale, asks):
    found = [(i, r[0], whole(r[1], scale)) for i, r in enumerate(rows) if whole(r[1], scale) is not None]
    out = []
    for i, q, v in found:
        if q is not None and asks(q):
            best = sorted(((-dot(v, w), last(c), c) for j, c, w in found if j != i), key=lambda x: x[:2])[:k]
            out += [(q, n + 1, c, -s) for n, (s, _, c) in enumerate(best)]
    return sorted(out, key=str)


@pytest.mark.parametrize("many", [False, True])
def test_top_k(spark, monkeypatch, many):
    """Odd rows, ties, copies; in one shard, and in many shards with several for the cell of the copies."""
    rows = clustered(np.random.default_rng(5), 700, 6, copies=200) + [(i, e if e is None else e + [0.1] * (len(e) == 3), x) for i, e, x in ODD]
    if many:
        monkeypatch.setattr(vectors, "SHARD_ROWS", 40)
    got = kd_search.top_k(table(spark, rows).repartition(5), F.col("vec_id") % 100 == 0, 10)
    assert sorted(collect(got, "query_id", "rank", "vec_id", "score"), key=str) == brute_top(rows, 10, 1024, lambda q: q % 100 == 0)


def test_top_k_of_few_rows(spark):
    few = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 2)]
    got = kd_search.top_k(table(spark, few), F.col("vec_id") == 0, 5)
    assert collect(got.orderBy("rank"), "vec_id", "score") == [(1, 524288), (2, 524288)]
    assert kd_search.top_k(table(spark, []), F.lit(True)).count() == 0
    assert kd_search.top_k(table(spark, few), F.lit(None).cast("boolean")).count() == 0
    with pytest.raises(ValueError):
        kd_search.top_k(table(spark, [(1, [3e30], 1)]), F.lit(True))


def test_tree_visits_few_leaves():
    """Best-first with bounds: on clustered points most leaves are never opened, and nothing is missed."""
    rng = np.random.default_rng(1)
    points = np.floor(1024 * np.array([e for _, e, _ in clustered(rng, 8000, 4)]))
    tree = kd_search.Tree(points, 32)
    bounds = kd_search.reach(points[:20], tree.lo, tree.hi, tree.norm)
    opened = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            opened.append(key)
            return np.asarray(self)[key]

    plain, tree.points = tree.points, tree.points.view(Counting)
    for q in range(20):
        held = tree.top(points[q], bounds[q], 10, -np.inf, -1, np.arange(8000), tree.order)
        assert [-s for s, _ in held] == sorted((plain @ points[q]).tolist(), reverse=True)[:10]
    assert len(opened) < 20 * 0.2 * sum(1 for c in tree.child if not c)


def brute_negatives(rows, anchors, positives=5, negatives=5, share=80, scale=256):
    found = [(i, r[0], whole(r[1], scale), r[2]) for i, r in enumerate(rows) if r[2] is not None and whole(r[1], scale) is not None]
    out = []
    for i, a, v, lab in found:
        if a is None or not anchors(a):
            continue
        scored = sorted(((-dot(v, w), last(c), c, y) for j, c, w, y in found if j != i), key=lambda x: x[:2])
        for p, _, pid, _ in [s for s in scored if s[3] == lab][:positives]:
            window = [s for s in scored if s[3] != lab and share * -p <= 100 * -s[0] <= 100 * -p][:negatives]
            out += [(a, pid, n + 1, c, -p, -s) for n, (s, _, c, _) in enumerate(window)]
    return sorted(out, key=str)


@pytest.mark.parametrize("many", [False, True])
def test_hard_negatives(spark, monkeypatch, many):
    rows = clustered(np.random.default_rng(9), 500, 20, copies=120) + [(i, e if e is None else e + [0.1] * (len(e) == 3), x) for i, e, x in ODD]
    if many:
        monkeypatch.setattr(vectors, "SHARD_ROWS", 40)
    got = hard_negatives.mine(table(spark, rows).repartition(4), F.col("label"), F.col("vec_id") % 20 == 0)
    assert sorted(collect(got, "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), key=str) == brute_negatives(rows, lambda a: a % 20 == 0)
    assert hard_negatives.mine(table(spark, []), F.col("label"), F.lit(True)).count() == 0


def test_index_leaves_out_and_prunes():
    """Rows lose their last blocks to the bound; a search still finds every row that reaches the threshold."""
    rng = np.random.default_rng(2)
    points = np.floor(256 * rng.normal(size=(3000, 64)) / 8 * np.geomspace(1, 0.05, 64))
    held = hard_negatives.Rows(points, np.arange(3000))
    for q in points[:30]:
        remains = hard_negatives.remaining(q)
        scores = points @ q
        for least in (np.sort(scores)[-5], 0.5 * scores.max(), 0.0, -np.inf):
            at, got = held.above(q, remains, least)
            assert sorted(at.tolist()) == np.flatnonzero(scores >= least).tolist() and (got == scores[at]).all()
    high = [x for step, x in held.levels.items() if step is not None]
    assert high and min(len(p) for p in min(high, key=lambda x: sum(map(len, x.postings))).postings) < 1000


# ---- phrases -------------------------------------------------------------------------


def brute_phrases(rows, support, longest, top):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        long = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        best = []
        for p, a in long.items():
            if any(b >= a and len(x) > len(p) and any(x[i:i + len(p)] == p for i in range(len(x))) for x, b in long.items()):
                continue
            s, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            best.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(best)[:top])]
    return sorted(out)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SMALL = phrases.Limits(task_bytes=5000, shard_words=700, block_bytes=300, run=50, bits=2**12)


@pytest.mark.parametrize("limits", [phrases.Limits(), SMALL])
def test_phrases(make, odd_rows, limits):
    """Odd rows, long texts, phrases across copies, many languages; whole, and in tiny shards, blocks, runs and a crowded bitmap."""
    rng = random.Random(4)
    rows = list(odd_rows) + [(100 + i, prose(rng, 60).replace("9 ", "9, ") + ". New York City Hall! new york\tcity", rng.choice(["en", "und", None, "fr"]), "s") for i in range(150)]
    rows += [(900 + i, "hot line of words, hot line of words", f"l{i % 7}", "s") for i in range(80)] + [(990, "é ü b " * 300, "fr", "s")]
    got = phrases.collocations(make(rows).repartition(6), support=20, longest=4, top=50, limits=limits)
    assert sorted(collect(got, *COLUMNS)) == brute_phrases([r[1:3] for r in rows], 20, 4, 50)


def test_phrases_of_nothing(make, empty):
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(make([(1, None, None, None), (2, "", "en", "a"), (3, " . ", "en", "a")]), 1).count() == 0


def test_scores_beyond_64_bits(make, monkeypatch):
    """Counts whose products pass 64 bits keep exact scores (the counts are given, not read)."""
    spark = make([]).sparkSession
    a, n = 3 * 10**9, 9 * 10**12
    rows = [("en", 0, "", n), ("en", 1, "x", a + 1), ("en", 1, "y", a + 2), ("en", 2, "x y", a)]
    monkeypatch.setattr(phrases, "frequent", lambda *_: spark.createDataFrame(rows, "lang string, words int, phrase string, a long"))
    assert phrases.collocations(make([])).first()["score"] == 1000 * a * n // ((a + 1) * (a + 2))


def test_shards_share_the_support():
    """The shares of a language's shards add up to one, wherever it is cut."""
    import pyarrow as pa

    texts = ["a b. c d", "", "x " * 500, None, "e, f"] * 40
    texts = [t or "" for t in texts]
    total = sum(len(t.encode()) + 1 for t in texts)
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts, "total": [total] * len(texts)})
    for words, block in itertools.product((10, 10**6), (64, 2**23)):
        found = [(len(w.codes), share) for _, w, share in phrases.shards(iter([batch]), phrases.Limits(shard_words=words, block_bytes=block))]
        assert sum(s for _, s in found) == pytest.approx(1.0) and sum(n for n, _ in found) == 40 * 506
