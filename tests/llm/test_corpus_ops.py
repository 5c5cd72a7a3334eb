"""Dedup, resharding, mixing and the pipeline."""

import itertools
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import collect, prose
from pyspark.sql import functions as F

import corpus_pipeline
from oracle_check import compare, connect
from tideline.llm import exact_dedup, graph, mixing, near_dup, queries, resharding, suffix_dedup
from tideline.llm.hashing import byte_slices, shingles

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_agrees_with_sql(spark, name):
    state, info = compare(spark, connect(SMALL), name, queries.QUERIES[name], queries.ORACLE[name], SMALL)
    assert state == "OK", info


# ---- exact dedup ----


@pytest.mark.parametrize("counters", [2, 1000])
def test_exact_dedup(make, odd_rows, counters):
    rows = [*odd_rows, *[(100 + i, "hot text", "en", "s") for i in range(300)]]
    got = exact_dedup.decide(make(rows).repartition(5), counters).collect()
    groups = {}
    for doc, text, *_ in rows:
        groups.setdefault(text or "", []).append(doc)
    assert len(got) == len(rows) and sum(r["kept"] for r in got) == len(groups)
    for r in got:
        mine = next(g for g in groups.values() if len(g) == r["group_size"] and r["doc_id"] in g and (max((x for x in g if x is not None), default=None) == r["keep_id"]))
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    kept = collect(exact_dedup.deduplicated(make(rows), counters), "doc_id", "text")
    assert sorted(t or "" for _, t in kept) == sorted(groups)
    assert all(d == max((x for x in groups[t or ""] if x is not None), default=None) for d, t in kept)


def test_exact_dedup_of_nothing(empty):
    assert exact_dedup.decide(empty).count() == 0 and exact_dedup.deduplicated(empty).columns == empty.columns


def test_heavy_digests_are_found(make):
    docs = make([(i, "hot" if i % 3 == 0 else f"cold {i}", "en", "s") for i in range(900)]).repartition(7)
    heavy = exact_dedup.heavy_digests(exact_dedup.digests(docs), 10).collect()
    assert [(r["n"], r["best"]["doc_id"]) for r in heavy] == [(300, 897)]


# ---- near dedup ----


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def near_components(rows, percent=85):
    sets = [(d, shingle_set(t)) for d, t, *_ in rows if d is not None]
    label = {d: d for d, _ in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((find(a), find(b)))
            label[high] = low
    return {d: find(d) for d, _ in sets}


def near_rows(seed):
    """Families whose members drift away step by step, so that chains, near misses and stars all occur."""
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        words = prose(rng, rng.choice((8, 40, 120))).split()
        for _ in range(rng.choice((1, 6, 14))):
            rows.append(" ".join(words))
            for _ in range(rng.choice((0, 1, 1, 3))):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    rng.shuffle(rows)
    return [(i, t, "en", "s") for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", range(3))
def test_near_components_match_brute_force(make, seed):
    rows = near_rows(seed)
    want = near_components(rows)
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in near_dup.components_of(make(rows).repartition(3)).collect()}
    assert got == {d: (want[d], len(shingle_set(t))) for d, t, *_ in rows}
    assert len(set(want.values())) < len(rows)


def test_pipeline_drops_near_copies_from_80_percent(spark, make):
    """Brute force at 80 percent on families, among them pairs that only link below 85."""
    rows = near_rows(5)
    rng = random.Random(6)
    for i in range(10):
        words = prose(rng, 104).split()
        other = [*words]
        other[20], other[70] = "new", "other"  # 90 of 110 shingles are shared
        rows += [(10_000 + 2 * i, " ".join(words), "en", "s"), (10_001 + 2 * i, " ".join(other), "en", "s")]
    sets = {d: shingle_set(t) for d, t, *_ in rows}
    label = {d: d for d in sets}
    for _ in sets:
        was = dict(label)
        for a, b in itertools.combinations(sets, 2):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
        if was == label:
            break
    got = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, make(rows).repartition(3), SMALL).collect()}
    assert got == set(label.values())
    assert got < set(near_components(rows).values())


def test_near_dedup_edges(odd, odd_rows, empty):
    want = near_components(odd_rows)
    got = near_dup.components_of(odd).collect()
    assert len(got) == len(odd_rows) and all(r["component_id"] == (None if r["doc_id"] is None else want[r["doc_id"]]) for r in got)
    assert {r["doc_id"] for r in near_dup.representatives(odd).collect()} == {None, *want.values()}
    assert near_dup.components_of(empty).count() == 0


@pytest.mark.parametrize("rounds", [0, 4])
def test_copies_of_one_text_around_the_threshold(make, monkeypatch, rounds):
    """One family whose members lie on both sides of the threshold to its smallest: pivots join most, the rest is paired."""
    monkeypatch.setattr(near_dup, "ROUNDS", rounds)
    rng = random.Random(12)
    base, rows = prose(rng, 150).split(), []
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice((1, 1, 2, 2, 3))):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), "en", "s"))
    got = dict(collect(near_dup.components_of(make(rows).repartition(3), 90), "doc_id", "component_id"))
    assert got == near_components(rows, 90)


def test_odd_sketches_bound_the_difference(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(63) for _ in range(150)]
    near = [base[k:] + [rng.getrandbits(63) for _ in range(k)] for k in (0, 1, 10, 25, 60, 149)]
    rows = spark.createDataFrame(list(enumerate(near)), "id long, set array<long>").coalesce(1).mapInArrow(near_dup.odd_sketch, "id long, odd array<long>")
    one, two = (rows.selectExpr(f"id as {k}", f"odd as odd_{k}") for k in "ab")
    for a, b, n in one.crossJoin(two).select("a", "b", near_dup.apart_at_least("odd_a", "odd_b")).collect():
        real = len(set(near[a]) ^ set(near[b]))
        assert 0.75 * real <= n <= real and (real - n) % 2 == 0


def test_odd_sketches_take_few_sets_at_once():
    rng = np.random.default_rng(1)
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(list(rng.integers(0, 1 << 62, (4000, 20))), pa.list_(pa.int64()))], ["id", "set"])
    tracemalloc.start()
    try:
        sketched = sum(out.num_rows for out in near_dup.odd_sketch(iter([batch])))
        assert sketched == 4000 and tracemalloc.get_traced_memory()[1] < 32 << 20
    finally:
        tracemalloc.stop()


def test_members_of_one_large_group_are_not_all_estimated(make, monkeypatch):
    """Copies of one passage, each changed at places of its own: hardly any pair reaches the threshold, and few are estimated."""
    frame = type(make([]))
    pairs, run = [], frame.mapInArrow

    def counted(df, function, schema, *rest):
        if function is near_dup.estimate:
            pairs.append(df.count())
        return run(df, function, schema, *rest)

    rng = random.Random(12)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        own = list(words)
        for at in rng.sample(range(0, 150, 5), 2):
            own[at] = f"x{rng.random()}"
        rows.append((i, " ".join(own), "en", "s"))
    monkeypatch.setattr(frame, "mapInArrow", counted)
    got = dict(collect(near_dup.components_of(make(rows).repartition(3)), "doc_id", "component_id"))
    assert got == near_components(rows)
    assert sum(pairs) < 120


def test_links_are_contracted(spark):
    labels = spark.createDataFrame([(i, i // 10 * 10) for i in range(40)], "id long, label long")
    links = spark.createDataFrame([(a, b) for a in range(10, 20) for b in range(20, 30)] + [(1, 2)], "a long, b long")
    got = dict(collect(near_dup.merged(labels, links), "id", "label"))
    assert got == {i: 10 if 10 <= i < 30 else i // 10 * 10 for i in range(40)}


def test_long_and_short_texts_hash_alike():
    import pyarrow as pa

    rng = random.Random(1)
    long = prose(rng, 400_000)
    texts = ["a b c", long, "", "x" * 3_000_000, long[:5000]]
    got = [s for _, data, offsets in byte_slices(pa.array(texts)) for s in shingles(data, offsets)]
    assert [len(s) for s in got] == [len(shingle_set(t)) for t in texts]


def test_likelihood_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(0)
    for j in (0.5, 0.85, 0.95):
        all_ = rng.integers(0, 2**63, (200, 1000)).astype(np.uint64)
        both = int(round(1000 * j))
        rest = (1000 - both) // 2
        estimates = []
        for e in all_:
            x, y = near_dup.registers(e[:both + rest]), near_dup.registers(np.r_[e[:both], e[both + rest:]])
            estimates.append(near_dup.likeliest(np.asarray([float(both + rest)]), np.asarray([float(1000 - rest)]), np.asarray([(x > y).sum()]), np.asarray([(x < y).sum()]))[0])
        assert abs(np.mean(estimates) - j) < 0.01 and np.std(estimates) < 0.06
        merged = np.maximum(near_dup.registers(all_[0][:500]), near_dup.registers(all_[0][400:]))
        assert (merged == near_dup.registers(all_[0])).all()


def test_components_of_a_long_chain(spark):
    links = spark.range(200).selectExpr("id + 1 as a", "id as b").union(spark.createDataFrame([(1000, 1001)], "a long, b long"))
    got = dict(collect(graph.components(links), "id", "label"))
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


# ---- suffix dedup ----


def removed(rows, length=suffix_dedup.LENGTH):
    first = {}
    for d, t, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i:i + length], d)
    out = []
    for d, t, *_ in rows:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1) if d is not None else ():
            if first[raw[i:i + length]] < d:
                gone[i:i + length] = [True] * length
        out.append((d, len(raw), bytes(b for b, g in zip(raw, gone) if not g), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))))
    return sorted(out, key=str)


def cut_rows(df):
    out = []
    for r in df.collect():
        whole = r["copy"] and r["n_bytes"] >= suffix_dedup.LENGTH
        out.append((r["doc_id"], r["n_bytes"], b"" if whole else r["kept"], 1 if whole else len(r["spans"] or ())))
    return out


def passages(seed):
    rng = random.Random(seed)
    shared = [prose(rng, rng.choice((6, 9, 20))) for _ in range(6)] + ["ab" * 60, "z" * 90]
    rows = []
    for i in range(80):
        parts = [rng.choice(shared) if rng.random() < 0.5 else prose(rng, rng.choice((2, 15))) for _ in range(rng.randrange(6))]
        if rng.random() < 0.3 and parts:
            at = rng.randrange(len(parts))
            parts[at] = parts[at][rng.randrange(10):][:rng.randrange(40, 80)]
        rows.append((i, " é ".join(parts), "en", "s"))
    return rows


def test_pointers_are_equal_for_equal_strings():
    import numpy as np

    rng = np.random.default_rng(3)
    for letters in (2, 60):
        context = rng.integers(97, 97 + letters, (40, suffix_dedup.WIDTH)).astype(np.uint8)
        context[10:20, 5:70] = context[0, 2:67]
        context[20:25] = context[0]
        pointer = suffix_dedup.refined(context)
        text = {(r, o): context[r, o:o + suffix_dedup.LENGTH].tobytes() for r in range(40) for o in range(pointer.shape[1])}
        numbers = {}
        for at, string in text.items():
            numbers.setdefault(string, set()).add(int(pointer[at]))
        assert all(len(x) == 1 for x in numbers.values()) and len(set.union(*numbers.values())) == len(numbers)


def test_surroundings_grow_with_the_text(make):
    """Four times the text makes about four times the rows that are shuffled, whatever the number of slices."""
    counts = []
    for n in (100, 400):
        rng = random.Random(5)
        rows = [(i, f"{prose(rng, 40)} {prose(random.Random(i // 2), 20)} {prose(rng, 40)}", "en", "s") for i in range(n)]
        known = make(rows).selectExpr("doc_id", "text").repartition(3)
        counts.append(known.mapInArrow(suffix_dedup.to_buckets(2, 4000), suffix_dedup.BUCKETS).count())
    assert counts[1] < 5 * counts[0]


def test_shared_buckets_answer_by_slice(make):
    """More routes do not make a row for each document on each route."""
    rng = random.Random(5)
    rows = [(i, f"{prose(rng, 40)} {prose(random.Random(i // 40), 60)}", "en", "s") for i in range(400)]
    known = make(rows).selectExpr("doc_id", "text").coalesce(1)
    sent = known.mapInArrow(suffix_dedup.to_buckets(16, 60_000), suffix_dedup.BUCKETS)
    assert 0 < sent.groupBy("route").applyInPandas(lambda route: suffix_dedup.shared_buckets(route, 20_000), suffix_dedup.SHARED).count() < 400


def test_rows_of_one_doc_id_stay_as_many(make):
    shared = prose(random.Random(6), 20)
    rows = [(1, shared, "en", "s"), (2, "x " + shared, "en", "s"), (2, "x " + shared, "en", "s"), (None, shared, "en", "s")]
    got = [(str(d), n, s) for d, n, _, s in cut_rows(suffix_dedup.removed(make(rows)))]
    assert sorted(got) == sorted((str(d), n, s) for d, n, _, s in removed(rows))


@pytest.mark.parametrize("seed,hot", [(0, 2000), (1, 2), (2, 2000)])
def test_suffix_dedup_matches_brute_force(make, seed, hot):
    rows = passages(seed)
    texts = {r[0]: r[1].encode() for r in rows}
    got = [(d, n, texts[d] if k is None else k, s) for d, n, k, s in cut_rows(suffix_dedup.removed(make(rows).repartition(4), hot, 4000, 64))]
    assert sorted(got, key=str) == removed(rows)
    assert sum(n - len(k) for _, n, k, _ in got) > 1000


@pytest.mark.parametrize("block", [16, 8192])
def test_hot_piece_meets_all_its_anchors(make, block):
    """Documents 2i and 2i+1 share passage i and lie in one slice; document 1000 + i repeats it beyond the limit of hot pieces."""
    rng = random.Random(4)
    shared = [prose(rng, 12) for _ in range(20)]
    rows = [(i, f"{prose(rng, 10)} {shared[i // 2]} {prose(rng, 10)}", "en", "s") for i in range(40)]
    rows += [(1000 + i, " ".join(f"{x} {prose(rng, 2)}" for x in [shared[i]] * 8), "en", "s") for i in range(20)]
    texts = {r[0]: r[1].encode() for r in rows}
    docs, one_slice = make(rows).coalesce(1), sum(len(texts[i]) for i in range(40))
    got = [(d, n, texts[d] if k is None else k, s) for d, n, k, s in cut_rows(suffix_dedup.removed(docs, 4, one_slice, block))]
    assert sorted(got, key=str) == removed(rows)


def test_suffix_dedup_edges(odd, odd_rows, empty):
    got = cut_rows(suffix_dedup.removed(odd))
    want = removed(odd_rows)
    assert sorted((str(d), n, s) for d, n, _, s in got) == sorted((str(d), n, s) for d, n, _, s in want)
    assert sorted(k for *_, k, s in got if s) == sorted(k for *_, k, s in want if s)
    assert suffix_dedup.removed(empty).count() == 0


# ---- resharding ----


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(4)
    for _ in range(50):
        old = {i: rng.randrange(0, 50) for i in range(rng.randrange(1, 5))}
        n = rng.randrange(1, 6)
        total = sum(old.values())
        caps = {j: total // n + (j < total % n) for j in range(n)}
        plan = resharding.transfers(old, caps)
        assert all(sum(x for i, _, x in plan if i == k) == v for k, v in old.items())
        assert all(sum(x for _, j, x in plan if j == k) == v for k, v in caps.items())
        assert sum(x for i, j, x in plan if i != j) == total - sum(min(v, caps.get(i, 0)) for i, v in old.items())


def test_reshard(spark, make, odd, odd_rows, empty):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(1, 60)), "en", rng.choice("aaab")) for i in range(3000)]
    folder, schema = resharding.lay_out(make(rows), F.when(F.col("source") == "a", 0).otherwise(5))
    layout = resharding.reshard(spark, folder, schema, 4)
    got = layout.read().collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted(r[:2] for r in rows)
    sizes = {}
    for r in got:
        sizes.setdefault(r["_shard"], []).append((r["_slot"], r["_size"]))
        assert r["_size"] == len(r["text"].encode()) + 1 and r["shard"] == "x"
    assert sorted(sizes) == [0, 1, 2, 3] and all(sorted(s for s, _ in v) == list(range(len(v))) for v in sizes.values())
    weight = [sum(n for _, n in v) for v in sizes.values()]
    assert max(weight) - min(weight) < 2 * 600
    again = resharding.reshard(spark, *resharding.lay_out(make(rows), F.pmod(F.col("doc_id"), F.lit(1)).cast("int")), 1)
    assert again.untouched == [0] and again.read().count() == 3000
    for docs, n in ((odd, len(odd_rows)), (empty, 0)):
        folder, schema = resharding.lay_out(docs, F.lit(0))
        assert resharding.reshard(spark, folder, schema, 3).read().count() == n


@pytest.mark.parametrize("doc_id,same", [(None, False), (7, True)])
def test_rows_without_an_id_of_their_own_are_split(spark, make, doc_id, same):
    rows = [(doc_id, "one text of all" if same else f"text number {i} of many", "en", "s") for i in range(8000)]
    folder, schema = resharding.lay_out(make(rows).repartition(4), F.lit(0))
    got = resharding.reshard(spark, folder, schema, 4).read().groupBy("_shard").agg(F.sum("_size").alias("n")).collect()
    weight = [r["n"] for r in got]
    assert len(weight) == 4 and max(weight) - min(weight) <= 0.01 * max(weight)


# ---- mixing ----


def water(sizes, weights=(5, 2, 1), cap=3):
    order = sorted((k for k in sizes if k is not None)) + ([None] if None in sizes else [])
    w = {k: weights[i % 3] for i, k in enumerate(order)}
    left, out, open_ = float(sum(sizes.values())), {}, set(order)
    while open_:
        share = {k: left * w[k] / sum(w[x] for x in open_) for k in open_}
        full = {k for k in open_ if share[k] > cap * sizes[k]}
        if not full:
            return out | share
        for k in full:
            out[k] = float(cap * sizes[k])
            left -= out[k]
        open_ -= full
    return out


def mixed_ok(rows, got):
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    goal, taken, largest = water(sizes), {}, {}
    source = {d: s for d, _, _, s in rows}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - goal[s]) < 1e-6 * max(1, goal[s]) and 0 <= r["copies"] <= 3
        taken[s] = taken.get(s, 0) + r["copies"] * r["size"]
        largest[s] = max(largest.get(s, 0), r["size"])
    for s, t in taken.items():
        assert abs(t - goal[s]) <= max(1, largest[s]), (s, t, goal[s])


@pytest.mark.parametrize("slices", [10_000, 7])
def test_mix_comes_near_its_targets(make, monkeypatch, slices):
    monkeypatch.setattr(mixing, "SLICE_ROWS", slices)
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.choice((1, 5, 5, 5, 30, 200))), "en", rng.choice(["a", "a", "a", "b", "é", "Z", None])) for i in range(800)]
    rows.append((9000, prose(rng, 40), "en", "tiny"))
    docs = make(rows)
    got = mixing.balance(docs).collect()
    assert len(got) == len(rows)
    mixed_ok(rows, got)
    again = sorted((r["doc_id"], r["copies"]) for r in mixing.balance(docs.repartition(7)).collect())
    assert again == sorted((r["doc_id"], r["copies"]) for r in got)
    out = mixing.mixed(docs)
    copies = {r["doc_id"]: r["copies"] for r in got}
    seen = {}
    for r in out.collect():
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
    assert seen == {d: c for d, c in copies.items() if c} and out.columns == docs.columns


def test_mix_edges(odd, odd_rows, empty):
    got = mixing.balance(odd).collect()
    assert len(got) == len(odd_rows) and all(r["copies"] <= 3 for r in got)
    assert mixing.balance(empty).count() == 0 and mixing.mixed(empty).count() == 0
    assert mixing.mixed(odd).count() == sum(r["copies"] for r in got)


def test_texts_of_the_mix_are_not_shuffled(spark, make, monkeypatch):
    """What meets the texts has a row for each source and length, and rows that nothing but their place tells apart are counted."""
    rows = [(i, "word " * (1 + i % 3), "en", "ab"[i % 2]) for i in range(6000)] + [(7, "one two", "en", "a")] * 500
    written, write = {}, mixing.stage

    def counted(df, name):
        written[name] = write(df, name)
        return written[name]

    monkeypatch.setattr(mixing, "stage", counted)
    out = mixing.mixed(make(rows))
    assert all(df.count() <= 6 for name, df in written.items() if name != "sizes")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    got = out.groupBy("doc_id").count().collect()
    want = {}
    for r in mixing.balance(make(rows)).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"]
    assert {r["doc_id"]: r["count"] for r in got} == {d: n for d, n in want.items() if n}


OWN_NAMES = ("_id", "_sha", "_stays", "_digest", "_copies", "_taken", "_key", "_size", "_no", "_text", "_letters", "lang_pred", "score", "rejected", "row",
             "place", "file", "copies", "key", "h", "sha", "keep_id", "file_path", "row_index", "label", "n_shingles", "component_id")


def test_stages_with_own_names_as_columns(make, odd, odd_rows):
    """Columns that bear names used inside an operator come through unchanged, whatever the stage."""
    docs = odd.drop("kept", "size", "shard", "sha", "id").selectExpr("*", *[f"concat('mine-', coalesce(cast(doc_id as string), 'none')) as `{c}`" for c in OWN_NAMES])
    spark = docs.sparkSession
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"mine-{'none' if r['doc_id'] is None else r['doc_id']}" for r in rows for c in OWN_NAMES), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= len(odd_rows)


# ---- pipeline ----


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, spark.createDataFrame(function(spark, docs, SMALL).toPandas(), docs.schema)
        assert docs.columns == before.columns
        kept[name] = (before.collect(), docs.collect())
    was, now = kept["language"]
    assert len(now) >= 0.98 * len(was)
    was, now = kept["exact_dedup"]
    best = {}
    for r in was:
        best[r["text"]] = max(best.get(r["text"], -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in now) == sorted(best.values())
    was, now = kept["near_dedup"]
    label = near_components([(r["doc_id"], r["text"]) for r in was], corpus_pipeline.NEAR_PERCENT)
    assert sorted(r["doc_id"] for r in now) == sorted(set(label.values()))
    was, now = kept["mixing"]
    copies = {r["doc_id"]: 0 for r in was}
    for r in now:
        copies[r["doc_id"]] += 1
    words = {r["doc_id"]: len(r["text"].split()) for r in was}
    by_source = {r["doc_id"]: r["source"] for r in was}
    sizes, taken, largest = {}, {}, {}
    for d, s in by_source.items():
        sizes[s] = sizes.get(s, 0) + words[d]
        taken[s] = taken.get(s, 0) + words[d] * copies[d]
        largest[s] = max(largest.get(s, 0), words[d])
    goal = water(sizes)
    assert max(copies.values()) <= 3 and all(abs(taken[s] - goal[s]) <= largest[s] for s in goal)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= len(now)
