"""Language, fingerprints and secrets."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.llm import fingerprints, language, queries, secrets

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    got = queries.op2_language(spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    both = got.merge(docs, on="doc_id")
    assert len(both) == len(docs) and both["score"].between(0, 1).all()
    held = both[both["held_out"]]
    assert 0.15 < len(held) / len(both) < 0.35
    assert (held["lang_pred"] == held["lang"]).mean() > 0.98
    assert both["rejected"].mean() < 0.01


def test_language_edges(spark, make, odd, odd_rows, empty):
    model = language.train(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = language.identify(odd, model).collect()
    assert len(rows) == len(odd_rows) and set(odd.columns) < set(rows[0].asDict())
    for r in rows:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not letters) and (letters or (r["score"] == 0 and r["rejected"]))
    assert language.train(empty) is None and language.identify(empty, model).count() == 0
    assert {r["lang_pred"] for r in language.identify(odd, None).collect()} == {"und"}
    assert language.train(make([(1, "only one", None, None)])) is None


def test_grams_stay_inside_texts():
    data = np.frombuffer(b"abcdefgh  xyz", np.uint8)
    _, row = language.grams(data, np.asarray([0, 4, 4, 13]))
    assert set(row.tolist()) <= {0, 2} and (row == 0).sum() == 3  # abc, bcd, abcd


def winnowed(text, k=fingerprints.GRAM, w=fingerprints.WINDOW):
    words = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % fingerprints.PRIME for x in words]
    runs = [h[i:i + k] for i in range(len(h) - k + 1)] if len(h) >= k else [h] if h else []
    hashes = []
    for run in runs:
        v = 0
        for x in run:
            v = (v * fingerprints.POINT + x) % fingerprints.PRIME
        hashes.append(v)
    out = []
    for s in range(max(1, len(hashes) - w + 1)) if hashes else ():
        window = hashes[s:s + w]
        best = min(window)
        at = s + max(i for i, v in enumerate(window) if v == best)
        if (best, at) not in out[-1:]:
            out.append((best, at))
    return ",".join(f"{v:X}:{i}" for v, i in out)


def test_fingerprints_match_brute_force(make):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.choice((0, 1, 3, 5, 12, 13, 80)))), "en", "s") for i in range(60)] + [(60, None, None, None)]
    texts = {i: t or "" for i, t, _, _ in rows}
    got = fingerprints.fingerprints(make(rows)).select("doc_id", "edited_text", fingerprints.shown("grams").alias("f"), fingerprints.shown("edited_grams").alias("e")).collect()
    assert len(got) == 61
    for r in got:
        t, after = texts[r["doc_id"]], texts[(r["doc_id"] + 1) % 61]
        q = len(t) // 4
        assert r["edited_text"] == t[:len(t) - q] + after[:q]
        assert r["f"] == winnowed(t) and r["e"] == winnowed(r["edited_text"])


def test_shared_run_of_words_shares_a_fingerprint(make):
    rng = random.Random(9)
    need = fingerprints.GRAM + fingerprints.WINDOW - 1
    rows, runs = [], {}
    for i in range(40):
        run = [f"w{rng.randrange(10**6)}" for _ in range(need)]
        for side in (0, 1):
            pad = lambda: [f"p{rng.randrange(10**6)}" for _ in range(rng.randrange(30))]
            rows.append((2 * i + side, " ".join(pad() + run + pad()), "en", "s"))
    got = {r["doc_id"]: {x >> 31 for x in r["grams"]} for r in fingerprints.fingerprints(make(rows)).select("doc_id", "grams").collect()}
    assert all(got[2 * i] & got[2 * i + 1] for i in range(40))


def test_fingerprint_ranges_and_edges(odd, odd_rows, empty, make):
    one = sorted(map(str, fingerprints.with_next(odd).where("not guard").select("doc_id", "text", "next_text").collect()))
    many = sorted(map(str, fingerprints.with_next(odd, bucket_bytes=300).where("not guard").select("doc_id", "text", "next_text").collect()))
    assert one == many and len(one) == len(odd_rows)
    assert fingerprints.fingerprints(empty).count() == 0
    only = fingerprints.fingerprints(make([(1, "just a few words", "en", "s")])).first()
    assert only["edited_text"] == "just a few w" + "just"
    likes = fingerprints.fingerprints(odd).select("text", fingerprints.likeness("grams", "edited_grams").alias("x")).collect()
    assert all(0 <= r["x"] <= 1 for r in likes)


def base_of(text):
    text = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)]


@pytest.fixture(scope="module")
def secret_rows():
    rng = random.Random(2)
    pick = lambda s, n: "".join(rng.choice(s) for _ in range(n))
    key = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows = []
    for i in range(300):
        middle = rng.choice([
            lambda: f'API_key: "{pick(key, 24)}"', lambda: f"password = {pick(key, rng.randrange(4, 12))}", lambda: "AKIA" + pick(key[:26] + "0123456789", rng.randrange(8, 18)),
            lambda: pick("0123456789abcdef", rng.randrange(28, 40)), lambda: "password=secret: abcdefghij", lambda: "token==" + pick(key, 9), lambda: "nothing"])()
        rows.append((i, f"ordinary words été about {middle} and some more identifiers like internationalization_of_everything", "en", "s"))
    rows += [(1000, "found " + pick(key, 40) + " here", "en", "s"), (1001, None, None, None), (1002, "", None, None), (1003, "see configuration_manager_factory_builder_default", "en", "s")]
    return rows + [(2000, " ".join(dir(F)) + " " + " ".join(dir(pd)) + " " + " ".join(dir(np)), "en", "s")]


ABROAD = {
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в духе братства.",
    "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられている。",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "hu": "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek.",
    "zh": "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
}


def test_unlearned_languages_are_rejected(spark, make):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs.where(~language.held_out()))
    rng = random.Random(3)
    noise = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 12))) for _ in range(60)) for _ in range(20)]
    abroad = [(i, t * 2, None, "s") for i, t in enumerate([*ABROAD.values(), *noise])]
    assert all(r["rejected"] for r in language.identify(make(abroad), model).collect())
    own = language.identify(docs.select("doc_id", "text"), model).where("text rlike '[a-z]'").groupBy("rejected").count().collect()
    turned = {r["rejected"]: r["count"] for r in own}
    assert turned.get(True, 0) <= 0.01 * turned[False]


def test_sample_is_bounded_without_ids(make):
    rows = [(None, f"word{i} some more words of text", "en", "s") for i in range(3000)] + [(7, f"mot{i} encore des mots", "fr", "s") for i in range(2000)]
    got = language.sample(make(rows))
    assert {lang: len({r["place"] for r in got if r["lang"] == lang}) for lang in ("en", "fr")} == {"en": 600, "fr": 600}


def test_own_names_as_extra_columns(spark, make):
    docs = make([(i, f"the cat number {i} sat on the mat", "en", "s") for i in range(50)]).selectExpr("*", "1 as lang_pred", "2 as rejected", "3 as score", "4 as _text")
    docs = docs.drop("size", "shard")
    model = language.train(docs)
    rows = language.identify(docs, model, "new_")
    assert rows.columns == [*docs.columns, "new_lang_pred", "new_score", "new_rejected"] and rows.where("lang_pred = 1 and new_lang_pred = 'en'").count() == 50


def test_secrets_base_and_added_spans(make, secret_rows, empty):
    docs = make(secret_rows)
    got = {r["doc_id"]: r for r in secrets.scan(docs).select("doc_id", secrets.joined("base").alias("base"), secrets.joined("spans").alias("spans")).collect()}
    for i, text, _, _ in secret_rows:
        assert got[i]["base"].split(",") == base_of(text) or (got[i]["base"] == "" and not base_of(text))
        assert set(filter(None, got[i]["base"].split(","))) <= set(got[i]["spans"].split(","))
    assert got[1000]["spans"] == "random:6:46" and got[1003]["spans"] == ""
    for i in range(300):  # nothing but cut-off keys is added beside the base spans
        assert all(re.fullmatch("AKIA[A-Z0-9]+|[0-9a-f]+", secret_rows[i][1][int(a):int(b)]) for k, a, b in (x.split(":") for x in got[i]["spans"].split(",") if x) if k == "random")
    assert secrets.scan(empty).count() == 0 and secrets.model(empty) == []


def test_secrets_of_odd_rows(odd, odd_rows):
    rows = secrets.scan(odd).select("doc_id", F.size("base").alias("n")).collect()
    assert len(rows) == len(odd_rows) and sum(r["n"] for r in rows) == sum(len(base_of(r[1])) for r in odd_rows)


def test_many_secrets_in_one_text(make, secret_rows):
    """Spans of a long text are found in a time that follows their number, and overlaps with base spans are seen among many."""
    import time

    rng = random.Random(6)
    key = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    pick = lambda n: "".join(rng.choice(key) for _ in range(n))
    lines = lambda n: " ".join(f"password={pick(8)}x " + (pick(30) if i % 50 == 0 else "word") for i in range(n))
    texts = {n: lines(n) for n in (300, 4000, 16000)}
    ratios = secrets.model(make(secret_rows))
    took = {}
    for n, text in texts.items():
        docs = make([(1, text, "en", "s")])
        start = time.perf_counter()
        row = secrets.scan(docs, ratios).select(secrets.joined("base").alias("base"), secrets.joined("spans").alias("spans")).first()
        took[n] = time.perf_counter() - start
        assert row["base"].split(",") == base_of(text)
        added = {x for x in row["spans"].split(",") if x.startswith("random")}
        want = {f"random:{m.start()}:{m.end()}" for m in re.finditer("(?<= )[A-Za-z0-9+/]{30}(?= |$)", text)}
        assert len(added & want) >= 0.95 * len(want) and added <= want
    assert took[16000] < 10 * max(took[4000], 0.5)
