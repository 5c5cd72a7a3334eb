"""The dealt queries: each applies its operator to the whole ``documents`` table and returns digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    exact_dedup, fingerprints, hard_negatives, kd_search, language, mixing, near_dup, packing, phrases, resharding, secrets, suffix_dedup, token_index)
from tideline.llm.common import documents, new_folder
from tideline.llm.encode import tokenizer_path


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.fingerprints(documents(spark, sf_dir))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), fingerprints.shown("grams").alias("fingerprint"),
        fingerprints.shown("edited_grams").alias("edited_fingerprint"), fingerprints.likeness("grams", "edited_grams").alias("near_edited"),
        fingerprints.likeness("grams", "next_grams").alias("near_next"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.train(docs.where(~language.held_out()))
    rows = language.identify(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op3_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = documents(spark, sf_dir), new_folder(spark, "ids")
    manifest = token_index.write_ids(docs, folder, tokenizer_path("word_bpe_49k.json"), end_id=2)
    found = token_index.read_ids(docs.select("doc_id"), manifest, folder)
    return found.select("doc_id", "start", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op4_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as their sources left them, in 16 uneven shards, become 16 even ones."""
    by_source = F.pmod(F.crc32(F.coalesce("source", F.lit(""))), F.lit(16)).cast("int")
    folder, schema = resharding.lay_out(documents(spark, sf_dir), by_source)
    rows = resharding.reshard(spark, folder, schema, 16).read()
    return rows.select(
        "doc_id", F.col("_size").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op5_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.balance(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.removed(documents(spark, sf_dir))
    whole = F.col("copy") & (F.col("n_bytes") >= suffix_dedup.LENGTH)
    return rows.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).when(F.col("kept").isNull(), 0).otherwise(F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.when(whole, 1).when(F.col("kept").isNull(), 0).otherwise(F.size("spans")).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).when(F.col("kept").isNull(), F.lower(F.hex("sha"))).otherwise(F.sha2("kept", 256)).alias("kept_sha256"))


def op7_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), end_id=1).placed
    return packed.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = exact_dedup.decide(documents(spark, sf_dir))
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.scan(documents(spark, sf_dir))
    return rows.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secrets.joined("base"), 256).alias("base_sha256"), secrets.joined("spans").alias("spans"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_dup.components_of(documents(spark, sf_dir))
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op11_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir), support=100, longest=5, top=2000)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hard_negatives.mine(rows, label, F.col("vec_id") % 100 == 0, positives=5, negatives=5, share=80, scale=256)


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_language": op2_language,
    "op3_token_index": op3_token_index,
    "op4_resharding": op4_resharding,
    "op5_entropy_balancing": op5_entropy_balancing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_harmonic_packing": op7_harmonic_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_secrets": op9_secrets,
    "op10_near_dup": op10_near_dup,
    "op11_kd_search": op11_kd_search,
    "op12_phrases": op12_phrases,
    "op13_hard_negatives": op13_hard_negatives,
}

FINGERPRINTS = """
    with d as (
        select doc_id, coalesce(text, '') as text, coalesce(lead(coalesce(text, '')) over (order by doc_id), first_value(coalesce(text, '')) over (order by doc_id)) as next_text
        from documents),
    e as (select *, length(text) as n, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) as edited from d),
    t as (
        select doc_id, 'text' as which, text as s from e union all select doc_id, 'edited', edited from e union all select doc_id, 'next', next_text from e),
    w as (
        select doc_id, which, row_number() over (partition by doc_id, which order by i) - 1 as i, (('0x' || substr(md5(x), 1, 8))::bigint) % 2147483647 as h
        from (select doc_id, which, unnest(string_split_regex(s, '[\\x20\\x09-\\x0D]+')) as x, unnest(range(100000)[:len(string_split_regex(s, '[\\x20\\x09-\\x0D]+'))]) as i from t)
        where x <> ''),
    g as (
        select doc_id, which, i, count(*) over (partition by doc_id, which) as n,
            case when count(*) over f = 5 then ((((first_value(h) over f * 1000003 + nth_value(h, 2) over f) % 2147483647 * 1000003 + nth_value(h, 3) over f) % 2147483647 * 1000003
                + nth_value(h, 4) over f) % 2147483647 * 1000003 + nth_value(h, 5) over f) % 2147483647 end as whole,
            list(h) over (partition by doc_id, which order by i rows between current row and unbounded following) as few
        from (select *, count(*) over (partition by doc_id, which) as n from w)
        window f as (partition by doc_id, which order by i rows between current row and 4 following)),
    p as (
        select doc_id, which, i, case when n >= 5 then whole else list_reduce(few, lambda a, x: (a * 1000003 + x) % 2147483647) % 2147483647 end * 2147483648 + (2147483647 - i) as v
        from g where whole is not null or (n < 5 and i = 0)),
    m as (
        select doc_id, which, min(v) over (partition by doc_id, which order by i rows between current row and 7 following) as v, i,
            count(*) over (partition by doc_id, which) as n from p),
    c as (select distinct doc_id, which, v from m where i <= greatest(n - 8, 0)),
    f as (
        select doc_id, which, string_agg(printf('%X', v >> 31) || ':' || (2147483647 - (v & 2147483647)), ',' order by 2147483647 - (v & 2147483647)) as shown,
            list(distinct v >> 31) as hashes from c group by all)
    select e.doc_id, n as n_chars, sha256(edited) as edited_sha256, coalesce(a.shown, '') as fingerprint, coalesce(b.shown, '') as edited_fingerprint,
        case when a.hashes is null and b.hashes is null then 1.0::double when a.hashes is null or b.hashes is null then 0.0::double
            else len(list_intersect(a.hashes, b.hashes)) / (len(a.hashes) + len(b.hashes) - len(list_intersect(a.hashes, b.hashes)))::double end as near_edited,
        case when a.hashes is null and x.hashes is null then 1.0::double when a.hashes is null or x.hashes is null then 0.0::double
            else len(list_intersect(a.hashes, x.hashes)) / (len(a.hashes) + len(x.hashes) - len(list_intersect(a.hashes, x.hashes)))::double end as near_next
    from e left join f a on a.doc_id = e.doc_id and a.which = 'text' left join f b on b.doc_id = e.doc_id and b.which = 'edited'
        left join f x on x.doc_id = e.doc_id and x.which = 'next'"""

SUFFIX_DEDUP = """
    with d as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
    p as (select doc_id, unnest(range(length(x) // 2 - 49)) as i from d where length(x) >= 100),
    s as (select doc_id, i, substr(x, 2 * i + 1, 100) as s from p join d using (doc_id)),
    m as (select s, min(doc_id) as least from s group by s having count(*) > 1),
    c as (select doc_id, i from s join m using (s) where least < doc_id),
    e as (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as new from c),
    g as (select doc_id, i, sum(new) over (partition by doc_id order by i) as g from e),
    r as (select doc_id, min(i) as a, max(i) + 50 as b from g group by doc_id, g),
    k as (
        select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as z from r),
    o as (
        select k.doc_id, sum(b - a) as n_removed, count(*) as n_spans, string_agg(substr(x, 2 * z + 1, 2 * (a - z)), '' order by a) || substr(any_value(x), 2 * max(b) + 1) as kept
        from k join d using (doc_id) group by k.doc_id)
    select d.doc_id, length(x) // 2 as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, x))) as kept_sha256
    from d left join o using (doc_id)"""

NEAR_DUP = """
    with recursive words as (
        select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
        from documents),
    shingles as (
        select distinct doc_id, unnest(case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
            else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
        from words),
    n as (select doc_id, count(*) as n from shingles group by doc_id),
    links as (
        select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
        group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 85 * (x.n + y.n - count(*))),
    reach(doc_id, other) as (select doc_id, doc_id from documents union select reach.doc_id, links.b from reach join links on links.a = reach.other)
    select d.doc_id, coalesce(n.n, 0) as n_shingles, min(other) as component_id, d.doc_id = min(other) as kept
    from documents d join reach on reach.doc_id = d.doc_id left join n on n.doc_id = d.doc_id group by d.doc_id, n.n"""

VECTORS = """
    select vec_id, {label} as label, list_transform(embedding, lambda x: floor({scale} * x::double)) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""

KD_SEARCH = f"""
    with v as ({VECTORS.format(label="0", scale=1024)}),
    s as (
        select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
        from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id)
    select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from s qualify rank <= 10"""

HARD_NEGATIVES = f"""
    with v as (select * from ({VECTORS.format(label="case when vec_id % 7 = 0 then (label + 1) % 10 else label end", scale=256)}) where label is not null),
    s as (
        select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_dot_product(a.v, c.v)::bigint as score
        from v a join v c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id),
    p as (
        select anchor_id, vec_id as positive_id, score as positive_score from s where same
        qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
    select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as rank, vec_id as negative_id,
        positive_score, score as negative_score
    from p join s using (anchor_id) where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
    qualify rank <= 5"""

PHRASES = """
    with d as (select doc_id, coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as s from documents),
    pieces as (select lang, unnest(string_split_regex(s, '[.,;:!?\x0A-\x0D]')) as s from d),
    w as (select lang, list_filter(string_split_regex(s, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
    totals as (select lang, sum(len(w)) as n from w group by lang),
    f as (
        select lang, m, phrase, count(*) as a from (
            select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as phrase
            from w, (select unnest(range(1, 6)) as m) where len(w) >= m)
        group by all having count(*) >= 100),
    cuts as (
        select c.lang, c.m, c.phrase, c.a, k, l.a as l, r.a as r, n::hugeint as n, (1000::hugeint * c.a * n::hugeint) // (l.a::hugeint * r.a) as score
        from (select *, unnest(range(1, m)) as k from f where m >= 2) c
        join f l on l.lang = c.lang and l.phrase = array_to_string(string_split(c.phrase, ' ')[:k], ' ')
        join f r on r.lang = c.lang and r.phrase = array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ')
        join totals t on t.lang = c.lang),
    best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    own as (
        select * from best b where not exists (
            select 1 from f x where x.lang = b.lang and x.m > b.m and 100 * x.a >= 100 * b.a and contains(' ' || x.phrase || ' ', ' ' || b.phrase || ' ')))
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n::bigint as n, score::bigint as score
    from own qualify rank <= 2000"""

ORACLE = {
    "op11_kd_search": KD_SEARCH,
    "op12_phrases": PHRASES,
    "op13_hard_negatives": HARD_NEGATIVES,
    "op8_exact_dedup": """
        select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id, count(*) over (partition by coalesce(text, '')) as group_size,
               doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept, sha256(coalesce(text, '')) as text_sha256
        from documents""",
    "op10_near_dup": NEAR_DUP,
    "op1_fingerprints": FINGERPRINTS,
    "op6_suffix_dedup": SUFFIX_DEDUP,
}
