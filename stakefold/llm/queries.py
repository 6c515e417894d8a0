"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakefold.llm import common, fingerprints, languages, lines, merkle, minhash, packing, personal_data, sentencepieces, token_files, toxicity, vectors, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        return function

    return register


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    common.small_batches(spark)
    return packing.pack_documents(common.documents(spark, folder), tokenizer_path("byte_bpe_50k.tiktoken"))


@query("op8_sentencepiece")
def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    common.small_batches(spark)
    return sentencepieces.encode_documents(common.documents(spark, folder), tokenizer_path("piece_bpe_32k.model"))


@query("op4_language")
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    common.small_batches(spark)
    docs = common.documents(spark, folder)
    model = languages.train(docs.where(common.crc32_of_id() % 3 != 1))
    found = languages.predict(docs, model)
    return found.withColumn("held_out", common.crc32_of_id() % 3 == 1)


@query("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    common.small_batches(spark)
    return fingerprints.fingerprint_documents(common.documents(spark, folder))


@query("op7_personal_data")
def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    common.small_batches(spark)
    docs = common.documents(spark, folder)
    return personal_data.find(docs, personal_data.train(docs))


@query("op5_warc")
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    common.small_batches(spark)
    manifest = warc.write_archives(common.table(spark, folder, "pages"), common.new_folder(spark, "warc"))
    parts = max(1, manifest.count())
    read = warc.read_archives(manifest.repartition(parts, "archive"))
    return read.where("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op5_warc"] = """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
     d as (select page_id, octet_length(payload) as n, sha256(payload) as digest from p),
     f as (select digest, min(page_id) as first from d where n >= 100 group by digest)
select d.page_id, d.n::bigint as payload_bytes, d.digest as payload_digest,
       case when d.page_id > f.first then 'revisit' else 'response' end as record_type,
       case when d.page_id > f.first then f.first end as refers_to
from d left join f on f.digest = d.digest and d.n >= 100"""


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    common.small_batches(spark)
    docs, labels = common.documents(spark, folder), common.table(spark, folder, "labels")
    learned = common.crc32_of_id() % 5 != 0
    machine = toxicity.train(docs.where(learned), labels.where(learned))
    return toxicity.score_documents(docs, machine).withColumn("held_out", ~learned)


@query("op2_minhash")
def op2_minhash(spark: SparkSession, folder: str) -> DataFrame:
    common.small_batches(spark)
    return minhash.groups(common.documents(spark, folder), minhash.Settings(words=2))


@query("op6_embeddings")
def op6_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.groups(common.table(spark, folder, "embeddings"))


@query("op10_line_dedup")
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.counted(common.documents(spark, folder))


ORACLES["op10_line_dedup"] = """
with d as (select doc_id, string_split(text, chr(10)) as l from documents where doc_id is not null and text is not null),
     p as (select doc_id, unnest(l) as line, unnest(range(len(l))) as no from d),
     w as (select doc_id, no, list_sort(list_distinct(list_filter(
                string_split_regex(lower(line), '[ \\t\\x0B\\f\\r]+'), lambda x: x <> ''))) as k from p),
     s as (select doc_id, no, k, len(k) as n from w where len(k) > 0),
     c as (select k, n, min({'doc_id': doc_id, 'no': no}) as first, row_number() over () as id from s group by k, n),
     t as (select id, n, unnest(k) as word from c),
     f as (select word, count(*) as df from t group by word),
     r as (select id, n, t.word, row_number() over (partition by id order by df, t.word) as place from t join f on t.word = f.word),
     q as (select id, n, word from r where place <= n - (80 * n + 99) // 100 + 1),
     m as (select distinct a.id as x, b.id as y from q a join q b on a.word = b.word
           where a.id < b.id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
     v as (select case when a.first > b.first then a.id else b.id end as id from m join c a on a.id = x join c b on b.id = y
           where 100 * len(list_intersect(a.k, b.k)) >= 80 * (a.n + b.n - len(list_intersect(a.k, b.k)))),
     g as (select s.doc_id, s.no from s join c on s.k = c.k
           where c.id in (select id from v) or {'doc_id': s.doc_id, 'no': s.no} > c.first),
     e as (select doc_id, count(distinct no) as n_removed,
                  array_to_string(list_transform(list_sort(list_distinct(list(no))), lambda x: x::varchar), ',') as removed
           from g group by doc_id)
select o.doc_id, coalesce(len(string_split(o.text, chr(10))), 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(removed, '') as removed
from documents o left join e on o.doc_id = e.doc_id"""


@query("op13_token_files")
def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    common.small_batches(spark)
    manifest = token_files.write_files(
        common.documents(spark, folder), tokenizer_path("word_bpe_49k.json"), common.new_folder(spark, "token-ids"))
    return token_files.read_files(manifest)


@query("op12_merkle")
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    common.small_batches(spark)
    proofs = merkle.documents_manifest(common.documents(spark, folder), common.crc32_of_id() % 7 == 0)
    return merkle.checked(proofs).withColumnRenamed("key", "doc_id")


ORACLES["op12_merkle"] = """
with recursive c as (
    select *, 'T' as given, doc_id::varchar as a, source::varchar as b, lang::varchar as c, text::varchar as e from documents),
w as (select *, coalesce(strlen(a) || ':' || a, '-') || coalesce(strlen(b) || ':' || b, '-') || coalesce(strlen(c) || ':' || c, '-') as head,
             coalesce(strlen(e) || ':' || e, '-') as tail from c),
d as (select doc_id, lang, sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) as leaf,
             sha256(head || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || tail) as other from w),
r as (select *, row_number() over (partition by lang order by doc_id, leaf) - 1 as i, count(*) over (partition by lang) as m from d),
t(lang, lvl, i, m, h) as (
    select lang, 0, i, m, leaf from r
    union all
    select lang, lvl + 1, i // 2, (m + 1) // 2, sha256(string_agg(h, '' order by i)) from t where m > 1 group by lang, lvl, m, i // 2),
z as (select doc_id, xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda s: ascii(s)::bigint),
          lambda c, b: list_reduce(range(8), lambda v, k: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, xor(c, b)),
          4294967295::bigint), 4294967295) % 7 = 0 as tampered from (select distinct doc_id from documents)),
s as (select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as m from t where m = 1),
u(lvl, i, m, h) as (
    select 0, i, m, subroot from s
    union all
    select lvl + 1, i // 2, (m + 1) // 2, sha256(string_agg(h, '' order by i)) from u where m > 1 group by lvl, m, i // 2),
f(doc_id, lang, leaf, lvl, i, m, h, proof) as (
    select doc_id, lang, leaf, 0, i, m, case when tampered then other else leaf end, ''
    from r left join z using (doc_id)
    union all
    select f.doc_id, f.lang, f.leaf, f.lvl + 1, f.i // 2, (f.m + 1) // 2,
           sha256(case when t.h is null then f.h when f.i % 2 = 1 then t.h || f.h else f.h || t.h end), f.proof || coalesce(t.h, '')
    from f left join t on t.lang is not distinct from f.lang and t.lvl = f.lvl and t.i = xor(f.i, 1) where f.m > 1),
g(doc_id, leaf, subroot, lvl, i, m, h, proof) as (
    select f.doc_id, f.leaf, s.subroot, 0, s.i, s.m, f.h, f.proof from f join s on f.lang is not distinct from s.lang where f.m = 1
    union all
    select g.doc_id, g.leaf, g.subroot, g.lvl + 1, g.i // 2, (g.m + 1) // 2,
           sha256(case when u.h is null then g.h when g.i % 2 = 1 then u.h || g.h else g.h || u.h end), g.proof || coalesce(u.h, '')
    from g left join u on u.lvl = g.lvl and u.i = xor(g.i, 1) where g.m > 1)
select doc_id, leaf, subroot, x.h as root, sha256(proof) as proof_sha256, g.h as folded_root, g.h = x.h as verified
from g, (select h from u where m = 1) x where g.m = 1"""


@query("op11_whitening")
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    common.small_batches(spark)
    return whitening.whiten(spark, common.table(spark, folder, "embeddings"))
