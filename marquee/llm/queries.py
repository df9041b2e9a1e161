"""The registered queries of this package, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.views import table
from . import chat, decontam, hard_negatives, jaccard, langid, learned_index, licences, packing, quality, shared_terms, substring, toxicity, warc
from .registry import ORACLES, QUERIES, query  # noqa: F401

_STOP = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))

_BROKEN = " or ".join(
    f"(n_words >= {r.from_words} and {r.whole} > 0 and not ({r.part}::double / {r.whole} between {r.low} and {r.high}))"
    for r in quality.RULES
)

OP6_SQL = rf"""
with texts as (select doc_id, coalesce(text, '') as t, row_number() over () as rid from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls from texts),
win as (select rid, i, array_to_string(ws[i:i + 7], ' ') as s
        from (select rid, ws, unnest(range(1, len(ws) - 6)) as i from w where len(ws) > 8)),
rep as (select rid, i from (select *, count(*) over (partition by rid, s) as c from win) where c > 1),
cov as (select rid, sum(least(8, coalesce(nxt - i, 8)))::bigint as n
        from (select *, lead(i) over (partition by rid order by i) as nxt from rep) group by rid),
m as (select w.rid, doc_id, len(ws)::bigint as n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(ls)::bigint as n_lines,
        (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(cov.n, 0)::bigint as n_repeat_words,
        length(regexp_replace(t, '[^!]', '', 'g'))::bigint as n_exclamations,
        len(list_filter(ws, lambda x: lower(x) in ({_STOP})))::bigint as n_stop_words
      from w left join cov on cov.rid = w.rid),
b as (select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_exclamations, n_stop_words,
  base_failed, not base_failed and not ({_BROKEN}) as kept from b
"""


@query("op6_quality_rules", OP6_SQL)
def op6_quality_rules(spark, folder):
    return quality.measure(table(spark, folder, "documents")).drop("failed")


_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1_SQL = rf"""
with d as (select *, len(ws) as n from (select row_number() over () as rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {_A_TO_Z}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents)),
i as (select *, least(13, len(ws)) as size from (select row_number() over () as iid, item_id,
    regexp_extract_all(translate(coalesce(text, ''), {_A_TO_Z}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from (select distinct cast(item_id as varchar) as item_id, text from benchmark)) where len(ws) > 0),
iw as (select iid, item_id, size, p, array_to_string(ws[p:p + size - 1], ' ') as said
  from (select *, unnest(range(1, len(ws) - size + 2)) as p from i)),
dw as (select rid, q, size, array_to_string(ws[q:q + size - 1], ' ') as said
  from (select *, unnest(range(1, n - size + 2)) as q from d, (select distinct size from i) where n >= size)),
h as (select rid, q, iid, item_id, p, size from dw join iw using (size, said)),
words as (select rid, count(*) as n_hit from (select distinct rid, unnest(range(q, q + size)) as word from h) group by rid),
runs as (select max(c + size - 1) as longest, rid from (select rid, size, count(*) as c from
    (select *, p - row_number() over (partition by rid, iid, q - p order by p) as island from h) group by rid, iid, q - p, island, size) group by rid),
named as (select rid, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items from (select distinct rid, item_id from h where item_id is not null) group by rid)
select doc_id, n::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= n as contaminated, coalesce(longest, 0)::bigint as longest_match
from d left join words using (rid) left join runs using (rid) left join named using (rid)
"""

OP7_SQL = r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
win as (select rid, p, array_to_string(ws[p:p + 34], ' ') as said from (select rid, ws, unnest(range(1, len(ws) - 33)) as p from d where len(ws) > 34)),
hit as (select rid, p from (select rid, p, count(*) over (partition by said) as c from win) where c > 1),
gone as (select distinct rid, unnest(range(p, p + 35)) as k from hit),
kept as (select rid, string_agg(word, ' ' order by k) as kept from (select rid, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as k from d)
  anti join gone using (rid, k) group by rid),
n as (select rid, count(*) as n_removed from gone group by rid)
select doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join n using (rid) left join kept using (rid)
"""

OP8_SQL = rf"""
with recursive d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_A_TO_Z}), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select rid, doc_id, case when len(ws) = 0 then [] else list_sort(list_distinct(list_transform(range(1, greatest(len(ws) - 3, 2)),
    lambda p: array_to_string(ws[p:p + 4], ' ')))) end as sh from d),
sets as (select row_number() over () as sid, sh, len(sh) as n from (select distinct sh from s) where len(sh) > 0),
rows_ as (select sid, n, unnest(sh) as one from sets),
links as (select a.sid as a, b.sid as b from rows_ a join rows_ b using (one) where a.sid <> b.sid group by a.sid, b.sid, a.n, b.n
  having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach as (select sid as a, sid as b from sets union select reach.a, links.b from reach join links on reach.b = links.a),
least_ as (select a, min(doc_id) as component_id from reach join sets on sets.sid = reach.b join s using (sh) group by a)
select doc_id, len(s.sh)::bigint as n_shingles, coalesce(component_id, doc_id) as component_id
from s left join sets on sets.sh = s.sh left join least_ on least_.a = sets.sid
"""


def _lines_digest(values):
    return F.sha2(F.array_join(values, ","), 256)


@query("op1_decontamination", OP1_SQL)
def op1_decontamination(spark, folder):
    found = decontam.scan(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        _lines_digest(F.sort_array("items")).alias("items_sha256"),
        decontam.contaminated().alias("contaminated"),
        F.coalesce(F.array_max(F.col("matches.length")), F.lit(0)).cast("bigint").alias("longest_match"),
    )


@query("op7_substring_dedup", OP7_SQL)
def op7_substring_dedup(spark, folder):
    cut = substring.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op8_ngram_jaccard", OP8_SQL)
def op8_ngram_jaccard(spark, folder):
    return jaccard.similar_groups(table(spark, folder, "documents").select("doc_id", "text"))


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op9_packing")
def op9_packing(spark, folder):
    packed = packing.pack(table(spark, folder, "documents").select("doc_id", "text"), _tokenizer())
    return packed.select(
        F.col("row.doc_id").alias("doc_id"),
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    )


def _remainder(key: str, of: int):
    return F.crc32(F.col(key).cast("string").cast("binary")) % of


@query("op2_chat_format")
def op2_chat_format(spark, folder):
    said = "\\### Assistant: </turn> ok"
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.format_conversations(rows.unionByName(probe), _tokenizer()))


@query(
    "op3_warc_archives",
    """
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b)::bigint as payload_bytes, sha256(b) as payload_digest from p),
f as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) else page_id end as first from d)
select page_id, payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to from f
""",
)
def op3_warc_archives(spark, folder):
    back = warc.round_trip(table(spark, folder, "pages").select("page_id", "url", "html"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_toxicity")
def op4_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    learn = labels.where(_remainder("doc_id", 5) != 0).select("doc_id", "toxic")
    counts = toxicity.trigram_counts(docs)
    model = toxicity.train(docs, learn, "doc_id", "text", "toxic", counts)
    found = toxicity.score(docs, model, "doc_id", "text")
    return found.select(
        "doc_id",
        (_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def _as_files(docs):
    """Documents laid out as files: a folder of a thousand per source, folders of fifty in it, the first of each a licence file."""
    name = F.when(F.col("doc_id") % 50 == 0, F.lit("LICENSE")).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    folder = [F.floor(F.col("doc_id") / n).cast("string") for n in (1000, 50)]
    return docs.select("doc_id", F.concat_ws("/", "source", *folder, name).alias("path"), "text")


@query("op5_licence_scan")
def op5_licence_scan(spark, folder):
    found = licences.scan(_as_files(table(spark, folder, "documents")))
    return found.select(F.col("row.doc_id").alias("doc_id"), "path", "licence", "score", "effective", "from_path")


@query("op10_language_id")
def op10_language_id(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    learn = docs.where(_remainder("doc_id", 4) != 2)
    model = langid.train(learn, "doc_id", "text", "lang")
    found = langid.predict(docs.select("doc_id", "text"), model, "doc_id", "text")
    return found.select("doc_id", (_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")


OP11_SQL = """
with r as (select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
      from embeddings where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as a, b.vec_id as b, a.label = b.label as same,
        list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::bigint as score
      from r a join r b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select * from (select a, b, score, row_number() over (partition by a order by score desc, b) as k from s where same) where k <= 5),
n as (select p.a, p.b, s.b as n, p.score as ps, s.score as ns,
        row_number() over (partition by p.a, p.b order by s.score desc, s.b) as rank
      from p join s on s.a = p.a and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score)
select a as anchor_id, b as positive_id, rank::integer as rank, n as negative_id, ps as positive_score, ns as negative_score
from n where rank <= 10
"""


@query("op11_hard_negatives", OP11_SQL)
def op11_hard_negatives(spark, folder):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, rows.where("vec_id % 100 = 0").select("vec_id"))


_TERMS = rf"unnest(regexp_extract_all(translate(coalesce(text, ''), {_A_TO_Z}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"

OP12_SQL = f"""
with t as (select rid, doc_id, {_TERMS} as term from (select *, row_number() over () as rid from documents)),
tf as (select rid, doc_id, term, count(*) as tf from t group by all),
d as (select rid, sum(tf)::bigint as n from tf group by rid),
s as (select count(*) as n_docs, coalesce(sum(n), 0)::bigint as n_terms from d),
w as (select term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint as w from tf, s group by term, n_docs),
i as (select *, row_number() over () as iid from (select distinct item_id, text from benchmark)),
q as (select iid, item_id, term, count(*) as times from (select iid, item_id, {_TERMS} as term from i) group by all),
x as (select iid, item_id, doc_id, rid,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::bigint as score
      from q join tf using (term) join w using (term) join d using (rid), s group by all),
r as (select *, row_number() over (partition by iid order by score desc, doc_id) as rank from x where score > 0)
select item_id, rank::integer as rank, doc_id, score from r where rank <= 10
"""


@query("op12_shared_terms", OP12_SQL)
def op12_shared_terms(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return shared_terms.search(documents, table(spark, folder, "benchmark"), 10)


@query("op13_learned_partitions")
def op13_learned_partitions(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return learned_index.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)
