"""One query per operator over its whole table, with DuckDB SQL where that can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallystream.llm.best_fit import pack_documents
from tallystream.llm.chat_format import conversation_digests, format_conversations
from tallystream.llm.common import table, vocabulary
from tallystream.llm.decontaminate import contamination
from tallystream.llm.exact_dedup import exact_groups
from tallystream.llm.hard_negatives import hard_negatives
from tallystream.llm.jaccard_join import near_groups
from tallystream.llm.language_id import predict_languages
from tallystream.llm.phrase_mining import collocations
from tallystream.llm.piece_codec import piece_digests
from tallystream.llm.secret_scan import scan_secrets, span_digests
from tallystream.llm.substring_dedup import remove_repeats
from tallystream.llm.token_count import count_tokens
from tallystream.llm.token_records import record_digests

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    return conversation_digests(format_conversations(rows.unionByName(added)))


ORACLES["op1_chat_format"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) loss_sha256,
  cast(sum(15 + length(replace(replace(replace(replace(role, '\', '\\'), chr(10), '\' || chr(10)), '<turn>', '\<turn>'), '</turn>', '\</turn>'))
    + length(replace(replace(replace(text, '\', '\\'), '<turn>', '\<turn>'), '</turn>', '\</turn>'))) as bigint) formatted_chars
from turns group by conv_id
"""


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLES["op2_decontaminate"] = r"""
with item as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark where text is not null),
item_window as (
  select distinct item_id, k, list_slice(w, i, i + k - 1) win
  from (select item_id, w, least(len(w), 10) k, unnest(range(1, len(w) - least(len(w), 10) + 2)) i from item where len(w) > 0)),
doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
doc_window as (
  select doc_id, k, i, list_slice(w, i, i + k - 1) win
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) i
        from doc, (select distinct k from item_window) where len(w) >= k)),
hit as (select d.doc_id, d.i, d.k, b.item_id from doc_window d join item_window b on d.k = b.k and d.win = b.win),
word as (select doc_id, count(distinct p) n from (select doc_id, unnest(range(i, i + k)) p from hit) group by 1),
items as (select doc_id, count(*) n, string_agg(s, ',' order by s) s
  from (select distinct doc_id, cast(item_id as varchar) s from hit) group by 1)
select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(word.n, 0) as bigint) n_hit,
  cast(coalesce(items.n, 0) as bigint) n_items, sha256(coalesce(items.s, '')) items_sha256, coalesce(word.n, 0) > 0 contaminated
from doc d left join word using (doc_id) left join items using (doc_id)
"""


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op3_exact_dedup"] = """
select doc_id, max(doc_id) over same keep_id, count(*) over same group_size,
  doc_id = max(doc_id) over same kept, sha256(coalesce(text, '')) text_sha256
from documents window same as (partition by coalesce(text, ''))
"""


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op4_substring_dedup"] = r"""
with doc as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
win as (select doc_id, i, list_slice(w, i, i + 12) k from (select doc_id, w, unnest(range(1, len(w) - 11)) i from doc where len(w) >= 13)),
least as (select k, min(doc_id) m from win group by k),
gone as (select doc_id, list(distinct p) p from (
  select doc_id, unnest(range(i, i + 13)) p from win join least using (k) where m < doc_id) group by doc_id),
word as (select doc_id, unnest(w) w, unnest(range(1, len(w) + 1)) i from doc),
kept as (select word.doc_id, string_agg(w, ' ' order by i) t, count(*) n
  from word left join gone using (doc_id) where p is null or not list_contains(p, i) group by word.doc_id)
select doc.doc_id, cast(len(w) as bigint) n_words, cast(len(w) - coalesce(n, 0) as bigint) n_removed,
  sha256(coalesce(t, '')) kept_sha256
from doc left join kept using (doc_id)
"""


@query
def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies", "stays")


NEAR_SQL = r"""
doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from {documents}),
shingle as (select distinct doc_id, list_slice(w, i, i + least(len(w), 5) - 1) s
  from (select doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) i from doc where len(w) > 0)),
size as (select doc_id, count(*) n from shingle group by 1),
link as (
  select x.doc_id a, y.doc_id b from shingle x join shingle y on x.s = y.s and x.doc_id <> y.doc_id
  join size p on p.doc_id = x.doc_id join size q on q.doc_id = y.doc_id
  group by x.doc_id, y.doc_id, p.n, q.n having count(*) >= 0.8 * (p.n + q.n - count(*)) - 1e-9),
reach as (select a, b from link union select r.a, l.b from reach r join link l on r.b = l.a),
lead as (select a, least(a, min(b)) m from reach group by a)
"""
ORACLES["op6_jaccard_join"] = (
    "with recursive "
    + NEAR_SQL.replace("{documents}", "documents")
    + """
select doc.doc_id, coalesce(m, doc.doc_id) class_id, coalesce(n, 0) n_links,
  case when len(w) = 0 then 1 else count(*) over (partition by w) end n_copies, coalesce(m, doc.doc_id) = doc.doc_id stays
from doc left join lead on lead.a = doc.doc_id left join (select a, count(*) n from link group by a) c on c.a = doc.doc_id
"""
)


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(scan_secrets(table(spark, sf_dir, "documents")))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


@query
def op9_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), limit=2048)


@query
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_phrase_mining"] = r"""
with doc as (select row_number() over () d, coalesce(lang, 'und') lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
piece as (select lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') w from doc),
total as (select lang, cast(sum(len(w)) as bigint) n from piece group by 1),
gram as (select lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) i from piece, range(1, 6) t(k) where len(w) >= k)),
often as (select lang, k size, phrase, count(*) a from gram group by all having count(*) >= 100),
cut as (select o.lang, o.phrase, o.size, o.a, k, array_to_string(list_slice(string_split(o.phrase, ' '), 1, k), ' ') p,
    array_to_string(list_slice(string_split(o.phrase, ' '), k + 1, o.size), ' ') q
  from (select *, unnest(range(1, size)) k from often where size > 1) o),
score as (select c.lang, c.phrase, c.a, c.k, x.a l, y.a r, n,
    cast((1000::hugeint * c.a * n) // (x.a::hugeint * y.a) as bigint) score
  from cut c join often x on x.lang = c.lang and x.phrase = c.p join often y on y.lang = c.lang and y.phrase = c.q
  join total on total.lang = c.lang),
low as (select * from score qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_phrase as (select lang, a, array_to_string(list_slice(string_split(phrase, ' '), i, i + k - 1), ' ') phrase
  from (select lang, phrase, size, a, k, unnest(range(1, size - k + 2)) i from often, range(2, 5) t(k) where size > k)),
kept as (select low.* from low where not exists (
  select 1 from inner_phrase i where i.lang = low.lang and i.phrase = low.phrase and 100 * i.a >= 100 * low.a))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) "rank", phrase, a, l, r, n, score
from kept qualify "rank" <= 2000
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), every=100, label=label)


ORACLES["op12_hard_negatives"] = r"""
with vec as (select row_number() over () u, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end lab,
    [floor(256 * cast(x as double)) for x in embedding] v
  from embeddings where label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
pair as (select a.u, a.vec_id anchor_id, a.lab = b.lab same, b.vec_id, b.u other, cast(list_inner_product(a.v, b.v) as bigint) s
  from vec a join vec b on a.u <> b.u where a.vec_id % 100 = 0),
positive as (select *, row_number() over (partition by u order by s desc, vec_id nulls last, other) n from pair where same qualify n <= 5),
negative as (select p.u, p.anchor_id, p.n, p.vec_id positive_id, p.s positive_score, q.vec_id negative_id, q.s negative_score,
    row_number() over (partition by p.u, p.n order by q.s desc, q.vec_id nulls last, q.other) k
  from positive p join pair q on p.u = q.u and not q.same
  where 80 * p.s <= 100 * q.s and 100 * q.s <= 100 * p.s qualify k <= 5)
select anchor_id, positive_id, cast(k as integer) "rank", negative_id, positive_score, negative_score from negative
"""


@query
def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)
