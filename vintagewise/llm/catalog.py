"""The queries of this package over the given tables, and the SQL that checks them."""

from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bit_slices, bpe, collocations, ctw, digest, minhash, mixing, piece_bpe, pii, quality, secrets, token_file, warc
from .common import table


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = Query(run, sql)
        return run

    return register


# as in common.words
WORDS_SQL = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


@query("op3_quality_ledger", sql=rf"""
with w as (select doc_id, coalesce(text, '') as t, {WORDS_SQL} as words from documents),
l as (select doc_id, list_filter(string_split(t, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '') as lines from w),
v as (select doc_id, unnest(range(1, len(words) - 1)) as i, words from w where len(words) >= 3),
g as (select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as g from v),
c as (select doc_id, i, count(*) over (partition by doc_id, g) as n from g),
r as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from c where n > 1) group by doc_id),
m as (
  select w.doc_id, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) as bigint) as n_lines,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) as bigint) as n_bullet_lines,
    cast(len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) as bigint) as n_ellipsis_lines,
    cast(coalesce(r.n, 0) as bigint) as n_repeat_words
  from w join l using (doc_id) left join r using (doc_id)
),
b as (
  select *, cast(
    (n_words < 50)::int + 2 * (100 * n_repeat_words > 50 * n_words)::int + 4 * (10 * n_symbols > n_words)::int
    + 8 * (10 * n_dup_lines > 4 * n_lines)::int + 16 * (word_chars < 3 * n_words)::int
    + 32 * (word_chars > 10 * n_words)::int + 64 * (10 * n_bullet_lines > 9 * n_lines)::int
    + 128 * (10 * n_ellipsis_lines > 3 * n_lines)::int as bigint) as fail_bits
  from m
)
select *, (fail_bits & 3) <> 0 as base_failed, fail_bits = 0 as kept from b
""")
def op3_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents and the verdict of the production policy."""
    entries = quality.ledger(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.col("fail_bits").bitwiseAND(F.lit(quality.mask_of(quality.BASE))) != 0
    return entries.select("*", base.alias("base_failed"), quality.passes().alias("kept"))


@query("op7_systematic_mix", sql=rf"""
with d as (select doc_id, source, cast(len({WORDS_SQL}) as bigint) as size, md5(cast(doc_id as varchar)) as draw from documents),
t as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, 3 * source_size as cap, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w from t),
f as (
  select *, row_number() over line as place,
    (select sum(source_size) from t) - coalesce(sum(cap) over (line rows between unbounded preceding and 1 preceding), 0) as rest,
    sum(w) over (line rows between current row and unbounded following) as ws
  from w window line as (order by cap / w, source nulls last)
),
c as (select place as first, rest, ws from f where rest * w <= cap * ws order by place limit 1),
g as (
  select source, source_size,
    case when place < first then cast(cap as double) else cast(c.rest * w as double) / cast(c.ws as double) end as target,
    cast(('0x' || substr(md5('mix/' || coalesce('+' || source, '-')), 1, 5)) as bigint) / 1048576.0::double as start
  from f, c
),
r as (
  select d.doc_id, d.size, source_size, target, start, case when source_size > 0 then target / source_size else 0 end as rate,
    row_number() over (partition by d.source order by d.size, draw) as place
  from d join g on d.source is not distinct from g.source
)
select doc_id, size, source_size, target,
  cast(size * (floor(start + place * rate) - floor(start + (place - 1) * rate)) as bigint) as taken
from r
""")
def op7_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, share and words taken of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    taken = mixing.mix(docs, keep=["doc_id"])
    return taken.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op10_secret_automaton")
def op10_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the spans found in every document."""
    found = secrets.secret_spans(table(spark, sf_dir, "documents", "doc_id", "text")).drop("text")
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[number(kind).alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(joined(base), 256).alias("base_sha256"), joined("secrets").alias("spans"))


@query("op2_bpe_transducer")
def op2_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and their decoding, as digests."""
    path = public_tokenizers.path(TOKENIZER)
    ids = bpe.encode(table(spark, sf_dir, "documents", "doc_id", "text"), path, drop_text=True)
    return bpe.decode(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op1_circulant_minhash", sql=rf"""
with recursive w as (select doc_id, list_transform({WORDS_SQL}, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as words from documents),
s as (
  select distinct doc_id, array_to_string(words[i:i + 4], ' ') as g
  from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i from w where len(words) > 0)
),
n as (select doc_id, count(*) as n from s group by doc_id),
h as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
e as (select a, b from h join n x on x.doc_id = a join n y on y.doc_id = b where 100 * common >= 75 * (x.n + y.n - common)),
r as (select doc_id as node, doc_id as reached from documents union select r.node, e.b from r join e on e.a = r.reached),
c as (select node, min(reached) as component_id from r group by node)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join c on c.node = d.doc_id left join n on n.doc_id = d.doc_id
""")
def op1_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near-duplicates of every document."""
    return minhash.linked(table(spark, sf_dir, "documents", "doc_id", "text"))


# 5 hexadecimal digits are 4 letters of base32
_BASE32_SQL = " || ".join(
    f"translate(lpad(to_base(cast('0x' || substr(sha1(html), {5 * i + 1}, 5) as bigint), 32), 4, '0'), "
    "'0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')" for i in range(8))


@query("op6_warc_index", sql=rf"""
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, cast(strlen(html) as bigint) as payload_bytes, {_BASE32_SQL} as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest, payload_bytes) as first_id from d)
select page_id, payload_bytes, payload_digest, case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id = first_id then null else first_id end as refers_to
from f
""")
def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back through the index."""
    index = warc.write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return warc.read_records(index, payloads=False).drop("payload")


@query("op4_token_file")
def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, and where each document lies in them."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_file.read_documents(token_file.write_tokens(docs, public_tokenizers.path(TOKENIZER), end=2))


@query("op9_improbable_digest")
def op9_improbable_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return digest.compared(docs, buckets=1 + size // digest.BUCKET_BYTES)


@query("op5_context_tree")
def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a model of four folds of five."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return ctw.score(docs, ctw.fold("doc_id") == 1)


@query("op8_disclosure")
def op8_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the spans found in every document."""
    found = pii.spans(table(spark, sf_dir, "documents", "doc_id", "text"))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.PATTERNS))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[number(kind).alias(f"n_{kind}") for kind in pii.PATTERNS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


# as in bit_slices.terms
TERMS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query("op11_bit_slices", sql=rf"""
with q as (select item_id, unnest({TERMS_SQL}) as term from benchmark),
i as (select item_id, term, count(*) as c from q group by item_id, term),
w as (select doc_id, {TERMS_SQL} as words from documents),
d as (select doc_id, len(words) as len from w where len(words) > 0),
c as (select cast(count(*) as hugeint) as docs, cast(sum(len) as hugeint) as total from d),
t as (select doc_id, term, count(*) as tf from (select doc_id, unnest(words) as term from w) where term in (select term from i) group by doc_id, term),
f as (select term, cast(floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1))) as hugeint) as weight from t, c group by term),
m as (select doc_id, 75 + ((25 * len * docs) // total) as m from d, c),
s as (
  select item_id, doc_id, cast(sum(c * weight * ((1000000000::hugeint * tf) // (1000 * tf + 12 * m))) as bigint) as score
  from t join i using (term) join f using (term) join m using (doc_id) group by item_id, doc_id
)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0) where rank <= 20
""")
def op11_bit_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bit_slices.search(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


@query("op12_collocations", sql=r"""
with p as (
  select coalesce(lang, 'und') as lang, doc_id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
),
w as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as words from p),
n as (select lang, cast(sum(len(words)) as bigint) as n from w group by lang),
g as (
  select lang, size, array_to_string(words[i:i + size - 1], ' ') as phrase
  from (select lang, words, size, unnest(range(1, len(words) - size + 2)) as i from w, (select unnest([1, 2, 3]) as size) where len(words) >= size)
),
f as (select lang, size, phrase, count(*) as a from g group by lang, size, phrase having count(*) >= 10),
c as (select *, string_split(phrase, ' ') as words from f where size > 1),
k as (select *, unnest(range(1, size)) as k from c),
s as (
  select k.lang, k.phrase, k.a, k.k, l.a as l, r.a as r, cast((1000000::hugeint * k.a * k.a) // (l.a::hugeint * r.a) as bigint) as score
  from k join f l on l.lang = k.lang and l.phrase = array_to_string(k.words[1:k.k], ' ')
  join f r on r.lang = k.lang and r.phrase = array_to_string(k.words[k.k + 1:], ' ')
),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
o as (
  select lang, phrase, max(a) as longer from (
    select lang, a, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) as phrase from c where size = 3
  ) group by lang, phrase
),
v as (
  select b.*, row_number() over (partition by b.lang order by score desc, b.a desc, b.phrase) as rank
  from b left join o on o.lang = b.lang and o.phrase = b.phrase where longer is null or 100 * longer < 50 * b.a
)
select v.lang, rank, phrase, a, l, r, n, score from v join n using (lang) where rank <= 2000
""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of two and three words of every language."""
    return collocations.mine(table(spark, sf_dir, "documents", "lang", "text"))


@query("op13_merge_rounds")
def op13_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and their decoding, as digests."""
    path = public_tokenizers.path(PIECES)
    ids = piece_bpe.encode(table(spark, sf_dir, "documents", "doc_id", "text"), path, drop_text=True)
    return piece_bpe.decode(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
