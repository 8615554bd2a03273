"""The registered query of every operator here, with production parameters over its whole table, and
its DuckDB twin where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from . import sentencepiece_unigram as spu
from .ann_forest import forest_search
from .embedding_whitening import whitened_components
from .language_mixture import language_mixture, learn_profiles
from .line_dedup import line_dedup
from .merkle_manifest import digest, fold, leaf_digest, merkle_manifest, siblings
from .minhash_dedup import near_duplicates
from .mixing import temperature_mix
from .quality_mcd import STATS, quality_rules
from .quality_ranking import quality_ranking
from .secret_scan import secret_scan
from .suffix_dedup import suffix_dedup
from .url_filter import canonical, url_filter

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def listed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical URLs of pages whose document (the number in the path) is labelled toxic."""
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("d"))
    number = F.expr("try_cast(nullif(regexp_extract(url, '/([0-9]+)', 1), '') as bigint)")
    pages = table(spark, sf_dir, "pages").select("url", number.alias("d"))
    return pages.join(toxic, "d", "left_semi").select(canonical(F.col("url")).alias("url"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, listed_urls(spark, sf_dir), URL_RULES).selectExpr(
        "page_id", "uf_host as host", "uf_path as path", "uf_rule as rule", "uf_verdict as verdict",
        "uf_listed as listed")


OP9_SQL = r"""
with u as (
  select page_id, url, coalesce(contains(url, '://'), false) as ok,
         try_cast(nullif(regexp_extract(url, '/([0-9]+)', 1), '') as bigint) as d,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
         list_sort(list_filter(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
                               lambda p: not regexp_matches(p, '^(utm_|ref=|$)'))) as params
  from pages),
c as (
  select *, case when ok then regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
                   || case when len(params) > 0 then '?' || array_to_string(params, '&') else '' end end as key
  from u),
listed as (select distinct key from c where d in (select doc_id from labels where toxic = 1)),
r as (
  select c.*, case
    when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule
  from c)
select page_id, host, path, rule,
       case when rule in ('www.example.com/en/', 'com/') then 'allow' when rule is not null then 'block'
            when listed.key is not null then 'block' else 'allow' end as verdict,
       rule is null and listed.key is not null as listed
from r left join listed on r.key = listed.key
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, min_chars=20, min_docs=3).select(
        "doc_id", F.col("ld_lines").alias("n_lines"), F.col("ld_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP10_SQL = """
with lines as (
  select d.doc_id, t.i, t.l, translate(trim(t.l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents) d,
       lateral (select unnest(d.ls) as l, unnest(range(len(d.ls))) as i) t),
keys as (
  select k, max(doc_id) as keeper from lines where length(k) >= 20
  group by k having count(distinct doc_id) >= 3),
marked as (
  select lines.*, keys.k is not null and lines.doc_id <> keys.keeper as gone
  from lines left join keys on lines.k = keys.k)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(l, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

def op1_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return quality_rules(docs).select("doc_id", *STATS, "base_failed", "kept")


def _op1_sql(h: float = 0.75, steps: int = 3, min_group: int = 50) -> str:
    """The whole estimate in SQL: the query's statistics from words and lines as rows, then the same steps over them. Numbers are written
    out here (floors, scale, cutoff), not taken from the module."""
    ws = r"[\x20\x09-\x0D]"
    x, pairs = range(5), [(i, j) for i in range(5) for j in range(i + 1)]
    floors = [0.5, 0.1, 0.3, 1.0, 1.0]
    root = [f"c{i}{i} + {(f * 64) ** 2!r} as v{i}{i}" for i, f in enumerate(floors)]
    for i in x:
        for j in range(i):
            root.append(f"(c{i}{j} - ({' + '.join([f'l{i}{k} * l{j}{k}' for k in range(j)]) or '0'})) / l{j}{j} as l{i}{j}")
        root.append(f"sqrt(greatest(v{i}{i} - ({' + '.join([f'l{i}{k} * l{i}{k}' for k in range(i)]) or '0'}), 1e-6)) as l{i}{i}")
        root += [f"-({' + '.join(f'l{i}{k} * r{k}{j}' for k in range(j, i))}) / l{i}{i} as r{i}{j}" for j in range(i)]
        root.append(f"1 / l{i}{i} as r{i}{i}")
    est = f"g, start, {', '.join(f'm{i}' for i in x)}, {', '.join(root)}, 2 * ({' + '.join(f'ln(l{i}{i})' for i in x)}) as logdet"
    moments = "count(*) as n, " + ", ".join([f"sum(x{i}) as s{i}" for i in x] + [f"sum(x{i} * x{j}) as s{i}{j}" for i, j in pairs])
    centre = ", ".join([f"s{i} / n as m{i}" for i in x] + [f"s{i}{j} / n - (s{i} / n) * (s{j} / n) as c{i}{j}" for i, j in pairs])
    d2 = " + ".join("power(" + " + ".join(f"r{i}{j} * (x{j} - m{j})" for j in range(i + 1)) + ", 2)" for i in x)
    rank = f"cast(round(32 * log2(1 + {d2})) as integer)"
    rounds = ""
    for k in range(steps):
        rounds += f"""
near{k} as (select r.*, e.start, {rank} as rk from fit r join est{k} e using (g)),
lim{k} as (select g, start, quantile_cont(rk, {h}) as q from near{k} group by g, start),
mom{k} as (select g, start, {moments} from near{k} join lim{k} using (g, start) where rk <= q group by g, start),
est{k + 1} as (select {est} from (select g, start, {centre} from mom{k})),"""
    return f"""
with docs as (select row_number() over () as id, doc_id, lang, source, coalesce(text, '') as t from documents),
words as (select id, list_filter(regexp_split_to_array(t, '{ws}+'), lambda w: w <> '') as w from docs),
grams as (select id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as s from (select id, w, unnest(range(1, len(w) - 1)) as i from words)),
twice as (select id, i, lead(i) over (partition by id order by i) as nxt from grams
          where (id, s) in (select (id, s) from grams group by id, s having count(*) > 1)),
cover as (select id, sum(least(3, coalesce(nxt - i, 3))) as n from twice group by id),
lines as (select id, count(*) - count(distinct l) as n from (select id, unnest(string_split(t, chr(10))) as l from docs)
          where regexp_matches(l, '[^\x20\x09-\x0D]') group by id),
stats as (
  select docs.*, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda v: length(v))), 0)::bigint as word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols, coalesce(lines.n, 0)::bigint as n_dup_lines,
         coalesce(cover.n, 0)::bigint as n_repeat_words, len(string_split(t, chr(10))) as n_lines
  from docs join words using (id) left join lines using (id) left join cover using (id)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         count(*) over (partition by lang, source) as n_ls, count(*) over (partition by lang) as n_l,
         cast(round(64 * ln(1 + n_words)) as bigint) as x0, cast(round(64 * ln(1 + coalesce(word_chars / nullif(n_words, 0), 0))) as bigint) as x1,
         cast(round(64 * ln(1 + coalesce(100 * n_symbols / nullif(word_chars, 0), 0))) as bigint) as x2,
         cast(round(64 * ln(1 + coalesce(100 * n_dup_lines / nullif(n_lines, 0), 0))) as bigint) as x3,
         cast(round(64 * ln(1 + coalesce(100 * n_repeat_words / nullif(n_words, 0), 0))) as bigint) as x4
  from stats),
rows_ as (
  select *, case when n_ls >= {min_group} then 'l' || coalesce('=' || lang, '') || chr(1) || 's' || coalesce('=' || source, '')
                 when n_l >= {min_group} then 'l' || coalesce('=' || lang, '') else 'all' end as g
  from judged),
fit as (select g, {', '.join(f'x{i}' for i in x)} from rows_ where not base_failed),
med as (select g, {', '.join(f'quantile_cont(x{i}, 0.5) as m{i}' for i in x)} from fit group by g),
mad as (select g, {', '.join(f'any_value(m{i}) as m{i}, quantile_cont(abs(x{i} - m{i}), 0.5) as d{i}' for i in x)}
        from fit join med using (g) group by g),
both_ as (
  select g, 1 as start, {centre} from (select g, {moments} from fit group by g)
  union all
  select g, 2, {', '.join(f'm{i}' for i in x)}, {', '.join(f'power(1.4826 * d{i}, 2)' if i == j else '0.0' for i, j in pairs)} from mad),
est0 as (select {est} from both_),{rounds}
best as (select g, arg_min(start, (logdet, start)) as start from est{steps} group by g),
final as (select e.* from est{steps} e join best using (g, start)),
scale as (select g, greatest(1, (power(2, quantile_cont({rank}, 0.5) / 32) - 1) / 4.3515) as f from fit join final using (g) group by g)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(({d2}) / f <= 35.888, true) as kept
from rows_ left join final using (g) left join scale using (g)
"""


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = spu.load_vocabulary(spu.VOCABULARY)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spu.encode(docs, vocab, check="exact").selectExpr(
        "doc_id", "cast(coalesce(array_size(token_ids), 0) as bigint) as n_tokens", "token_ids", "coalesce(exact, true) as exact")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    joined = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    count = "cast(array_size(filter(ss_spans, s -> s.kind = '{0}')) as bigint) as n_{0}"
    return found.selectExpr(
        "doc_id", count.format("assign"), count.format("access"), count.format("hex"),
        f"sha2(cast({joined.format('filter(ss_spans, s -> s.kind <> \'novel\')')} as binary), 256) as base_sha256",
        joined.format("ss_spans") + " as spans", count.format("novel"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2, percent=80)


OP4_SQL = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as ws from documents),
shingles as (
  select distinct doc_id, unnest(case when len(ws) >= 2 then list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])
                                      else ws end) as s from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (select a.doc_id as x, b.doc_id as y, count(*) as i from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
           group by a.doc_id, b.doc_id),
links as (select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * i >= 80 * (p.n + q.n - i)),
near as (select x, y from links union all select y, x from links),
reach as (select doc_id, doc_id as c from documents union select reach.doc_id, near.y from reach join near on reach.c = near.x)
select d.doc_id, coalesce(sizes.n, 0) as n_shingles, r.c as component_id, d.doc_id = r.c as kept
from documents d left join sizes on sizes.doc_id = d.doc_id
join (select doc_id, min(c) as c from reach group by doc_id) r on r.doc_id = d.doc_id
"""


def op5_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), length=400, keep_text=False)
    return cut.select("doc_id", F.col("sd_bytes").alias("n_bytes"), F.col("sd_removed").alias("n_removed"),
                      F.array_size("sd_spans").cast("long").alias("n_spans"), F.sha2("sd_kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
with raw as (select doc_id, encode(coalesce(text, '')) as b from documents),
starts as (select doc_id, b, unnest(range(1, greatest(octet_length(b) - 398, 1))) as i from raw),
wins as (select doc_id, i, hex(b[i:i + 399]) as w from starts),
again as (select w from wins group by w having count(*) > 1),
hits as (select doc_id, i from wins where w in (select w from again)),
edges as (select doc_id, i, lag(i) over (partition by doc_id order by i) as p from hits),
runs as (select doc_id, i, sum(case when p is null or i > p + 400 then 1 else 0 end) over (partition by doc_id order by i) as run from edges),
spans as (select doc_id, run, min(i) as a, max(i) + 400 as b from runs group by doc_id, run),
cuts as (select doc_id, a, b from spans union all select doc_id, octet_length(b) + 1, null from raw),
kept as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 1) as x, a as y from cuts),
parts as (select kept.doc_id, string_agg(case when y > x then hex(raw.b[x:y - 1]) else '' end, '' order by x) as h
          from kept join raw on raw.doc_id = kept.doc_id group by kept.doc_id)
select raw.doc_id, octet_length(raw.b) as n_bytes, coalesce(s.n, 0)::bigint as n_removed, coalesce(s.k, 0) as n_spans, sha256(unhex(parts.h)) as kept_sha256
from raw join parts on parts.doc_id = raw.doc_id
left join (select doc_id, sum(b - a) as n, count(*) as k from spans group by doc_id) s on s.doc_id = raw.doc_id
"""


def held_out() -> Column:
    """Documents that no language profile is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn_profiles(docs.where(~held_out()).select("text", "lang"))
    return language_mixture(docs.select("doc_id", "text"), profiles, keep_text=False).select(
        "doc_id", held_out().alias("held_out"), F.col("li_lang").alias("lang_pred"),
        F.col("li_score").alias("score"), F.col("li_langs").alias("langs"), F.col("li_shares").alias("shares"))


def op8_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return temperature_mix(docs, repetition=2.0).selectExpr(
        "doc_id", "source", "mx_tokens as n_tokens", "mx_epoch as epoch", "mx_block as block", "mx_order as position")


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*MANIFEST_FIELDS)
    tampered = leaf_digest([F.replace("text", F.lit("\n"), F.lit("")) if f == "text" else F.col(f) for f in MANIFEST_FIELDS])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    rows = merkle_manifest(docs, MANIFEST_FIELDS, carry={"other": F.when(chosen, tampered)})
    folded = fold(F.coalesce("other", "mk_leaf"), F.col("mk_path"))
    return rows.select("doc_id", F.col("mk_leaf").alias("leaf"), F.col("mk_subroot").alias("subroot"), F.col("mk_root").alias("root"),
                       digest(siblings(F.col("mk_path"))).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.expr("folded_root = root"))


def _op11_sql(levels: int = 16, top: int = 6) -> str:
    """The trees level by level; enough levels for 3^16 documents of a source and 3^6 sources. Needs distinct doc_ids within a source."""
    def climb(name: str, start: str, of: str, count: int) -> str:
        """{name}N: nodes (g, i, h, c) with c nodes on the level; {of}N: (id, g, i, proof, fold) of what climbs."""
        out = ""
        for k in range(count):
            prev = start if k == 0 else f"{name}{k}"
            out += f"""
{name}s{k} as materialized (select g, i, c, coalesce(string_agg(h, '') over (partition by g, i // 3 order by i rows between unbounded preceding and 1 preceding), '') as l,
  coalesce(string_agg(h, '') over (partition by g, i // 3 order by i rows between 1 following and unbounded following), '') as r from {prev}),
{name}{k + 1} as materialized (select g, i // 3 as i, case when any_value(c) > 1 then sha256(string_agg(h, '' order by i)) else any_value(h) end as h,
  (any_value(c) + 2) // 3 as c from {prev} group by g, i // 3),
{of}{k + 1} as materialized (select id, g, i // 3 as i, case when c > 1 then proof || l || r else proof end as proof,
  case when c > 1 then sha256(l || fold || r) else fold end as fold from {of}{k} join {name}s{k} using (g, i)),"""
        return out

    field = lambda c, v: f"coalesce(octet_length(encode(({v})::varchar))::varchar || ':' || ({v})::varchar, '-')"      # noqa: E731
    leaf = lambda text: "sha256(" + " || ".join(field(c, text if c == "text" else c) for c in MANIFEST_FIELDS) + ")"
    # CRC-32, bit by bit: each byte enters with its first bit, seven more follow
    bits = "list_concat([4294967295], flatten(list_transform(string_split(doc_id::varchar, ''), lambda x: [ord(x), 0, 0, 0, 0, 0, 0, 0])))"
    crc = f"xor(list_reduce({bits}, lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)"
    return f"""
with docs as materialized (
  select row_number() over () as id, doc_id, dense_rank() over (order by source nulls first) - 1 as g,
         row_number() over (partition by source order by doc_id nulls first) - 1 as i, count(*) over (partition by source) as c,
         {leaf('text')} as h, case when coalesce({crc} % 2 = 0, false) then {leaf("replace(text, chr(10), '')")} end as other
  from documents),
a0 as materialized (select id, g, i, '' as proof, coalesce(other, h) as fold from docs),
{climb('n', 'docs', 'a', levels)}
subroots as materialized (select 0 as g, g as i, h, count(*) over () as c from n{levels}),
b0 as materialized (select id, 0 as g, g as i, proof, fold from a{levels}),
{climb('m', 'subroots', 'b', top)}
root as (select any_value(h) as root from m{top})
select docs.doc_id, docs.h as leaf, n{levels}.h as subroot, root.root, sha256(b.proof) as proof_sha256, b.fold as folded_root, b.fold = root.root as verified
from docs join n{levels} on n{levels}.g = docs.g join b{top} b on b.id = docs.id, root
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_components(table(spark, sf_dir, "embeddings"), components=32).withColumnRenamed("id", "vec_id")


def op13_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality_ranking(docs, labels, ~F.col("held_out")).selectExpr(
        "doc_id", "held_out", "qr_score as score", "qr_predicted as predicted")


QUERIES = {
    "op1_quality_mcd": op1_quality_mcd,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_secret_scan": op3_secret_scan,
    "op4_minhash": op4_minhash,
    "op5_ann_forest": op5_ann_forest,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_language_mixture": op7_language_mixture,
    "op8_temperature_mix": op8_temperature_mix,
    "op9_url_filter": op9_url_filter,
    "op10_line_dedup": op10_line_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_whitening": op12_whitening,
    "op13_quality_ranking": op13_quality_ranking,
}

ORACLE = {
    "op1_quality_mcd": _op1_sql(),
    "op4_minhash": OP4_SQL,
    "op6_suffix_dedup": OP6_SQL,
    "op9_url_filter": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_merkle_manifest": _op11_sql(),
}
