"""The queries of the corpus operators, each next to its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.catalog.registry import query, table
from skeinwork.llm.bpe import bpe_digests
from skeinwork.llm.clustering import cluster_vectors
from skeinwork.llm.decontaminate import benchmark_hits
from skeinwork.llm.exact_dedup import exact_dedup
from skeinwork.llm.fill_in_middle import fill_in_middle
from skeinwork.llm.language_id import fit_dictionaries, is_held_out, predict_language
from skeinwork.llm.language_model import score_texts
from skeinwork.llm.license_scan import license_summary, scan_licenses
from skeinwork.llm.ngram_join import jaccard_components
from skeinwork.llm.secrets import scan_secrets
from skeinwork.llm.sharding import shard_by_bytes
from skeinwork.llm.token_files import read_token_files, write_token_files
from skeinwork.llm.url_filter import judge_urls

SHARDS = 24


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    """The pattern that splits a text before the merges of the rank files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


@query("""
    with d as (select doc_id, coalesce(text, '') as body from documents)
    select doc_id,
           max(doc_id) over same as keep_id,
           count(*) over same as group_size,
           doc_id = max(doc_id) over same as kept,
           sha256(body) as text_sha256
    from d
    window same as (partition by body)
""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query()
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = is_held_out(F.col("doc_id"))
    found = predict_language(docs, fit_dictionaries(docs.where(~held_out)), carry=["doc_id"])
    return found.select("row.doc_id", "language.*").withColumn("held_out", held_out)


@query()
def op5_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)
    return read_token_files(files)


@query()
def op7_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = is_held_out(F.col("doc_id"), rest=1)
    scored = score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return scored.withColumn("held_out", ~F.col("trained")).drop("trained")


@query()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), pattern())


_LINKS_SQL = """
    with recursive words as (
        select doc_id, [x for x in regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] as w
        from documents
    ),
    grams as (
        select distinct doc_id, array_to_string(w[i : i + 4], ' ') as gram
        from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)
    ),
    sizes as (select doc_id, count(*) as n from grams group by doc_id),
    common as (select a.doc_id as x, b.doc_id as y, count(*) as c from grams a join grams b using (gram) where a.doc_id <> b.doc_id group by all),
    links as (
        select x, y from common join sizes s on s.doc_id = x join sizes t on t.doc_id = y where 100 * c >= 75 * (s.n + t.n - c)
    ),
    reach as (
        select doc_id, doc_id as other from words
        union
        select r.doc_id, l.y from reach r join links l on l.x = r.other
    )
    select w.doc_id, coalesce(s.n, 0) as n_shingles, (select min(other) from reach r where r.doc_id = w.doc_id) as component_id,
           (select count(*) from links l where l.x = w.doc_id) as n_links
    from words w left join sizes s on s.doc_id = w.doc_id
"""


@query(_LINKS_SQL)
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


@query()
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table holds labelled findings: labels are the weak ones, of four documents in five."""
    found = scan_secrets(table(spark, sf_dir, "documents"), learn=~is_held_out(F.col("doc_id")))
    value = F.col("value")
    return found.select(
        "doc_id", "word_no", "nth", F.length(value).alias("n_chars"), F.sha2(value.cast("binary"), 256).alias("value_sha256"),
        F.round("score", 9).alias("score"), "secret",
    )


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query()
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


_HITS_SQL = """
    with d as (
        select doc_id, [x for x in regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] as w
        from documents
    ),
    b as (
        select item_id, [x for x in regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] as w
        from benchmark
    ),
    -- the items of the tables have five words or more
    item_grams as (select item_id, len(w) as size, i, array_to_string(w[i + 1 : i + 5], ' ') as gram from (select item_id, w, unnest(range(0, len(w) - 4)) as i from b)),
    held as (select doc_id, len(w) as n, i, array_to_string(w[i + 1 : i + 5], ' ') as gram from (select doc_id, w, unnest(range(0, len(w) - 4)) as i from d)),
    starts as (
        select distinct doc_id, item_id, size, greatest(0, least(held.i - item_grams.i, n - size)) as start from held join item_grams using (gram)
    ),
    cut as (select doc_id, item_id, start, least(size, n) as n_words from starts join (select doc_id, len(w) as n from d) using (doc_id)),
    window_counts as (
        select c.doc_id, c.item_id, c.start, c.n_words, h.gram, count(*) as times
        from cut c join held h on h.doc_id = c.doc_id and h.i between c.start and c.start + c.n_words - 5 group by all
    ),
    item_counts as (select item_id, gram, count(*) as times from item_grams group by all),
    common as (
        select doc_id, item_id, start, n_words, sum(least(x.times, y.times)) as common
        from window_counts x join item_counts y using (item_id, gram) group by all
    ),
    judged as (
        select doc_id, item_id, start, n_words, common, n_words - 4 + len(b.w) - 4 - common as total from common join b using (item_id)
    ),
    hits as (
        select *, row_number() over (partition by doc_id, item_id order by common / total desc, start) as r from judged where 100 * common >= 75 * total
    )
    select doc_id, item_id, cast(start as int) as start, cast(n_words as int) as n_words, cast(common as bigint) as common, cast(total as bigint) as total,
           common / total as similarity
    from hits where r = 1
"""


@query(_HITS_SQL)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


@query()
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_summary(scan_licenses(table(spark, sf_dir, "documents")))


CENTROIDS, ROUNDS = 16, 3


def _clusters_sql() -> str:
    """One assignment and one mean per round."""
    kept = "len(embedding) = 64 and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0"
    steps = [
        f"v as (select vec_id, [floor(64 * x::double)::bigint for x in embedding] as q from embeddings where {kept})",
        f"c0 as (select r - 1 as cluster, q from (select q, row_number() over (order by sha256('1:' || vec_id)) as r from v) where r <= {CENTROIDS})",
    ]
    for n in range(ROUNDS + 1):
        square = "list_sum([(v.q[i] - c.q[i]) * (v.q[i] - c.q[i]) for i in range(1, 65)])::bigint"
        steps += [
            f"d{n} as (select v.vec_id, c.cluster, {square} as distance from v, c{n} as c)",
            f"a{n} as (select vec_id, cluster, distance from d{n} qualify row_number() over (partition by vec_id order by distance, cluster) = 1)",
        ]
        if n < ROUNDS:
            steps += [
                f"""m{n} as (
                    select cluster, i, (s - ((s % n) + n) % n) // n as mean from (
                        select cluster, i, sum(q[i])::bigint as s, count(*) as n
                        from a{n} join v using (vec_id), (select unnest(range(1, 65)) as i) group by cluster, i))""",
                f"""c{n + 1} as (
                    select c.cluster, coalesce(list(mean order by i) filter (where i is not null), any_value(q)) as q
                    from c{n} as c left join m{n} using (cluster) group by c.cluster)""",
            ]
    return f"""
        with {", ".join(steps)}
        select vec_id, cluster::int as cluster, distance, sum(distance) over (partition by cluster)::bigint as cluster_inertia,
               sum(distance) over ()::bigint as inertia, sha256(array_to_string(q, ',')) as centroid_sha256
        from a{ROUNDS} join c{ROUNDS} using (cluster)
    """


@query(_clusters_sql())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"), k=CENTROIDS, rounds=ROUNDS)


@query("""
    with h as (select doc_id, coalesce(text, '') as body, sha256('7:' || doc_id) as h from documents),
    d as (
        select doc_id, body, regexp_extract_all(body, '[^\n]*\n|[^\n]+') as u, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
               ('0x' || h[25:32])::bigint as h4
        from h
    ),
    cuts as (select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b from d),
    parts as (
        select *, array_to_string(u[1:a], '') as prefix, array_to_string(u[a + 1:b], '') as middle, array_to_string(u[b + 1:], '') as suffix,
               case when body = '' or contains(body, '<P>') or contains(body, '<S>') or contains(body, '<M>') then 'plain'
                    when h4 % 100 < 50 then 'spm' else 'psm' end as form
        from cuts
    )
    select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
           case when form <> 'plain' then length(middle) end as middle_chars,
           sha256(case form when 'plain' then body when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
           sha256(body) as restored_sha256
    from parts
""")
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = fill_in_middle(table(spark, sf_dir, "documents"), restore=True)
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))
