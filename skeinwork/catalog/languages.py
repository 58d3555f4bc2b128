"""Totals per language, text functions, language identification, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skeinwork.catalog.registry import query, table
from skeinwork.functions.langname import with_language_name
from skeinwork.functions.text import after_first, before_first, clean_tweet, one_line, script_override
from skeinwork.operators.duplicates import duplicate_metrics, mark_duplicates
from skeinwork.operators.skew import spread
from skeinwork.operators.langid import build_profiles, detect_lang
from skeinwork.operators.totals import by_total, lang_totals as totals_per_language
from skeinwork.plans import pagecounts
from skeinwork.session import scratch_path
from skeinwork.sources.sinks import tuple_lines
from skeinwork.sources.text_records import parse_pagecounts

NAMES = "(values ('en', 'English'), ('es', 'Spanish'), ('fr', 'French'), ('de', 'German')) as names(code, name)"

# the documents of src0 stand for the front pages, titled like their language
PAGES = """
select lang as code, case when source = 'src0' then lang when source <> 'src1' then source || '/' || doc_id end as title, n_chars as views
from documents
"""


def _front_title():
    """src0: titled like its language; src1: without a title."""
    return F.when(F.col("source") == "src0", F.col("lang")).when(F.col("source") != "src1", F.concat_ws("/", "source", "doc_id"))


@query(f"""
with pages as ({PAGES}),
totals as (
  select code, sum(views)::bigint as total_views, max(views) as top_views,
         (array_agg(title order by views desc, title desc nulls last))[1] as top_title
  from pages where title is distinct from code group by code)
select coalesce(name, lower(code)) as language, code, total_views, top_title, top_views
from totals left join {NAMES} using (code)
""")
def lang_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("lang").alias("code"), _front_title().alias("title"), F.col("n_chars").alias("views")
    )
    return by_total(totals_per_language(docs))


@query(f"""
with pages as ({PAGES}),
totals as (
  select code, sum(views)::bigint as total_views, max(views) as top_views, (array_agg(title order by views desc, title desc))[1] as top_title
  from pages where title is not null and title <> code group by code)
select row_number() over (order by total_views desc, code) as place, coalesce(name, lower(code)) as language, code, total_views, top_title, top_views
from totals left join {NAMES} using (code)
""")
def report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on page counts from text to its report file, which is read back in the order of its lines."""
    path = scratch_path(spark, "pagecounts")
    docs = table(spark, sf_dir, "documents").where(_front_title().isNotNull())
    docs.select(F.concat_ws(" ", F.concat_ws(".", "lang", "source"), _front_title(), "n_chars", F.lit("0")).alias("value")).write.text(f"{path}/in")
    pagecounts.run(spark, f"{path}/in", f"{path}/out")
    schema = "language string, code string, total_views bigint, top_title string, top_views bigint"
    lines = spark.read.schema(schema).option("header", True).csv(f"{path}/out")
    # a line per language
    at = F.struct(F.col("_metadata.file_name"), F.monotonically_increasing_id())
    return lines.withColumn("at", at).withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("at")).cast("bigint")).drop("at")


@query(f"""
with pages as ({PAGES})
select code, title, views from pages where title is not null
""")
def pagecount_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").where(_front_title().isNotNull()).select(
        F.concat_ws(" ", F.concat_ws(".", "lang", "source"), _front_title(), "n_chars", F.lit("0")).alias("value")
    )
    return parse_pagecounts(lines)


@query("""
select d.code, coalesce(name, lower(d.code)) as language, rows_seen
from (select code, count(*) as rows_seen from (
        select lang as code from documents union all select event_type from events
        union all select case source when 'src2' then 'ceb' when 'src3' then 'WAR' when 'src4' then 'nds' when 'src5' then 'haw' else 'qqq' end
        from documents) group by code) d
left join (values ('en', 'English'), ('es', 'Spanish'), ('fr', 'French'), ('de', 'German'), ('ceb', 'Cebuano'), ('war', 'Waray'),
                  ('nds', 'Low German'), ('haw', 'Hawaiian')) as n(code, name)
  on n.code = lower(d.code)
""")
def language_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "documents").select(F.col("lang").alias("code")).unionByName(
        table(spark, sf_dir, "events").select(F.col("event_type").alias("code"))
    )
    longer = {"src2": "ceb", "src3": "WAR", "src4": "nds", "src5": "haw"}
    project = F.coalesce(*[F.when(F.col("source") == s, F.lit(c)) for s, c in longer.items()], F.lit("qqq"))
    codes = codes.unionByName(table(spark, sf_dir, "documents").select(project.alias("code")))
    seen = codes.groupBy("code").agg(F.count(F.lit(1)).alias("rows_seen"))
    return with_language_name(seen, "code", "language")


@query("""
with messages as (
  select doc_id, 'RT @' || source || ' https://x.example/' || doc_id || ' ' || text || ' RT @end' as s from documents),
cleaned as (
  select doc_id, regexp_replace(regexp_replace(regexp_replace(s, 'RT', ''), '@\\pL+', '', 'g'),
                                'https?://\\S+\\s?', '', 'g') as s from messages)
select doc_id, length(s) as chars, md5(s) as digest, md5(regexp_replace(s, '[\\r\\n]', ' ', 'g')) as one_line_digest
from cleaned
""")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.concat(
        F.lit("RT @"), "source", F.lit(" https://x.example/"), F.col("doc_id").cast("string"), F.lit(" "), "text", F.lit(" RT @end")
    )
    cleaned = spread(table(spark, sf_dir, "documents")).select("doc_id", clean_tweet(message).alias("s"))
    return cleaned.select(
        "doc_id",
        F.length("s").cast("bigint").alias("chars"),
        F.md5(F.col("s").cast("binary")).alias("digest"),
        F.md5(one_line(F.col("s")).cast("binary")).alias("one_line_digest"),
    )


@query("""
with marked as (
  select conv_id, turn, case when role = 'user' then 'lt' else 'en' end as lang,
         text || case turn when 0 then ' かな' when 1 then ' 한글' else '' end as text
  from conversations)
select conv_id, turn,
       case when lang = 'lt' and regexp_matches(text, '\\p{Hiragana}') then 'ja'
            when lang = 'lt' and regexp_matches(text, '\\p{Hangul}') then 'ko' else lang end as lang
from marked
""")
def script_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = F.when(F.col("turn") == 0, F.lit(" かな")).when(F.col("turn") == 1, F.lit(" 한글")).otherwise(F.lit(""))
    lang = F.when(F.col("role") == "user", F.lit("lt")).otherwise(F.lit("en"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", script_override(lang, F.concat("text", sample)).alias("lang")
    )


@query("""
select page_id, split_part(url, '://', 1) as scheme, split_part(host, '.', 1) as first_label, host
from (select page_id, url, split_part(substr(url, strpos(url, '://') + 3), '/', 1) as host from pages)
""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = before_first(after_first(F.col("url"), "://"), "/")
    return table(spark, sf_dir, "pages").select(
        "page_id", before_first(F.col("url"), "://").alias("scheme"), before_first(host, ".").alias("first_label"), host.alias("host")
    )


@query("""
select '(' || n_nationkey || ',' || n_name || ',' || n_regionkey || ',' || customers || ')' as value
from nation join (select c_nationkey, count(*) as customers from customer group by 1) on c_nationkey = n_nationkey
""")
def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    nation = table(spark, sf_dir, "nation")
    joined = customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return tuple_lines(joined.select("n_nationkey", "n_name", "n_regionkey", "customers"))


CHARS = """
chars as (
  select doc_id, lang, string_split(' ' || trim(regexp_replace(lower(text), '[^\\pL]+', ' ', 'g')) || ' ', '') as c
  from documents),
grams as (
  select doc_id, lang, unnest([c[i] || c[i + 1] || c[i + 2] for i in range(1, len(c) - 1)]) as gram from chars),
counts as (select lang, gram, count(*) as n from grams group by all),
profile as (
  select gram, lang, n / sqrt(sum(n::double * n) over (partition by lang)) as weight from counts)
"""


@query(f"with {CHARS} select gram, lang, round(weight, 6) as weight from profile")
def language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = build_profiles(table(spark, sf_dir, "documents"), "text", "lang")
    return profiles.select("gram", "lang", F.round("weight", 6).alias("weight"))


@query(f"""
with {CHARS},
doc_counts as (select doc_id, gram, count(*) as n from grams group by all),
scores as (
  select d.doc_id, p.lang, sum(d.n * p.weight) as s from doc_counts d join profile p using (gram) group by all),
lengths as (select doc_id, sum(n) as grams from doc_counts group by all),
best as (
  select doc_id, lang, s, row_number() over (partition by doc_id order by s desc, lang desc) as rn from scores)
select documents.doc_id, best.lang as detected, round(best.s / lengths.grams, 6) as score
from documents left join best on best.doc_id = documents.doc_id and rn = 1
left join lengths on lengths.doc_id = documents.doc_id
""")
def language_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = detect_lang(docs, "doc_id", "text", build_profiles(docs, "text", "lang"))
    return found.withColumn("score", F.round("score", 6))


MARKED = """
select doc_id, row_number() over (partition by text order by n_chars desc, doc_id) > 1 as is_duplicate from documents
"""


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.sha2("text", 256).alias("digest"))
    return mark_duplicates(docs, ["digest"], "n_chars", "doc_id")


@query(MARKED)
def duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked(spark, sf_dir).select("doc_id", "is_duplicate")


@query(f"""
select count(*) as total, count(*) filter (is_duplicate) as duplicates,
       round(100.0 * count(*) filter (is_duplicate) / count(*), 6) as pct_duplicates
from ({MARKED})
""")
def duplicate_document_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_metrics(_marked(spark, sf_dir))
