"""One query per operator over its whole table, and the SQL of those that SQL can express."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargelens.llm import alignment, langid, licences, linkgraph, ordering, packing, pitman_yor, pseudonyms, quality, runs, simhash, topk, winnow
from chargelens.llm.common import id_crc, table

QUALITY_LEAST = 0.3
QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


@_query
def op1_url_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linkgraph.judge(table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", F.round("trust", 9).alias("trust"), F.round("distrust", 9).alias("distrust"), "verdict")


@_query
def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pitman_yor.score_texts(table(spark, sf_dir, "documents"), id_crc(F.col("doc_id")) % 7 != 2)
    return out.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query
def op3_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@_query
def op4_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def labelled_fold(doc_id: str = "doc_id"):
    """Ids whose crc32 as text leaves a rest other than 0 by 5: the only rows that labels are learned from."""
    return id_crc(F.col(doc_id)) % 5 != 0


def fitted_quality(docs: DataFrame, labels: DataFrame) -> quality.RuleModel:
    return quality.fit(quality.train_rows(docs, labels, labelled_fold()))


@_query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality.score_all(docs, fitted_quality(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (~labelled_fold()).alias("held_out"), "score", (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"))


@_query
def op6_licence_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licences.scan_licences(table(spark, sf_dir, "documents"))
    starts, base, own = F.col("places.start"), F.array_distinct("places.label"), F.col("spans.label")
    best = F.coalesce(F.array_max("spans.share"), F.lit(0.0))
    return out.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )


@_query
def op7_winnowed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnow.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@_query
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


@_query
def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.materialise(table(spark, sf_dir, "documents"))[0]


#: setting that holds the secret key; without it the queries use a key for tests, which protects nothing
KEY_CONF, TEST_KEY = "spark.chargelens.pseudonym.key", "pseudonym key 1"


def pseudonym_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_CONF, TEST_KEY)


@_query
def op10_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pseudonym_key(spark), found="kinds")
    return out.select("doc_id", "text", F.size("kinds").cast("long").alias("n_values"), F.array_join("kinds", ",").alias("kinds"))


@_query
def op11_kneser_ney_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify(table(spark, sf_dir, "documents"), labelled_fold())
    return out.select("doc_id", (~labelled_fold()).alias("held_out"), "lang_pred", "score", F.round("entropy", 6).alias("entropy"), "refused")


def looped(doc_id, text):
    """The text with single blanks; of ids whose crc32 ends in 0, the words from word a on are replaced by the p from a on, over and over."""
    h = id_crc(doc_id)
    g = F.floor(h / 10).cast("long")

    def over_and_over(words):
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        return F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int"))))

    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # a list of one, so that the words are cut out once
    made = F.transform(F.filter(F.array(words), lambda w: F.size(w) > 0), lambda w: F.array_join(over_and_over(w), " "))
    return F.when(h % 10 == 0, F.get(made, F.lit(0))).otherwise(text)


@_query
def op12_basic_factor_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    out = runs.periodic_runs(docs).withColumn("best", best)
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_query
def op13_identity_map_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = alignment.align(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _words(column: str) -> str:
    low = _LOW.format(f"coalesce({column}, '')")
    return rf"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


SQL["op7_winnowed_decontamination"] = f"""
with d as materialized (select doc_id, {_words('text')} as w from documents),
b as materialized (select item_id, {_words('text')} as w from benchmark),
bw as materialized (
  select distinct item_id, least(len(w), 13) as n, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) as s from b where len(w) > 0)
),
sizes as (select distinct n from bw),
dw as materialized (
  select doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s from d, sizes where len(w) >= n)
),
hit as materialized (select distinct dw.doc_id, dw.s, dw.n, bw.item_id from dw join bw on bw.win = dw.win and bw.n = dw.n),
spots as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from hit) group by doc_id),
its as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hit group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
from d left join spots using (doc_id) left join its using (doc_id)
"""

SQL["op8_exact_top_k"] = """
with v as materialized (
  select vec_id, [floor(64 * cast(x as double)) for x in embedding] as v from embeddings
  where embedding is not null and vec_id is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from s qualify rank <= 20
"""


def _graph_sql() -> str:
    """Rounds written out one after the other."""
    fits = [(f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')", r) for r in sorted(linkgraph.RULES, key=lambda r: -len(r.host + r.path))]
    rule = " ".join(f"when {c} then '{r.host}{r.path}'" for c, r in fits)
    verdict = " ".join(f"when {c} then '{r.verdict}'" for c, r in fits)
    whole = ", ".join(f"'{r.host}/'" for r in linkgraph.RULES if r.path == "/")
    d = linkgraph.DAMPING
    low = _LOW
    parts = [
        f"p as materialized (select page_id, {low.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} as host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path, html from pages)",
        f"r as materialized (select page_id, host, path, case {rule} end as rule, case {verdict} end as own from p)",
        f"""e as materialized (select host as src, dst, count(*) as n from (select host, {low.format("unnest(regexp_extract_all(html, '(?i)href[ \\t\\n\\r\\f\\x0b]*=[ \\t\\n\\r\\f\\x0b]*[\"'']?(?:[a-z]+:)?//([^/\"''?#>[:space:]]+)', 1))")} as dst from p) where host <> '' and host <> dst group by 1, 2)""",
        f"seen as materialized (select host, own, count(*) as n from r where own = 'allow' or rule in ({whole}) group by 1, 2)",
    ]
    for name, kind, src, dst in (("t", "allow", "src", "dst"), ("b", "block", "dst", "src")):
        parts.append(f"{name}s as materialized (select host, n / sum(n) over () * {1 - d} as base from seen where own = '{kind}')")
        parts.append(f"{name}e as materialized (select {src} as a, {dst} as z, n / sum(n) over (partition by {src}) as w from e)")
        parts.append(f"{name}0 as materialized (select host, base as score from {name}s)")
        for i in range(linkgraph.ROUNDS):
            parts.append(f"{name}{i + 1} as materialized (select host, sum(score) as score from (select z as host, score * w * {d} as score from {name}e join {name}{i} on host = a union all select host, base from {name}s) group by 1)")
    n = linkgraph.ROUNDS
    return (
        "with " + ",\n".join(parts) + f"\nselect page_id, r.host, r.path, rule, round(coalesce(t{n}.score, 0), 9) as trust, round(coalesce(b{n}.score, 0), 9) as distrust, "
        f"coalesce(own, case when coalesce(b{n}.score, 0) > {linkgraph.MARGIN} * coalesce(t{n}.score, 0) then 'block' else 'allow' end) as verdict "
        f"from r left join t{n} on t{n}.host = r.host left join b{n} on b{n}.host = r.host"
    )


SQL["op1_url_link_graph"] = _graph_sql()
