"""The registered queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm import (
    cap_filters,
    cross_polytope,
    language,
    line_dedup,
    ngram_lm,
    packing,
    periodic_runs,
    prob_minhash,
    quality,
    sentencepiece_bpe,
    topk,
    url_rules,
    whitening,
)
from sluicegate.llm.common import remainder

CAPACITY = 2048
# The rules that URLs are judged by.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda key: key % 20 == 0)


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"select * from values {values} as rules(host, path, verdict)")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules, keep=("page_id",))


def op3_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("text_crc32", F.crc32("text"))
    model = vocabulary("piece_bpe_32k.model")
    coded = sentencepiece_bpe.encode_texts(docs, model, seed=1, keep=("doc_id", "text_crc32"), decode_back=True)
    lossless = F.crc32("decoded").eqNullSafe(F.col("text_crc32"))
    return coded.select("doc_id", "ids", F.size("ids").alias("n_ids"), lossless.alias("lossless"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), capacity=CAPACITY)


def op6_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 5) == 1
    found = ngram_lm.score(docs, train=~held_out, keep=("doc_id",), order=3)
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("lm_tokens").alias("n_tokens"),
        F.col("lm_known").alias("n_known"),
        F.col("lm_train_tokens").alias("train_tokens"),
        F.col("lm_base").alias("base_score"),
        F.col("lm_score").alias("score"),
    )


def op7_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prob_minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "component_id", "kept")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 3) == 1
    model = language.learn(docs, train=~held_out)
    found = language.identify(docs, model, keep=("doc_id",))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    model = quality.learn(docs, table(spark, sf_dir, "labels"), train=~held_out)
    found = quality.score(docs, model, keep=("doc_id",)).withColumnRenamed("quality_score", "score")
    predicted = F.when(F.col("score") >= 0.7, 1).otherwise(0)
    return found.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_later_lines(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return found.select("doc_id", "text", "n_lines", "n_removed")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    exact = F.col("deviation")
    fits = F.when(exact <= F.lit(2**63 - 1), exact).cast("long")
    return found.select(
        "vec_id", "component", "n", fits.alias("deviation"), "whitened", "explained", "identity_error",
        exact.alias("deviation_exact"),
    )


def op12_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), lambda key: key % 50 == 0)


def with_repeats(docs: DataFrame) -> DataFrame:
    """The documents with a periodic end laid into some of them, as the contract of ``op13`` asks: of a document
    whose CRC32 h is divisible by ten, each word from a on becomes the one (i - a) % p behind a."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        places = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(places, lambda i: F.get(words, i.cast("int"))), " "))

    # In an array of one, so that the words are split once.
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    laid = F.transform(F.array(words), repeated)[0]
    return docs.withColumn("text", F.when(h % 10 == 0, laid).otherwise(F.col("text")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.collapse_runs(docs)

    def greater(x: Column, y: Column) -> Column:
        more, less = x["length"] * y["period"], y["length"] * x["period"]
        by = [(less - more), x["start"] - y["start"], x["period"] - y["period"]]
        return F.coalesce(*(F.when(d != 0, F.signum(d).cast("int")) for d in by), F.lit(0))

    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.get(F.array_sort("runs", greater), F.lit(0))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_topk": op1_topk,
        "op2_url_rules": op2_url_rules,
        "op3_cap_filters": op3_cap_filters,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_packing": op5_packing,
        "op6_ngram_lm": op6_ngram_lm,
        "op7_prob_minhash": op7_prob_minhash,
        "op8_language": op8_language,
        "op9_quality": op9_quality,
        "op10_line_dedup": op10_line_dedup,
        "op11_whitening": op11_whitening,
        "op12_cross_polytope": op12_cross_polytope,
        "op13_periodic_runs": op13_periodic_runs,
    }


def _topk_sql() -> str:
    return """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as x from embeddings
            where embedding is not null and not list_contains(list_transform(embedding, lambda x: x is null or not isfinite(x)), true)),
        s as (
            select q.vec_id as query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::bigint as score
            from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id)
        select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
        from s qualify rank <= 20
    """


def _url_sql() -> str:
    rules = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    return f"""
        with cut as (
            select page_id, row_number() over () as row,
                   case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
            from pages),
        split as (
            select page_id, row,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
            from cut),
        rules(rule_host, rule_path, action) as (values {rules})
        select page_id, host, path, rule_host || rule_path as rule, coalesce(action, 'allow') as verdict
        from split left join rules
            on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
        qualify row_number() over (partition by row order by length(rule_host || rule_path) desc, length(rule_host) desc) = 1
    """


def _near_vectors_sql() -> str:
    return """
        with recursive v as (select vec_id, label, list_transform(embedding, lambda x: x::double) as x from embeddings),
        links as (
            select a.vec_id as a, b.vec_id as b from v a join v b
            on a.label = b.label and a.vec_id <> b.vec_id
            and list_inner_product(a.x, b.x) / sqrt(list_inner_product(a.x, a.x) * list_inner_product(b.x, b.x)) >= 0.93),
        reach(vec_id, other) as (
            select vec_id, vec_id from v
            union select reach.vec_id, links.b from reach join links on reach.other = links.a)
        select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
        from (select vec_id, min(other) as component_id from reach group by 1)
        left join (select a, count(*) as n from links group by 1) on a = vec_id
    """


def _near_duplicates_sql() -> str:
    return """
        with recursive words as (
            select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') as w from documents),
        windows as (
            select doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) as i from words where len(w) > 0),
        shingles as (
            select doc_id, array_to_string(w[i : i + 4], ' ') as shingle, count(*)::double as times from windows group by all),
        totals as (select doc_id, sum(times) as total from shingles group by doc_id),
        common as (
            select x.doc_id as a, y.doc_id as b, sum(least(x.times, y.times)) as shared
            from shingles x join shingles y using (shingle) where x.doc_id < y.doc_id group by all),
        pairs as (
            select a, b from common join totals x on a = x.doc_id join totals y on b = y.doc_id
            where shared >= 0.8 * least(x.total, y.total) - 1e-9),
        sides as (
            select a, b, shingle, sum(x) as x, sum(y) as y from (
                select a, b, shingle, times as x, 0.0 as y from pairs join shingles on doc_id = a
                union all select a, b, shingle, 0.0, times from pairs join shingles on doc_id = b)
            group by all),
        shared as (
            select d.a, d.b, d.shingle, 1 / sum(greatest(k.x / d.x, k.y / d.y)) as part
            from sides d join sides k on d.a = k.a and d.b = k.b where d.x > 0 and d.y > 0 group by all),
        links as (select a, b from shared group by all having sum(part) >= 0.8 - 1e-12),
        reach(doc_id, other) as (
            select doc_id, doc_id from documents
            union select reach.doc_id, l.b from reach join (select a, b from links union all select b, a from links) l on reach.other = l.a)
        select doc_id, min(other) as component_id, doc_id = min(other) as kept from reach group by doc_id
    """


def _line_dedup_sql() -> str:
    return """
        with recursive given as (
            select doc_id, text, string_split(text, chr(10)) as parts from documents where text is not null),
        lines as (select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as pos from given),
        worded as (
            select doc_id, pos, line, list_sort(list_distinct(list_filter(
                string_split(regexp_replace(lower(line), '[\\t\\r\\n\\x0B\\f]', ' ', 'g'), ' '), lambda w: w <> ''))) as words
            from lines),
        classes as (
            select row_number() over () as class, words, len(words) as n, min({'doc_id': doc_id, 'pos': pos}) as first
            from worded where len(words) > 0 group by words),
        tokens as (select class, n, unnest(words) as word from classes),
        frequency as (select word, count(*) as df from tokens group by word),
        prefix as (
            select class, n, word from tokens join frequency using (word)
            qualify row_number() over (partition by class order by df, word) <= n - ceil(0.8 * n - 1e-9) + 1),
        pairs as (
            select distinct a.class as a, b.class as b from prefix a join prefix b using (word)
            where a.class < b.class and least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
        later as (
            select distinct greatest(x.first, y.first) as place
            from pairs join classes x on a = x.class join classes y on b = y.class
            where len(list_intersect(x.words, y.words)) >= 0.8 * (x.n + y.n - len(list_intersect(x.words, y.words))) - 1e-9),
        stay as (
            select doc_id, pos, line from worded left join classes using (words)
            where classes.class is null
               or (first = {'doc_id': doc_id, 'pos': pos} and first not in (select place from later)))
        select documents.doc_id, case when text is not null then coalesce(kept.clean, '') end as text,
               coalesce(len(string_split(text, chr(10))), 0)::int as n_lines,
               (coalesce(len(string_split(text, chr(10))), 0) - coalesce(kept.n, 0))::int as n_removed
        from documents left join (
            select doc_id, string_agg(line, chr(10) order by pos) as clean, count(*) as n from stay group by doc_id) kept
        using (doc_id)
    """


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk": _topk_sql(),
        "op2_url_rules": _url_sql(),
        "op3_cap_filters": _near_vectors_sql(),
        "op7_prob_minhash": _near_duplicates_sql(),
        "op10_line_dedup": _line_dedup_sql(),
    }
