"""The thirteen operators as queries over their whole tables, with SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rankdex.llm import (
    bpe,
    decontamination,
    fill_middle,
    importance,
    language_id,
    line_spread,
    near_duplicates as near,
    order_minhash,
    quality,
    simhash_segments,
    suffix_dedup,
    url_filter,
    warc,
)
from rankdex.scratch import materialise, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(sql: str | None = None):
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def held_out(key: Column) -> Column:
    """The rows that no model may learn from."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(3)) == 1, F.lit(False))


def _quoted(terms) -> str:
    return ", ".join(f"'{t}'" for t in terms)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RULE_ROWS = ", ".join(f"('{r}', '{v}')" for r, v in url_filter.RULES)


@register(
    rf"""with p as (select page_id, url, translate(url, '{_UPPER}', '{_LOWER}') low from pages),
    parts as (select page_id, low,
            case when contains(low, '://')
                then regexp_extract(substr(low, strpos(low, '://') + 3), '^[^/?#]*') else '' end host,
            case when contains(url, '://') then regexp_extract(
                substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) else '' end path
        from p),
    rules as (select rule, verdict, split_part(rule, '/', 1) rule_host,
            substr(rule, strpos(rule, '/')) rule_path from (values {_RULE_ROWS}) r(rule, verdict)),
    ruled as (select page_id, low, host, path, max_by(rule, length(rule)) rule,
            max_by(verdict, length(rule)) ruling
        from parts left join rules on (host = rule_host or ends_with(host, '.' || rule_host))
            and starts_with(path, rule_path)
        group by page_id, low, host, path),
    counted as (select *, list_distinct(regexp_split_to_array(coalesce(low, ''), '[^a-z0-9]+')) words
        from ruled),
    hits as (select *,
            cast(len(list_filter(words, lambda w: w in ({_quoted(url_filter.STRICT_TERMS)}))) as integer)
                strict_hits,
            cast(len(list_filter(words, lambda w: w in ({_quoted(url_filter.SOFT_TERMS)}))) as integer)
                soft_hits
        from counted)
    select page_id, host, path, rule, coalesce(ruling, case when strict_hits > 0
            or soft_hits >= {url_filter.SOFT_LIMIT} then 'block' else 'allow' end) verdict,
        strict_hits, soft_hits
    from hits"""
)
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


_BASE32 = " || ".join(
    f"""list_aggregate(list_transform([35, 30, 25, 20, 15, 10, 5, 0], lambda s: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        cast((cast('0x' || substr(digest, {at}, 10) as bigint) >> s) & 31 as integer) + 1, 1)),
        'string_agg', '')"""
    for at in (1, 11, 21, 31)
)


@register(
    f"""with p as (select page_id, coalesce(html, '') payload, sha1(coalesce(html, '')) digest
        from pages),
    g as (select *, min(page_id) over (partition by digest) first_id from p)
    select page_id, cast(strlen(payload) as bigint) payload_bytes, {_BASE32} payload_digest,
        case when page_id = first_id then 'response' else 'revisit' end record_type,
        case when page_id <> first_id then first_id end refers_to
    from g"""
)
def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = scratch_path(spark, "warc")
    warc.write_archives(warc.resolve_revisits(_table(spark, sf_dir, "pages")), archives)
    headers = materialise(warc.read_archives(spark, archives), "headers")
    return warc.follow_revisits(headers).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@register()
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80)


@register()
def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), word_vocabulary()).select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = language_id.fit(documents, ~held_out(F.col("doc_id")))
    return language_id.predict(documents, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@register()
def op10_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.fit(documents, labels, ~held_out(F.col("doc_id")))
    return quality.score(documents, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@register()
def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_minhash.with_edited(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        order_minhash.as_text(F.col("fingerprint")).alias("fingerprint"),
        order_minhash.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@register(
    f"""with d as (select doc_id, source, text, string_split(text, chr(10)) ls from documents),
    l as (select doc_id, source, unnest(ls) line, unnest(range(len(ls))) pos from d),
    t as (select doc_id, source, line, pos, trim(line) body from l),
    b as (select body, min((doc_id, pos)) first_place from t where body <> ''
        group by body having count(distinct source) >= {line_spread.MIN_SITES}),
    k as (select t.doc_id, t.pos, t.line,
            first_place is not null and first_place <> (t.doc_id, t.pos) gone
        from t left join b using (body)),
    r as (select doc_id, cast(count(*) as bigint) n_lines,
            cast(count(*) filter (gone) as bigint) n_removed,
            coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '') kept
        from k group by doc_id)
    select doc_id, coalesce(n_lines, 0) n_lines, coalesce(n_removed, 0) n_removed,
        case when text is not null then sha256(kept) end kept_sha256
    from documents left join r using (doc_id)"""
)
def op8_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_spread.dedup_lines(_table(spark, sf_dir, "documents"), counts=True)
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@register()
def op9_benchmark_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.contaminated(documents, benchmark).drop("row")


@register()
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register()
def op11_simhash_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_segments.near_duplicates(_table(spark, sf_dir, "documents"))
    return rows.withColumn("fingerprint", simhash_segments.as_text(F.col("fingerprint")))


_HASH_AT = ", ".join(
    f"cast(cast('0x' || substr(digest, {at}, 8) as bigint) as bigint) h{i}" for i, at in enumerate((1, 9, 17, 25), 1)
)


@register(
    f"""with d as (select doc_id, coalesce(text, '') t,
            sha256('1:' || coalesce(cast(doc_id as varchar), '')) digest from documents),
    h as (select doc_id, t, cast(length(t) as bigint) n, {_HASH_AT} from d),
    f as (select *, least(h1 % (n + 1), h2 % (n + 1)) one, greatest(h1 % (n + 1), h2 % (n + 1)) two,
            case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                or h3 % 100 >= {fill_middle.RATE} then 'plain'
            when h4 % 100 < {fill_middle.SUFFIX_FIRST} then 'spm' else 'psm' end form
        from h),
    c as (select *, substr(t, 1, one) prefix, substr(t, one + 1, two - one) middle,
            substr(t, two + 1) suffix from f)
    select doc_id, n, form, case when form <> 'plain' then one end prefix_chars,
        case when form <> 'plain' then two - one end middle_chars,
        sha256(case form when 'plain' then t
            when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) output_sha256,
        sha256(t) restored_sha256
    from c"""
)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.fill_in_middle(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(), 256).alias("restored_sha256"),
    )


@register()
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return importance.resample(documents, benchmark).drop("n_words")
