"""The registered queries of this subpackage, over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import (
    alignment, bpe, decontaminate, hard_negatives, jaccard_join, masked_lm, pii, quality, secret_scan,
    substring_dedup, suffix_dedup, tree_quality, warc)

RANKS = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.score_quality(documents, quality.train(documents, labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "p_quality", "p_toxic")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                              public_tokenizers.PATTERN)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(_table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_report(_table(spark, sf_dir, "documents"))


def op6_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.score_documents(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"),
                                    _table(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(_table(spark, sf_dir, "pages"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_tree_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return tree_quality.score_documents(documents, tree_quality.train(documents, labels))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("vec_id")
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", F.when(
        number % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, is_anchor=F.col("id") % 50 == 0)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_byte_bpe, op3_substring_dedup, op4_secret_scan, op5_personal_data,
        op6_masked_lm, op7_decontamination, op8_warc, op9_jaccard_join, op10_suffix_dedup, op11_tree_quality,
        op12_hard_negatives, op13_tokenizer_alignment)}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op3_substring_dedup": rf"""
        with docs as (select doc_id, {_WORDS} as w from documents),
        windows as (
            select doc_id, unnest(range(1, len(w) - 18)) as p, w from docs where len(w) >= 20),
        named as (select doc_id, p, array_to_string(w[p:p + 19], ' ') as words from windows),
        marked as (
            select doc_id, p, row_number() over (partition by words order by doc_id, p) as turn
            from named),
        gone as (
            select distinct doc_id, p + i as p from marked, range(0, 20) r(i) where turn > 1),
        removed as (select doc_id, list(p) as places from gone group by doc_id)
        select d.doc_id, len(w)::bigint as n_words, coalesce(len(places), 0)::bigint as n_removed,
            sha256(array_to_string([w[i] for i in range(1, len(w) + 1)
                if places is null or not list_contains(places, i)], ' ')) as kept_sha256
        from docs d left join removed r on d.doc_id = r.doc_id""",
    "op7_decontamination": r"""
        with texts as (
            select 'd' as side, doc_id as id, text from documents
            union all select 'b', item_id, text from benchmark),
        words as (
            select side, id, regexp_extract_all(regexp_replace(lower(coalesce(text, '')),
                '[^\p{L}\p{N}\x09-\x0D\x20]+', '', 'g'), '[^\x20\x09-\x0D]+') as w from texts),
        shingles as (
            select distinct side, id, array_to_string(w[p:p + 4], ' ') as s
            from (select side, id, w, unnest(range(1, len(w) - 3)) as p from words
                  where len(w) >= 5)),
        sizes as (select id, count(*) as n from shingles where side = 'b' group by id)
        select d.id as doc_id, b.id as item_id, count(*) as n_shared, any_value(n) as n_item
        from shingles d join shingles b on d.s = b.s and d.side = 'd' and b.side = 'b'
            join sizes on sizes.id = b.id
        group by d.id, b.id having count(*) >= 0.8 * any_value(n)""",
    "op8_warc": """
        with raw as (select page_id, coalesce(html, '') as html from pages),
        named as (select page_id, strlen(html) as payload_bytes, sha1(html) as hex,
                         min(page_id) over (partition by html) as first from raw),
        parts as (select *, [('0x' || substr(hex, 5 * i + 1, 5))::bigint for i in range(0, 8)] as v
                  from named)
        select page_id, payload_bytes,
            array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((v[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31)::bigint + 1, 1)
                for i in range(0, 32)], '') as payload_digest,
            case when page_id = first then 'response' else 'revisit' end as record_type,
            case when page_id <> first then first end as refers_to
        from parts""",
    "op9_jaccard_join": rf"""
        with recursive docs as (select doc_id, {_WORDS} as w from documents),
        shingles as (
            select distinct doc_id, array_to_string(w[p:p + 4], ' ') as s
            from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as p
                  from docs where len(w) > 0)),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        shared as (
            select a.doc_id as a, b.doc_id as b, count(*) as n
            from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
            group by a.doc_id, b.doc_id),
        links as (
            select a, b from shared s join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 5 * s.n >= 4 * (x.n + y.n - s.n)),
        reach(a, b) as (
            select a, b from links
            union select r.a, l.b from reach r join links l on r.b = l.a)
        select d.doc_id, least(d.doc_id, coalesce((select min(b) from reach where a = d.doc_id),
                d.doc_id)) as class_id,
            (select count(*) from links where a = d.doc_id) as n_links
        from docs d""",
    "op12_hard_negatives": """
        with e as (
            select vec_id, [floor(256 * x::double) for x in embedding] as q,
                case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
            from embeddings where vec_id is not null and label is not null and embedding is not null
                and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
        scored as (
            select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
                list_inner_product(a.q, b.q)::bigint as score
            from e a join e b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
        positives as (
            select anchor_id, vec_id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
        select anchor_id, positive_id, (row_number() over best)::int as rank, vec_id as negative_id,
            positive_score, score as negative_score
        from positives join scored using (anchor_id)
        where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        window best as (partition by anchor_id, positive_id order by score desc, vec_id)
        qualify rank <= 3""",
}
