"""The registered queries of the thirteen operators, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import decontaminate, exact_dedup, hard_negatives, language_id, line_dedup
from tidemill.llm import packing, quality, resampling, sharding, simhash
from tidemill.llm import substring_dedup, token_counts, token_files, tokens
from tidemill.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, root: str) -> DataFrame:
    return exact_dedup.exact_groups(Tables(spark, root).documents)


def op4_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    tables = Tables(spark, root)
    return decontaminate.leaks(tables.documents, tables.benchmark)


def op5_simhash(spark: SparkSession, root: str) -> DataFrame:
    found = simhash.near_groups(Tables(spark, root).documents)
    return found.select("doc_id", "fingerprint", "component_id", "component_size")


def op2_quality(spark: SparkSession, root: str) -> DataFrame:
    tables = Tables(spark, root)
    return quality.scored(tables.documents, tables.labels)


def op3_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.packed(Tables(spark, root).documents)


def op6_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    return line_dedup.drop_boilerplate(Tables(spark, root).documents, texts=False)


def op7_token_counts(spark: SparkSession, root: str) -> DataFrame:
    """By two patterns and a tokenizer file, which SQL cannot follow."""
    return token_counts.corpus_totals(Tables(spark, root).documents, tokens.default_tokenizer())


def token_counts_patterns(spark: SparkSession, root: str) -> DataFrame:
    """The same batches by the patterns alone."""
    return token_counts.corpus_totals(Tables(spark, root).documents)


def op8_sharding(spark: SparkSession, root: str) -> DataFrame:
    return sharding.sharded(Tables(spark, root).documents)


def op9_token_files(spark: SparkSession, root: str) -> DataFrame:
    return token_files.tokenized(Tables(spark, root).documents)


def op10_substring_dedup(spark: SparkSession, root: str) -> DataFrame:
    return substring_dedup.drop_repeats(Tables(spark, root).documents, texts=False)


def op11_language_id(spark: SparkSession, root: str) -> DataFrame:
    return language_id.identified(Tables(spark, root).documents)


def op12_resampling(spark: SparkSession, root: str) -> DataFrame:
    tables = Tables(spark, root)
    return resampling.resampled(tables.documents, tables.benchmark)


def op13_hard_negatives(spark: SparkSession, root: str) -> DataFrame:
    return hard_negatives.mined(Tables(spark, root).embeddings)


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_decontaminate": op4_decontaminate,
    "op5_simhash": op5_simhash,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "token_counts_patterns": token_counts_patterns,
    "op8_sharding": op8_sharding,
    "op9_token_files": op9_token_files,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_language_id": op11_language_id,
    "op12_resampling": op12_resampling,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
        with flat as (
            select doc_id,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as flat
            from documents)
        select doc_id,
               min(doc_id) over (partition by flat) as keep_id,
               count(*) over (partition by flat) as group_size,
               doc_id = min(doc_id) over (partition by flat) as kept,
               sha256(flat) as text_sha256
        from flat""",
    "op6_line_dedup": r"""
        with parts as (
            select doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
            from documents),
        wide as (
            select line from parts where line <> '' group by line
            having count(distinct coalesce(source, chr(0))) >= 10)
        select doc_id,
               count(*) as n_lines,
               count(*) filter (line in (select line from wide)) as n_removed,
               sha256(coalesce(string_agg(line, chr(10) order by pos)
                   filter (line not in (select line from wide)), '')) as kept_sha256
        from parts group by doc_id""",
    "token_counts_patterns": r"""
        with clean as (
            select *, regexp_replace(coalesce(text, ''), '[#$%&*|]+', '', 'g') as whole
            from documents),
        kept as (
            select * from clean
            qualify doc_id = min(doc_id) over (partition by whole)),
        counts as (
            select source, lang, strlen(whole) as bytes, 'words-1' as tokenizer,
                   len(regexp_extract_all(whole, '[^\x20\x09-\x0D]+')) as tokens
            from kept
            union all
            select source, lang, strlen(whole), 'pieces-1',
                   len(regexp_extract_all(whole,
                       '[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]'))
            from kept)
        select source, lang, tokenizer, count(*) as documents,
               sum(tokens)::bigint as tokens, sum(bytes)::bigint as bytes
        from counts group by source, lang, tokenizer""",
    "op12_resampling": r"""
        with bits as (
            select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
                order by i) as t
            from (select unnest(range(0, 256))::bigint as i)),
        texts as (
            select 'd' as kind, row_number() over () as id, doc_id, text from documents
            union all
            select 'b', row_number() over (), null, text from benchmark),
        parts as (
            select kind, id, unnest(regexp_extract_all(
                translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
            from texts),
        words as (select kind, id, word, count(*) as n from parts group by all),
        kinds as (
            select word, xor(list_reduce(list_prepend(4294967295::bigint,
                list_transform(range(1, strlen(word) + 1),
                    lambda k: ('0x' || substr(hex(word), 2 * k - 1, 2))::bigint)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
            from (select distinct word from words), bits),
        totals as (
            select bucket, coalesce(sum(n) filter (kind = 'd'), 0) as s,
                   coalesce(sum(n) filter (kind = 'b'), 0) as t
            from words join kinds using (word) group by bucket),
        whole as (select sum(s)::double as all_s, sum(t)::double as all_t from totals),
        gains as (
            select bucket, floor(1000 * ln((t + 1.0)::double * (all_s + 10000.0)
                / ((s + 1.0)::double * (all_t + 10000.0))))::bigint as gain
            from totals, whole),
        per_doc as (
            select id, sum(n)::bigint as n_features,
                   floor(sum(n * gain)::double / sum(n)::double)::bigint as weight
            from words join kinds using (word) join gains using (bucket)
            where kind = 'd' group by id),
        scored as (
            select doc_id, coalesce(n_features, 0)::bigint as n_features,
                   coalesce(weight, 0)::bigint as weight,
                   (coalesce(weight, 0) + floor(-1000 * ln(-ln(
                       (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5)::double
                       / 4294967296::double))))::bigint as score
            from texts left join per_doc using (id) where kind = 'd'),
        placed as (
            select *, row_number() over (partition by n_features >= 20
                order by score desc, doc_id) as place
            from scored)
        select doc_id, n_features, weight, score,
               case when n_features >= 20 and place <= (select count(*) * 10 // 100
                   from scored where n_features >= 20) then place end as rank
        from placed""",
    "op13_hard_negatives": """
        with rows as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v,
                   (case when vec_id % 7 = 0 then (label + 1) % 10 else label end) as label
            from embeddings
            where label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
        pairs as (
            select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
                   list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::bigint as score
            from rows a join rows b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
        positives as (
            select anchor_id, other_id as positive_id, score as positive_score from pairs
            where same
            qualify row_number() over (partition by anchor_id
                order by score desc, other_id) <= 5)
        select anchor_id, positive_id,
               (row_number() over (partition by anchor_id, positive_id
                   order by score desc, other_id))::int as rank,
               other_id as negative_id, positive_score, score as negative_score
        from pairs join positives using (anchor_id)
        where not same and 30 * positive_score <= 100 * score
          and 100 * score <= 90 * positive_score
        qualify rank <= 10""",
}
