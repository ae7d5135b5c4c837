"""The queries opN: each operator on its whole table, with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.llm import divergence, exact, importance, licenses, mixing, neighbours, packing, preferences, quality, secrets, simhash, substrings, token_files
from lateline.llm.common import read
from lateline.sources.staging import shared_folder


def op1_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op2_simhash_groups(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf, "documents"))


def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf, "documents")).drop("spans")


def op4_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_dedup(read(spark, sf, "documents"))


def op5_quality_model(spark: SparkSession, sf: str) -> DataFrame:
    return quality.classify(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op6_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(read(spark, sf, "documents"))


def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{shared_folder(spark).rstrip('/')}/token-files-{uuid4().hex}"
    token_files.write(read(spark, sf, "documents"), folder)
    return token_files.read(spark, folder)


def op8_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(read(spark, sf, "documents"), licenses.digests(spark))


def op9_preference_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return preferences.preferences(read(spark, sf, "conversations"), *preferences.neighbouring())


def op10_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.divergences(read(spark, sf, "documents"))


def op12_importance_draw(spark: SparkSession, sf: str) -> DataFrame:
    return importance.resample(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op13_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(read(spark, sf, "documents"))


QUERIES = {
    "op1_source_mix": op1_source_mix,
    "op2_simhash_groups": op2_simhash_groups,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality_model": op5_quality_model,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_token_files": op7_token_files,
    "op8_license_scan": op8_license_scan,
    "op9_preference_pairs": op9_preference_pairs,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_source_divergence": op11_source_divergence,
    "op12_importance_draw": op12_importance_draw,
    "op13_secret_scan": op13_secret_scan,
}

ORACLE = {
    "op4_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, text_sha256
        from (select doc_id, sha256(coalesce(text, '')) as text_sha256, coalesce(text, '') as content from documents)
        window same as (partition by content)
    """,
    "op9_preference_pairs": """
        with turns as (
            select distinct conv_id // 2 as pair_id, conv_id % 2 = 0 as chosen, turn, role, text from conversations
        ),
        rows as (
            select pair_id, turn, role, text, bool_or(chosen) as in_chosen, bool_or(not chosen) as in_rejected
            from turns group by all
        ),
        cuts as (select pair_id, min(turn) filter (not (in_chosen and in_rejected)) as cut from rows group by pair_id),
        placed as (select rows.*, cut, cut is null or turn < cut as shared from rows join cuts using (pair_id)),
        parts as (
            select *, 'prompt' as part from placed where shared
            union all select *, 'chosen' from placed where not shared and in_chosen
            union all select *, 'rejected' from placed where not shared and in_rejected
        )
        select pair_id, part, turn, role,
               '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) as rendered,
               part <> 'prompt' and coalesce(role = 'assistant', false) as loss, cut as first_difference
        from parts
    """,
    "op10_nearest_neighbours": """
        with usable as (
            select vec_id, embedding::double[] as e from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
              and len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        pairs as (
            select q.vec_id as query_id, c.vec_id, list_distance(q.e, c.e) as score
            from usable q join usable c on q.vec_id <> c.vec_id and len(q.e) = len(c.e)
            where q.vec_id % 100 = 0
        )
        select query_id, rank::int as rank, vec_id, score
        from (select *, row_number() over (partition by query_id order by score, vec_id) as rank from pairs)
        where rank <= 10
    """,
}


def _license_sql() -> str:
    """The same canonical form and lookup in SQL; known texts come from the operator's fixed values."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def canonical(text: str) -> str:
        text = f"lower(coalesce({text}, ''))"
        text = f"regexp_replace({text}, {quoted(licenses.COPYRIGHT_LINE)}, '', 'g')"
        text = rf"regexp_replace({text}, '[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F ‐-‟]+', ' ', 'g')"
        for word, standard in licenses.SPELLINGS:
            text = rf"regexp_replace({text}, '\b{word}\b', '{standard}', 'g')"
        return text

    known = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in licenses.KNOWN)
    whole = r"sha256(trim(regexp_replace(c, '[ \n]+', ' ', 'g')))"
    return f"""
        with known as (
            select digest, min(license_id) as license_id from (
                select license_id, {whole} as digest
                from (select license_id, {canonical("text")} as c from (values {known}) as k(license_id, text))
            ) group by digest
        ),
        texts as (select doc_id, {canonical("text")} as c from documents),
        lines as (select doc_id, sha256(trim(unnest(string_split(c, chr(10))))) as digest from texts),
        notices as (
            select doc_id, string_agg(distinct license_id, ',' order by license_id) as notices
            from lines join known using (digest) group by doc_id
        )
        select doc_id, text_digest, license_id, notices
        from (select doc_id, {whole} as text_digest from texts) left join notices using (doc_id)
             left join known on digest = text_digest
    """


ORACLE["op8_license_scan"] = _license_sql()
ORACLE["op11_source_divergence"] = divergence.SQL
ORACLE["op12_importance_draw"] = importance.SQL
