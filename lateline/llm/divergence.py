"""How much the words of each source differ from those of the other sources and of the whole language.

1. Tasks count words with Arrow's compute functions: ``ascii_lower``, ``split_pattern_regex``,
   ``dictionary_encode`` and a hash ``group_by`` on codes, first by document, then by group. Partial counts of
   several batches are merged while they are small, so a task sends each word of a group about once.
2. Spark merges them to one row a word of a language, with its counts by source; words of too few documents go.
3. Words are dealt to shards. A shard is a matrix of words by sources; it adds up the differences of each two sources
   over its words, and keeps the best words of each source. Sums and best lists of all shards are then merged.

The sources of a language are in every shard of it: the result has a row for each two of them, so they are fewer
than the rows a reader can take. The size of a shard follows the number of counts, and no key gathers more than a shard.

All figures are integers. A share is ``1 + floor(10**9 * (count + 1) / (words + kept words))``, a difference
``floor((p - q)**2 / q)``.

Rows: null text, language and source count as empty; repeated rows and ids are documents of their own; a group without
kept words still has its pairs, with value 0 where its language keeps none; equal values are ranked by name in UTF-8.
No documents give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.common import BATCH_ROWS, slices
from lateline.sources.staging import stage

#: What lies between terms: all ASCII characters but letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCUMENTS = 3
BEST_TERMS = 200
#: Counts (words times sources) of a shard: a few tens of megabytes in a task.
SHARD_CELLS = 1_000_000
#: Partial counts that a task merges before it sends them.
PARTIAL_ROWS = 300_000
SCALE_PARTS = 100_000, 10_000  # their product is 10**9

RESULT = "lang string, source string, part string, item string, value long, rank int"


def _plain(docs: DataFrame) -> DataFrame:
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return docs.select(
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ["text", "lang", "source"]]
    )


# --- counting ------------------------------------------------------------------------------------


def _encoded(values: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, pa.Array]:
    """Codes and the values they stand for."""
    values = pc.dictionary_encode(values)
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.indices.cast(pa.int64()), values.dictionary


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """``(lang, source, term, n, docs)`` of some documents."""
    words = pc.split_pattern_regex(pc.ascii_lower(batch["text"]), BETWEEN)
    doc = pc.list_parent_indices(words).cast(pa.int64())
    words = pc.list_flatten(words)
    real = pc.greater(pc.binary_length(words), 0)
    code, terms = _encoded(words.filter(real))
    in_doc = pa.table({"doc": doc.filter(real), "term": code}).group_by(["doc", "term"]).aggregate([([], "count_all")])
    lang, langs = _encoded(batch["lang"])
    source, sources = _encoded(batch["source"])
    group = pc.add(pc.multiply(lang, len(sources)), source).take(in_doc["doc"])
    counts = (
        pa.table({"group": group, "term": in_doc["term"], "n": in_doc["count_all"]})
        .group_by(["group", "term"])
        .aggregate([("n", "sum"), ("n", "count")])
    )
    group = counts["group"]
    lang = pc.divide(group, len(sources)) if len(sources) else group
    source = pc.subtract(group, pc.multiply(lang, len(sources)))
    columns = [langs.take(lang), sources.take(source), terms.take(counts["term"]), counts["n_sum"], counts["n_count"]]
    return pa.table(columns, names=["lang", "source", "term", "n", "docs"])


def _merged(tables: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return whole.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(["lang", "source", "term", "n", "docs"])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in slices(batches, "text"):
        held.append(_counted(batch))
        if sum(len(table) for table in held) > PARTIAL_ROWS:
            held = [_merged(held)]
            if len(held[0]) > PARTIAL_ROWS // 2:
                yield from held.pop().to_batches(max_chunksize=BATCH_ROWS * 10)
    if held:
        yield from _merged(held).to_batches(max_chunksize=BATCH_ROWS * 10)


def kept_terms(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``(lang, term, counts)``: terms of at least so many documents of a language, with ``(source, n)`` of each source."""
    partial = _plain(docs).mapInArrow(_partial_counts, "lang string, source string, term string, n long, docs long")
    # Dealt by language and term once: a task has sent a term of a group a few times at most.
    by_group = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    terms = by_group.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("counts")
    )
    return terms.where(F.col("docs") >= least_documents).select("lang", "term", "counts")


# --- divergences ---------------------------------------------------------------------------------


def shares(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """``1 + floor(10**9 * (counts + 1) / words)`` in two steps, each within 64 bits up to 9 * 10**13 words."""
    first, second = SCALE_PARTS
    whole, rest = np.divmod((counts + 1) * first, words)
    return 1 + whole * second + rest * second // words


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _shard(best_terms: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Sums over each two sources, and the best terms of each source, of one shard of a language."""

    def figures(terms: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("source").combine_chunks()
        names = groups["source"].combine_chunks()
        words = groups["words"].to_numpy().astype(np.int64)
        n_terms, n_groups = len(terms), len(groups)
        lang = groups["lang"][0].as_py() if n_groups else ""
        counts = np.zeros((n_terms, n_groups), np.int64)
        if n_terms:
            listed = terms["counts"].combine_chunks()
            flat = listed.flatten()
            row = pc.list_parent_indices(listed).to_numpy()
            column = pc.index_in(flat.field("source"), names).to_numpy(zero_copy_only=False)
            counts[row, column] = flat.field("n").to_numpy()
        p = shares(counts, words)
        sums = np.zeros((n_groups, n_groups), np.int64)
        for i in range(n_groups):
            sums[i] = differences(p[:, i : i + 1], p).sum(axis=0)
        own, other = np.nonzero(~np.eye(n_groups, dtype=bool))
        parts = [pa.table([names.take(own), pa.array(["pair"] * len(own), pa.string()), names.take(other), sums[own, other]],
                          names=["source", "part", "item", "value"])]
        if n_terms:
            of_lang = shares(counts.sum(axis=1), groups["lang_words"].to_numpy()[0])
            spelled = terms["term"].combine_chunks()
            for i in range(n_groups):
                over = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > of_lang))
                found = pa.table({"item": spelled.take(over), "value": differences(p[over, i], of_lang[over])})
                keys = [("value", "descending"), ("item", "ascending")]
                found = found.take(pc.select_k_unstable(found, min(best_terms, len(found)), keys)) if len(found) else found
                same = [pa.array([text] * len(found), pa.string()) for text in (names[i].as_py(), "term")]
                parts.append(pa.table([*same, found["item"], found["value"]], names=["source", "part", "item", "value"]))
        result = pa.concat_tables(parts)
        return result.add_column(0, "lang", pa.array([lang] * len(result), pa.string()))

    return figures


def divergences(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    best_terms: int = BEST_TERMS,
    shard_cells: int = SHARD_CELLS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: differences to each other source, and the terms above the language."""
    kept = stage(kept_terms(docs, least_documents), "kept-terms")
    sums = kept.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
    groups = _plain(docs).select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
    groups = groups.join(vocabulary, "lang", "left").na.fill(0, ["n", "vocabulary"])
    of_lang = Window.partitionBy("lang")
    groups = stage(
        groups.select(
            "lang",
            "source",
            (F.col("n") + F.col("vocabulary")).alias("words"),
            (F.sum("n").over(of_lang) + F.col("vocabulary")).alias("lang_words"),
            (F.col("vocabulary") * F.count(F.lit(1)).over(of_lang)).alias("cells"),
        ),
        "term-groups",
    )
    most = groups.agg(F.max("cells")).first()[0] or 0
    shards = -(-most // shard_cells) or 1  # of every language: empty ones cost nothing but their sources
    dealt = kept.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"))
    everywhere = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    parts = (
        dealt.groupBy("lang", "shard")
        .cogroup(everywhere.groupBy("lang", "shard"))
        .applyInArrow(_shard(best_terms), "lang string, source string, part string, item string, value long")
    )
    parts = stage(parts, "divergence-parts")
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    # The ranks of pairs are of sources; of terms only the best of each shard have come so far.
    ranked = pairs.withColumn("rank", F.row_number().over(best))
    terms = parts.where("part = 'term'").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= best_terms)
    return ranked.unionByName(terms).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


SQL = r"""
    with plain as (
        select row_number() over () as row_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
        from documents
    ),
    in_doc as (
        select lang, source, term, row_id, count(*) as n
        from (select lang, source, row_id,
                     unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from plain)
        group by all
    ),
    kept as (select lang, term, sum(n)::hugeint as lang_n from in_doc group by all having count(*) >= 3),
    vocabulary as (select lang, count(*)::hugeint as v, sum(lang_n)::hugeint as n from kept group by lang),
    counts as (
        select lang, source, term, sum(n)::hugeint as n from in_doc semi join kept using (lang, term) group by all
    ),
    grouped as (
        select g.lang, g.source, coalesce(c.n, 0)::hugeint as n, coalesce(v, 0)::hugeint as v, coalesce(v.n, 0)::hugeint as lang_n
        from (select distinct lang, source from plain) g left join vocabulary v using (lang)
        left join (select lang, source, sum(n)::hugeint as n from counts group by all) c using (lang, source)
    ),
    shared as (
        select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
               1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.n + g.v) as p,
               1 + (1000000000::hugeint * (k.lang_n + 1)) // (g.lang_n + g.v) as q
        from grouped g join kept k using (lang) left join counts c using (lang, source, term)
    ),
    pairs as (
        select a.lang, a.source, 'pair' as part, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::bigint as value
        from shared a join shared b on a.lang = b.lang and a.term = b.term and a.source <> b.source
        group by all
        union all
        select a.lang, a.source, 'pair', b.source, 0::bigint
        from grouped a join grouped b on a.lang = b.lang and a.source <> b.source where a.v = 0
    ),
    terms as (
        select lang, source, 'term' as part, term as item, (((p - q) * (p - q)) // q)::bigint as value
        from shared where n > 0 and p > q
    )
    select lang, source, part, item, value, rank::int as rank
    from (
        select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
        from (select * from pairs union all select * from terms)
    )
    where part = 'pair' or rank <= 200
"""
