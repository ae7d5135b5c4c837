"""Secrets in texts: three patterns, and other tokens that look more like random strings than like identifiers.

Native: DataFrame functions only.

1. Every text is cut by four patterns, its matches beside the gaps between them; running lengths of both are the spans.
   Three patterns are the base kinds ``assign``, ``access`` and ``hex``. The fourth gives candidates: runs of
   ``[A-Za-z0-9+/_=-]`` of 16 or more characters. What is found is stored, so texts are scanned once.
2. Two character Markov models of order one are counted from labelled samples. Random strings are the values of base matches;
   ordinary identifiers are candidates that do not mix digits with letters, so that no unknown secret is among them. Each
   sample counts once however often it occurs, and a sample that is found in both roles is random. The counts of pairs are at most ``SYMBOLS ** 2``, and become one list of
   whole numbers: thousandths of the log-likelihood ratio of a pair.
3. A candidate is a span of kind ``random`` if its letters and digits mix
   (at least one digit and one letter) and its ratio adds up to ``LEAST_RATIO`` or more. Base spans stay as they are.

Spans are in code points, the end exclusive, and are those of whole matches, with the key of an assignment.

Rows: a null text is empty; a text without spans has an empty list; repeated rows and ids are documents of their own. In a model
without samples all characters are as likely; two such models are worth 0. Other columns are not read. No documents give no rows.
A row's spans stay in its row and nothing is gathered by document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.sources.staging import stage

# ---------------------------------------------------------------------------
# The base patterns and their least lengths.
# ---------------------------------------------------------------------------

ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_VALUE = 12
LEAST_ACCESS = 18
LEAST_HEX = 16

# ---------------------------------------------------------------------------

#: The same matches, without stopping at runs that are too short anyway: a run is taken whole from its start.
LONG_ACCESS = rf"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}"
LONG_HEX = rf"[0-9a-f]{{{LEAST_HEX},}}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
SYMBOLS = len(ALPHABET)
#: Thousandths of a natural logarithm: the evidence that a candidate needs.
LEAST_RATIO = 6_000
#: Pairs that the share of a character counts as, beside those seen after another one.
PRIOR = 8

KINDS = ["assign", "access", "hex", "random"]

FINDING = "array<struct<from:int,kind:int,upto:int,value:string>>"
#: Matches that are placed in one go; a text with more is placed block by block.
BLOCK = 500


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once: an expression in a lambda is computed for every element."""
    return F.transform(F.array(value), use)[0]


def _placed(cuts: Column, kind: int) -> Column:
    """``(from, kind, upto, value)`` of all matches, from the lengths of matches and of the gaps before them."""

    def empty(kind_of_list: str) -> Column:
        return F.struct(F.lit(0).alias("upto"), F.array().cast(kind_of_list).alias("all"))

    def add(done: Column, cut: Column) -> Column:
        start = done["upto"] + F.char_length(cut["gap"])
        upto = start + F.char_length(cut["found"])
        one = F.struct(start.alias("from"), F.lit(kind).alias("kind"), upto.alias("upto"), cut["value"].alias("value"))
        return F.struct(upto.alias("upto"), F.concat(done["all"], F.array(one)).alias("all"))

    def add_block(done: Column, block: Column) -> Column:
        moved = F.transform(
            block["all"],
            lambda x: F.struct(
                (x["from"] + done["upto"]).alias("from"), x["kind"].alias("kind"),
                (x["upto"] + done["upto"]).alias("upto"), x["value"].alias("value"),
            ),
        )
        upto = done["upto"] + block["upto"]
        return F.struct(upto.alias("upto"), F.concat(done["all"], F.array(moved)).alias("all"))

    def in_blocks(all_cuts: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(all_cuts), F.lit(1)), F.lit(BLOCK))
        blocks = F.transform(starts, lambda at: F.aggregate(F.slice(all_cuts, at, BLOCK), empty(FINDING), add))
        return F.flatten(F.aggregate(blocks, empty(f"array<{FINDING}>"), add_block)["all"])

    return _let(cuts, in_blocks)


def _cuts(text: str, pattern: str, group: int = 0) -> Column:
    """``(found, gap, value)`` of all matches of a text, and what follows the last one as a gap without a match."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    return F.arrays_zip(found.alias("found"), gaps.alias("gap"), value.alias("value"))


def _matches(cuts: Column | str) -> Column:
    """Without the last gap."""
    return F.filter(cuts, lambda cut: cut["found"].isNotNull())


def _covered(cuts: str, least: int) -> Column:
    """The text with blanks in place of its matches whose value is long enough."""
    blank = lambda cut: F.repeat(F.lit(" "), F.char_length(cut["found"]))
    kept = lambda cut: F.when(F.char_length(cut["value"]) >= least, blank(cut)).otherwise(F.coalesce(cut["found"], F.lit("")))
    return F.array_join(F.transform(cuts, lambda cut: F.concat(cut["gap"], kept(cut))), "")


def findings(docs: DataFrame) -> DataFrame:
    """``(doc_id, base, candidates)``: base spans by place, and runs of candidate characters outside of them.

    Each step is a projection of its own, so that every text is matched by a pattern once.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    cuts = texts.select(
        "doc_id", "text", _cuts("text", ASSIGN, 2).alias("assign"), _cuts("text", LONG_ACCESS).alias("access"), _cuts("text", LONG_HEX).alias("hex")
    )
    base = F.concat(
        F.filter(_placed(_matches("assign"), 0), lambda x: F.char_length(x["value"]) >= LEAST_VALUE),
        _placed(_matches("access"), 1),
        _placed(_matches("hex"), 2),
    )
    # What an assignment holds is covered first; access keys and hex runs are then looked for in the rest.
    rest = cuts.select("doc_id", F.array_sort(base).alias("base"), _covered("assign", LEAST_VALUE).alias("rest"))
    for pattern in (LONG_ACCESS, LONG_HEX):
        rest = rest.select("doc_id", "base", _cuts("rest", pattern).alias("cuts")).select(
            "doc_id", "base", _covered("cuts", 1).alias("rest")
        )
    return rest.select("doc_id", "base", _placed(_matches(_cuts("rest", CANDIDATE)), 3).alias("candidates"))


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def samples(found: DataFrame) -> DataFrame:
    """``(value, random)``: every different sample once."""
    plain = F.filter("candidates", lambda c: ~_mixed(c["value"]))
    labelled = F.concat(
        F.transform("base", lambda b: F.struct(b["value"].alias("value"), F.lit(1).alias("random"))),
        F.transform(plain, lambda c: F.struct(c["value"].alias("value"), F.lit(0).alias("random"))),
    )
    return found.select(F.inline(labelled)).groupBy("value").agg(F.max("random").alias("random"))


def _pair(value: Column, place: Column) -> Column:
    """The number of the pair of characters at a place, from 0."""

    def symbol(at: Column) -> Column:
        return F.instr(F.lit(ALPHABET), F.substring(value, at, F.lit(1))) - 1

    return symbol(place) * SYMBOLS + symbol(place + 1)


def _pairs(value: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.char_length(value) - 1), lambda place: _pair(value, place))


def pair_counts(labelled: DataFrame) -> DataFrame:
    """``(pair, random, n)``; counted in each task before the shuffle."""
    long_enough = labelled.where(F.char_length("value") > 1)
    return long_enough.select(F.explode(_pairs(F.col("value"))).alias("pair"), "random").groupBy("pair", "random").agg(
        F.count(F.lit(1)).alias("n")
    )


def ratios(counts: DataFrame) -> DataFrame:
    """``(pair, ratio)`` of every pair: thousandths of ``ln P(second | first, random) - ln P(second | first, ordinary)``.

    ``P(second | first)`` counts the pair, and ``PRIOR`` times the share of the second character after any, so that a character
    which one kind hardly has tells them apart after any other.
    """
    both = counts.groupBy("pair").agg(
        F.sum(F.when(F.col("random") == 1, F.col("n"))).alias("r"), F.sum(F.when(F.col("random") == 0, F.col("n"))).alias("o")
    )
    every = counts.sparkSession.range(SYMBOLS * SYMBOLS).withColumnRenamed("id", "pair")
    filled = every.join(both, "pair", "left").na.fill(0, ["r", "o"]).withColumns(
        {"first": F.floor(F.col("pair") / SYMBOLS), "second": F.col("pair") % SYMBOLS}
    )  # SYMBOLS ** 2 rows

    def summed(by: str) -> DataFrame:
        return filled.groupBy(by).agg(F.sum("r").alias(f"r_{by}"), F.sum("o").alias(f"o_{by}"))

    whole = filled.agg(F.sum("r").alias("r_all"), F.sum("o").alias("o_all"))

    def probability(kind: str) -> Column:
        share = (F.col(f"{kind}_second") + 1).cast("double") / (F.col(f"{kind}_all") + SYMBOLS).cast("double")
        return (F.col(kind).cast("double") + PRIOR * share) / (F.col(f"{kind}_first") + PRIOR).cast("double")

    joined = filled.join(summed("first"), "first").join(summed("second"), "second").join(F.broadcast(whole))  # one row
    ratio = F.floor(1000 * F.log(probability("r") / probability("o")) + 0.5).cast("int")
    return joined.select("pair", ratio.alias("ratio"))


def _model(table: DataFrame) -> Column:
    """The ratios as a constant list, ordered by pair: ``SYMBOLS ** 2`` numbers, whatever the documents."""
    rows = sorted((row["pair"], row["ratio"]) for row in table.collect())
    return F.split(F.lit(",".join(str(ratio) for _, ratio in rows)), ",").cast("array<int>")


def _is_random(value: Column, model: Column, least: int) -> Column:
    ratio = F.aggregate(_pairs(value), F.lit(0), lambda done, pair: done + model[pair])
    return _mixed(value) & (ratio >= least)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(name) for name in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", names[s["kind"]], s["from"].cast("string"), s["upto"].cast("string"))
        ),
        ",",
    )


def scan(docs: DataFrame, least_ratio: int = LEAST_RATIO) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` of every document, ``spans`` with the random ones."""
    found = stage(findings(docs), "findings")
    model = _model(ratios(pair_counts(samples(found))))
    added = F.filter("candidates", lambda c: _is_random(c["value"], model, least_ratio))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{KINDS[kind]}") for kind in range(3)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", added))).alias("spans"),
    )
