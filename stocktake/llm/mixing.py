"""Mix sources to target weights by Pareto order sampling.

Every source gets a target in words: the weights share ``share`` times all words,
and a target that would pass ``max_repeats`` times its source is held there while
the excess is shared again. A source at ``r`` times its size first gets floor(r)
whole copies of each document for certain. The rest is a sample without
replacement: documents are ranked by the Pareto ratio, random odds over
inclusion odds (the odds of the remaining fraction times the document's size over the
source's mean size, so longer documents go first more often), and taken in that
order until the source's words are spent.

Shape of the plan: words are counted once and kept as a narrow table. The
running sum over a source, which may hold a third of all rows, is never one
window: ranks fall into ``BUCKETS`` ranges whose sums come from a grouped
aggregate, and only the range where the target lies is sorted, with rows that tie
counted first. Random numbers are drawn by id and text, and rows that tie in these
are ordered by a hash of the whole row; so what still ties at the cut are rows that
are equal in every column, however many, and as many of them are taken as the
target allows.

Defined results: a NULL or empty text has size 0, takes 0 words and stays in the
report; NULL is a source of its own, last in order; a NULL id draws like an
empty one; repeated rows count as rows of their own. A text counts whole, however
long, in its row. Columns named like those of the result are not mistaken for
them. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stocktake.llm.common import WORD, cut_lineage

BUCKETS = 4096


#: Rows that one task makes of a row that is repeated.
REPEATED_ROWS = 1024


def uniform(id_col: Column, text: Column, seed: int) -> Column:
    """A number in (0, 1) fixed by id and text: the first 52 bits of an MD5."""
    drawn = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.md5(text.cast("binary")), F.lit(f":{seed}"))
    digits = F.substring(F.md5(drawn.cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, max_repeats: int) -> DataFrame:
    """One row per source: source, source_size, n_docs, target.

    ``sizes`` has source and size. The windows run over one row per source.
    """
    src = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
           .withColumn("at", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
           .withColumn("w", F.element_at(F.array(*map(F.lit, weights)),
                                         F.pmod(F.col("at") - 1, F.lit(len(weights))).cast("int") + 1))
           .withColumn("cap", F.col("source_size") * max_repeats)
           .withColumn("full_at", F.col("cap") / F.col("w")))
    # Sources fill up in the order of full_at; the level of the others follows
    # from what is left once those before them are full.
    by_level = W.orderBy("full_at", "at")
    after = by_level.rowsBetween(W.currentRow, W.unboundedFollowing)
    src = (src
           .withColumn("before", F.sum("cap").over(by_level.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("cap"))
           .withColumn("total", F.sum("source_size").over(W.partitionBy()))
           .withColumn("level", (F.col("total") * share - F.col("before")) / F.sum("w").over(after))
           .withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"),
                                             F.struct(F.row_number().over(by_level).alias("k"), "level")))
                       .over(W.partitionBy())["level"]))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("cap").cast("double")))
    return src.select("source", "source_size", "n_docs", target.alias("target"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """``docs`` with its id, source, size, random number and hash under names of this module."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.withColumn("__id", F.col(id_col)).withColumn("__source", F.col(source_col))
            .withColumn("__size", F.regexp_count(text, F.lit(WORD)).cast("bigint"))
            .withColumn("__u", uniform(F.col(id_col), text, seed)).withColumn("__row", F.xxhash64(*docs.columns)))


def _ranked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's row of ``plan``, the rank key, its range and its order.

    The key is q / (1 + q) of the Pareto ratio q = u / (1 - u) / odds: the same
    order, within (0, 1].
    """
    odds = (F.when(F.col("mean_size") > 0,
                   F.col("part") / (1 - F.col("part")) * F.col("__size") / F.nullif(F.col("mean_size"), F.lit(0.0)))
            .otherwise(0.0))
    u = F.col("__u")
    return (rows.join(plan, F.col("__source").eqNullSafe(F.col("s")))
            .withColumn("__key", u / (u + odds * (1 - u)))
            .withColumn("__bucket", F.least(F.floor(F.col("__key") * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))
            .withColumn("__order", F.struct("__key", "__id", "__size", "__row")))


def mix_plan(rows: DataFrame, weights: tuple[int, ...], share: float, max_repeats: int) -> DataFrame:
    """One row per source: its targets and where its order is cut.

    ``rows`` is a narrow table of __id, __source, __size, __u and __row. Of the
    ``tied`` rows at the cut the first ``within`` are taken.
    """
    size = F.nullif(F.col("source_size"), F.lit(0))
    src = cut_lineage(
        source_targets(rows.select(F.col("__source").alias("source"), F.col("__size").alias("size")), weights, share, max_repeats)
        .withColumn("certain", F.coalesce(F.floor(F.col("target") / size), F.lit(0)).cast("bigint"))
        .withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size"))
        .withColumn("part", F.coalesce(F.col("rest") / size, F.lit(0.0)))
        .withColumn("mean_size", F.col("source_size") / F.col("n_docs"))
        .withColumnRenamed("source", "s"))
    ranked = _ranked(rows, src)
    upto = F.sum("words").over(W.partitionBy("__source").orderBy("__bucket").rowsBetween(W.unboundedPreceding, W.currentRow))
    edge = (ranked.groupBy("__source", "__bucket").agg(F.sum("__size").alias("words"), F.first("rest").alias("rest"))
            .withColumn("upto", upto).where(F.col("upto") >= F.col("rest"))
            .groupBy("__source").agg(F.min(F.struct("__bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("e"))
            .select(F.col("__source").alias("edge_s"), F.col("e.__bucket").alias("edge"), F.col("e.before").alias("before")))
    # Only the range where the target lies is sorted, a row for all that tie.
    in_edge = (ranked.join(edge, F.col("__source").eqNullSafe(F.col("edge_s")) & (F.col("__bucket") == F.col("edge")))
               .groupBy("__source", "__order").agg(F.count("*").alias("tied"), F.first("__size").alias("__size"),
                                                   F.first("before").alias("before"), F.first("rest").alias("rest")))
    words = F.col("tied") * F.col("__size")
    ahead = (F.col("before") - words
             + F.sum(words).over(W.partitionBy("__source").orderBy("__order").rowsBetween(W.unboundedPreceding, W.currentRow)))
    # The j-th of them is taken if no more than half of it lies beyond the target.
    room = F.floor((F.col("rest") - F.col("ahead")) / F.nullif(F.col("__size"), F.lit(0)) + 0.5)
    within = F.when(F.col("__size") > 0, F.least(F.greatest(room, F.lit(0)), F.col("tied"))).when(
        F.col("ahead") <= F.col("rest"), F.col("tied")).otherwise(0)
    cut = (in_edge.withColumn("ahead", ahead).withColumn("within", within).where("within > 0")
           .groupBy("__source").agg(F.max(F.struct("__order", "within", "tied")).alias("c"))
           .select(F.col("__source").alias("cut_s"), F.col("c.__order").alias("cut"), "c.within", "c.tied"))
    return cut_lineage(src.join(edge, F.col("s").eqNullSafe(F.col("edge_s")), "left")
                       .join(cut, F.col("s").eqNullSafe(F.col("cut_s")), "left")
                       .select("s", "source_size", "target", "certain", "rest", "part", "mean_size", "edge", "cut", "within", "tied"))


def _with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with their source's row of ``plan`` and __copies, how often the mix takes them."""
    ranked = _ranked(rows, plan)
    sampled = ((F.col("rest") > 0)
               & (F.col("edge").isNull() | (F.col("__bucket") < F.col("edge"))
                  | ((F.col("__bucket") == F.col("edge")) & F.coalesce(F.col("__order") <= F.col("cut"), F.lit(False)))))
    with_copies = lambda df, also: df.withColumn("__copies", F.col("certain") + (sampled & also).cast("bigint"))
    if plan.where("within < tied").isEmpty():
        return with_copies(ranked, F.lit(True))
    # Rows that are equal throughout, of which the cut takes a part: counted, and made again with numbers.
    split = F.coalesce((F.col("__order") == F.col("cut")) & (F.col("within") < F.col("tied")), F.lit(False))
    equal = ranked.where(split).groupBy(*ranked.columns).agg(F.count("*").alias("__n"))
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / REPEATED_ROWS))).alias("__chunk")
    last = F.least(F.col("__n"), (F.col("__chunk") + 1) * REPEATED_ROWS)
    numbered = (equal.select("*", chunk).repartition("__chunk")
                .select("*", F.explode(F.sequence(F.col("__chunk") * REPEATED_ROWS + 1, last)).alias("__k")))
    return (with_copies(ranked.where(~split), F.lit(True))
            .unionByName(with_copies(numbered, F.col("__k") <= F.col("within")).drop("__n", "__chunk", "__k")))


def _narrow(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return cut_lineage(_sized(docs, id_col, text_col, source_col, seed).select("__id", "__source", "__size", "__u", "__row"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_repeats: int = 2,
                seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every document."""
    rows = _narrow(docs, id_col, text_col, source_col, seed)
    return (_with_copies(rows, mix_plan(rows, weights, share, max_repeats))
            .select(F.col("__id").alias("doc_id"), F.col("__source").alias("source"), F.col("__size").alias("size"),
                    "source_size", "target", F.col("__copies").alias("copies"),
                    (F.col("__copies") * F.col("__size")).alias("taken")))


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_repeats: int = 2,
               seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken. Texts stay where they are."""
    plan = mix_plan(_narrow(docs, id_col, text_col, source_col, seed), weights, share, max_repeats)
    # The row travels as one struct, so its columns clash with none of the plan.
    sized = (_sized(docs, id_col, text_col, source_col, seed)
             .select(F.struct(*docs.columns).alias("__whole"), "__id", "__source", "__size", "__u", "__row"))
    return (_with_copies(sized, plan).where("__copies > 0")
            .select("__whole", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select("__whole.*"))
