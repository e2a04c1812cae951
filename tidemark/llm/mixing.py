"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed into cells (source, language, topic) of token weight. The cell
weights are raked: scaled in turn to each marginal's targets until all three agree.
A document's weight is its cell's fitted share over its actual share; probabilities
are those weights times one constant, cut at 1, where the constant makes the expected
tokens of the sample equal to the budget. Documents are drawn by a hash of id and
text, so a repeated run draws the same ones.

The fit works on the cell table, whose size is the number of category combinations,
and stays in Spark: windows per marginal, a checkpoint every few rounds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import shield
from tidemark.session import shared_dir, written

MARGINALS = ("source", "lang", "topic")
KEEP = 0.7
TEMPERATURE = 0.5
ROUNDS, TOLERANCE, PER_CHECK = 30, 1e-5, 3
SMALL_CELLS = 100_000

#: First match names the topic of a text; ``general`` otherwise.
TOPICS = (
    ("legal", r"(?i)licen[sc]e|copyright|rights reserved"),
    ("credentials", r"(?i)token|password|secret|api_?key"),
    ("contact", r"@|\+[0-9]"),
    ("tabular", r"\|"),
    ("numeric", r"[0-9]{4}"),
)
_NONE = "\0"


def topic_of(text: Column) -> Column:
    """Topic by the rules of TOPICS; null and empty texts are ``general``."""
    out = F.lit("general")
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return F.coalesce(out, F.lit("general"))


def with_cells(docs: DataFrame) -> DataFrame:
    """Add the cell (``_source``, ``_lang``, ``_topic``) and ``_tokens``, the number of words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(_NONE)) if c in docs.columns else F.lit(_NONE)
    return docs.select(
        "*", whole("source").alias("_source"), whole("lang").alias("_lang"), topic_of(text).alias("_topic"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("_tokens"),
    )


def _marginal(name: str, targets: Mapping[str, float] | None, temperature: float) -> Column:
    """Target share of the row's category: given, or the observed share to the power ``temperature``."""
    category = F.col(f"_{name}")
    if targets is not None:
        pairs = [x for k, v in targets.items() for x in (F.lit(_NONE if k is None else k), F.lit(float(v)))]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), category), F.lit(0.0)) if pairs else F.lit(0.0)
    return F.pow(F.sum("tokens").over(Window.partitionBy(f"_{name}")).cast("double"), F.lit(temperature))


def fit_cells(
    cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None,
    temperature: float = TEMPERATURE, rounds: int = ROUNDS, tolerance: float = TOLERANCE,
) -> DataFrame:
    """Add ``share`` (actual) and ``fitted`` to cells with ``tokens``; both sum to 1.

    Cells without tokens, and categories without a target, get 0. Targets of absent categories
    are spread over the present ones in proportion.
    """
    spark = cells.sparkSession
    shared_dir(spark)
    targets = targets or {}
    whole = Window.partitionBy(F.lit(1))
    raw = cells.where("tokens > 0").select(
        "*", *[_marginal(m, targets.get(m), temperature).alias(f"_raw_{m}") for m in MARGINALS]
    )
    # Targets sum to 1 over the categories that occur: a category's target is counted once, by a share of its cells.
    scaled = raw.select(
        "*",
        *[(F.col(f"_raw_{m}") / F.count(F.lit(1)).over(Window.partitionBy(f"_{m}"))).alias(f"_part_{m}") for m in MARGINALS],
    )
    current = scaled.select(
        *[f"_{m}" for m in MARGINALS], "tokens", (F.col("tokens") / F.sum("tokens").over(whole)).alias("share"),
        *[(F.col(f"_raw_{m}") / F.sum(f"_part_{m}").over(whole)).alias(f"_t_{m}") for m in MARGINALS],
    ).withColumn("fitted", F.col("share")).checkpoint()
    for _ in range(0, rounds, PER_CHECK):
        for m in MARGINALS * PER_CHECK:
            have = F.sum("fitted").over(Window.partitionBy(f"_{m}"))
            current = current.withColumn(
                "fitted", F.when(have > 0, F.col("fitted") * F.col(f"_t_{m}") / have).otherwise(0.0)
            )
        current = current.checkpoint()
        gaps = current.select(
            F.greatest(*[F.abs(F.sum("fitted").over(Window.partitionBy(f"_{m}")) - F.col(f"_t_{m}")) for m in MARGINALS]).alias("gap")
        ).agg(F.max("gap").alias("gap"))
        gap = gaps.first()["gap"]
        if gap is None or gap <= tolerance:
            break
    return current


def probabilities(fitted: DataFrame, keep: float = KEEP) -> DataFrame:
    """Add ``weight`` and ``probability``; the expected share of tokens drawn is ``keep`` where possible.

    Cells sorted by weight are cut at 1 from the heaviest on; the constant follows from
    running sums, so no search is needed. Cells of weight 0 are never drawn.
    """
    weighted = fitted.withColumn("weight", F.col("fitted") / F.col("share"))
    heavy = Window.partitionBy(F.lit(1)).orderBy(F.col("weight").desc(), *[f"_{m}" for m in MARGINALS])
    above = heavy.rowsBetween(Window.unboundedPreceding, -1)
    below = heavy.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # With the cells above cut at 1, the rest must supply what is missing.
    tried = weighted.select(
        "*",
        ((F.lit(keep) - F.coalesce(F.sum("share").over(above), F.lit(0.0)))
         / F.sum(F.col("share") * F.col("weight")).over(below)).alias("_c"),
    )
    fits = F.when((F.col("weight") > 0) & (F.col("_c") * F.col("weight") <= 1) & (F.col("_c") > 0), F.col("_c"))
    constant = F.first(fits, ignorenulls=True).over(heavy.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return tried.select(
        *[f"_{m}" for m in MARGINALS], "tokens", "share", "fitted", "weight",
        F.when(F.col("weight") > 0, F.least(F.lit(1.0), F.coalesce(constant, F.lit(float("inf"))) * F.col("weight")))
        .otherwise(0.0).alias("probability"),
    )


def mix(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, keep: float = KEEP, seed: int = 17
) -> DataFrame:
    """Add ``topic``, ``tokens``, ``weight``, ``probability`` and ``sampled`` to every document.

    Null sources and languages are categories of their own. Documents without words have
    weight 0 and are not drawn. Rows that agree in id and text are drawn or left together. Without a
    source or language column all documents share one null category. Other columns pass through,
    whatever their names, but the five named above are replaced.
    """
    docs, named = shield(docs, ["doc_id", "text", "source", "lang"], ["topic", "tokens", "weight", "probability", "sampled"])
    cells_of = with_cells(docs)
    keys = [f"_{m}" for m in MARGINALS]
    cells = written(cells_of.groupBy(*keys).agg(F.sum("_tokens").alias("tokens")), "cells")
    chances = written(probabilities(fit_cells(cells, targets), keep), "chances").select(*keys, "weight", "probability")
    if chances.count() <= SMALL_CELLS:
        chances = F.broadcast(chances)
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    chance = F.when(F.col("_tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0)
    out = cells_of.join(chances, keys, "left")
    return named(out.select(
        *docs.columns,
        F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"),
        F.coalesce("weight", F.lit(0.0)).alias("weight"), chance.alias("probability"), (draw < chance).alias("sampled"),
    ))


__all__ = ["fit_cells", "mix", "probabilities", "topic_of", "with_cells"]
