"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic). Raking multiplies the
cells in turn by target / current share of each dimension until all marginals
meet their targets; every step is a window sum over the cell table, never over
documents. A document's probability is its cell's target tokens over the
cell's tokens, scaled so that the expected total meets a token budget; where a
cell has fewer tokens than asked for, all of it is taken and the others make up
for it: the total is met then, and the target shares are not. They are met up
to ``largest_budget``, which a budget of None stands for. A document is sampled
when a hash of its id and text, as a number from 0 to 1, lies below its
probability, so a rerun samples the same.

Raking goes on until all marginals meet their targets. Where it stalls before,
the targets contradict each other (as where sources of one language each have
shares that the languages cannot have); the remaining error is told by a
warning, or with ``strict`` by a ContradictingTargets, and the weights meet the
targets of the last dimension.

The tables have no topic, so ``topic`` tells texts by their form.

Results in odd cases: a null in a dimension is a value of its own; null or
empty text has no tokens, and a cell without any gets probability 0; repeated
rows share one draw; an empty table gives an empty table; other columns are
ignored, or carried along by the filter.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starmart.llm.common import broadcast_within, persist

DIMS = ["source", "lang", "topic"]
#: A marginal's target is its own share to this power: 1 leaves it, 0 evens it out.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.5}
#: Share of all tokens to sample; None: as many as the targets allow.
BUDGET = 0.7
#: Sweeps over all dimensions between two looks at the error; the error (relative)
#: that ends them, and the share of it that has to go from look to look.
STEP, TOLERANCE, PROGRESS = 4, 1e-10, 0.01
#: Cells up to which the table of probabilities is broadcast.
MAX_BROADCAST_ROWS = 200_000


def topic() -> Column:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (F.when(F.contains(text, F.lit(" | ")) | F.contains(text, F.lit("!! ")), F.lit("marked"))
            .when(text.rlike("[0-9]{3}"), F.lit("figures"))
            .when(F.octet_length(text) < 1000, F.lit("short")).otherwise(F.lit("prose")))


def _named(value: Column) -> Column:
    """A dimension's value as a key that keeps null apart."""
    return F.when(value.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), value.cast("string")))


def _value(key: str) -> Column:
    """The value that a key names."""
    return F.when(F.col(key) != "null", F.expr(f"substring({key}, 2)")).alias(key)


def _draw() -> Column:
    """A number in [0, 1) from 52 bits of a hash of id and text."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"),
                   F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _tokens() -> Column:
    return F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


class ContradictingTargets(ValueError):
    pass


def rake(cells: DataFrame, dims: list[str], targets: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """Cells (dims, n) with column w: shares that meet the targets (tables:
    dimension, share) of all dimensions. Targets that cannot be met together:
    a warning, or an error if ``strict``."""
    w = cells.filter("n > 0").withColumn("w", F.col("n").cast("double"))
    for d in dims:
        w = w.join(broadcast_within(targets[d].select(d, F.col("share").alias(f"t_{d}")), MAX_BROADCAST_ROWS), d)
    error = F.lit(0.0)
    for d in dims:
        error = F.greatest(error, F.abs(F.sum("w").over(Window.partitionBy(d)) / F.col(f"t_{d}") - 1))
    last = float("inf")
    while True:
        for _ in range(STEP):
            for d in dims:
                w = w.withColumn("w", F.col("w") * F.col(f"t_{d}") / F.sum("w").over(Window.partitionBy(d)))
        w = persist(w, "raked")
        off = w.select(error.alias("e")).agg(F.max("e")).first()[0]
        if off is None or off < TOLERANCE:
            break
        if off > (1 - PROGRESS) * last:
            said = f"the targets of {', '.join(dims)} contradict each other: a share remains off by {off:.2g} of its target"
            if strict:
                raise ContradictingTargets(said)
            warnings.warn(said, stacklevel=2)
            break
        last = off
    return w.select(*dims, "n", "w")


def power_targets(cells: DataFrame, dims: list[str], powers: dict[str, float]) -> dict[str, DataFrame]:
    """Share of each value of a dimension, from its tokens to a power."""
    out = {}
    for d in dims:
        one = persist(cells.filter("n > 0").groupBy(d).agg(F.sum("n").cast("double").alias("n")), f"share-{d}")
        power = F.pow(F.col("n"), F.lit(powers[d]))
        whole = one.agg(F.sum(power)).first()[0]
        out[d] = one.select(d, (power / F.lit(whole)).alias("share"))
    return out


def largest_budget(raked: DataFrame) -> float:
    """The largest share of all tokens at which no cell is asked for more than
    it has, so that the expected shares of every value are those of w."""
    row = raked.agg(F.min(F.col("n") / F.col("w")).alias("c"), F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    return row["c"] * row["w"] / row["n"] if row["n"] else 0.0


def probabilities(raked: DataFrame, budget: float | None) -> DataFrame:
    """Column p: min(1, c * w / n), with c such that the expected number of
    tokens is ``budget`` of all (None: the largest that meets the targets).
    Each round knows more cells that are taken whole."""
    if budget is None:
        most = raked.agg(F.min(F.col("n") / F.col("w"))).first()[0]
        return raked.withColumn("p", F.least(F.lit(1.0), F.col("w") * F.lit(most) / F.col("n")))
    c, whole = 0.0, None
    while True:
        full = F.col("w") * c >= F.col("n")
        row = raked.agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(full, F.col("n"))), F.lit(0)).alias("whole"),
                        F.coalesce(F.sum(F.when(~full, F.col("w"))), F.lit(0.0)).alias("rest")).first()
        if row["n"] is None or row["whole"] == whole or row["rest"] == 0:
            break
        whole = row["whole"]
        c = max(0.0, (budget * row["n"] - whole) / row["rest"])
    return raked.withColumn("p", F.least(F.lit(1.0), F.col("w") * c / F.col("n")))


def _described(docs: DataFrame) -> list[Column]:
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic()}
    return [_named(dims[d]).alias(d) for d in DIMS]


def cell_probabilities(described: DataFrame, budget: float | None = BUDGET, powers: dict[str, float] | None = None,
                       strict: bool = False) -> DataFrame:
    """Probability per cell of rows with DIMS and tokens."""
    cells = persist(described.groupBy(*DIMS).agg(F.sum("tokens").alias("n")), "cells")
    raked = rake(cells, DIMS, power_targets(cells, DIMS, powers or POWERS), strict)
    return persist(probabilities(raked, budget), "probabilities")


def mix(docs: DataFrame, budget: float | None = BUDGET, powers: dict[str, float] | None = None, strict: bool = False) -> DataFrame:
    """doc_id, DIMS, tokens, p and sampled for every row."""
    described = persist(docs.select("doc_id", *_described(docs), _tokens().alias("tokens"), _draw().alias("u")), "described")
    p = cell_probabilities(described, budget, powers, strict).select(*DIMS, "p")
    out = described.join(broadcast_within(p, MAX_BROADCAST_ROWS), DIMS, "left").withColumn("p", F.coalesce("p", F.lit(0.0)))
    return out.select("doc_id", *map(_value, DIMS), "tokens", "p", (F.col("u") < F.col("p")).alias("sampled"))


def mix_filter(docs: DataFrame, budget: float | None = BUDGET, powers: dict[str, float] | None = None) -> DataFrame:
    """The sampled rows of ``docs``, columns unchanged."""
    p = cell_probabilities(docs.select(*_described(docs), _tokens().alias("tokens")), budget, powers).select(*DIMS, "p")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    named = docs.select(row, *_described(docs), _draw().alias("u"))
    return named.join(broadcast_within(p, MAX_BROADCAST_ROWS), DIMS).filter("u < p").select("row.*")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.withColumn("p", F.round("p", 6))
