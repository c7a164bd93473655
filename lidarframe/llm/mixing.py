"""Temperature mixing: sources in proportion to a power of their share, as block permutations.

Weights are w(s) = share(s)^a / sum, share by tokens. The exponent a is found by bisection: either
the mixture gets a target entropy, or it becomes as even as a limit of repetitions allows. A
source's budget is its weight of the whole budget. It is filled with whole epochs and the beginning
of one more, each an own permutation: the source's rows are hashed into blocks of bounded size,
blocks are put in order by a hash of seed and epoch, and so are rows in their block. Running
sums within blocks and over blocks say where the last epoch ends, so no task sees a whole source.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lidarframe.llm.common import WORD_CHARS, hidden, materialise, named, shown, table

SEED = 11
BLOCK_ROWS = 4096
MAX_REPEATS = 2.0
MAX_SOURCES = 100_000  # the table of sources is held by the driver; more is an error
WORDS = f"coalesce(regexp_count(text, r'{WORD_CHARS}'), 0)"


class Share(NamedTuple):
    source: str | None
    tokens: int
    rows: int
    weight: float
    budget: int


def weights(tokens: list[int], exponent: float) -> list[float]:
    total = sum(tokens)
    powers = [(t / total) ** exponent if t else 0.0 for t in tokens]
    return [p / sum(powers) for p in powers]


def entropy(shares: list[float]) -> float:
    return -sum(w * math.log(w) for w in shares if w)


def repeats(tokens: list[int], shares: list[float], budget: float | None) -> list[float]:
    """Epochs of each source; without a budget, as many that the least repeated has one."""
    rates = [w / t for w, t in zip(shares, tokens) if t]
    whole = budget if budget is not None else 1 / min(rates)
    return [r * whole for r in rates]


def find_exponent(
    tokens: list[int],
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
    budget: float | None = None,
    steps: int = 60,
) -> float:
    """Exponent in [0, 1]. As it falls, entropy and repetitions grow.

    With ``target_entropy`` (nats): where the weights have it, or the nearest end of the range. Else
    the least exponent at which no source is repeated more than ``max_repeats`` times, or 1 if there is none.
    """

    def fits(a: float) -> bool:
        shares = weights(tokens, a)
        if target_entropy is not None:
            return entropy(shares) <= target_entropy
        return max(repeats(tokens, shares, budget)) <= max_repeats * (1 + 1e-12)

    return _bisect(fits, steps)


def _bisect(fits: Callable[[float], bool], steps: int) -> float:
    low, high = 0.0, 1.0
    if fits(low):
        return low
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def plan(
    totals: list[tuple[str | None, int, int]],
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
    budget: int | None = None,
) -> list[Share]:
    """Weight and budget of each (source, tokens, rows).

    Without ``budget`` the whole is so large that each source is used up once at least. Sources
    without tokens have weight and budget 0.
    """
    tokens = [t for _, t, _ in totals]
    if not any(tokens):
        return [Share(s, t, n, 0.0, 0) for s, t, n in totals]
    shares = weights(tokens, find_exponent(tokens, max_repeats, target_entropy, budget))
    whole = budget if budget is not None else max(t / w for t, w in zip(tokens, shares) if t)
    out = []
    for (source, t, n), w in zip(totals, shares):
        own = round(w * whole)
        out.append(Share(source, t, n, w, max(own, t) if budget is None else own))
    return out


def mix(
    docs: DataFrame,
    source_column: str = "source",
    tokens: str = WORDS,
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
    budget: int | None = None,
    seed: int = SEED,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows of ``docs``, each as often as the mixture has it, with columns mix_tokens, mix_epoch,
    mix_block, mix_position and mix_at.

    ``tokens`` is a SQL expression for a row's tokens. mix_position counts the tokens of the source before the row; mix_at is
    that as part of the source's budget: sorted by it, every stretch holds the sources by weight.
    Without ``budget`` every row comes at least once, also rows without tokens (of a source that has
    none: once exactly). With one, a row of the last epoch is in if it ends within the source's
    budget. Rows with a null source are a source of their own; null tokens and texts count 0. Repeated rows
    count as often as they are there. An empty table gives an empty table. Columns of the given names
    are replaced, other names are free.
    """
    added = ["mix_tokens", "mix_epoch", "mix_block", "mix_position", "mix_at"]
    columns = [c for c in docs.columns if c.lower() not in added]
    rows = materialise(
        docs.select(
            *hidden(columns),
            named(source_column).cast("string").alias("__source"),
            F.expr(f"cast(coalesce({tokens}, 0) as long)").alias("__tokens"),
            F.monotonically_increasing_id().alias("__row"),
        ),
        "mix",
        "zstd",
    )
    spark = docs.sparkSession
    light = rows.select("__row", "__source", "__tokens")
    totals = light.groupBy("__source").agg(F.sum("__tokens"), F.count("*")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    ordered = sorted(map(tuple, totals), key=lambda r: (r[0] is not None, r[0] or ""))
    shares = plan(ordered, max_repeats, target_entropy, budget)
    known = spark.createDataFrame(
        [(s.source, s.tokens, s.budget, max(1, -(-s.rows // block_rows)), budget is None) for s in shares],
        "__name string, __total long, __budget long, __blocks int, __whole boolean",
    )
    # epochs: whole ones, and one more that the rest of the budget begins
    used = F.expr("if(__total > 0, cast(ceil(__budget / __total) as int), if(__whole, 1, 0))")
    placed = (
        light.join(F.broadcast(known), F.col("__source").eqNullSafe(F.col("__name")))
        .withColumn("__block", F.pmod(F.xxhash64(F.lit(seed), "__row"), "__blocks").cast("int"))
        .where(used > 0)
        .withColumn("__epoch", F.explode(F.sequence(F.lit(0), used - 1)))
        .select("__row", "__name", "__tokens", "__block", "__epoch")
    )
    sums = placed.groupBy("__name", "__epoch", "__block").agg(F.sum("__tokens").alias("__sum"))
    earlier = Window.partitionBy("__name", "__epoch").orderBy(
        F.xxhash64(F.lit(seed + 1), "__epoch", "__block"), "__block"
    )
    starts = sums.withColumn("__start", F.sum("__sum").over(earlier) - F.col("__sum")).select(
        F.col("__name").alias("__n2"), F.col("__epoch").alias("__e2"), F.col("__block").alias("__b2"), "__start"
    )
    inside = Window.partitionBy("__name", "__epoch", "__block").orderBy(
        F.xxhash64(F.lit(seed + 2), "__epoch", "__row"), "__row"
    )
    running = F.sum("__tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    same = (
        F.col("__name").eqNullSafe(F.col("__n2"))
        & (F.col("__epoch") == F.col("__e2"))
        & (F.col("__block") == F.col("__b2"))
    )
    chosen = (
        placed.withColumn("__end", running)
        .join(starts, same)
        .join(F.broadcast(known.withColumnRenamed("__name", "__n3")), F.col("__name").eqNullSafe(F.col("__n3")))
        .withColumn("__end", F.expr("__epoch * __total + __start + __end"))
        .where("(__whole and __epoch = 0) or __end <= __budget")
        .select(
            "__row",
            F.col("__tokens").alias("mix_tokens"),
            F.col("__epoch").alias("mix_epoch"),
            F.col("__block").alias("mix_block"),
            F.expr("__end - __tokens").alias("mix_position"),
            F.expr("if(__budget > 0, (__end - __tokens) / __budget, 0D)").alias("mix_at"),
        )
    )
    return rows.drop("__source", "__tokens").join(chosen, "__row").select(*shown(columns), *added)


def op10_temperature_mixing(spark, sf_dir: str) -> DataFrame:
    """Whole documents are mixed and written; the columns are taken from the files."""
    mixed = materialise(mix(table(spark, sf_dir, "documents")), "mixture", "zstd")
    return mixed.select(
        "doc_id",
        "source",
        F.expr(WORDS).cast("long").alias("tokens"),
        F.col("mix_epoch").alias("epoch"),
        F.col("mix_block").alias("block"),
        F.col("mix_position").alias("position"),
        F.col("mix_at").alias("at"),
    )
