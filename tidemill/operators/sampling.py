"""Sampling that depends on the row's key only: the same rows on every run, in any
partitioning, whichever executor reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.plans.ordered import OrderedKeys
from tidemill.session import materialize

SPACE = 16**8
DIGITS, STEP = 32, 4  # of a digest; digits that one count looks at
AT_ONCE = 100_000
RANK, PLACE, DRAW = "_rank", "_place", "draw"


def hash_rank(keys: list[str], seed: int) -> Column:
    """Hex digest of the seed and the key columns, uniform in its first digits."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *keys))


def cut_point(share: float) -> str:
    """The text below which a ``share`` of all digests lies: an 8-digit hex prefix, or a letter
    after all hex digits for the whole."""
    point = round(share * SPACE)
    return format(point, "08x") if point < SPACE else "g"


def hash_fraction(df: DataFrame, keys: list[str], fraction: float, seed: int = 0) -> DataFrame:
    return df.filter(hash_rank(keys, seed) < F.lit(cut_point(fraction)))


def hash_take(
    df: DataFrame, keys: list[str], n: int, seed: int = 0, at_once: int = AT_ONCE
) -> DataFrame:
    """Exactly ``n`` rows (all rows if there are fewer), without replacement: those with the
    smallest digests, the same in any partitioning.

    Up to ``at_once`` rows are a heap per task. More are cut off by the digest: rows are counted
    by its first four digits, the cell in which the n-th row lies by the next four, and on,
    until that cell is small enough or all digits are used; only its rows are ordered.
    """
    rank = hash_rank(keys, seed)
    if n <= at_once:
        return df.orderBy(rank, *keys).limit(n)
    prefix, left = "", n
    while len(prefix) < DIGITS:
        cell = F.substring(rank, len(prefix) + 1, STEP)
        here = df.filter(rank.startswith(prefix)) if prefix else df
        counts = {r[0]: r[1] for r in here.groupBy(cell).agg(F.count(F.lit(1))).collect()}  # 16 ** STEP rows
        if not prefix and sum(counts.values()) <= n:
            return df
        for value in sorted(counts):
            if counts[value] > left:
                prefix += value
                break
            left -= counts[value]
        else:
            break  # the cells before this one are just enough
        if counts[value] <= at_once or not left:
            break
    inside = F.substring(rank, 1, len(prefix))
    below = df.filter(inside < prefix)
    if not left:
        return below
    edge = df.filter(inside == prefix).withColumn(RANK, rank)
    placed = OrderedKeys(edge, [], [RANK, *keys], at_once).position(PLACE)
    return below.union(placed.filter(F.col(PLACE) <= left).select(*df.columns))


def hash_draws(df: DataFrame, keys: list[str], n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` draws with replacement: draw i takes the row whose place in the order of
    ``keys`` is a hash of the seed and i. Adds the number of the draw. No row of an empty frame."""
    indexed = materialize(OrderedKeys(df, [], keys).position(PLACE), "indexed")
    total = indexed.count()
    draws = df.sparkSession.range(n if total else 0).withColumnRenamed("id", DRAW)
    digest = F.substring(hash_rank([DRAW], seed), 1, 15)
    wanted = draws.withColumn(PLACE, F.conv(digest, 16, 10).cast("bigint") % F.lit(max(total, 1)) + 1)
    return wanted.join(indexed, PLACE).drop(PLACE)


def hash_split(
    df: DataFrame, keys: list[str], weights: list[float], seed: int = 0, name: str = "part"
) -> DataFrame:
    """Adds the number of the split; ``weights`` are normalised."""
    total = sum(weights)
    reached, chain = 0.0, None
    for number, weight in enumerate(weights[:-1]):
        reached += weight / total
        test = hash_rank(keys, seed) < F.lit(cut_point(reached))
        chain = F.when(test, number) if chain is None else chain.when(test, number)
    last = F.lit(len(weights) - 1)
    return df.withColumn(name, last if chain is None else chain.otherwise(last))
