"""Mixing sources to target weights with balanced samples, by the cube method.

A source whose target is r times its size gives every document floor(r) times, and once more with probability r - floor(r).
The flight phase moves these fractional probabilities along the null space of two constraints, documents and tokens, until
they are 0 or 1; it never changes either total. It runs in chunks of one source's documents. The few documents that a chunk
leaves fractional meet in new chunks of their source, until one chunk a source is left: the landing problem.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import NO_ID, WORD, durable, numbered, told_apart

EDGE = 1e-9


def water_fill(sizes: Sequence[float], weights: Sequence[float], most: float) -> list[float]:
    """Share the sum of sizes by weights; a share stops at most times its size, and the others share the excess.

    A share is reached by a level: weight * level, or most * size where that is less. Shares stop in the order of size over
    weight, so one pass in that order finds the level.
    """
    out = [0.0] * len(sizes)
    left, open_weight = float(sum(sizes)), float(sum(weights))
    order = sorted(range(len(sizes)), key=lambda i: sizes[i] / weights[i])
    for n, i in enumerate(order):
        if left / open_weight * weights[i] <= most * sizes[i]:
            for k in order[n:]:
                out[k] = left / open_weight * weights[k]
            break
        out[i] = most * sizes[i]
        left, open_weight = left - out[i], open_weight - weights[i]
    return out


def flight(chances: np.ndarray, sizes: np.ndarray, seed: Sequence[int] = (1,)) -> np.ndarray:
    """Chances moved to 0 or 1, all but two at most, with sum(chances) and sum(chances * sizes) kept.

    Three open documents at a time: the null space of their two constraints is one line, along which a step to either side
    closes one of them; which side is drawn so that every chance keeps its expectation. Equal seeds give equal draws.
    """
    rng = np.random.default_rng([*seed])
    draws = rng.random(2 * len(chances) + 4).tolist()
    p, s = chances.tolist(), sizes.tolist()
    active: list[int] = []
    at = step = 0
    while True:
        while len(active) < 3 and at < len(p):
            if EDGE < p[at] < 1 - EDGE:
                active.append(at)
            at += 1
        if len(active) < 3:
            break
        i, j, k = active
        u = (float(s[k] - s[j]), float(s[i] - s[k]), float(s[j] - s[i]))
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for x, d in ((p[i], u[0]), (p[j], u[1]), (p[k], u[2])):
            if d > 0:
                up, down = min(up, (1 - x) / d), min(down, x / d)
            elif d < 0:
                up, down = min(up, x / -d), min(down, (1 - x) / -d)
        move = up if draws[step % len(draws)] * (up + down) < down else -down
        step += 1
        for n, d in zip(active, u, strict=True):
            p[n] += move * d
            p[n] = 0.0 if p[n] < EDGE else 1.0 if p[n] > 1 - EDGE else p[n]
        active = [n for n in active if 0 < p[n] < 1]
    return np.array(p)


def land(chances: np.ndarray, sizes: np.ndarray, seed: Sequence[int] = (1,), held: int = 10) -> np.ndarray:
    """The landing problem of a source: the flight of all but its held smallest documents, then a search over what is open.

    Of all ways to close these and the one or two that the flight left, it takes the one with the least error in tokens, a
    document too many or too few counting as a twentieth of a mean one. sizes must fall.
    """
    out = chances.copy()
    open_ = np.flatnonzero((chances > EDGE) & (chances < 1 - EDGE))
    flown = open_[: max(0, len(open_) - held)]
    out[flown] = flight(chances[flown], sizes[flown], seed)
    open_ = np.flatnonzero((out > EDGE) & (out < 1 - EDGE))
    ways = np.arange(2 ** len(open_))[:, None] >> np.arange(len(open_)) & 1
    tokens, rows = np.abs((ways - out[open_]) @ sizes[open_].astype(float)), np.abs((ways - out[open_]).sum(axis=1))
    best = np.argmin(tokens + 0.05 * (sizes.mean() if len(sizes) else 0) * rows)
    out[open_] = ways[best]
    return np.round(out)


#: Sources that a mix may have, at most: one row for each is on the driver and is broadcast.
SOURCES = 100_000


def mix_sources(docs: DataFrame, size: Column | None = None, source: str = "source", key: str = "doc_id", weights: Sequence[float] = (5, 2, 1), most: float = 3.0, chunk: int = 1000, seed: int = 1, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of docs: key, source, size, source_size, target, chance, copies, taken, and the columns in carry.

    Sources by code point, null (a source of its own) last, have the weights in turn; targets share the sum of all sizes
    (water_fill). size is by default the number of words of a column text (null: 0). copies is how often the mix takes the
    document, taken is copies * size. Chunks and draws hang on what a row holds (key, source, size, column text if there is one,
    and what is carried) and, among rows equal in all of these, on a number; so reruns agree, however the files are split,
    null, repeated and equal keys are rows like others, and a chunk holds about `chunk` rows whatever they are. An empty
    table gives an empty result. Other columns are not read; of those in carry, one that is called like a column of the
    result's own gives way to it. One row a source comes to the driver: sources are what a mix is configured by, and more
    than SOURCES of them raise an error.
    """
    own = (key, source, "size", "source_size", "target", "chance", "copies", "taken")
    carry = tuple(c for c in carry if c not in own)
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)) if size is None else size
    held = [f"c{i}" for i in range(len(carry))]
    content = F.xxhash64(F.col("`text`") if "text" in docs.columns else F.lit(0))
    whole = told_apart(docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID)).alias("id"), F.col(f"`{source}`").alias("source"), size.cast("long").alias("size"), content.alias("content"), *[F.col(f"`{c}`").alias(h) for c, h in zip(carry, held, strict=True)]), "row")
    hashed = [h for h in held if not isinstance(whole.schema[h].dataType, T.MapType)]
    thin = numbered(whole.select("id", "source", "size", "content", "row", *hashed), "row", ["id", "source", "size", "content", *hashed])
    thin = durable(thin.select("id", "source", "size", "row", "mark", "nth"))  # it is read several times, and what is carried may be large
    totals = thin.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).limit(SOURCES + 1).collect()
    if len(totals) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources: group them first")
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    targets = water_fill([r["size"] for r in totals], [weights[i % len(weights)] for i in range(len(totals))], most)
    plan = [(r["source"], i, int(r["size"]), t, int(r["rows"])) for i, (r, t) in enumerate(zip(totals, targets, strict=True))]
    known = docs.sparkSession.createDataFrame(plan, "source string, which int, source_size long, target double, rows long")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    part = rate - F.floor(rate)
    aside = thin.withColumnRenamed("source", "_source")
    told = aside.join(F.broadcast(known), F.col("_source").eqNullSafe(F.col("source")))
    told = told.select(
        "id", "row", "mark", "nth", "source", "size", "which", "source_size", "target", "rows", F.floor(rate + EDGE).cast("int").alias("whole"),
        F.when((part < EDGE) | (part > 1 - EDGE), 0.0).otherwise(part).alias("chance"),
    ).withColumn("open", F.col("chance"))
    done = [told.where("open = 0")]
    rest = told.where("open > 0")
    groups = max([r[4] for r in plan], default=0)
    turn = 0
    while True:
        last = groups <= chunk
        mixed = rest.withColumn("chunk", F.pmod(F.xxhash64("mark", "nth", F.lit(seed + turn)), F.greatest(F.lit(1), F.ceil(F.col("rows") / F.lit(chunk)))).cast("long"))
        moved = mixed.groupBy("which", "chunk").applyInPandas(_fly(chunk, seed, turn), mixed.schema).drop("chunk")
        moved = durable(moved)
        settled = (F.col("open") == 0) | (F.col("open") == 1)
        done.append(moved.where(settled))
        if last:
            break
        rest = moved.where(~settled)
        groups, turn = -(-groups // chunk) * 2, turn + 1
        rest = rest.withColumn("rows", F.when(F.col("rows") <= chunk, F.col("rows")).otherwise(F.ceil(F.col("rows") / F.lit(chunk)) * 2))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    copies = (F.col("whole") + F.col("open").cast("int")).alias("copies")
    out = out.select("row", F.nullif(F.col("id"), F.lit(NO_ID)).alias("id"), "source", "size", "source_size", "target", "chance", copies).withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
    if carry:  # by the number of the row: one row a side, whatever the keys are
        out = out.join(whole.select("row", *held), "row")
    return out.select(*[F.col(c).alias(n) for c, n in zip(("id", "source", "size", "source_size", "target", "chance", "copies", "taken", *held), (*own, *carry), strict=True)])


def _fly(chunk: int, seed: int, turn: int):
    """A chunk's flight; a source with no more rows than one chunk lands at once, as it has this one chunk only."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "id", "mark", "nth"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        close = land if rows["rows"].iloc[0] <= chunk else flight
        draws = (seed, turn, int(rows["which"].iloc[0]), int(rows["chunk"].iloc[0]))
        rows["open"] = close(rows["open"].to_numpy(float), rows["size"].to_numpy(), draws)
        return rows

    return run
