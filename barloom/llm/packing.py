"""Best-fit packing of token pieces by linear grouping.

Piece lengths are at most `size`, so the corpus is described by `size` counts. The whole plan is made from that
histogram on the driver, in runs (so many sequences alike): large lengths are rounded up within groups of equal
cardinality, configurations of those few sizes are optimised, actual lengths take their places, and best fit adds the
small ones. A run ends when a length or a configuration is used up, so the plan's size depends on `size` and `groups`
only, not on the corpus. Pieces then get their places by their rank among the pieces of their length.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .scratch import Scratch
from .tokens import Encoder, default_path

SIZE = 2048
#: Numbers of groups, and of places that are filled freely, that are tried; the plan of the fewest sequences is taken.
GROUPS = ((16, 2), (8, 2))
#: So many different large lengths, at most, are also tried without rounding.
FEW = 64
#: Part of the optimised configurations that is carried out before the rest is grouped and optimised anew.
SHARE = 0.2
#: Lengths below size / SMALL are small: best fit puts them last.
SMALL = 8
#: Pieces of one length are ranked in buckets of about so many, and buckets in runs of so many: a length that very many
#: pieces have is no hot group.
PER_BUCKET, PER_RUN = 256, 1024

_encoders: dict[str, Encoder] = {}


def pieces_column(text: str, path: str, size: int = SIZE, end_id: int = 0):
    """Column of array<struct<piece, start, length, ids_crc32>>: the ids and one end id, cut if longer than `size`.

    The first piece is the short one. A null text is empty: one piece that is the end id.
    """
    tail = np.array([end_id], "<u4").tobytes()

    def cut(column: pa.Array) -> pa.Array:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        counts, rows = [], []
        for ids in _encoders[path].encode(column):
            ids = ids.astype("<u4").tobytes() + tail
            n = len(ids) // 4
            first = n % size or size
            bounds = [0, *range(first, n + 1, size)]
            counts.append(len(bounds) - 1)
            rows += [(i, s, e - s, zlib.crc32(ids[4 * s : 4 * e])) for i, (s, e) in enumerate(zip(bounds, bounds[1:]))]
        cols = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        values = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, kinds)], names=[k for k, _ in kinds])
        return pa.ListArray.from_arrays(pa.array([0, *accumulate(counts)], pa.int32()), values)

    return arrow_udf(cut, "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>").asNondeterministic()(F.col(text))


def _grouped(stock: np.ndarray, groups: int) -> tuple[list[int], list[int]]:
    """(longest length, pieces) of about `groups` groups of equal cardinality, longest first; a length is never split."""
    total, seen, last = int(stock.sum()), 0, -1
    tops: list[int] = []
    demand: list[int] = []
    for s in np.flatnonzero(stock)[::-1].tolist():
        g = seen * groups // total
        if g != last:
            tops.append(s)
            demand.append(0)
            last = g
        demand[-1] += int(stock[s])
        seen += int(stock[s])
    return tops, demand


def _best_shape(sizes: np.ndarray, prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable sequence (counts by size): a knapsack by length."""
    value, last = np.zeros(room + 1), np.full(room + 1, -1)
    for at in range(1, room + 1):
        value[at] = value[at - 1]
        worth = np.where(sizes <= at, value[np.maximum(at - sizes, 0)] + prices, -1.0)
        g = int(worth.argmax())
        if worth[g] > value[at] + 1e-12:
            value[at], last[at] = worth[g], g
    counts, at = np.zeros(len(sizes)), room
    while at > 0:
        if last[at] < 0:
            at -= 1
        else:
            counts[last[at]] += 1
            at -= sizes[last[at]]
    return float(value[room]), counts


def _configurations(sizes: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[np.ndarray, float]]:
    """(counts by size, so many sequences) that hold the demand in the fewest sequences, fractions allowed.

    The linear programme by column generation: duals of the basis price the sizes, the knapsack finds the sequence
    that is worth most, and it enters the basis until none is worth more than itself. A basis has as many shapes
    as there are sizes, so the plan stays small at any demand.
    """
    m = len(sizes)
    basis, cost = np.diag((room // sizes).astype(float)), np.ones(m)
    amount = demand / np.diag(basis)
    for _ in range(40 * m):
        prices = np.linalg.solve(basis.T, cost)
        worst = int(prices.argmin())
        if prices[worst] < -1e-9:  # more of this size than demanded does no harm
            column, c = np.zeros(m), 0.0
            column[worst] = -1
        else:
            worth, column = _best_shape(sizes, np.maximum(prices, 0), room)
            c = 1.0
            if worth <= 1 + 1e-7:
                break
        move = np.linalg.solve(basis, column)
        steps = np.where(move > 1e-9, amount / np.where(move > 1e-9, move, 1), np.inf)
        k = int(steps.argmin())
        if not np.isfinite(steps[k]):
            break
        amount = np.maximum(amount - steps[k] * move, 0)
        amount[k], basis[:, k], cost[k] = steps[k], column, c
    return [(basis[:, k].astype(int), float(amount[k])) for k in range(m) if cost[k] == 1 and amount[k] > 1e-9]


def _substituted(stock: np.ndarray, shape: np.ndarray, tops: list[int], size: int, free: int) -> Counter | None:
    """Actual lengths for the places of a shape, taken from the stock; none if a group has run out.

    All but the `free` last places take the longest of their group. As these are shorter than what they were rounded up to,
    the last one takes the longest of all in stock that fits, or the last two the fullest pair, so that the sequence is
    full or nearly so. With no free place every one takes its own, as is right where groups are single lengths.
    """
    places = [g for g, c in enumerate(shape) for _ in range(c)]
    take: Counter = Counter()
    room, lows = size, [*tops[1:], 0]
    for g in places[: len(places) - free]:
        some = np.flatnonzero(stock[lows[g] + 1 : min(tops[g], room) + 1])
        if not len(some):
            break
        s = int(some[-1]) + lows[g] + 1
        take[s] += 1
        stock[s] -= 1
        room -= s
    else:
        if not free:
            return take
        lengths = np.flatnonzero(stock[: room + 1])
        if min(free, len(places)) == 1 and len(lengths):
            s = int(lengths[-1])
            take[s] += 1
            stock[s] -= 1
            return take
        if min(free, len(places)) == 2 and len(lengths):
            partner = np.searchsorted(lengths, room - lengths, "right") - 1
            itself = (partner >= 0) & (lengths[np.maximum(partner, 0)] == lengths) & (stock[lengths] < 2)
            partner = np.where(itself, partner - 1, partner)
            both = np.where(partner >= 0, lengths + lengths[np.maximum(partner, 0)], 0)
            if both.max() > 0:
                k = int(np.flatnonzero(both == both.max())[-1])
                for s in (int(lengths[k]), int(lengths[partner[k]])):
                    take[s] += 1
                    stock[s] -= 1
                return take
    for s, c in take.items():
        stock[s] += c
    return None


def _large_runs(stock: np.ndarray, size: int, groups: int, free: int) -> list[tuple[int, Counter]]:
    """Runs of sequences of large pieces by configurations; what is left stays in the stock (a few pieces for each group).

    Each round groups what is in stock, optimises the configurations and carries out a SHARE of each, at most: what
    substitution changes in the demand is then seen by the next round.
    """
    runs: list[tuple[int, Counter]] = []
    while stock.sum() > 2 * groups:
        exact = np.count_nonzero(stock) <= groups
        unit = 1 if exact else max(1, size // 256)
        tops, demand = _grouped(stock, groups) if not exact else (np.flatnonzero(stock)[::-1].tolist(), stock[stock > 0][::-1].tolist())
        sizes = np.array([-(-s // unit) for s in tops])
        shapes = _configurations(sizes, np.array(demand, float), size // unit)
        shapes.sort(key=lambda x: (-int((x[0] * sizes).sum()), x[0].tolist()))
        before = len(runs)
        for shape, amount in shapes:
            times = int(amount if exact else amount * SHARE) or int(amount > 0.99)
            while times and (take := _substituted(stock, shape, tops, size, 0 if exact else free)):
                often = 1 + min(times - 1, *(int(stock[s]) // c for s, c in take.items()))
                for s, c in take.items():
                    stock[s] -= c * (often - 1)
                runs.append((often, take))
                times -= often
        if len(runs) == before:
            break
    return runs


def plan(histogram: dict[int, int], size: int = SIZE, groups: tuple[tuple[int, int], ...] = GROUPS) -> list[tuple[int, Counter]]:
    """Counts by length -> runs (number of sequences, pieces by length in each of them); every piece is placed once.

    Of all that is tried the plan of the fewest sequences is taken; none can have fewer than the tokens fill. Where
    there are up to FEW large lengths, each may also be a group of its own.
    """
    least = -(-sum(s * n for s, n in histogram.items()) // size)
    kinds = sum(size // SMALL <= s < size and n > 0 for s, n in histogram.items())
    groups = ((kinds, 0), *groups) if 0 < kinds <= FEW else groups
    best = None
    for count, free in groups:
        runs, _ = grouped_plan(histogram, size, count, free)
        if best is None or sum(n for n, _ in runs) < sum(n for n, _ in best):
            best = runs
        if sum(n for n, _ in best) == least:
            break
    return best or []


def grouped_plan(histogram: dict[int, int], size: int, groups: int, free: int) -> tuple[list[tuple[int, Counter]], int]:
    """(runs, large pieces that no configuration placed) for one number of groups and of free places.

    Best fit then places what is left, longest first: the rest of the large pieces, and the small ones. Nothing that a
    configuration placed is moved.
    """
    stock = np.zeros(size + 1, np.int64)
    for s, n in histogram.items():
        if size // SMALL <= s < size:
            stock[s] = n
    runs: list[tuple[int, Counter]] = [(histogram[size], Counter({size: 1}))] if histogram.get(size) else []
    runs += _large_runs(stock, size, groups, free)
    rest = {int(s): int(stock[s]) for s in np.flatnonzero(stock)} | {s: n for s, n in histogram.items() if n and s < size // SMALL}
    for s, n in sorted(rest.items(), reverse=True):
        runs = _best_fit(runs, s, n, size)
    return runs, int(stock.sum())


def _room(run: tuple[int, Counter], size: int) -> int:
    return size - sum(s * c for s, c in run[1].items())


def _best_fit(runs: list[tuple[int, Counter]], s: int, n: int, size: int) -> list[tuple[int, Counter]]:
    """n pieces of length s, each to the sequence with the least room that holds it; new sequences when none does.

    The sequence just used has the least room that still fits, so each is filled before the next.
    """
    order = sorted(runs, key=lambda r: _room(r, size))
    out: list[tuple[int, Counter]] = []
    for times, held in order:
        each = _room((times, held), size) // s
        if not each or not n:
            out.append((times, held))
            continue
        whole = min(times, n // each)
        n -= whole * each
        if whole:
            out.append((whole, held + Counter({s: each})))
        if whole < times:
            if n:
                out.append((1, held + Counter({s: n})))
                whole, n = whole + 1, 0
            if whole < times:
                out.append((times - whole, held))
    if n:
        each = size // s
        if n // each:
            out.append((n // each, Counter({s: each})))
        if n % each:
            out.append((1, Counter({s: n % each})))
    return out


def _places(runs: list[tuple[int, Counter]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, pieces in each sequence, offset of the first of them)."""
    rank: Counter = Counter()
    out, sequence = [], 0
    for times, held in runs:
        at = 0
        for s in sorted(held, reverse=True):
            c = held[s]
            out.append((s, rank[s], rank[s] + times * c - 1, sequence, c, at))
            rank[s] += times * c
            at += c * s
        sequence += times
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, size: int = SIZE, groups: tuple[tuple[int, int], ...] = GROUPS, end_id: int = 0) -> DataFrame:
    """Documents -> (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row for each piece.

    Every token of every text has one place; no sequence is longer than `size`, and none has a gap. A null or empty
    text is one piece, the end id alone; a very long one is cut into pieces of `size`. Rows with equal or null ids,
    and repeated rows, are documents of their own; other columns are not read. No rows: no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = docs.select(F.col(id_col).alias("doc_id"), pieces_column(text_col, tokenizer or default_path(), size, end_id).alias("p"))
    pieces = scratch.table(cut.select("doc_id", F.inline("p")))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `size` rows
    places = _places(plan(histogram, size, groups))
    place = spark.createDataFrame(places, "long bigint, lo bigint, hi bigint, sequence bigint, each bigint, at bigint")
    buckets = spark.createDataFrame([(s, -(-n // PER_BUCKET)) for s, n in histogram.items()], "long bigint, buckets bigint")

    pieces = pieces.join(F.broadcast(buckets), F.col("length") == F.col("long")).drop("long")
    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("buckets"))
    pieces = pieces.withColumn("bucket", bucket).drop("buckets")
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    counts = scratch.table(counts.withColumn("run", F.floor(F.col("bucket") / PER_RUN)))
    runs = counts.groupBy("length", "run").agg(F.sum("n").alias("m"))
    runs = runs.select("length", "run", (F.sum("m").over(Window.partitionBy("length").orderBy("run")) - F.col("m")).alias("upto"))
    before = F.sum("n").over(Window.partitionBy("length", "run").orderBy("bucket")) - F.col("n")
    first = scratch.table(counts.withColumn("before", before).join(runs, ["length", "run"]).select("length", "bucket", (F.col("before") + F.col("upto")).alias("first")))
    row = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = pieces.withColumn("row", row).join(first, ["length", "bucket"]).withColumn("rank", F.col("first") + F.col("row"))
    nth = F.col("rank") - F.col("lo")
    return ranked.join(F.broadcast(place), (F.col("length") == F.col("long")) & F.col("rank").between(F.col("lo"), F.col("hi"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("bigint").alias("sequence_id"),
        (F.col("at") + (nth % F.col("each")) * F.col("length")).cast("bigint").alias("offset"),
    )
