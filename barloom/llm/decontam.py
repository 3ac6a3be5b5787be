"""Benchmark decontamination by winnowing: least k-gram hash of each window, joined with the benchmark's, then exact extension."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .bytesnp import LOWER, WORD, mixed, prefix_hash, slices, sliding_min, span_hash, text_column, word_bounds
from .scratch import Scratch, free_name, small_batches

#: Words of a window; any shared run of this many words is found.
WINDOW = 10
#: Words of a k-gram. WINDOW - GRAM + 1 k-grams make a window, and the least of their hashes is its fingerprint.
GRAM = 5
#: Windows of one broadcast index (about 300 bytes each, if words are of usual length); a larger benchmark is taken in blocks.
BLOCK_WINDOWS = 200_000
_WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n words in a row."""
    if len(h) < n:
        return h[:0]
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[j : j + len(out)]
    return mixed(out)


class Index:
    """Windows of some benchmark items: by exact words, and by fingerprint."""

    def __init__(self, items: list[tuple[str, str | None]]):
        self.windows: dict[bytes, set[str]] = defaultdict(set)
        prints, short = [], defaultdict(list)
        for item, text in items:
            data = LOWER[np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)]
            starts, ends, _ = word_bounds(data, np.array([0, len(data)]), WORD)
            words = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
            h = span_hash(prefix_hash(data), starts, ends)
            n = min(len(words), WINDOW)
            for i in range(len(words) - n + 1 if words else 0):
                self.windows[b" ".join(words[i : i + n])].add(item)
            if n == WINDOW:
                prints.append(sliding_min(_grams(h, GRAM), WINDOW - GRAM + 1))
            elif n:
                short[n].append(_grams(h, n))
        self.windows = dict(self.windows)
        self.prints = {WINDOW: np.unique(np.concatenate(prints))} if prints else {}
        self.prints |= {n: np.unique(np.concatenate(x)) for n, x in short.items()}

    def candidates(self, h: np.ndarray, n: int) -> np.ndarray:
        """Starts of the n-word windows whose fingerprint the benchmark has."""
        low = sliding_min(_grams(h, GRAM), WINDOW - GRAM + 1) if n == WINDOW else _grams(h, n)
        if not len(low):
            return np.zeros(0, np.int64)
        first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))  # a fingerprint mostly serves several windows
        known = self.prints[n]
        at = np.minimum(np.searchsorted(known, low[first]), len(known) - 1)
        hit = known[at] == low[first]
        return np.flatnonzero(np.repeat(hit, np.diff(np.append(first, len(low)))))


def _scan(index: Index, column: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]]]:
    """For each text: number of words, merged hit spans (in words) and the items that occur."""
    offsets, whole = text_column(column)
    n_words = np.zeros(len(column), np.int64)
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(column))]
    items: list[list[str]] = [[] for _ in range(len(column))]
    for lo, hi in slices(offsets):
        data = LOWER[whole[offsets[lo] : offsets[hi]]]
        starts, ends, doc = word_bounds(data, offsets[lo : hi + 1] - offsets[lo], WORD)
        if not len(starts):
            continue
        counts = np.bincount(doc, minlength=hi - lo)
        n_words[lo:hi] = counts
        first = np.concatenate([[0], np.cumsum(counts)])
        h = span_hash(prefix_hash(data), starts, ends)
        found: dict[int, set[str]] = defaultdict(set)
        cover = np.zeros(len(starts) + 1, np.int32)
        for n in index.prints:
            at = index.candidates(h, n)
            for i in at[doc[at] == doc[at + n - 1]]:
                text = data[starts[i] : ends[i + n - 1]].tobytes()
                key = b" ".join(data[s:e].tobytes() for s, e in zip(starts[i : i + n], ends[i : i + n], strict=True))
                if (got := index.windows.get(key)) is not None and text:
                    found[int(doc[i])] |= got
                    cover[i] += 1
                    cover[i + n] -= 1
        total = np.cumsum(cover)  # over the whole slice: a window's end may stand on the first word of the next text
        for d, got in found.items():
            items[lo + d] = sorted(got)
            hit = np.zeros(counts[d] + 2, bool)
            a, b = first[d], first[d + 1]
            hit[1:-1] = total[a:b] > 0
            edges = np.flatnonzero(hit[1:] != hit[:-1])
            spans[lo + d] = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
    return n_words, spans, items


_RESULT = "struct<n_words:bigint,spans:array<struct<lo:bigint,hi:bigint>>,items:array<string>>"


def _lists(rows: list[list], values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, rows))], pa.int32()), values)


def _hits(text: str, index):
    """Column of _RESULT for a text column; index: a broadcast Index."""

    def scan(column: pa.Array) -> pa.Array:
        n_words, spans, items = _scan(index.value, column)
        flat = [s for row in spans for s in row]
        lo, hi = (pa.array([s[k] for s in flat], pa.int64()) for k in (0, 1))
        return pa.StructArray.from_arrays(
            [
                pa.array(n_words),
                _lists(spans, pa.StructArray.from_arrays([lo, hi], names=["lo", "hi"])),
                _lists(items, pa.array([s for row in items for s in row], pa.string())),
            ],
            names=["n_words", "spans", "items"],
        )

    return arrow_udf(scan, _RESULT).asNondeterministic()(F.col(text))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[Index]:
    """Indexes over the benchmark, one block at a time; an item is never split."""
    block, size = [], 0
    for item, text in benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        if item is None:
            continue
        n = max(1, len(_WORDS.findall((text or "").encode("utf-8", "replace"))))
        if block and size + n > limit:
            yield Index(block)
            block, size = [], 0
        block.append((item, text))
        size += n
    yield Index(block)


def _n_hit(spans):
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, s: a + s["hi"] - s["lo"])


def _union(spans):
    """Merged spans: sorted, then each either widens the last one or begins another."""
    empty = spans[0:0] if isinstance(spans, list) else F.slice(spans, 1, 0)
    last = lambda a: F.element_at(a, -1)
    return F.aggregate(
        F.array_sort(spans),
        empty,
        lambda a, s: F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["hi"] >= s["lo"]), F.concat(
            F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))),
            F.array(F.struct(last(a)["lo"].alias("lo"), F.greatest(last(a)["hi"], s["hi"]).alias("hi"))),
        )).otherwise(F.concat(a, F.array(s))),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """Documents -> (doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans, items), a row for each row.

    hit_spans: [lo, hi) in words, merged and in order. A null or empty text has no words and no hits; a very long one is
    read whole. Rows that repeat, or have equal or null ids, have results each. Items with a null id or without words
    occur nowhere; items that repeat an id count as one. An empty benchmark hits nothing. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    blocks = _blocks(benchmark, item_col, item_text_col, block_windows)
    index, more = next(blocks), next(blocks, None)
    found = base.select("doc_id", _hits("body", spark.sparkContext.broadcast(index)).alias("r"))
    if more is None:
        found = found.select("doc_id", "r.n_words", F.col("r.spans").alias("hit_spans"), "r.items")
    else:  # beyond one block: a pass for each, and the hits of a row meet again by its number
        scratch = Scratch(spark, "decontam")
        base = scratch.table(base.withColumn("row", F.monotonically_increasing_id()))
        passes = [index, more]
        hits = None
        while passes:
            part = base.select("row", _hits("body", spark.sparkContext.broadcast(passes.pop(0))).alias("r"))
            part = scratch.table(part.select("row", "r.*").where("size(spans) > 0 or n_words > 0"))
            hits = part if hits is None else hits.union(part)
            if not passes and (more := next(blocks, None)) is not None:
                passes.append(more)
        merged = hits.groupBy("row").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
        )
        none = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
        found = base.select("row", "doc_id").join(merged, "row", "left").select(
            "doc_id",
            F.coalesce("n_words", F.lit(0)).alias("n_words"),
            F.coalesce(_union(F.col("spans")), none).alias("hit_spans"),
            F.array_sort(F.coalesce("items", F.array().cast("array<string>"))).alias("items"),
        )
    n_hit = _n_hit(F.col("hit_spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "hit_spans",
        "items",
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """docs without the rows that hold a benchmark window. Columns and rows as given; no rows: no rows."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    scratch, out, n, name = Scratch(spark, "decontam"), docs, 0, free_name(docs, "hits")
    for index in _blocks(benchmark, item_col, item_text_col, block_windows):
        out, n = scratch.table(out) if n else out, n + 1  # one index at a time in a worker
        hits = _hits(text_col, spark.sparkContext.broadcast(index))
        out = out.withColumn(name, hits).where(F.size(f"{name}.spans") == 0).drop(name)
    return out
