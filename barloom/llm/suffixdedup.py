"""Exact substring dedup: hash-compared suffix sort around content-chosen anchors.

Every window of WINDOW bytes has an anchor, the place of its least GRAM-byte hash, so equal windows have equal
anchors at the same place in them. Only the suffixes at anchors that share a hash with another are sorted, forwards
and, reversed, backwards: a mergesort whose comparisons find the common extension by binary search over prefix
polynomial hashes. An anchor's best extensions to both sides give the repeated bytes around it; they are verified
byte by byte. Anchors with equal surroundings are one class from the start, so a text of many copies is sorted once:
they are told by a cryptographic digest (BLAKE2b, 128 bits) of the surrounding bytes, which two different strings
don't share even if someone tries, so that no polynomial hash is trusted unverified. Rows have 128 bits of identity.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .bytesnp import mixed, prefix_hash, powers, slices, sliding_min, span_hash, text_column
from .scratch import Scratch, with_ids, without_ids

WINDOW = 200
GRAM = 32
#: Classes of one anchor hash that are sorted in one task; of more, the windows themselves are counted.
LARGE = 20_000
#: Classes that are sorted at once; a larger group of one hash is taken whole.
AT_ONCE = 4096
#: Neighbours in the order that are looked at one by one; what is open after them is settled by counting windows.
STEPS = 64
#: Rows of which numpy holds intermediate results at once.
_ROWS = 4096
_PLACE = 24
#: A text of over twice as many bytes is read in parts.
_SEGMENT = 1 << 20


def _anchors(data: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of all windows inside the texts; of equal hashes the first counts."""
    h = prefix_hash(data)
    n = len(data)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n - gram + 1)
    hashes = span_hash(h, at, at + gram)
    key = (hashes >> np.uint64(_PLACE) << np.uint64(_PLACE)) | at.astype(np.uint64)
    least = sliding_min(key, window - gram + 1)
    inside = np.zeros(len(least) + 1, np.int32)
    for s, e in zip(bounds[:-1], bounds[1:], strict=True):
        if e - s >= window:
            inside[s] += 1
            inside[e - window + 1] -= 1
    least = least[np.cumsum(inside[:-1]) > 0]
    place = (least & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    place = place[np.concatenate([[True], place[1:] != place[:-1]])] if len(place) else place
    return place, hashes[place]


def _scan(window: int, gram: int):
    """Texts -> a row for each anchor: hash, digest of its surroundings, text, and (place, bytes to the left, to the right) packed."""
    reach = window - gram

    def rows(data: np.ndarray, bounds: np.ndarray):
        place, hashes = _anchors(data, bounds, window, gram)
        doc = np.searchsorted(bounds, place, "right") - 1
        return place, hashes, doc

    def run(batches):
        for batch in batches:
            offsets, whole = text_column(batch["text"])
            for lo, hi in slices(offsets, 1 << 18):
                data, bounds = whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                if len(data) > 2 * _SEGMENT:  # one very long text, in overlapping parts
                    parts = [rows(data[s : s + _SEGMENT + window - 1], np.array([0, min(_SEGMENT + window - 1, len(data) - s)])) for s in range(0, len(data), _SEGMENT)]
                    place = np.concatenate([p[0] + k * _SEGMENT for k, p in enumerate(parts)])
                    place, first = np.unique(place, return_index=True)
                    hashes, doc = np.concatenate([p[1] for p in parts])[first], np.zeros(len(place), np.int64)
                else:
                    place, hashes, doc = rows(data, bounds)
                if not len(place):
                    continue
                left = np.maximum(bounds[doc], place - reach)
                right = np.minimum(bounds[doc + 1], place + window)
                raw, digest = memoryview(data), hashlib.blake2b
                around = b"".join([digest(raw[s:e], digest_size=16).digest() for s, e in zip(left.tolist(), right.tolist(), strict=True)])
                around = np.frombuffer(around, "<i8").reshape(-1, 2)
                # Equal bytes with the anchor at another place in them are another class.
                at = ((place - left) << 10) | (right - place)
                packed = ((place - bounds[doc]) << 20) | at
                ids = pa.array(lo + doc)
                yield pa.record_batch(
                    {"h": hashes.view(np.int64), "c1": around[:, 0] ^ at, "c2": around[:, 1].copy(), "r1": batch["r1"].take(ids), "r2": batch["r2"].take(ids), "packed": packed}
                )

    return run


class Rows:
    """Byte strings of up to `width` bytes as a matrix with prefix polynomial hashes: common prefixes by binary search."""

    def __init__(self, strings: list[bytes], width: int):
        self.length = np.array([len(s) for s in strings], np.int64)
        self.bytes = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)
        self.hash = np.zeros((len(strings), width + 1), np.uint64)
        for a in range(0, len(strings), _ROWS):
            some = slice(a, a + _ROWS)
            np.cumsum((self.bytes[some].astype(np.uint64) + np.uint64(1)) * powers(width)[0][:width], axis=1, out=self.hash[some, 1:])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes: the longest that hash alike."""
        lo, hi = np.zeros(len(i), np.int64), np.minimum(self.length[i], self.length[j])
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            same = self.hash[i, mid] == self.hash[j, mid]
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether row i sorts before row j; a prefix sorts first."""
        n = self.common(i, j)
        last = self.bytes.shape[1] - 1
        a, b = self.bytes[i, np.minimum(n, last)], self.bytes[j, np.minimum(n, last)]
        ends = (n == self.length[i]) | (n == self.length[j])
        return np.where(ends, self.length[i] < self.length[j], a < b)

    def order(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Rows in order within each group [start, start + size): a mergesort of all groups in step.

        At each level an element's new place is its place in its own run and the number of elements of the other
        run before it, which a binary search with `before` counts.
        """
        order = np.arange(len(self.length))
        group = np.repeat(np.arange(len(start)), size)
        first, total = start[group], size[group]
        offset = np.arange(len(order)) - first
        width = 1
        while width < (size.max() if len(size) else 0):
            base = offset // (2 * width) * 2 * width
            is_left = offset - base < width
            lo = first + np.where(is_left, np.minimum(base + width, total), base)
            hi = first + np.where(is_left, np.minimum(base + 2 * width, total), np.minimum(base + width, total))
            begin = lo.copy()
            active = np.flatnonzero(lo < hi)
            while len(active):
                mid = (lo[active] + hi[active]) >> 1
                mine, other = order[active], order[mid]
                # Of equal elements the left run's come first.
                ahead = np.where(is_left[active], self.before(other, mine), ~self.before(mine, other))
                lo[active] = np.where(ahead, mid + 1, lo[active])
                hi[active] = np.where(ahead, hi[active], mid)
                active = active[lo[active] < hi[active]]
            own = np.where(is_left, offset - base, offset - base - width)
            place = first + base + own + (lo - begin)
            after = np.empty_like(order)
            after[place] = order
            order = after
            width *= 2
        return order


def _walk(by: Rows, other: Rows, order: np.ndarray, group: np.ndarray, open_: np.ndarray, most: np.ndarray, window: int, steps: int):
    """For the open rows the longest extension in `by` among partners whose extensions together reach the window.

    From a row's place in the order its common prefix with the rows above, and below, only shrinks; the first partner
    that qualifies on a side is that side's best. most: the longest extension in `other` to any row.
    Returns (best, partner, rows that are still undecided).
    """
    n = len(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    adjacent = np.zeros(n + 1, np.int64)
    same = np.flatnonzero(group[order[1:]] == group[order[:-1]]) + 1
    adjacent[same] = by.common(order[same - 1], order[same])
    best, partner = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    undecided = np.zeros(n, bool)
    for side in (-1, 1):
        rows = np.flatnonzero(open_)
        reach = np.full(len(rows), 1 << 30)
        for step in range(1, steps + 2):
            at = place[rows] + side * step
            edge = np.clip(at + 1 if side < 0 else at, 0, n)
            reach = np.minimum(reach, np.where((at >= 0) & (at < n), adjacent[edge], 0))
            go = (reach > best[rows]) & (reach + most[rows] >= window)
            rows, reach, at = rows[go], reach[go], at[go]
            if not len(rows):
                break
            if step > steps:
                undecided[rows] = True
                break
            v = order[at]
            good = reach + other.common(rows, v) >= window
            best[rows[good]], partner[rows[good]] = reach[good], v[good]
            rows, reach = rows[~good], reach[~good]
    return best, partner, undecided


def _nearest(by: Rows, order: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each row its longest common prefix with any row of its group: that with a neighbour in the order."""
    out = np.zeros(len(order), np.int64)
    same = np.flatnonzero(group[order[1:]] == group[order[:-1]]) + 1
    n = by.common(order[same - 1], order[same])
    np.maximum.at(out, order[same - 1], n)
    np.maximum.at(out, order[same], n)
    return out


def _repeated_windows(left: Rows, right: Rows, rows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the rows (most bytes to the left, to the right) that its repeated windows reach, by comparing whole windows.

    Windows with the anchor at one place are looked at together, so that only one of each row is held. Hashes tell
    which can't be equal; the bytes decide.
    """
    most, least = np.full(len(rows), -1), np.full(len(rows), -1)
    for x in range(min(left.bytes.shape[1], window) + 1):
        at = np.flatnonzero((left.length[rows] >= x) & (right.length[rows] >= window - x))
        if len(at) < 2:
            continue
        _, of, k = np.unique(mixed(left.hash[rows[at], x]) + right.hash[rows[at], window - x], return_inverse=True, return_counts=True)
        at = at[k[of] > 1]
        if not len(at):
            continue
        whole = np.concatenate([left.bytes[rows[at], :x], right.bytes[rows[at], : window - x]], axis=1)
        _, of, k = np.unique(whole.view(f"S{window}").ravel(), return_inverse=True, return_counts=True)
        at = at[k[of] > 1]
        most[at] = x
        least[at] = np.where(least[at] < 0, x, least[at])
    return np.maximum(most, 0), np.where(least < 0, 0, window - least)


def _count_windows(lefts: list[bytes], rights: list[bytes], window: int) -> list[tuple[int, int]]:
    """`_repeated_windows` of anchors given as to `extensions`, all of one group."""
    left, right = (Rows(x, max(1, max(map(len, x), default=1))) for x in (lefts, rights))
    return list(zip(*(x.tolist() for x in _repeated_windows(left, right, np.arange(len(lefts)), window)), strict=True))


def extensions(lefts: list[bytes], rights: list[bytes], size: np.ndarray, single: np.ndarray, window: int = WINDOW, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(left, right) bytes of repeated windows around each `single` anchor; 0, 0 where none of its windows is repeated.

    lefts: the bytes before an anchor, last first; rights: those from it on; size: anchors of each group, in turn.
    """
    start = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
    group = np.repeat(np.arange(len(size)), size)
    left, right = (Rows(x, max(1, max(map(len, x), default=1))) for x in (lefts, rights))
    by_left, by_right = left.order(start, size), right.order(start, size)
    most_left, most_right = _nearest(left, by_left, group), _nearest(right, by_right, group)
    open_ = single & (most_left + most_right >= window)
    best_left, pl, u1 = _walk(left, right, by_left, group, open_, most_right, window, steps)
    best_right, pr, u2 = _walk(right, left, by_right, group, open_, most_left, window, steps)
    # Verification: the bytes that the hashes found equal are compared.
    wrong = (u1 | u2) & open_
    for rows, partner, length in ((left, pl, best_left), (right, pr, best_right)):
        for a in range(0, len(partner), _ROWS):
            k = np.arange(a, min(a + _ROWS, len(partner)))
            k = k[partner[k] >= 0]
            within = np.arange(rows.bytes.shape[1]) < length[k, None]
            wrong[k] |= ((rows.bytes[k] != rows.bytes[partner[k]]) & within).any(1)
    out_left, out_right = np.where(open_, best_left, 0), np.where(open_, best_right, 0)
    for g in np.unique(group[wrong]):
        rows = np.arange(start[g], start[g] + size[g])
        a, b = _repeated_windows(left, right, rows, window)
        out_left[rows], out_right[rows] = np.where(open_[rows], a, 0), np.where(open_[rows], b, 0)
    none = (out_left == 0) & (out_right == 0)
    return np.where(none, 0, out_left), np.where(none, 0, out_right)


def _sort(window: int):
    """Contexts ordered by anchor hash -> (h, c1, c2, left, right) of the classes of one anchor that repeat something."""

    def settle(held: dict[str, list]):
        h = np.array(held["h"])
        cut = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        size = np.diff(np.append(cut, len(h)))
        lefts = [c[:k][::-1] for c, k in zip(held["around"], held["ll"], strict=True)]
        rights = [c[k:] for c, k in zip(held["around"], held["ll"], strict=True)]
        left, right = extensions(lefts, rights, size, np.array(held["n"]) == 1, window)
        hit = np.flatnonzero(left + right > 0)
        return pa.record_batch({"h": h[hit], "c1": np.array(held["c1"])[hit], "c2": np.array(held["c2"])[hit], "left": left[hit].astype(np.int64), "right": right[hit].astype(np.int64)})

    def run(batches):
        held: dict[str, list] = {k: [] for k in ("h", "c1", "c2", "n", "ll", "around")}
        for batch in batches:
            for lo in range(0, batch.num_rows, AT_ONCE // 2):
                part = batch.slice(lo, AT_ONCE // 2)
                for k in held:
                    held[k] += part[k].to_pylist()
                if len(held["h"]) >= AT_ONCE:  # all but the last group, which may go on
                    cut = next((k for k in range(len(held["h"]) - 1, 0, -1) if held["h"][k] != held["h"][k - 1]), 0)
                    if cut:
                        yield settle({k: v[:cut] for k, v in held.items()})
                        held = {k: v[cut:] for k, v in held.items()}
        if held["h"]:
            yield settle(held)

    return run


def _cut_contexts(batches):
    """Texts with the anchors wanted in them -> the bytes around each."""
    made = lambda out: pa.record_batch({k: pa.array(v, pa.binary() if k == "around" else pa.int64()) for k, v in out.items()})
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("h", "c1", "c2", "n", "ll", "around")}
        for text, wanted in zip(batch["text"], batch["wanted"], strict=True):
            raw, anchors = text.as_buffer(), wanted.values
            for lo in range(0, len(anchors), AT_ONCE):
                some = anchors.slice(lo, AT_ONCE)
                for k in ("h", "c1", "c2", "n"):
                    out[k] += some.field(k).to_pylist()
                for packed in some.field("packed").to_pylist():
                    place, ll, rl = packed >> 20, (packed >> 10) & 1023, packed & 1023
                    out["ll"].append(ll)
                    out["around"].append(raw.slice(place - ll, ll + rl).to_pybytes())
                if len(out["h"]) >= AT_ONCE:
                    yield made(out)
                    out = {k: [] for k in out}
        yield made(out)


def _windows(window: int):
    """The hashes of all windows around an anchor, with the place of the anchor in them."""

    def run(batches):
        for batch in batches:
            for h, c1, c2, ll, around in zip(*(batch[k].to_pylist() for k in ("h", "c1", "c2", "ll", "around")), strict=True):
                data = np.frombuffer(around, np.uint8)
                s = np.arange(0, min(ll, len(data) - window) + 1)
                w = span_hash(prefix_hash(data), s, s + window).view(np.int64)
                same = {k: np.full(len(s), v) for k, v in (("h", h), ("c1", c1), ("c2", c2))}
                yield pa.record_batch(same | {"x": (ll - s).astype(np.int64), "w": w})

    return run


def _cut_out(text: pa.Array, spans: pa.Array) -> pa.Array:
    """(n_removed, n_spans, kept_sha256) of texts without the union of their spans."""
    rows = []
    for t, some in zip(text, spans, strict=True):
        raw = (t.as_py() or "").encode("utf-8")
        merged: list[list[int]] = []
        for s, e in sorted((x["s"], x["e"]) for x in some.as_py()):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        kept, last = hashlib.sha256(), 0
        for s, e in merged:
            kept.update(raw[last:s])
            last = e
        kept.update(raw[last:])
        rows.append((sum(e - s for s, e in merged), len(merged), kept.hexdigest()))
    cols = list(zip(*rows)) or [[], [], []]
    return pa.StructArray.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["n_removed", "n_spans", "kept_sha256"])


_CLASS = ["h", "c1", "c2"]
_ROW = ["r1", "r2"]


def repeated_spans(docs: DataFrame, scratch: Scratch, window: int = WINDOW, gram: int = GRAM, large: int = LARGE) -> DataFrame:
    """(r1, r2, text) -> (r1, r2, spans): the byte spans [s, e) of repeated windows, not merged; texts without any are left out."""
    anchors = scratch.table(docs.mapInArrow(_scan(window, gram), "h long, c1 long, c2 long, r1 long, r2 long, packed long"))
    # Written, so that the join below exchanges both sides and adaptive execution can split a hash that very many anchors have.
    shared = scratch.table(anchors.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    met = scratch.table(anchors.join(shared, "h"))
    scratch.drop(anchors)
    classes = met.groupBy(*_CLASS).agg(F.count("*").alias("n"), F.min(F.struct(*_ROW, "packed")).alias("one"))
    classes = scratch.table(classes.select(*_CLASS, "n", "one.*"))
    sizes = classes.groupBy("h").agg(F.count("*").alias("classes"), F.min("n").alias("least")).where("classes > 1 and least = 1")
    compared = scratch.table(classes.join(scratch.table(sizes.drop("least")), "h"))

    wanted = compared.groupBy(*_ROW).agg(F.collect_list(F.struct(*_CLASS, "n", "packed")).alias("wanted"))
    texts = with_ids(docs, _ROW, scratch.table(compared.select(*_ROW).distinct()), _ROW).dropDuplicates(_ROW)
    contexts = texts.join(wanted, _ROW).select("text", "wanted")
    contexts = contexts.mapInArrow(_cut_contexts, "h long, c1 long, c2 long, n long, ll long, around binary")
    sort = lambda rows: rows.repartition("h").sortWithinPartitions("h").mapInArrow(_sort(window), "h long, c1 long, c2 long, left long, right long")
    big = compared.where(F.col("classes") > large).select("h").distinct()
    if big.isEmpty():
        found = sort(contexts)
    else:
        contexts, big = scratch.table(contexts), scratch.table(big)
        every = scratch.table(contexts.join(big, "h", "left_semi").mapInArrow(_windows(window), "h long, c1 long, c2 long, x long, w long"))
        twice = every.groupBy("h", "x", "w").agg(F.count("*").alias("k")).where("k > 1").drop("k")
        hits = every.join(twice, ["h", "x", "w"]).groupBy(*_CLASS).agg(F.max("x").alias("left"), (F.lit(window) - F.min("x")).alias("right"))
        found = sort(contexts.join(big, "h", "left_anti")).union(hits)
    found = scratch.table(found)
    copies = classes.where("n > 1").select(
        *_CLASS, F.shiftright("packed", 10).bitwiseAND(F.lit(1023)).alias("left"), F.col("packed").bitwiseAND(F.lit(1023)).alias("right")
    )
    once = found.join(copies.select(*_CLASS), _CLASS, "left_anti") if not big.isEmpty() else found
    place = F.shiftright("packed", 20)
    spans = met.join(copies.union(once), _CLASS).select(*_ROW, (place - F.col("left")).alias("s"), (place + F.col("right")).alias("e"))
    return scratch.table(spans.groupBy(*_ROW).agg(F.collect_list(F.struct("s", "e")).alias("spans")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, large: int = LARGE) -> DataFrame:
    """Documents -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row for each row.

    Removed is each byte of a `window`-byte string that starts anywhere else too. A null text is empty; texts shorter
    than the window keep all; very long ones are read whole, in overlapping parts. Rows with equal ids and texts are
    copies of each other, like rows with other ids; ids may be null and of any type. Other columns are not read. No rows: no rows.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    base = base.withColumns({"r1": F.xxhash64("doc_id", "text"), "r2": F.xxhash64(F.lit(8), "text", "doc_id")})
    spans = repeated_spans(base.select(*_ROW, "text"), scratch, window, gram, large)
    ids = scratch.table(spans.select(*_ROW))
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    zero = F.lit(0).cast("long")
    clean = without_ids(base, _ROW, ids, _ROW).select("doc_id", n_bytes, zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    cut = arrow_udf(_cut_out, "struct<n_removed:bigint,n_spans:bigint,kept_sha256:string>").asNondeterministic()
    touched = with_ids(base, _ROW, ids, _ROW).join(spans, _ROW).select("doc_id", n_bytes, cut("text", "spans").alias("r"))
    return clean.union(touched.select("doc_id", "n_bytes", "r.*"))
