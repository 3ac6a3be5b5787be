"""Substring dedup by paragraph: MinHash banding, exact Jaccard, components; and passages that stand inside paragraphs.

Equal paragraphs are one class from the start. Bands of few rows are tuned for recall (see BANDS): of pairs at the
threshold 99.8 % collide, of more similar ones nearly all. Colliding classes are verified on their whole shingle sets.
A passage in the midst of other text shares no paragraph. Of every PASSAGE words in a row the place of the least
GRAM-word hash is an anchor, so any passage of PASSAGE words or more that stands in two places word for word has an anchor in
common; runs of such anchors are returned beside the paragraphs.

Rows are told apart by their id, whatever its type, and a hash of their text; classes of equal paragraphs have numbers
of their own, so that all links and components are of plain longs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .bytesnp import LOWER, WORD, mixed, powers, prefix_hash, slices, sliding_min, span_hash, text_column, word_bounds
from .graph import components
from .scratch import Scratch, with_ids

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: 1 - (1 - 0.8^2)^6 = 0.998 of the pairs with Jaccard 0.8 collide in a band.
BANDS, ROWS = 6, 2
#: Passages of PASSAGE words in a row are found wherever they begin and end, by common runs of GRAM words.
PASSAGE, GRAM = 50, 20

_LINE = np.zeros(256, bool)
_LINE[10] = True
_rng = np.random.default_rng(29)
_FACTORS = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


class Words:
    """Words of the texts of one slice, and the units (paragraphs or sentences) that they make."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = LOWER[data], bounds
        self.starts, self.ends, self.doc = word_bounds(self.data, bounds, WORD)
        self.h = span_hash(prefix_hash(self.data), self.starts, self.ends)
        p, inverse = powers(len(self.h) + 1)
        self.inverse = inverse
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.h * p[: len(self.h)])])

    def units(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, end word, number in its text) of each unit that has words; ends: bytes that end a unit."""
        if not len(self.starts):
            return (np.zeros(0, np.int64),) * 3
        cut = np.concatenate([[0], np.cumsum(ends[self.data])])
        number = cut[self.starts] - cut[self.bounds[self.doc]]
        first = np.flatnonzero(np.concatenate([[True], (number[1:] != number[:-1]) | (self.doc[1:] != self.doc[:-1])]))
        return first, np.append(first[1:], len(self.starts)), number[first]

    def digests(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of each unit's words in order."""
        return mixed((self.sums[end] - self.sums[first]) * self.inverse[first] + (end - first).astype(np.uint64))

    def shingles(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, first hash of each unit): SHINGLE_WORDS words in a row, or the whole unit if it has fewer."""
        n = np.maximum(end - first - SHINGLE_WORDS + 1, 1)
        at = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(at, n) + np.repeat(first, n)
        return self.digests(place, np.minimum(place + SHINGLE_WORDS, np.repeat(end, n))), at


def _slices_of(batch):
    offsets, whole = text_column(batch["text"])
    for lo, hi in slices(offsets):
        yield lo, Words(whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


_ROW = ["id", "r1"]


def _named(batch, rows: np.ndarray) -> dict:
    """Id and row identity of the rows."""
    at = pa.array(rows)
    return {k: batch[k].take(at) for k in _ROW}


def _paragraphs(min_words: int):
    """Texts -> a row for each paragraph of min_words or more: place, words, two digests and the bands' keys.

    A paragraph of fewer than SHINGLE_WORDS words is its only shingle, similar to equal ones alone: it has no keys.
    """

    def run(batches):
        for batch in batches:
            for lo, w in _slices_of(batch):
                first, end, number = w.units(_LINE)
                long = np.flatnonzero(end - first >= min_words)
                if not len(long):
                    continue
                first, end, number = first[long], end[long], number[long]
                sh, at = w.shingles(first, end)
                keys = []
                for b in range(BANDS):
                    key = np.full(len(first), np.uint64(b + 1))
                    for k in range(b * ROWS, (b + 1) * ROWS):
                        v = sh * _FACTORS[k] + _SHIFTS[k]
                        key = mixed(key + np.minimum.reduceat((v ^ (v >> np.uint64(32))) * _FACTORS[k - 1], at))
                    keys.append(key.view(np.int64))
                banded = end - first >= SHINGLE_WORDS
                doc = w.doc[first]
                start = w.starts[first] - w.bounds[doc]
                yield pa.record_batch(
                    _named(batch, lo + doc) | {
                        "para": number.astype(np.int64), "start": start, "end": w.ends[end - 1] - w.bounds[doc], "words": end - first,
                        "d1": w.digests(first, end).view(np.int64), "d2": mixed(np.add.reduceat(mixed(sh), at)).view(np.int64),
                        "bands": pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(BANDS * banded)]).astype(np.int32), np.stack(keys, 1)[banded].ravel()),
                    }
                )

    return run


def _shingle_sets(batches):
    """Texts with the paragraphs wanted in them, and their classes -> the sorted distinct shingle hashes of each class."""
    for batch in batches:
        wanted = [{x["para"]: x["cid"] for x in row} for row in batch["wanted"].to_pylist()]
        for lo, w in _slices_of(batch):
            first, end, number = w.units(_LINE)
            doc = w.doc[first] if len(first) else first
            cids = [wanted[lo + d].get(k) for d, k in zip(doc.tolist(), number.tolist(), strict=True)]
            keep = [k for k, c in enumerate(cids) if c is not None]
            if not keep:
                continue
            sh, at = w.shingles(first[keep], end[keep])
            sets = [np.unique(s) for s in np.split(sh, at[1:])]
            size = np.array([len(x) for x in sets])
            listed = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]).astype(np.int32), np.concatenate(sets).view(np.int64))
            yield pa.record_batch({"u": pa.array([cids[k] for k in keep], pa.int64()), "set": listed, "size": size})


def _compared(a: pa.Array, b: pa.Array) -> pa.Array:
    """Pairs of sorted sets -> how many elements they share, and those that only one of them has; all pairs at once.

    Equal neighbours in the merged rows are the intersection.
    """
    na, nb = (np.diff(np.asarray(x.offsets)) for x in (a, b))
    rows = np.concatenate([np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)])
    values = np.concatenate([np.asarray(a.flatten()), np.asarray(b.flatten())])
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    same = (rows[1:] == rows[:-1]) & (values[1:] == values[:-1])
    both = np.bincount(rows[1:][same], minlength=len(a))
    alone = np.ones(len(rows), bool)
    alone[1:] &= ~same
    alone[:-1] &= ~same
    upto = np.concatenate([[0], np.cumsum(np.bincount(rows[alone], minlength=len(a)))]).astype(np.int32)
    return pa.StructArray.from_arrays([pa.array(both, pa.int64()), pa.ListArray.from_arrays(upto, values[alone])], names=["both", "apart"])


#: Members of one list that a task compares with as many others at once; of a longer list every pair of blocks is a task.
BLOCK = 512
#: Up to so many, plain sets are quicker than a matrix.
FEW = 24


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each of left shares with each of right: a product of 0/1 matrices, some columns at a time."""
    size = [np.array([len(x) for x in side]) for side in (left, right)]
    values = [np.concatenate(side) for side in (left, right)]
    common = np.intersect1d(*values)
    out = np.zeros((len(left), len(right)), np.float32)
    at = [np.minimum(np.searchsorted(common, v), max(len(common) - 1, 0)) for v in values]
    known = [common[k] == v if len(common) else np.zeros(len(v), bool) for k, v in zip(at, values, strict=True)]
    rows = [np.repeat(np.arange(len(n)), n) for n in size]
    for lo in range(0, len(common), 1024):
        parts = []
        for n, k, ok, row in zip(size, at, known, rows, strict=True):
            some = ok & (k >= lo) & (k < lo + 1024)
            m = np.zeros((len(n), min(1024, len(common) - lo)), np.float32)
            m[row[some], k[some] - lo] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def _family_links(left: list[tuple], right: list[tuple], r: float) -> list[tuple[int, int]]:
    """Members (node, part, is_rest, size, differences from the middle) -> links between components, as places (i, j).

    Two sets differ in just what their differences from the middle differ in. Only pairs with a member that isn't in
    the middle's component and with different components are of use; of links that join the same two, one is given.
    """
    root: dict = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    if len(left) * len(right) <= FEW * FEW:
        sets = [[set(m[4]) for m in side] for side in (left, right)]
        near = [
            (i, j) for i, a in enumerate(left) for j, b in enumerate(right)
            if a[1] != b[1] and (a[2] or b[2]) and len(sets[0][i] ^ sets[1][j]) <= r * (a[3] + b[3]) + 1e-9
        ]
    else:
        count, size = ([np.array([x(m) for m in side], np.float32) for side in (left, right)] for x in (lambda m: len(m[4]), lambda m: m[3]))
        shared = _shared(*([np.asarray(m[4], np.int64) for m in side] for side in (left, right)))
        apart = count[0][:, None] + count[1][None] - 2 * shared
        ok = apart <= r * (size[0][:, None] + size[1][None]) + 1e-4
        ok &= np.array([m[2] for m in left])[:, None] | np.array([m[2] for m in right])[None]
        names = {p: k for k, p in enumerate({m[1] for m in (*left, *right)})}
        label = [np.array([names[m[1]] for m in side]) for side in (left, right)]
        ok &= label[0][:, None] != label[1][None]
        near = zip(*(x.tolist() for x in np.nonzero(ok)), strict=True)
    out = []
    for i, j in near:
        a, b = find(left[i][1]), find(right[j][1])
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def _families(r: float):
    """Rows in order of (middle, pair of blocks) -> links between components."""

    def settle(rows: list[tuple]) -> list[tuple]:
        lo, hi = rows[0][1:3]
        left = [x[4:] for x in rows if x[3] == lo]
        right = left if lo == hi else [x[4:] for x in rows if x[3] == hi]
        return [(left[i][1], right[j][1]) for i, j in _family_links(left, right, r)]

    def given(links: list[tuple]):
        return pa.record_batch({k: pa.array([link[i] for link in links], pa.int64()) for i, k in enumerate("uv")})

    def run(batches):
        held: list[tuple] = []
        links: list[tuple] = []
        for batch in batches:
            apart, upto = batch["apart"].flatten().to_numpy(), batch["apart"].offsets.to_numpy()
            cols = [batch[c].to_pylist() for c in ("v", "lo", "hi", "block", "u", "part", "is_rest", "nu")]
            for k, row in enumerate(zip(*cols, strict=True)):
                if held and held[0][:3] != row[:3]:
                    links += settle(held)
                    held = []
                held.append((*row, apart[upto[k] - upto[0] : upto[k + 1] - upto[0]].tolist()))
            if len(links) >= 4096:
                yield given(links)
                links = []
        if held:
            links += settle(held)
        yield given(links)

    return run


#: Places of anchors are numbered in parts of so many words, of _PLACE bits: a text of any length fits.
_PLACE = 24
_SEGMENT = 1 << 23


def _anchor_places(w: Words) -> np.ndarray:
    """First words of the anchors of all windows of PASSAGE words inside one text."""
    n, low = len(w.starts), np.uint64((1 << _PLACE) - 1)
    found = []
    for s in range(0, n - PASSAGE + 1, _SEGMENT):
        e = min(n, s + _SEGMENT + PASSAGE - 1)
        place = np.arange(s, e - GRAM + 1)
        key = (w.digests(place, place + GRAM) & ~low) | (place - s).astype(np.uint64)
        least = sliding_min(key, PASSAGE - GRAM + 1)
        least = least[w.doc[s : s + len(least)] == w.doc[s + PASSAGE - 1 : s + PASSAGE - 1 + len(least)]]
        found.append((least & low).astype(np.int64) + s)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _anchors(batches):
    """Texts -> a row for each anchor: its place in words, its bytes and the hash of its GRAM words."""
    for batch in batches:
        for lo, w in _slices_of(batch):
            at = _anchor_places(w)
            if not len(at):
                continue
            doc = w.doc[at]
            yield pa.record_batch(
                _named(batch, lo + doc) | {
                    "place": at - np.searchsorted(w.doc, doc, "left"), "start": w.starts[at] - w.bounds[doc],
                    "end": w.ends[at + GRAM - 1] - w.bounds[doc], "gram": w.digests(at, at + GRAM).view(np.int64),
                }
            )


def _components(classes: DataFrame, base: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Classes (cid, id, r1, para, bands) -> (cid, root) of those that hang together with others.

    Each class of a list is verified against the list's middle m: the class that shares the most with others, by the
    sizes of its lists. What is linked with it needs no further comparison; the rest, and only the rest, is compared
    with the other members, exactly, from what each of them differs in from m. Of the links found one is kept for every
    two components, so a list of many near copies gives a row for each member, not for each pair, and no link
    between separate parts is lost. Long lists are compared in blocks, each pair of blocks a task.
    """
    rows = classes.select("cid", F.explode("bands").alias("key"))
    full = scratch.table(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    met = scratch.table(rows.join(full, "key"))
    score = met.groupBy("cid").agg(F.sum("n").alias("score"))
    met = scratch.table(met.join(scratch.table(score), "cid"))
    order = F.col("score").cast("decimal(19,0)") * F.lit("10000000000000000000").cast("decimal(20,0)") + F.col("cid")
    middle = scratch.table(met.groupBy("key").agg(F.max_by("cid", order).alias("v")))

    some = classes.join(scratch.table(met.select("cid").distinct()), "cid", "left_semi")
    wanted = scratch.table(some.groupBy(*_ROW).agg(F.collect_list(F.struct("para", "cid")).alias("wanted")))
    texts = with_ids(base, _ROW, wanted, _ROW).join(wanted, _ROW)
    sets = scratch.table(texts.select("text", "wanted").mapInArrow(_shingle_sets, "u long, set array<long>, size long"))
    compare = arrow_udf(_compared, "struct<both:bigint,apart:array<bigint>>").asNondeterministic()

    a = sets.select("u", F.col("set").alias("a"), F.col("size").alias("nu"))
    b = sets.select(F.col("u").alias("v"), F.col("set").alias("b"), F.col("size").alias("nv"))
    star = met.join(middle, "key").select(F.col("cid").alias("u"), "v").where("u <> v").distinct()
    star = star.join(a, "u").join(b, "v").select("u", "v", "nu", "nv", compare("a", "b").alias("r"))
    similar = F.col("r.both") >= threshold * (F.col("nu") + F.col("nv") - F.col("r.both"))
    star = scratch.table(star.select("u", "v", "nu", "r.apart", similar.alias("similar")))

    # Lists by their middle v in which some member hangs together with others than v; `part`: the component so far.
    parts = scratch.table(components(star.where("similar").select("u", "v"), scratch).select(F.col("node").alias("u"), F.col("component").alias("part")))
    middles = scratch.table(star.select(F.col("v").alias("u")).distinct())
    main = middles.join(parts, "u", "left").select(F.col("u").alias("v"), F.coalesce("part", "u").alias("main"))
    rows = star.join(parts, "u", "left").select("u", "v", "nu", "apart", F.coalesce("part", "u").alias("part"))
    rows = rows.join(scratch.table(main), "v").select("u", "v", "nu", "apart", "part", (F.col("part") != F.col("main")).alias("is_rest"))
    rows = scratch.table(rows)
    open_ = rows.groupBy("v").agg(F.count("*").alias("n"), F.count_if("is_rest").alias("rest")).where("rest > 0 and n > 1")
    rows = rows.join(scratch.table(open_.select("v", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))), "v")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("u"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    rows = rows.select("v", "lo", "hi", "block", "u", "part", "is_rest", "nu", "apart").repartition("v", "lo", "hi").sortWithinPartitions("v", "lo", "hi")
    again = scratch.table(rows.mapInArrow(_families((1 - threshold) / (1 + threshold)), "u long, v long"))
    # The links found last are between components: few, and only they go through components again.
    joined = components(again, scratch).select(F.col("node").alias("part"), "component")
    alone = again.select(F.explode(F.array("u", "v")).alias("part")).distinct().join(parts.select("part"), "part", "left_anti")
    every = parts.union(alone.select("part", "part"))
    return every.join(scratch.table(joined), "part", "left").select(F.col("u").alias("cid"), F.coalesce("component", "part").alias("root"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, min_words: int = 1) -> DataFrame:
    """Documents -> (doc_id, kind, start, end, n_words, component_id, component_start, n_members, kept).

    A row for each paragraph (kind "paragraph": a line) of min_words or more that is equal or similar to another, in
    the same text or elsewhere, and for each stretch (kind "passage") of text in which every PASSAGE words hold GRAM words
    that stand elsewhere too. start, end: bytes of the UTF-8 text. component_id, component_start: the least
    member, which is the one that is kept; of a passage: where the first place with any of its common words has them.
    n_members: paragraphs of the component; of a passage: the most occurrences that some of its common words have. kept of a passage:
    whether any of its common words stand here first, so that what is shared in a chain of passages always stays somewhere.

    Ids may be of any orderable type. Null and empty texts have no rows; very long ones are taken whole; rows with a
    null id are left out. Rows with equal ids and other texts are texts of their own; of rows with equal ids and
    texts one is taken. Other columns are not read. No rows: no rows.
    """
    scratch = Scratch(docs.sparkSession, "paragraphs")
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    base = base.select("id", F.xxhash64("text").alias("r1"), "text")
    if not base.groupBy(*_ROW).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        base = scratch.table(base.dropDuplicates(_ROW))
    name = [base.schema["id"], T.StructField("r1", T.LongType())]
    numbers = lambda *names: [T.StructField(c, T.LongType()) for c in names]
    kind = T.StructType([*name, *numbers("para", "start", "end", "words", "d1", "d2"), T.StructField("bands", T.ArrayType(T.LongType()))])
    paras = scratch.table(base.mapInArrow(_paragraphs(min_words), kind))
    least = F.min(F.struct("id", "start", "r1", "para")).alias("least")
    classes = paras.groupBy("d1", "d2").agg(least, F.first("bands").alias("bands"), F.count("*").alias("n"))
    classes = scratch.table(classes.select(F.monotonically_increasing_id().alias("cid"), "d1", "d2", "least.*", "bands", "n"))
    found = _components(classes.where("size(bands) > 0").select("cid", "id", "r1", "para", "bands"), base, threshold, scratch)
    named = classes.select("cid", "d1", "d2", "id", "start", "r1", "n").join(found, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    sizes = named.groupBy("root").agg(F.sum("n").alias("members"), F.min(F.struct("id", "start", "r1")).alias("least")).where("members > 1")
    grouped = scratch.table(named.select("d1", "d2", "root").join(sizes, "root").select("d1", "d2", "members", "least"))
    here = (F.col("id") == F.col("least.id")) & (F.col("r1") == F.col("least.r1")) & (F.col("start") == F.col("least.start"))
    paragraphs = paras.drop("bands").join(grouped, ["d1", "d2"]).select(
        F.col("id").alias("doc_id"), F.lit("paragraph").alias("kind"), "start", "end", F.col("words").alias("n_words"),
        F.col("least.id").alias("component_id"), F.col("least.start").alias("component_start"), F.col("members").alias("n_members"), here.alias("kept"),
    )
    return paragraphs.unionByName(_passages(base, T.StructType([*name, *numbers("place", "start", "end", "gram")]), scratch))


def _passages(base: DataFrame, kind: T.StructType, scratch: Scratch) -> DataFrame:
    rows = scratch.table(base.mapInArrow(_anchors, kind))
    least = F.min(F.struct("id", "start")).alias("least")
    full = rows.groupBy("gram").agg(F.count("*").alias("n"), least).where("n > 1")
    # Of rows with one id that have the same words at one place, each counts as the first: both stay.
    own = (F.col("id") == F.col("least.id")) & (F.col("start") == F.col("least.start"))
    met = rows.join(scratch.table(full), "gram").withColumn("own", own).drop("gram")
    by = Window.partitionBy(*_ROW).orderBy("place")
    before = F.lag("place").over(by)
    # Within a common passage one anchor follows the other within PASSAGE - GRAM + 1 words.
    new = before.isNull() | (F.col("place") - before > PASSAGE - GRAM + 1)
    run = met.withColumn("run", F.sum(new.cast("int")).over(by))
    runs = run.groupBy(*_ROW, "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max("place") - F.min("place") + GRAM).alias("n_words"),
        F.max("n").alias("n_members"), F.min("least").alias("least"), F.bool_or("own").alias("kept"),
    )
    return runs.select(
        F.col("id").alias("doc_id"), F.lit("passage").alias("kind"), "start", "end", "n_words", F.col("least.id").alias("component_id"),
        F.col("least.start").alias("component_start"), "n_members", "kept",
    )
