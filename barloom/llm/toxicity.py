"""Toxicity by multiple-instance learning: sentence probabilities, combined by noisy-or, trained from document labels."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .bytesnp import LOWER, WORD, prefix_hash, slices, span_hash, text_column, word_bounds
from .scratch import Scratch, free_name, small_batches

#: Labelled documents, and bytes of them, that training takes at most, least hash of the id first.
TRAIN_ROWS, TRAIN_BYTES = 12_000, 64 << 20
#: Files that the labelled documents are written to at most.
TRAIN_FILES = 12
THRESHOLD = 0.3
#: A word counts as itself and by its first so many bytes.
PREFIXES = (4, 5, 6)
#: Features that stand in fewer training documents, or tell less (chi-square), are left out; at most FEATURES stay.
LEAST_DOCS, LEAST_CHI2, FEATURES = 4, 12.0, 2000
_FILTER_BITS = 22

_END = np.zeros(256, bool)
_END[[10, 33, 46, 63]] = True


@dataclass
class Model:
    """keys: sorted feature hashes; weights: theirs; bias: of a sentence with any; leak: a document's without evidence."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    leak: float

    def filter(self) -> np.ndarray:
        known = np.zeros(1 << _FILTER_BITS, bool)
        known[self.keys >> np.uint64(64 - _FILTER_BITS)] = True
        return known


def _sentences(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, sentence of each word, first word of each sentence, document of each sentence)."""
    starts, ends, doc = word_bounds(data, offsets, WORD)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return starts, ends, none, none, none
    stops = np.concatenate([[0], np.cumsum(_END[data])])[starts]
    new = np.concatenate([[True], (stops[1:] != stops[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(new)
    return starts, ends, np.cumsum(new) - 1, first, doc[first]


def _word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """One array of hashes for each kind: whole words, then prefixes (of a shorter word: the word)."""
    h = prefix_hash(data)
    out = [span_hash(h, starts, ends)]
    for k, n in enumerate(PREFIXES, 1):
        out.append(span_hash(h, starts, np.minimum(starts + n, ends)) ^ np.uint64(0x9E37 * k + (k << 56)))
    return out


def train(texts: pa.Array, labels: np.ndarray, rounds: int = 400) -> Model:
    """Weights by Adam on the noisy-or likelihood: P(toxic) = 1 - (1 - leak) * product over sentences of (1 - p)."""
    offsets, whole = text_column(texts)
    labels = np.asarray(labels, float)
    rate = labels.mean() if len(labels) else 0.0
    none = Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, float(min(0.25, rate / 2)))
    if not 0 < rate < 1:
        return none

    def parts():
        for lo, hi in slices(offsets):
            data = LOWER[whole[offsets[lo] : offsets[hi]]]
            starts, ends, of, first, doc = _sentences(data, offsets[lo : hi + 1] - offsets[lo])
            if len(starts):
                yield lo, of, doc, _word_features(data, starts, ends)

    # Presence of each feature in documents of either label.
    keys, toxic, seen = (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64))
    for lo, of, doc, kinds in parts():
        docs, feats = np.tile(doc[of], len(kinds)), np.concatenate(kinds)
        order = np.lexsort((docs, feats))
        docs, feats = docs[order], feats[order]
        one = np.concatenate([[True], (docs[1:] != docs[:-1]) | (feats[1:] != feats[:-1])])
        docs, feats = docs[one], feats[one]
        k, inverse = np.unique(feats, return_inverse=True)
        both, at = np.unique(np.concatenate([keys, k]), return_inverse=True)
        counts = [np.zeros(len(both), np.int64) for _ in range(2)]
        for out, old, new in zip(counts, (toxic, seen), (np.bincount(inverse, labels[lo + docs]), np.bincount(inverse)), strict=True):
            out[at[: len(keys)]] += old
            out[at[len(keys) :]] += new.astype(np.int64)
        keys, (toxic, seen) = both, counts
    n, pos = len(labels), labels.sum()
    expected = seen * pos / n
    spread = expected * (1 - pos / n) * (n - seen) / max(n - 1, 1)
    chi2 = np.where(spread > 0, (toxic - expected) ** 2 / np.maximum(spread, 1e-9), 0)
    good = np.flatnonzero((seen >= LEAST_DOCS) & (chi2 >= LEAST_CHI2))
    good = np.sort(good[np.lexsort((keys[good], -chi2[good]))][:FEATURES])
    if not len(good):
        return none
    model = Model(keys[good], np.zeros(len(good)), 0.0, none.leak)
    known = model.filter()

    # (sentence, feature) pairs of the sentences that have any.
    rows, cols, sent_doc, total = [], [], [], 0
    for lo, of, doc, kinds in parts():
        s, f = _evidence(model, known, of, kinds)
        if not len(s):
            continue
        has, s = np.unique(s, return_inverse=True)
        rows.append(s + total)
        cols.append(f)
        sent_doc.append(doc[has] + lo)
        total += len(has)
    s, f, d = np.concatenate(rows), np.concatenate(cols), np.concatenate(sent_doc)
    pair = np.unique(s * len(good) + f)
    s, f = pair // len(good), pair % len(good)

    theta = np.zeros(len(good) + 2)  # weights, bias, logit of the leak
    theta[-2], theta[-1] = -2.0, -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        z = theta[-2] + np.bincount(s, theta[f], total)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        leak = 1 / (1 + np.exp(-theta[-1]))
        log_clean = np.bincount(d, -np.logaddexp(0, z), n) + np.log1p(-leak)
        score = np.clip(-np.expm1(log_clean), 1e-9, 1 - 1e-12)
        # d/d(log_clean) of the log likelihood: -clean/score for toxic documents, 1 for the others.
        pull = np.where(labels > 0, -np.exp(log_clean) / score, 1.0)
        gz = pull[d] * -p
        g = np.concatenate([np.bincount(f, gz[s], len(good)), [gz.sum(), (pull * -leak).sum()]])
        g[:-2] -= 0.05 * theta[:-2]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta += 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        theta[-1] = min(theta[-1], -1.5)
    return Model(model.keys, theta[:-2].copy(), float(theta[-2]), float(1 / (1 + np.exp(-theta[-1]))))


def _evidence(model: Model, known: np.ndarray, of: np.ndarray, kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(sentence, feature) of every word and prefix that the model has."""
    rows, cols = [], []
    for feats in kinds:
        at = np.flatnonzero(known[feats >> np.uint64(64 - _FILTER_BITS)])
        k = np.minimum(np.searchsorted(model.keys, feats[at]), len(model.keys) - 1)
        same = model.keys[k] == feats[at]
        rows.append(of[at[same]])
        cols.append(k[same])
    return np.concatenate(rows), np.concatenate(cols)


def score_texts(model: Model, known: np.ndarray, column: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """For each text its score, and (first byte, end byte, probability) of the sentences that are likelier toxic than not."""
    offsets, whole = text_column(column)
    log_clean = np.full(len(column), np.log1p(-model.leak))
    found: list[list[tuple[int, int, float]]] = [[] for _ in range(len(column))]
    if len(model.keys):
        for lo, hi in slices(offsets):
            data = LOWER[whole[offsets[lo] : offsets[hi]]]
            at = offsets[lo : hi + 1] - offsets[lo]
            starts, ends, of, first, doc = _sentences(data, at)
            if not len(starts):
                continue
            s, f = _evidence(model, known, of, _word_features(data, starts, ends))
            if not len(s):
                continue
            pair = np.unique(s * len(model.keys) + f)
            s, f = pair // len(model.keys), pair % len(model.keys)
            has, s = np.unique(s, return_inverse=True)
            z = model.bias + np.bincount(s, model.weights[f], len(has))
            log_clean[lo:hi] += np.bincount(doc[has], -np.logaddexp(0, z), hi - lo)
            last = np.append(first[1:], len(starts)) - 1
            for k in np.flatnonzero(z > 0):
                d, w = doc[has[k]], has[k]
                found[lo + d].append((int(starts[first[w]] - at[d]), int(ends[last[w]] - at[d]), float(1 / (1 + np.exp(-z[k])))))
    return np.clip(-np.expm1(log_clean), 0.0, 1.0), found


_RESULT = "struct<score:double,offending:array<struct<start:bigint,end:bigint,p:double>>>"


def scores_column(text: str, model):
    """Column of _RESULT for a text column; model: a broadcast Model."""

    def score(column: pa.Array) -> pa.Array:
        scores, found = score_texts(model.value, model.value.filter(), column)
        flat = [x for row in found for x in row]
        cols = [pa.array([x[k] for x in flat], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))]
        spans = pa.StructArray.from_arrays(cols, names=["start", "end", "p"])
        lists = pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, found))], pa.int32()), spans)
        return pa.StructArray.from_arrays([pa.array(scores), lists], names=["score", "offending"])

    return arrow_udf(score, _RESULT).asNondeterministic()(F.col(text))


def held_out(id_col: str):
    """True for rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> Model:
    """A model from at most `rows` labelled documents of `size` bytes together that aren't held out.

    An id's label is 1 if any of its labels is; of documents with equal ids the one with the least hash of its text is
    taken, so that neither repeated rows nor repeated ids add to the sample. Labels other than 0 and 1, null ids and null
    texts are left out. Without labels of both kinds every text scores the leak.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = (
        labels.select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("key").isNotNull() & ~held_out("key"))
        .groupBy("key")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    one = texts.join(F.broadcast(known), "key").groupBy("key", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    # Few files, however many partitions a shuffle has: for each one the executors start processes that set its rights.
    one = scratch.table(one.withColumn("size", F.octet_length("text").cast("long")).coalesce(TRAIN_FILES))
    # At most `rows` numbers in one window: those that fit into `size` together, an oversized one being passed over.
    upto = F.sum("size").over(Window.orderBy(F.xxhash64("key"), "key").rowsBetween(Window.unboundedPreceding, 0))
    some = one.select("key", "size").where(F.col("size") <= size).select("key", upto.alias("upto")).where(F.col("upto") <= size).select("key")
    got = one.join(F.broadcast(some), "key", "left_semi").select("key", "label", "text").toArrow().sort_by([("key", "ascending")])
    return train(got["text"], got["label"].to_numpy())


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Documents -> (doc_id, held_out, score, predicted, offending), a row for each row.

    A null or empty text has no sentences and scores the leak; a very long one is scored whole. Repeated rows and rows
    with equal ids are scored each for itself; a null id is not held out. offending: byte spans of sentences with p
    over 0.5. Other columns are not read. No rows: no rows.
    """
    small_batches(docs.sparkSession)
    r = scores_column(text_col, docs.sparkSession.sparkContext.broadcast(model))
    out = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), r.alias("r"))
    return out.select("doc_id", "held_out", "r.score", (F.col("r.score") >= threshold).cast("int").alias("predicted"), "r.offending")


def reject(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without those that score `threshold` or more. Columns and rows as given; no rows: no rows."""
    small_batches(docs.sparkSession)
    name = free_name(docs, "toxicity")
    r = scores_column(text_col, docs.sparkSession.sparkContext.broadcast(model))
    return docs.withColumn(name, r).where(F.col(f"{name}.score") < threshold).drop(name)
