"""SimHash near-dedup through an inverted index of positional bytes with count filtering."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .graph import components
from .scratch import Scratch, without_ids

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
#: Two fingerprints that differ in at most MAX_BITS bits share at least this many of their 8 positional bytes.
MIN_SHARED = 8 - MAX_BITS
#: Lists longer than this are not paired row by row; see `links`.
LONG_LIST = 64


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of one text, as an unsigned number."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    joined, width = b" ".join(words), len(words) - n
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: n - 1]]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 16):
        some = zip(starts[lo : lo + (1 << 16)], ends[lo + width : lo + width + (1 << 16)], strict=False)
        h = np.array([digest(joined[s : e - 1], SEED) for s, e in some], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(text: pa.Array) -> pa.Array:
    out = np.array([fingerprint(t) for t in text.to_pylist()], np.uint64)
    return pa.array(out.view(np.int64), pa.int64())


def fingerprint_column(text: str):
    """Column of signed 64-bit fingerprints of a text column."""
    return arrow_udf(_fingerprints, "bigint").asNondeterministic()(F.col(text))


def links(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct fingerprints (fp) -> links (u, v) whose closure is that of all pairs within MAX_BITS bits.

    The index has one posting per choice of two of the four byte pairs, holding the four positional bytes
    there: of 6 shared positional bytes at least two whole byte pairs are shared, so every pair that reaches the
    guaranteed minimum meets in some list. Lists of one byte would each hold 1/256 of all rows. Pairs of a list
    are tallied (how many of the 8 positional bytes agree), those with MIN_SHARED or more are verified bit by bit.
    A list of more than LONG_LIST rows agrees in 32 bits; there each row meets others at the values that it
    and its one-bit changes in the other 32 bits have. Two rows share such a value just if they differ in at most
    two bits, and each row is linked to the least of a value: 33 rows for each, however long the list is.
    """
    pairs = list(itertools.combinations(range(4), 2))
    keyed = prints.select("fp").withColumn("slot", F.explode(F.array(*(F.lit(i) for i in range(len(pairs))))))
    masks = [sum(0xFFFF << (16 * p) for p in c) for c in pairs]
    masks = [m - 2**64 if m >= 2**63 else m for m in masks]
    mask = F.element_at(F.array(*(F.lit(m).cast("long") for m in masks)), F.col("slot") + 1)
    keyed = keyed.select("fp", "slot", F.col("fp").bitwiseAND(mask).alias("bytes"))
    counts = keyed.groupBy("slot", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    met = scratch.table(keyed.join(counts, ["slot", "bytes"]))

    short = met.where(F.col("n") <= LONG_LIST)
    a = short.select("slot", "bytes", F.col("fp").alias("u"))
    b = short.select("slot", "bytes", F.col("fp").alias("v"))
    xor = F.col("u").bitwiseXOR(F.col("v"))
    shared = sum(
        (F.shiftrightunsigned(xor, 8 * i).bitwiseAND(F.lit(255)) == 0).cast("int") for i in range(8)
    )
    paired = (
        a.join(b, ["slot", "bytes"])
        .where(F.col("u") < F.col("v"))
        .where(shared >= MIN_SHARED)
        .where(F.bit_count(xor) <= MAX_BITS)
        .select("u", "v")
    )

    flips = [1 << i for i in range(63)] + [-(2**63)]
    change = F.explode(
        F.concat(
            F.array(F.lit(0).cast("long")),
            F.filter(F.array(*(F.lit(f).cast("long") for f in flips)), lambda f: f.bitwiseAND(mask) == 0),
        )
    )
    at = met.where(F.col("n") > LONG_LIST).select("slot", "fp", change.alias("flip"))
    at = at.select("slot", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    least = at.groupBy("slot", "value").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1")
    starred = at.join(least, ["slot", "value"]).select(F.col("fp").alias("u"), "v")
    return paired.union(starred).where("u <> v").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents -> (doc_id, fingerprint, component_id).

    One row for each input row. fingerprint: 16 hex digits; component_id: the least id that links reach.
    A null or empty text has fingerprint zero and is linked like any other, a very long one is read whole; a null id takes
    part with its text, and its row shows the component's least id that is not null. Repeated rows stay repeated, and
    rows with equal ids have their own fingerprints. Ids may be of any orderable type; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    marked = scratch.table(docs.select(F.col(id_col).alias("id"), fingerprint_column(text_col).alias("fp")))
    return _joined(marked, scratch).select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _joined(marked: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, fp) -> (id, fp, component_id)."""
    prints = scratch.table(marked.groupBy("fp").agg(F.min("id").alias("least")))
    found = components(links(prints, scratch), scratch)
    named = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = scratch.table(named.join(ids, "component").select("fp", "component_id"))
    return marked.join(classes, "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component, the one with the least id. Columns as given; no rows: no rows.

    Rows with a null id are kept. Of rows with equal ids any one is kept, if one of them is the least of its component.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    marked = scratch.table(docs.select(F.col(id_col).alias("id"), fingerprint_column(text_col).alias("fp")))
    per_id = (
        _joined(marked, scratch)
        .where("id is not null")
        .groupBy("id")
        .agg(F.max("component_id").alias("last"), F.count("*").alias("n"))
        .where("last < id or n > 1")
    )
    per_id = scratch.table(per_id)
    out = without_ids(docs, [id_col], per_id.where("last < id"), ["id"])
    if per_id.where("last >= id").isEmpty():
        return out
    return out.where(F.col(id_col).isNull()).unionByName(out.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]))
