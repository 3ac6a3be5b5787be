"""Cases in which an operator once did less than the whole job."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import decontam, licenses, paragraphs, suffixdedup, tokens, toxicity


def test_hits_of_a_text_after_a_hit_at_the_end():
    item = " ".join(f"w{k}" for k in range(10))
    longer = " ".join(f"w{k}" for k in range(3, 16))
    index = decontam.Index([("a", item), ("b", longer), ("c", "x y z")])
    n_words, spans, items = decontam._scan(index, pa.array([item, "", item, longer, longer + " other", None, "x y z", "x y z", "q x y z"]))
    assert spans == [[(0, 10)], [], [(0, 10)], [(0, 13)], [(0, 13)], [], [(0, 3)], [(0, 3)], [(1, 4)]]
    assert items == [["a"], [], ["a"], ["b"], ["b"], [], ["c"], ["c"], ["c"]] and n_words.tolist() == [10, 0, 10, 13, 14, 0, 3, 3, 4]


def test_tokens_of_every_character_of_two_bytes():
    e = tokens.Encoder(tokens.default_path())
    texts = [f"a{chr(c)} {chr(c)}b1{chr(c)}{chr(c)}.{chr(c)}" for c in range(0x80, 0x800)] + ["gəlir ˈɪŋɡlɪʃ ʿ"]
    for t, ids in zip(texts, e.encode(pa.array(texts)), strict=True):
        assert e.tokenizer.encode(t, add_special_tokens=False).ids == ids.tolist(), t


def test_short_paragraphs_have_rows(spark):
    nine = "a line of nine words that stands here again"
    texts = ["ab\n" + nine + "\nfoo one", "ab\n" + nine, "x\n" + nine + " too", "seven words that stand in one text", "ab"]
    got = paragraphs.dedup(spark.createDataFrame([*enumerate(texts), (4, "ab"), (5, "foo")], "doc_id long, text string")).collect()
    have = {(g.doc_id, g.start, g.n_words, g.component_id, g.component_start, g.n_members, g.kept) for g in got}
    want = {(0, 0, 1, 0, 0, 3, True), (1, 0, 1, 0, 0, 3, False), (4, 0, 1, 0, 0, 3, False)}
    want |= {(0, 3, 9, 0, 3, 3, True), (1, 3, 9, 0, 3, 3, False), (2, 2, 10, 0, 3, 3, False)}
    assert have == want and len(got) == len(want)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_of_one_id_are_texts_of_their_own(spark, kind):
    one = lambda k: k if kind == "long" else f"id{k}"
    words = lambda c: " ".join(f"{c}{k}" for k in range(60))
    rows = [(one(1), words("a")), (one(1), words("b")), (one(1), words("b")), (one(2), "x\n" + words("b")), (one(3), words("c")), (None, words("b"))]
    got = paragraphs.dedup(spark.createDataFrame(rows, f"doc_id {kind}, text string")).collect()
    size = len(words("b"))
    have = sorted((g.kind, g.doc_id, g.start, g.end, g.component_id, g.component_start, g.n_members, g.kept) for g in got)
    assert [h for h in have if h[0] == "paragraph"] == [("paragraph", one(1), 0, size, one(1), 0, 2, True), ("paragraph", one(2), 2, size + 2, one(1), 0, 2, False)]
    assert {h[1] for h in have if h[0] == "passage"} == {one(1), one(2)} and len(have) == 4


def test_every_word_of_a_chain_of_passages_stays_somewhere(spark):
    some = lambda c: " ".join(f"{c}{k}" for k in range(120))
    x, y, z = some("x"), some("y"), some("z")
    texts = {1: f"p q {x} {y} r", 2: f"s {x} {y} {z} t", 3: f"u {y} {z} v", 4: f"w {x} w"}
    got = paragraphs.dedup(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).where("kind = 'passage'").collect()
    assert {g.doc_id for g in got} == {1, 2, 3, 4} and not any(g.kept for g in got if g.doc_id in (3, 4))
    left = ""
    for d, t in texts.items():
        raw = bytearray(t.encode())
        for g in got:
            if g.doc_id == d and not g.kept:
                raw[g.start : g.end] = b" " * (g.end - g.start)
        left += raw.decode() + " "
    assert set(f"{x} {y} {z}".split()) <= set(left.split())


def test_passages_repeated_in_one_text(spark):
    part = " ".join(f"k{k}" for k in range(80))
    got = paragraphs.dedup(spark.createDataFrame([(5, f"a {part} b {part} c")], "doc_id long, text string")).where("kind = 'passage'").collect()
    assert len(got) >= 1 and all(g.doc_id == 5 and g.n_members == 2 for g in got)


def test_anchors_of_a_text_of_many_parts(monkeypatch):
    """Parts of any length give the anchors that the whole text has: every window has one."""
    import numpy as np

    text = pa.record_batch({"text": pa.array([" ".join(f"w{(k * k) % 911}" for k in range(3000))])})
    (_, w), = paragraphs._slices_of(text)
    whole = paragraphs._anchor_places(w)
    for size in (1, 64, 1000):
        monkeypatch.setattr(paragraphs, "_SEGMENT", size)
        assert np.array_equal(paragraphs._anchor_places(w), whole)


def test_copies_are_told_by_their_bytes(spark, monkeypatch):
    """Even if all polynomial hashes of gram surroundings were alike, other bytes are another class."""
    import random

    r = random.Random(3)
    some = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    gram = some(8)
    texts = [some(40) + gram + some(40) for _ in range(6)]
    texts += [texts[0], texts[1][:60] + some(28)]
    got = suffixdedup.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), window=40, gram=8).collect()
    seen = {}
    for t in texts:
        for i in range(len(t) - 39):
            seen[t[i : i + 40]] = seen.get(t[i : i + 40], 0) + 1
    for g in got:
        t, hit = texts[g.doc_id], set()
        for i in range(len(t) - 39):
            if seen[t[i : i + 40]] > 1:
                hit |= set(range(i, i + 40))
        assert g.n_removed == len(hit)


def test_known_licenses_are_read_as_documents_are(spark):
    """Copyright lines, titles and rules in a known text count no more than in a document."""
    text = "The X License\n" + "=" * 500 + "\nCopyright (c) 2020 Some Body\n\nAll rights of this software are given to\nyou."
    known = [("X", text)]
    rows = [(0, text), (1, text.replace("Some Body", "Another").replace("=", "-")), (2, text.replace("you", "them"))]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), known=known).collect()
    assert sorted((g.doc_id, g.line, g.license) for g in got) == [(0, -1, "X"), (1, -1, "X")]


FOLDER = "/usr/share/common-licenses"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no published license texts here")
def test_whole_published_licenses_are_found(spark):
    files = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    rows = []
    for k, f in enumerate(files):
        with open(f"{FOLDER}/{f}", encoding="utf-8") as h:
            text = h.read()
        rows += [(k, text), (100 + k, "Copyright (C) 2019 Some Body\n\n" + text.upper().replace("\n", "\n   ")), (200 + k, text.replace("the", "a", 1))]
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and len(t) > 500)
    bsd = next(t for n, t in licenses.KNOWN if n == "BSD-3-Clause" and len(t) > 500)
    rows += [(300, "The MIT License (MIT)\n\nCopyright (c) 2020 A B\n\n" + mit), (301, "MIT License\n\n" + re.sub(r"(.{50}\S*) ", r"\1\n", mit))]
    rows += [(302, "BSD 3-Clause License\n\nCopyright (c) 2020, A\nAll rights reserved.\n\n" + bsd.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "))]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("line = -1").collect()
    want = {(k + d, n) for k, n in enumerate(files.values()) for d in (0, 100)} | {(300, "MIT"), (301, "MIT"), (302, "BSD-3-Clause")}
    assert {(g.doc_id, g.license) for g in got} == want


def traced(f):
    """(result of f, MB that it held at most)."""
    import tracemalloc

    tracemalloc.start()
    try:
        return f(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_windows_are_counted_one_place_at_a_time():
    """A group that is settled by its windows holds one window of each row, and finds what comparing every pair does."""
    import random
    from collections import Counter

    r = random.Random(5)
    some = lambda n: bytes(r.choice(b"a\0") for _ in range(n))
    lefts, rights = [some(r.randint(0, 5)) for _ in range(60)], [some(r.randint(1, 9)) for _ in range(60)]
    spans = [[(x, left[:x][::-1] + right[: 8 - x]) for x in range(len(left) + 1) if len(right) >= 8 - x] for left, right in zip(lefts, rights, strict=True)]
    seen = Counter(w for ws in spans for w in ws)
    hits = [[x for x, w in ws if seen[x, w] > 1] for ws in spans]
    assert suffixdedup._count_windows(lefts, rights, 8) == [(max(h), 8 - min(h)) if h else (0, 0) for h in hits] and any(hits) and not all(hits)

    g = np.random.default_rng(1)
    left, right = g.integers(97, 123, 168, dtype=np.uint8), g.integers(97, 123, 200, dtype=np.uint8)
    lefts, rights = [], []
    for k in g.integers(40, 168, 2000):  # each shares k bytes with the others on one side, and just too few on the other
        for out, whole, n in ((lefts, left, k), (rights, right, min(199, 200 - k + g.integers(-8, 1)))):
            out.append(np.concatenate([whole[:n], g.integers(97, 123, len(whole) - n, dtype=np.uint8)]).tobytes())
    (a, b), most = traced(lambda: suffixdedup.extensions(lefts, rights, np.array([2000]), np.ones(2000, bool)))
    assert (a > 0).any() and most < 60


def test_anchors_of_a_very_long_text_take_little_memory(monkeypatch):
    """A text of 6 MB is read in parts, and has the anchors that it has as a whole."""
    text = np.random.default_rng(2).integers(97, 123, 6 << 20, dtype=np.uint8).tobytes().decode()
    batch = pa.record_batch({"text": pa.array([text]), "r1": pa.array([1]), "r2": pa.array([2])})
    scan = lambda: pa.Table.from_batches(list(suffixdedup._scan(200, 32)([batch])))
    parts, most = traced(scan)
    monkeypatch.setattr(suffixdedup, "_SEGMENT", 1 << 23)
    assert parts.equals(scan()) and most < 200


def test_labelled_documents_are_written_to_few_files(spark, monkeypatch):
    """As many files as partitions would have executors start processes for each; the model is the same."""
    texts = [f"w{k % 7} so bad{k % 3} . and more of it" if k % 4 == 0 else f"w{k % 7} fine and well . and more" for k in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int")
    files, table = [], toxicity.Scratch.table

    def counted(self, df):
        out = table(self, df)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(toxicity.Scratch, "table", counted)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    few = toxicity.fit(docs, labels)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        many = toxicity.fit(docs, labels)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(many.keys) and np.array_equal(many.keys, few.keys) and np.array_equal(many.weights, few.weights)
    assert len(files) == 2 and max(files) <= toxicity.TRAIN_FILES
