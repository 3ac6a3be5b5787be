"""Toxicity: scores against a plain noisy-or, and accuracy on labels that training never saw."""

from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from barloom.llm import toxicity


def key(word: bytes, kind: int) -> int:
    """The hash of one feature by itself: a word (kind 0) or one of its prefixes."""
    data = np.frombuffer(word, np.uint8)
    return int(toxicity._word_features(data, np.array([0]), np.array([len(data)]))[kind][0])


def plain_score(model: toxicity.Model, text: str | None) -> float:
    weight = dict(zip(model.keys.tolist(), model.weights.tolist(), strict=True))
    clean = 1 - model.leak
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    for sentence in re.split(rb"[\n!.?]", low):
        found = {key(w, k) for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", sentence) for k in range(4)} & weight.keys()
        if found:
            clean *= 1 - 1 / (1 + math.exp(-(model.bias + sum(weight[f] for f in found))))
    return 1 - clean


def test_scores_are_the_noisy_or_of_sentences():
    r = random.Random(3)
    words = ["vile", "Vileness", "good", "go", "goodly", "straße", "x1", "Scum", "scumbag", "日本"]
    keys = sorted({key(re.sub(b"[A-Z]", lambda m: m[0].lower(), w.encode()), k) for w in words[:8] for k in range(4)})
    model = toxicity.Model(np.array(keys, np.uint64), np.array([r.uniform(-2, 2) for _ in keys]), -1.0, 0.05)
    texts = ["".join(r.choice(words) + r.choice([" ", ". ", "! ", "\n", "-", "?"]) for _ in range(r.randint(0, 12))) for _ in range(300)] + [None, "", "..."]
    got, _ = toxicity.score_texts(model, model.filter(), pa.array(texts))
    assert np.allclose(got, [plain_score(model, t) for t in texts], atol=1e-12)


@pytest.mark.parametrize("folder, least", [("sf0.01", 0.75), ("sf0.1", 0.93)])
def test_held_out_labels(folder, least):
    """Area under the curve on the supplied labels whose ids are held out; the small table has some 300 labels to learn from."""
    docs = pq.read_table(f"/root/testdata/{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    labels = {x["doc_id"]: x["toxic"] for x in pq.read_table(f"/root/testdata/{folder}/labels.parquet").to_pylist()}
    known = [(d["text"] or "", labels[d["doc_id"]], zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2) for d in docs if labels.get(d["doc_id"]) in (0, 1)]
    train, test = [x for x in known if not x[2]], [x for x in known if x[2]]
    model = toxicity.train(pa.array([t for t, *_ in train]), np.array([y for _, y, _ in train]))
    scores, _ = toxicity.score_texts(model, model.filter(), pa.array([t for t, *_ in test]))
    y = np.array([y for _, y, _ in test])
    bad, good = scores[y == 1], scores[y == 0]
    area = ((bad[:, None] > good).sum() + (bad[:, None] == good).sum() / 2) / (len(bad) * len(good))
    assert len(bad) >= 5 and area >= least, area
