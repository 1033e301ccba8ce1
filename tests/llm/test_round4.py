"""Candidates of the Jaccard join where common passages run through many documents."""

import random

import numpy as np
import pytest

from millrace.llm import jaccard, textops
from millrace.llm.shipping import ship


def linked(rule, a, b):
    overlap = np.int64(len(np.intersect1d(a, b)))
    return bool(rule.linked(overlap, np.int64(len(a) + len(b)) - overlap))


def test_common_passages_make_no_clusters(spark, monkeypatch):
    """Only near copies are fetched again, not every document that a chain of shared passages leads to."""
    ship(spark)
    rng = random.Random(4)
    passages = [[f"p{k}_{i}" for i in range(40)] for k in range(5)]
    texts = []
    for k in range(120):
        own = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        for at in sorted(rng.sample(range(200), 2), reverse=True):
            own[at:at] = passages[rng.randrange(5)]
        texts.append(own)
    for k in range(10):
        texts.append(list(texts[k]))
        texts[-1][rng.randrange(len(texts[-1]))] = "edit"
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    fetched, sets_of = [], jaccard._sets_of
    monkeypatch.setattr(jaccard, "_sets_of", lambda docs, wanted, rule: fetched.extend(r["doc_id"] for r in wanted.collect()) or sets_of(docs, wanted, rule))
    got = jaccard.jaccard_components(docs, jaccard.Similarity())
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {k: k if k < 120 else k - 120 for k in range(130)}
    assert sorted(fetched) == [*range(10), *range(120, 130)]


@pytest.mark.parametrize("rule", [jaccard.Similarity(), jaccard.Similarity(words=3, num=90, den=100)])
def test_stars_connect_all_that_is_linked(rule):
    """Sketches of sizes beside each power of two, ids in any order, one id with two sets."""
    rng = np.random.default_rng(7)
    draw = lambda n: textops.mix(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    base, sets = draw(600), []
    for size in (500, 512, 513, 540, 590, 600):
        for lost in (0, 3, 30, 80):
            sets.append(np.unique(np.concatenate((base[lost:size], draw(lost // 2)))))
    sets += [np.unique(draw(n)) for n in (510, 514, 600)] + [base[:5]]
    ids = rng.permutation(len(sets)).astype(np.int64)
    ids[3] = ids[4]
    stars = jaccard.sketch_stars(ids, np.array([len(s) for s in sets]), [jaccard.parity_sketch(s) for s in sets], rule)
    hub = {int(i): int(i) for i in ids} | {int(a): int(b) for a, b in stars}
    for i, a in zip(ids.tolist(), sets, strict=True):
        for j, b in zip(ids.tolist(), sets, strict=True):
            assert hub[i] == hub[j] or not linked(rule, a, b)
    assert {int(i) for i in ids[24:]} <= {i for i, h in hub.items() if i == h}
