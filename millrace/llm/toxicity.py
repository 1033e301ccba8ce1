"""Toxic spans by a linear-chain conditional random field.

Tokens are words without the marks around them, in lower case. Labels are known for
documents only, so tokens are labelled from a distance: how much more often a word, or its
beginning, stands in toxic documents than in others gives each token a grade, and in toxic
training documents tokens of a high grade count as toxic. The field has two states; it sees
the grades of a token and of its neighbours. Forward-backward marginals give the spans;
their noisy-or, calibrated by a logistic curve, is the score of the document. A chain is up
to ``CHAIN`` words of one line.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops
from millrace.llm.samples import training_rows
from millrace.operators.staging import stage

SAMPLE = 8000  # labelled documents that are learnt from
LEXICON = 50_000  # graded words and beginnings at most, the highest
CHAINS = 4_000  # chains that the field is fitted on
CHAIN = 64
BEGINNINGS = (5, 6)  # bytes
GRADES = np.array([1.0, 2.0, 3.0, 4.0, 5.0])  # bounds between the grades, in log-odds
HIGH = 3  # grade from which a token of a toxic document is labelled toxic
_MARK = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text, keys) of each word; ``keys`` has a row for the word and for each of its beginnings."""
    data = textops.lower_ascii(data)
    starts, ends, first = textops.words(data, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    solid = np.flatnonzero(~_MARK[data])
    a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    bare = b > a
    inner, outer = starts.copy(), ends.copy()
    inner[bare], outer[bare] = solid[a[bare]], solid[b[bare] - 1] + 1
    rolling = textops.Rolling(data)
    keys = [rolling.of(inner, outer)]
    for k in BEGINNINGS:
        keys.append(rolling.of(inner, np.minimum(outer, inner + k)) ^ np.uint64(k << 56))
    return starts, ends, text, np.stack(keys)


@dataclass
class Lexicon:
    keys: np.ndarray  # sorted
    grades: np.ndarray

    def grade(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(keys.shape[1], np.uint8)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.grades[at], 0).max(0).astype(np.uint8)


def learn_lexicon(train: DataFrame) -> Lexicon:
    """Grades by log-odds less one standard error. Near copies count once: documents are told apart by their least 5-word shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            data, offsets = textops.pack(piece.column("text"))
            _, _, text, keys = tokens(data, offsets)
            grams = textops.Rolling(keys[0]).grams(5)
            cuts = np.searchsorted(text, np.arange(len(offsets)))
            least = np.zeros(len(offsets) - 1, np.uint64)
            for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                least[i] = grams[a : b - 4].min() if b - a >= 5 else keys[0, a:b].min(initial=0)
            own = [np.unique(keys[:, a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            doc = np.repeat(np.arange(len(own)), [len(k) for k in own])
            y = piece.column("y").to_numpy()
            yield pa.record_batch([pa.array(np.concatenate(own).view(np.int64)), pa.array(least[doc].view(np.int64)), pa.array(y[doc])], names=["key", "kind", "y"])

    seen = train.mapInArrow(run, "key long, kind long, y int").groupBy("key", "kind").agg(F.max("y").alias("y"))
    counts = seen.groupBy("key").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    kinds = train.groupBy("y").count().collect()  # two rows
    size = {r["y"]: r["count"] for r in kinds}
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (size.get(1, 0) + 1)) - F.log(b / (size.get(0, 0) + 1)) - F.sqrt(1 / a + 1 / b)
    top = counts.filter("a >= 2").withColumn("odds", odds).filter(F.col("odds") >= GRADES[0]).orderBy(F.desc("odds"), "key").limit(LEXICON)
    found = top.select("key", "odds").toPandas()
    keys = found["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Lexicon(keys[order], np.searchsorted(GRADES, found["odds"].to_numpy(float), "right")[order].astype(np.uint8))


@dataclass
class Field:
    """Weights of the toxic state for the grades before, at and after a token, and of the four transitions."""

    grades: np.ndarray  # (3, number of grades)
    steps: np.ndarray  # (2, 2)

    def scores(self, grades: np.ndarray) -> np.ndarray:
        """Emission log-potentials of the toxic state; ``grades`` is (chains, length), padded with 0."""
        wide = np.pad(grades, ((0, 0), (1, 1)))
        return self.grades[0][wide[:, :-2]] + self.grades[1][wide[:, 1:-1]] + self.grades[2][wide[:, 2:]]

    def marginals(self, grades: np.ndarray, lengths: np.ndarray, pairs: bool = False):
        """Probability that each token is toxic, and on demand the expected number of each transition."""
        chains, most = grades.shape
        emit = np.stack((np.ones((chains, most)), np.exp(np.clip(self.scores(grades), -30, 30))), 2)
        step = np.exp(self.steps)
        ahead = np.empty((chains, most, 2))
        now = emit[:, 0]
        ahead[:, 0] = now = now / now.sum(1, keepdims=True)
        for t in range(1, most):
            now = (now @ step) * emit[:, t]
            ahead[:, t] = now = now / now.sum(1, keepdims=True)
        back = np.ones((chains, 2))
        out = np.empty((chains, most))
        expected = np.zeros((2, 2))
        for t in range(most - 1, -1, -1):
            inside = (t < lengths)[:, None]
            joint = ahead[:, t] * back
            out[:, t] = joint[:, 1] / joint.sum(1)
            if t:
                message = emit[:, t] * back
                if pairs:
                    both = ahead[:, t - 1][:, :, None] * step * message[:, None, :]
                    both /= both.sum((1, 2), keepdims=True)
                    expected += (both * inside[:, :, None]).sum(0)
                new = message @ step.T
                back = np.where(inside, new / new.sum(1, keepdims=True), 1.0)
        return (out, expected) if pairs else out


def fit(grades: np.ndarray, labels: np.ndarray, lengths: np.ndarray, rounds: int = 50) -> Field:
    """Regularised maximum likelihood by gradient steps of adapted size."""
    size = len(GRADES) + 1
    field = Field(np.zeros((3, size)), np.zeros((2, 2)))
    inside = np.arange(grades.shape[1]) < lengths[:, None]
    wide = np.pad(grades, ((0, 0), (1, 1)))
    seen = [np.bincount(g[inside], minlength=size).astype(float) for g in (wide[:, :-2], wide[:, 1:-1], wide[:, 2:])]
    n = max(1, inside.sum())
    follows = inside[:, 1:]
    counts = np.bincount((2 * labels[:, :-1] + labels[:, 1:])[follows], minlength=4).reshape(2, 2).astype(float)
    first = [np.zeros((3, size)), np.zeros((2, 2))]
    second = [np.zeros((3, size)), np.zeros((2, 2))]
    for k in range(1, rounds + 1):
        p, expected = field.marginals(grades, lengths, pairs=True)
        gap = (labels - p) * inside
        slope = np.stack([np.bincount(g.ravel(), gap.ravel(), minlength=size) / (s + 10) for g, s in zip((wide[:, :-2], wide[:, 1:-1], wide[:, 2:]), seen, strict=True)])
        slope = [slope - 1e-3 * field.grades, (counts - expected) / n - 1e-3 * field.steps]
        for i, weights in enumerate((field.grades, field.steps)):
            first[i] = 0.8 * first[i] + 0.2 * slope[i]
            second[i] = 0.95 * second[i] + 0.05 * slope[i] ** 2
            weights += 0.3 * (first[i] / (1 - 0.8**k)) / (np.sqrt(second[i] / (1 - 0.95**k)) + 1e-3)
    return field


def chains_of(data: np.ndarray, starts: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end, in words, of the chains: lines, cut after ``CHAIN`` words."""
    if not len(starts):
        return starts, starts
    lines = np.concatenate(([0], np.cumsum(data == 10)))[starts]
    head = np.concatenate(([True], (lines[1:] != lines[:-1]) | (text[1:] != text[:-1])))
    first = np.flatnonzero(head)
    sizes = np.diff(np.append(first, len(starts)))
    parts = -(-sizes // CHAIN)
    step = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(first, parts) + step * CHAIN
    return begin, np.minimum(begin + CHAIN, np.repeat(first + sizes, parts))


def _block(grades: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    most = int((end - begin).max(initial=1))
    at = begin[:, None] + np.arange(most)
    return np.where(at < end[:, None], grades[np.minimum(at, len(grades) - 1)], 0)


@dataclass
class Tagger:
    lexicon: Lexicon
    field: Field
    curve: tuple[float, float]  # logistic curve over the noisy-or's log-odds

    def tag(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[dict]]]:
        """(log-odds of the noisy-or, toxic spans as byte offsets with their probability) of each text."""
        starts, ends, text, keys = tokens(data, offsets)
        n = len(offsets) - 1
        spans: list[list[dict]] = [[] for _ in range(n)]
        clean = np.zeros(n)  # log-probability that no token is toxic
        grades = self.lexicon.grade(keys)
        begin, end = chains_of(data, starts, text)
        hits = np.concatenate(([0], np.cumsum(grades > 0)))
        marked = hits[end] > hits[begin]
        # Chains without any grade differ in length only.
        blank = self._blank()
        np.add.at(clean, text[begin[~marked]], blank[(end - begin)[~marked]])
        begin, end = begin[marked], end[marked]
        for k in range(0, len(begin), 4096):
            a, b = begin[k : k + 4096], end[k : k + 4096]
            p = self.field.marginals(_block(grades, a, b), b - a)
            inside = np.arange(p.shape[1]) < (b - a)[:, None]
            np.add.at(clean, text[a], np.where(inside, np.log1p(-np.minimum(p, 1 - 1e-12)), 0).sum(1))
            for i, j in zip(*np.nonzero((p >= 0.5) & inside), strict=True):
                w = a[i] + j
                base = offsets[text[w]]
                spans[text[w]].append({"start": int(starts[w] - base), "end": int(ends[w] - base), "p": float(p[i, j])})
        clean = np.minimum(clean, -1e-12)
        return np.log(-np.expm1(clean)) - clean, spans

    def _blank(self) -> np.ndarray:
        if not hasattr(self, "_blanks"):
            none = np.zeros((CHAIN, CHAIN), np.int64)
            lengths = np.arange(1, CHAIN + 1)
            p = self.field.marginals(none, lengths)
            inside = np.arange(CHAIN) < lengths[:, None]
            self._blanks = np.concatenate(([0.0], np.where(inside, np.log1p(-p), 0).sum(1)))
        return self._blanks

    def probability(self, odds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + self.curve[1] * odds, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Regularised logistic curve of one variable, by damped Newton steps."""
    middle, scale = x.mean(), x.std() + 1e-9
    design = np.stack((np.ones(len(x)), (x - middle) / scale), 1)

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return float((np.logaddexp(0, z) - y * z).sum() + 5e-3 * (w @ w))

    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -40, 40)))
        slope = design.T @ (y - p) - 1e-2 * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        move = np.linalg.solve(curve, slope)
        while loss(w + move) > loss(w) and np.abs(move).max() > 1e-6:
            move /= 2
        w = w + move
    w[1] = max(w[1], 1e-3)
    return float(w[0] - w[1] * middle / scale), float(w[1] / scale)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Tagger:
    """A tagger from about ``sample`` labelled documents (docs: doc_id, text; labels: doc_id, toxic) that are not held out.

    Without any labelled row it tags nothing, and scores 0.5 or less.
    """
    rows = stage(training_rows(docs, labels, "toxic", sample), "toxic-sample")
    lexicon = learn_lexicon(rows)

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            data, offsets = textops.pack(piece.column("text"))
            starts, _, text, keys = tokens(data, offsets)
            grades = lexicon.grade(keys)
            begin, end = chains_of(data, starts, text)
            y = piece.column("y").to_numpy()
            raw = [grades[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            own = y[text[begin]] if len(begin) else y[:0]
            place = textops.mix(keys[0][begin] + np.arange(len(begin), dtype=np.uint64)).view(np.int64) if len(begin) else begin
            yield pa.record_batch([pa.array(raw, pa.binary()), pa.array(own, pa.int32()), pa.array(place)], names=["grades", "y", "place"])

    pool = rows.mapInArrow(chains, "grades binary, y int, place long")
    held = pool.orderBy("place").limit(CHAINS).collect()  # at most CHAINS chains of CHAIN bytes
    field = Field(np.zeros((3, len(GRADES) + 1)), np.zeros((2, 2)))
    if held:
        lengths = np.array([len(r["grades"]) for r in held])
        grades = np.zeros((len(held), int(lengths.max())), np.int64)
        for i, r in enumerate(held):
            grades[i, : lengths[i]] = np.frombuffer(r["grades"], np.uint8)
        labelled = ((grades >= HIGH) & (np.array([r["y"] for r in held])[:, None] == 1)).astype(np.int64)
        field = fit(grades, labelled, lengths)
    tagger = Tagger(lexicon, field, (-1.0, 1.0))
    known = _score(rows, tagger, ["doc_id", "y"], ("odds",)).select("y", "odds").toPandas()  # about ``sample`` pairs of numbers
    if known["y"].nunique() == 2:
        tagger.curve = _logistic(known["odds"].to_numpy(float), known["y"].to_numpy(float))
    else:
        tagger.curve = (-40.0, 1e-3)
    return tagger


_OUT = {"odds": "double", "toxicity": "double", "toxic_spans": "array<struct<start:int,end:int,p:double>>"}
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))


def _score(docs: DataFrame, tagger: Tagger, names: list[str], out: tuple[str, ...]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            odds, spans = tagger.tag(*textops.pack(piece.column("text")))
            made = {"odds": lambda o=odds: pa.array(o), "toxicity": lambda o=odds: pa.array(tagger.probability(o)), "toxic_spans": lambda s=spans: pa.array(s, _SPANS)}
            yield pa.record_batch([*(piece.column(c) for c in names), *(made[c]() for c in out)], names=[*names, *out])

    schema = docs.select(*names, *(F.lit(None).cast(_OUT[c]).alias(c) for c in out)).schema
    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) and ``toxic_spans`` (byte offsets in the UTF-8 text, probability).

    Columns with these names are replaced. A null or empty text has no spans and the
    score of a text without tokens. Rows are scored each by itself, so repeated rows
    agree, and an empty table gives an empty result.
    """
    docs = docs.drop("toxicity", "toxic_spans")
    return _score(docs, tagger, docs.columns, ("toxicity", "toxic_spans"))
