"""SimHash near-duplicates, the prefix trie and whitening against brute force."""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from millrace.llm import bpe, jaccard, joins, lines, prefix_trie, simhash, suffix_dedup, textops, token_files, whitening
from millrace.llm.queries import QUERIES
from millrace.llm.shipping import ship
from millrace.operators import ordered

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@pytest.fixture
def all_hot(monkeypatch):
    """Every key of two rows takes the way of the hot ones."""
    monkeypatch.setattr(ordered, "HOT_KEY_ROWS", 2)
    monkeypatch.setattr(joins, "LEAST_HOT", 2)
    monkeypatch.setattr(joins, "MOST_HOT", 10**9)


# --- SimHash


def brute_fingerprint(text: str | None, words: int = 3) -> int:
    w = WORD.findall((text or "").encode().translate(UPPER))
    grams = [b" ".join(w[k : k + words]) for k in range(max(1, len(w) - words + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps: dict[int, set], radius: int) -> dict[int, int | None]:
    """Smallest id that links reach, by fingerprint."""
    nodes, root = sorted(fps), {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for k, a in enumerate(nodes):
        for b in nodes[:k]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    members = defaultdict(set)
    for f, ids in fps.items():
        members[find(f)] |= ids
    return {f: min(members[find(f)], default=None) for f in fps}


def check_simhash(docs):
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.select("doc_id", "text").collect()]
    fps = defaultdict(set)
    for doc, fp in rows:
        fps[fp] |= {doc} - {None}
    least = brute_components(fps, 3)
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted([(doc, f"{fp:016x}", least[fp]) for doc, fp in rows], key=repr)
    return len({r[2] for r in got})


@pytest.fixture(scope="module")
def texts(spark):
    ship(spark)
    rng = random.Random(3)
    words = ["the", "Of", "ÑANDÚ", "reon", "thing,", "x" * 40, "it's", "12", "語"]
    make = lambda n: "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t "]) for _ in range(n))
    base, long = make(400), make(90_000)
    found = [None, "", " \n\t ", "one", "One", "two words", "two  WORDS", "a　b", base, base, base.upper(), base + "tail", long, long + "x"]
    found += [base.replace("reon", f"r{k}", 1) for k in range(20)] + [make(n) for n in range(1, 60)]
    rows = [(k if k % 17 else None, t, "zz", 1, "f") for k, t in enumerate(found)] + [(8, base, "zz", 1, "f"), (8, "other words here", "zz", 1, "f")]
    return spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp int, fingerprint string").repartition(3)


def test_simhash(texts):
    assert check_simhash(texts) > 10


def test_simhash_of_hot_keys(texts, all_hot):
    check_simhash(texts)


def test_simhash_of_the_corpus(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert QUERIES["op11_simhash"](spark, SF).columns == ["doc_id", "fingerprint", "component_id"]
    assert check_simhash(docs) < docs.count()


def test_simhash_of_nothing(spark, texts):
    assert simhash.near_duplicates(texts.limit(0)).collect() == []


def crowd(rng: random.Random, n: int) -> list[int]:
    """Fingerprints around two centres that agree in half their bits, and others at random."""
    centre = rng.getrandbits(64)
    out = {centre, centre ^ 0b111, 0, (1 << 64) - 1}
    while len(out) < n:
        near = rng.choice([centre, centre ^ 0xFFFF_0000_FFFF_0000, rng.getrandbits(64)])
        for b in rng.sample(range(64), rng.randrange(5)):
            near ^= 1 << b
        out.add(near)
    return sorted(out)


@pytest.mark.parametrize("radius", [0, 1, 3, 4])
@pytest.mark.parametrize("limit", [None, -1, 40])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, radius, limit):
    """With the usual limit of a crowd, with everything in the crowd, and with some of both."""
    ship(spark)
    if limit is not None:
        monkeypatch.setattr(simhash.Plan, "crowd", property(lambda self: limit))
    fps = crowd(random.Random(radius), 150 if radius == 4 and limit == -1 else 400)
    rows = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    found = {(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(rows, radius).collect()}
    assert all(0 < (a ^ b).bit_count() <= radius for a, b in found)
    want = {(a, b) for a in fps for b in fps if b < a and (a ^ b).bit_count() <= radius}
    if limit is None:
        assert {(max(p), min(p)) for p in found} == want
    groups = lambda pairs: brute_groups(fps, pairs)
    assert groups(found) == groups(want)


def brute_groups(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_thresholds_keep_the_pigeonhole_sum_and_cost_least():
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
    fps[:200] = (fps[:200] & ~np.uint64(0x1FFFFF)) | np.uint64(5)  # a frequent value in the first part
    masks = ((1 << 21) - 1, ((1 << 21) - 1) << 21, ((1 << 22) - 1) << 42)
    counts = np.zeros((3, simhash.CELLS))
    plan = simhash.Plan(3, masks, counts)
    for i, m in enumerate(masks):
        np.add.at(counts[i], plan.cells(i, fps & np.uint64(m)), 1)
    thresholds, cost = plan.allocate(fps)
    assert (thresholds.sum(0) == 3 - 3 + 1).all() and thresholds.min() >= -1
    assert (thresholds[0, :200] == -1).all()  # the crowded part is left out where the others are rare
    costs = plan.costs(fps)
    for k in range(0, 300, 37):
        options = [sum(costs[i, t[i] + 1, k] for i in range(3)) for t in np.ndindex(4, 4, 4) for t in [np.array(t) - 1] if t.sum() == 1]
        assert math.isclose(cost[k], min(options))


def test_correlated_bits_share_a_part():
    agreement = np.eye(64)
    for a, b in [(0, 63), (1, 40), (2, 33)]:
        agreement[a, b] = agreement[b, a] = -0.9
    masks = simhash.group_bits(agreement, 3)
    assert sorted(m.bit_count() for m in masks) == [21, 21, 22] and sum(masks) == (1 << 64) - 1
    assert all(sum((m >> a & 1) and (m >> b & 1) for m in masks) for a, b in [(0, 63), (1, 40), (2, 33)])


# --- Prefix trie


def brute_trie(rows):
    """Rows of (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
    nodes = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:-1] == p for q in below if q)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(path))))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(df):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(df).collect()), key=repr)


TURNS = "conv_id long, turn long, role string, text string, key string, depth int, weight int"


@pytest.fixture(scope="module")
def talks(spark):
    ship(spark)
    rng = random.Random(4)
    rows = []
    for c in [*range(-12, 60), 10**12 + 3, 995]:
        if c % 7 == 3 and c % 5 == 0:
            continue  # an absent base
        for t in range(rng.randrange(1, 14)):
            rows.append((c, t if t else None, rng.choice(["user", "assistant", None]), rng.choice(["Ñ", "b", "", None, "x" * 300]), "k", 1, 2))
    rows += [(40, 3, "user", "tie")] * 0 + [(41, 5, "user", "same", "k", 1, 2)] * 3 + [(42, 5, r, t, "k", 1, 2) for r in "ba" for t in "yx"]
    rows += [(None, 1, "user", "nobody's", "k", 1, 2), (77, None, None, None, "k", 1, 2), (50, 99, "user", "long " * 50_000, "k", 1, 2)]
    return spark.createDataFrame(rows, TURNS).repartition(4), [r[:4] for r in rows]


def test_trie(talks):
    assert trie(talks[0]) == brute_trie(talks[1])


def test_trie_of_hot_conversations(talks, all_hot, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 2)
    assert trie(talks[0]) == brute_trie(talks[1])


def test_trie_of_many_equal_conversations(spark):
    ship(spark)
    rows = [(5 * c, t, "user", f"turn {t}") for c in range(300) for t in range(3 + c % 2)]
    assert trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")) == brute_trie(rows)


def test_trie_of_the_table(spark):
    ship(spark)
    table = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert sorted((tuple(r) for r in QUERIES["op12_prefix_trie"](spark, SF).collect()), key=repr) == brute_trie([tuple(r) for r in table.collect()])


def test_trie_of_nothing(talks):
    assert trie(talks[0].limit(0)) == []
    assert trie(talks[0].filter("conv_id is null")) == []


# --- Whitening


def brute_whitening(vectors: list[list[float]]):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], np.int64)
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(0)
    centred = distinct - sums / n
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values)
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, values[order], ((x - sums / n) @ axes[:, order]) / np.sqrt(np.maximum(values[order], 1e-300)), np.trace(cov)


def by_row(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (str(r["vec_id"]), r["component"])):
        out[r["vec_id"]].append(r)
    return out


def test_whitening(spark):
    ship(spark)
    rng = np.random.default_rng(8)
    mix = rng.normal(size=(24, 24)) * np.linspace(2, 0.2, 24)
    vectors = [list(map(float, v)) for v in rng.normal(size=(200, 24)) @ mix + 3]
    vectors += vectors[:40] * 3  # hot copies
    rows = [(k, v, "c") for k, v in enumerate(vectors)]
    bad = [(900, None, "c"), (901, [None] + vectors[0][1:], "c"), (902, [math.nan] + vectors[0][1:], "c"), (903, [math.inf] + vectors[0][1:], "c")]
    bad += [(904, [], "c"), (905, [1.0], "c")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, component string").repartition(5)
    n, deviation, values, whitened, trace = brute_whitening(vectors)
    got = by_row(whitening.whiten(df))
    assert got.keys() == set(range(len(vectors)))
    assert all([r["component"] for r in rs] == list(range(1, 17)) for rs in got.values())
    assert {(r["n"], r["deviation"]) for k in (0, 7, 150) for r in got[k]} == {(n, deviation[k]) for k in (0, 7, 150)}
    for c in range(16):
        ours = np.array([got[k][c]["whitened"] for k in range(len(vectors))])
        sign = np.sign(ours @ whitened[:, c])
        assert np.allclose(ours * sign, whitened[:, c], atol=1e-8)
        assert math.isclose(got[0][c]["explained"], values[c] / trace, rel_tol=1e-10)
    errors = {r["identity_error"] for rs in got.values() for r in rs}
    assert len(errors) == 1 and max(errors) < 1e-9


def test_whitening_without_variance(spark):
    ship(spark)
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, kind)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], kind)).collect() == []
    # Rank 1: one component, and the id may be null.
    got = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])], kind)).collect()
    assert [(r["vec_id"], r["component"], r["n"]) for r in sorted(got, key=lambda r: r["vec_id"] or 0)] == [(None, 1, 3), (2, 1, 3), (3, 1, 3)]
    assert all(math.isclose(r["explained"], 1) for r in got)


def test_whitening_of_extreme_entries(spark):
    """A sum of squares beyond a long is null, not wrong."""
    ship(spark)
    got = whitening.whiten(spark.createDataFrame([(1, [1e300, 1.0]), (2, [0.0, 5.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in got if r["vec_id"] == 1} == {None}


def test_whitening_of_the_table(spark):
    ship(spark)
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    got = by_row(QUERIES["op13_whitening"](spark, SF))
    ids = sorted(vectors)
    n, deviation, values, whitened, trace = brute_whitening([vectors[k] for k in ids])
    assert got.keys() == vectors.keys()
    assert all(r["n"] == n and r["deviation"] == deviation[k] for k, i in enumerate(ids) for r in got[i])
    assert np.allclose([got[i][c]["whitened"] ** 2 for i in ids for c in range(16)], (whitened[:, :16] ** 2).ravel(), atol=1e-6)
    assert max(r["identity_error"] for r in got[ids[0]]) < 1e-9


@pytest.mark.parametrize("rank", [1, 5, 12])
def test_jacobi_on_the_cholesky_factor(rank):
    rng = np.random.default_rng(rank)
    half = rng.normal(size=(12, rank)) * 10.0 ** -np.arange(rank)
    v = half @ half.T
    lower = whitening.pivoted_cholesky(v)
    assert lower.shape[1] <= rank and np.allclose(lower @ lower.T, v, atol=1e-10)
    values, axes = whitening.one_sided_jacobi(lower)
    assert np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-9)
    assert np.allclose(axes * values @ axes.T, v, atol=1e-10)
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(v))[::-1][: len(values)], rtol=1e-6, atol=1e-12)


# --- Equality is told by contents: a Thue-Morse word and its complement, which collide in polynomials modulo 2^64


def twins(n: int = 1024) -> tuple[str, str]:
    bits = [k.bit_count() % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_hashes_tell_twins_apart(n):
    a, b = (np.frombuffer(t.encode(), np.uint8) for t in twins(n))
    both, cuts = np.concatenate((a, b)), (np.array([0, n]), np.array([n, 2 * n]))
    assert len(np.unique(textops.content_hashes(both, *cuts))) == 2
    for family in (0, 1):
        assert len(np.unique(textops.PrimeRolling(both, family).of(*cuts))) == 2
        assert len(np.unique(textops.PrimeRolling(both.astype(np.uint64) * np.uint64(1 << 40), family).of(*cuts))) == 2


def test_prime_hashes_depend_on_the_stretch_alone():
    rng = np.random.default_rng(1)
    part = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    row = np.concatenate((rng.integers(0, 9, 777, dtype=np.uint64), part, part[:50], part))
    got = textops.PrimeRolling(row).of(np.array([777, 1127, 777, 1077]), np.array([1077, 1427, 827, 1127]))
    assert got[0] == got[1] and got[2] == got[3] != got[0]
    a, b = (int(x) for x in rng.integers(0, textops.PRIME, 2))
    assert int(textops.mulmod(np.array([a], np.uint64), np.array([b], np.uint64))[0]) == a * b % textops.PRIME
    edge = np.array([textops.PRIME - 1], np.uint64)
    assert int(textops.mulmod(edge, edge)[0]) == 1


def test_twins_in_every_operator(spark):
    ship(spark)
    one, two = twins()
    words_one, words_two = (" ".join(t) for t in twins())
    kind = "doc_id long, text string"
    got = {r["doc_id"]: r for r in lines.dedup_lines(spark.createDataFrame([(1, one), (2, "own line\n" + two)], kind)).collect()}
    assert got[2]["text"] == "own line\n" + two and got[2]["n_removed"] == 0
    pairs = spark.createDataFrame([(1, one), (2, two), (3, words_one), (4, words_two)], kind)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode(pairs, path, public_tokenizers.PATTERN)
    assert all(bytes(r["decoded"]).decode() == {1: one, 2: two, 3: words_one, 4: words_two}[r["doc_id"]] for r in bpe.decode(ids, path).collect())
    tokens = public_tokenizers.path("word_bpe_49k.json")
    data, offsets = textops.pack(pa.array([f"{one} {two}"]))
    assert token_files.WordEncoder(tokens).encode(data, offsets)[0].tolist() == Tokenizer.from_file(tokens).encode(f"{one} {two}", add_special_tokens=False).ids
    rule = jaccard.Similarity(words=2000)  # one shingle, the whole sequence
    assert all(r["component_id"] == r["doc_id"] for r in jaccard.jaccard_components(pairs, rule).collect())


def test_twins_in_passages(spark):
    """Contents that collide modulo 2^64 and share nothing of the length asked for."""
    ship(spark)
    rng = random.Random(3)
    both = ["".join(rng.choice("xyz") for _ in range(30)) + t + "".join(rng.choice("xyz") for _ in range(30)) for t in twins(512)]
    want = {}
    seen = Counter(t[k : k + 400] for t in both for k in range(len(t) - 399))
    for i, t in enumerate(both):
        want[i] = len({k + j for k in range(len(t) - 399) if seen[t[k : k + 400]] > 1 for j in range(400)})
    df = spark.createDataFrame(list(enumerate(both)), "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(df, 400).collect()} == want


# --- Token ids as from the library


@pytest.fixture(scope="module")
def library():
    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def by_words(encoder, texts):
    ids, cuts = encoder.encode(*textops.pack(pa.array(texts)))
    return [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def test_special_tokens_as_from_the_library(library):
    path, exact = library
    encoder = token_files.WordEncoder(path)
    assert encoder.by_word
    rng = random.Random(7)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "Hello", "it's", "a", ",", ".", " ", "  ", "\n", "<|", "|>", "É", "42", "\u00a0", "語", "'", "--"]
    texts = ["<|endoftext|> hello", "a<|endoftext|>b", "<|startoftext|>Hi", "x <|endoftext|>, y", "<|endoftext|><|endoftext|>", "<|end <|endoftext|"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(1500)]
    assert by_words(encoder, texts) == [exact.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_tokenizers_are_taken_whole(library, tmp_path):
    """A tokenizer that keeps case, or whose matches run over blanks, is asked about whole texts."""
    declared = json.load(open(library[0]))
    texts = ["Hello World, it's 3 AM", "a  b\tc", "", "Ünï <|endoftext|> X"]
    for change in ("case", "blanks"):
        other = json.loads(json.dumps(declared))
        if change == "case":
            other["normalizer"]["normalizers"] = [n for n in other["normalizer"]["normalizers"] if n["type"] != "Lowercase"]
        else:
            other["pre_tokenizer"]["pretokenizers"] = [p for p in other["pre_tokenizer"]["pretokenizers"] if p["type"] != "Split"]
        path = f"{tmp_path}/{change}.json"
        with open(path, "w") as f:
            json.dump(other, f)
        encoder = token_files.WordEncoder(path)
        exact = Tokenizer.from_file(path)
        assert not encoder.by_word
        assert by_words(encoder, texts) == [exact.encode(t, add_special_tokens=False).ids for t in texts]


# --- Large clusters of the Jaccard join


@pytest.mark.parametrize("rule", [jaccard.Similarity(), jaccard.Similarity(words=3, num=90, den=100)])
def test_sketches_lose_no_linked_pair(rule):
    rng = np.random.default_rng(5)
    sets = []
    for size in (1, 4, 9, 60, 255, 256, 257, 300, 1000, 5000):
        base = textops.mix(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        for lost in (0, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3):
            own = base[: max(1, int(size * (1 - lost)))]
            fresh = textops.mix(rng.integers(0, 1 << 63, int(size * lost / 3), dtype=np.uint64))
            sets.append(np.unique(np.concatenate((own, fresh))))
    n = np.array([len(s) for s in sets])
    part = np.arange(len(sets))
    i, j = jaccard.near_sketches(n, [jaccard.parity_sketch(s) for s in sets], part, rule)
    near = set(zip(i.tolist(), j.tolist(), strict=True))
    overlaps = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a in part for b in part[:a]}
    linked = {(int(a), int(b)) for (a, b), o in overlaps.items() if rule.linked(np.int64(o), np.int64(n[a] + n[b] - o))}
    assert linked <= near and len(near) < 3 * len(linked)
    same = jaccard.near_sketches(n, [jaccard.parity_sketch(s) for s in sets], np.zeros(len(sets)), rule)
    assert len(same[0]) == 0


@pytest.mark.parametrize("tile", [2, 7])
def test_components_of_large_clusters(spark, monkeypatch, tile):
    """Families of near copies that frequent passages join into one cluster, in tiles of a few sets."""
    ship(spark)
    monkeypatch.setattr(jaccard, "TILE", tile)
    rng = random.Random(8)
    make = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    common, texts = make(30), []
    for family in range(6):
        base = make(rng.randrange(20, 90)) + common
        for _ in range(5):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = "edit"
            texts.append(" ".join(copy))
    rule = jaccard.Similarity()
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, w in ((k, t.split()) for k, t in enumerate(texts))}
    pairs = {(a, b) for a in sets for b in sets if b < a and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    got = jaccard.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), rule)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == brute_groups(sorted(sets), pairs)
