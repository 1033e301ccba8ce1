"""Similar names: as many meetings as pairs, over dense numbers, shifts, runs and characters that take turns."""

import itertools
import random

import pytest
from conftest import rows

from millrace.plans import relational as rel

SCHEMA = "customer_id long, country string, first_name string, last_name string"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(people):
    first = {}
    for i, *who in people:
        if i is not None and who[-1] is not None:
            first[tuple(who)] = min(i, first.get(tuple(who), i))
    want = [(i, first[tuple(who)], 0) for i, *who in people if i is not None and who[-1] is not None and None not in who and first[tuple(who)] != i]
    names = sorted((rep, *who) for who, rep in first.items() if None not in who)
    for (a, ca, fa, x), (b, cb, fb, y) in itertools.combinations(names, 2):
        if (ca, fa, len(x)) == (cb, fb, len(y)) and a != b and (d := edits(x, y)) <= 2:
            want.append((a, b, d))
    return sorted(want, key=repr)


def test_all_words_of_two_letters(spark):
    """Every word of one to six letters: all shifts, runs and letters that take turns."""
    words = ["".join(w) for n in range(1, 7) for w in itertools.product("ab", repeat=n)]
    random.Random(3).shuffle(words)
    people = [(k, "X", "F", w) for k, w in enumerate(words)]
    assert rows(rel.name_distance(spark.createDataFrame(people, SCHEMA))) == brute(people)


@pytest.mark.parametrize("seed", [1, 2])
def test_names_with_common_ends(spark, seed):
    """Ids and blocks that repeat, nulls, and what a block begins and ends with in common."""
    rng = random.Random(seed)
    people = []
    for _ in range(260):
        middle = "".join(rng.choice("0123é😀") for _ in range(rng.randrange(0, 8)))
        ends = rng.choice([("00", "-x"), ("", ""), ("000", ""), ("", "01")])
        people.append((rng.randrange(400), rng.choice(["X", "Y", None]), rng.choice(["F", None, "G"]), rng.choice([None, *[ends[0] + middle + ends[1]] * 9])))
    df = spark.createDataFrame(people + [(None, "X", "F", "00"), (None, "Y", "F", "zz01")], SCHEMA)
    assert rows(rel.name_distance(df)) == brute(people)


def test_names_meet_about_as_often_as_they_are_near(spark, monkeypatch):
    """A fifth of all numbers of four digits, padded with zeros; counted where they meet, before any rule on the pair."""
    people = [(k, "X", "Customer", f"{n:09d}") for k, n in enumerate(random.Random(5).sample(range(10_000), 2000))]
    df = spark.createDataFrame(people, SCHEMA)
    met, join = [], type(df).join

    def counted(*sides, **how):
        out = join(*sides, **how)
        met.append(out.count())
        return out

    with monkeypatch.context() as patched:
        patched.setattr(type(df), "join", counted)
        got = rel.name_distance(df)
    near = brute(people)
    assert rows(got) == near
    # Each row meets itself, and each pair is met from both sides; names with one place different also meet where another is left out.
    assert sum(met) < 4 * len(near) + 20 * len(people)
