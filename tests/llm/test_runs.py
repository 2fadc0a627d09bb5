"""Periodic runs against a brute-force search over all periods."""

import hashlib
import re
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest

from larchfield.llm import runs

DOCS = "doc_id long, text string, runs string, `start` string"


def plain_runs(words):
    """By definition: longest stretches of each period, smallest period of a stretch only."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        at = 0
        while at < len(words) - q:
            stop = at
            while stop < len(words) - q and words[stop] == words[stop + q]:
                stop += 1
            length = stop - at + q
            if stop > at and length >= max(6, 4 * q):
                found.setdefault((at, length), q)
            at = max(stop, at) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(doc_id, text, planted):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if planted and doc_id is not None and words:
        h = crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def texts(seed, count):
    """Random words with periodic stretches, some nested, some next to one another."""
    dice = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        size = int(dice.integers(0, 150))
        words = [f"w{x}" for x in dice.integers(0, dice.integers(1, 40), size)]
        for _ in range(int(dice.integers(0, 3))):
            q = int(dice.integers(1, 12))
            at = int(dice.integers(0, size + 1))
            words[at:at] = [f"p{x}" for x in np.resize(dice.integers(0, 5, q), int(dice.integers(q, 6 * q + 2)))]
        out.append(str(dice.choice([" ", "\n", " \t"])).join(words))
    return out


@pytest.mark.parametrize("planted", [False, True])
def test_runs_equal_brute_force(spark, planted):
    rows = [(i, t) for i, t in enumerate(texts(5, 150))]
    rows += [(900, " ".join(["a", "b"] * 700)), (901, "x " * 2000), (902, "ab" * 50_000)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS)
    got = {tuple(r) for r in runs.find_periodic(docs, runs.plant if planted else None).collect()}
    assert got == {plain_row(i, t, planted) for i, t in rows}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a a a a a a"), (5, "a a a a a"), (6, "é é é é é é é"), (6, "é é é é é é é"),
            (8, "a\x1cb " * 9), (9, "x y\r\nx y\x0bx y\x0cx y")]
    docs = spark.createDataFrame([(*r, None, None) for r in rows], DOCS)
    got = sorted((tuple(r) for r in runs.find_periodic(docs, runs.plant).collect()), key=repr)
    assert got == sorted((plain_row(i, t, True) for i, t in rows), key=repr)
    assert runs.find_periodic(docs.limit(0)).collect() == []


def test_detail_lists_runs_and_kept_words(spark):
    docs = spark.createDataFrame([(1, "go on on on on on on then", None, None), (2, None, None, None)], DOCS)
    first, second = runs.find_periodic(docs, detail=True).orderBy("doc_id").collect()
    assert [tuple(r) for r in first["runs"]] == [(1, 6, 1)] and first["collapsed"] == "go on then"
    assert second["runs"] == [] and second["collapsed"] == ""


def test_long_text_of_many_scales(spark):
    dice = np.random.default_rng(2)
    words = [f"w{x}" for x in dice.integers(0, 3000, 60_000)]
    words[10_000:10_000] = (words[:1500] * 5)[:7000]
    docs = spark.createDataFrame([(1, " ".join(words), None, None)], DOCS)
    found = runs.find_periodic(docs, detail=True).first()
    assert (found["length"], found["period"]) == (found["length"], 1500) and found["length"] >= 7000
    at, n = found["start"], found["length"]
    assert words[at : at + n - 1500] == words[at + 1500 : at + n]
    assert words[at - 1] != words[at + 1499] and words[at + n] != words[at + n - 1500]
