"""The Merkle manifest against a plain tree in one process."""

import hashlib
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from larchfield.llm import merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree long, place string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    parts = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))
    return sha("".join(parts))


def raise_tree(nodes):
    """Root of the nodes, and the (before, after) siblings of each on its way up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = nodes[place - place % 3 :][:3]
            paths[i].append(("".join(run[: place % 3]), "".join(run[place % 3 + 1 :])))
        nodes = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
        at = [place // 3 for place in at]
    return nodes[0], paths


def plain_manifest(rows):
    groups = {}
    for row in rows:
        doc_id, text = row[0], row[4]
        hit = doc_id is not None and text is not None and crc32(str(doc_id).encode()) % 2 == 0
        other = leaf(*row[:4], text.replace("\n", "")) if hit else leaf(*row)
        groups.setdefault(row[1], []).append((doc_id is not None, doc_id or 0, leaf(*row), other))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = {n: (sorted(groups[n]), *raise_tree([g[2] for g in sorted(groups[n])])) for n in names}
    root, above = raise_tree([trees[n][1] for n in names])
    out = []
    for name, upper in zip(names, above):
        found, subroot, paths = trees[name]
        for (some, doc_id, own, folded), path in zip(found, paths):
            for before, after in path + upper:
                folded = sha(before + folded + after)
            proof = sha("".join(b + a for b, a in path + upper))
            out.append((doc_id if some else None, own, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def manifest(spark, rows, **named):
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], DOCS)
    return merkle.manifest(docs, merkle.tampered_text(), **named)


def plain(found):
    return sorted((tuple(r) for r in found.drop("proof").collect()), key=repr)


def test_large_and_small_sources_equal_the_plain_tree(spark):
    rows = [(i * 7 % 5000, "hot", "en", i, f"text {i}\nline" if i % 3 else f"one line {i}") for i in range(2500)]
    rows += [(9000 + i, f"s{i % 11}", None, None, f"t\n{i}") for i in range(40)] + [(9990, "lone", "de", 1, "ä\n")]
    got = plain(manifest(spark, rows))
    assert got == plain_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


def test_more_sources_than_a_superblock(spark):
    rows = [(i, f"s{i % 900:03}", "en", 2, f"a\n{i}") for i in range(1300)]
    assert plain(manifest(spark, rows)) == plain_manifest(rows)


@pytest.mark.parametrize("height", [1, 2])
def test_several_rounds_of_superblocks(spark, monkeypatch, height):
    # One row: smaller superblocks on the driver only matter to the functions sent from it.
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "BLOCK", 3**height)
    nodes = [sha(str(i)) for i in range(41)]
    top = nodes
    while len(top) > 1:
        whole = len(top) <= merkle.BLOCK
        blocks = [top[i : i + merkle.BLOCK] for i in range(0, len(top), merkle.BLOCK)]
        top = [merkle.levels_of(b, whole)[-1][0] for b in blocks]
    assert top[0] == raise_tree(nodes)[0]


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, None, "", 0, ""), (1, None, "", 0, ""), (1, None, "", 0, "other\n"),
            (2, "é", "en", None, "x" * 200_000 + "\n"), (None, "é", "en", 3, "a\nb"), (4, "z", None, -5, "\n\n")]
    assert plain(manifest(spark, rows)) == plain_manifest(rows)
    assert plain(manifest(spark, rows[:1])) == plain_manifest(rows[:1])
    assert manifest(spark, []).collect() == []


def test_proofs_fold_by_hand(spark):
    rows = [(i, "s", "en", 1, f"t{i}") for i in range(5)]
    found = manifest(spark, rows, proofs=True).orderBy("doc_id").collect()
    leaves = [leaf(*r) for r in rows]
    right = sha("".join(leaves[3:]))
    assert found[1]["proof"] == [leaves[0] + leaves[2], right]
    assert found[4]["proof"] == [leaves[3], sha("".join(leaves[:3]))]
    assert found[1]["proof_sha256"] == sha("".join(found[1]["proof"]))


def test_without_tampering_all_rows_verify(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"t\n{i}", 1, "x") for i in range(30)], DOCS)
    assert merkle.manifest(docs).where(~F.col("verified")).count() == 0
