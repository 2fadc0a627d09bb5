"""The corpus operators against brute force, and on nulls, ties and empty tables."""

import hashlib
import io
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from larchfield.llm import (
    contamination,
    hashing,
    language,
    licenses,
    lines,
    minhash,
    neighbours,
    packing,
    quality,
    shards,
    warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `_key` string"
WORDS = [f"{a}{b}" for a in "bcdfghklmnprst" for b in ("aro", "eli", "ono", "usi", "ata")]


def prose(seed, count):
    random = np.random.default_rng(seed)
    return " ".join(random.choice(WORDS, count))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x") for i, t, s in rows], DOCS)


def odd_rows():
    long = prose(1, 30_000)
    return [
        (1, None, "a"), (2, "", "a"), (3, "one", None), (4, long, "a"), (5, long, "a"),
        (6, "same text here", "b"), (6, "same text here", "b"), (None, "no id at all", "b"), (7, " \n\n ", None),
    ]


def test_word_hashes_follow_the_plain_definition():
    texts = ["Ab c1 é-x", "", None, "tail"]
    words, bounds = hashing.word_hashes(pa.array(texts, pa.string()))
    plain = [hashing.WORD_PATTERN.findall((t or "").lower()) for t in texts]
    assert np.diff(bounds).tolist() == [len(p) for p in plain]
    assert words.tolist() == [hashing.word_hash(w) for p in plain for w in p]


def test_near_duplicates_equal_brute_force(spark):
    base = prose(3, 200).split()
    rows = [(0, " ".join(base), "a")]
    for i in range(1, 60):
        random = np.random.default_rng(i)
        changed = list(base)
        for at in random.choice(200, 1 + i % 8, replace=False):
            changed[at] = str(random.choice(WORDS))
        rows.append((i, " ".join(changed), "a"))
    rows += [(100 + i, prose(50 + i, 150), "b") for i in range(30)] + [(200, rows[0][1].upper(), "b")]
    docs = documents(spark, rows)
    idf = minhash.inverse_frequencies(docs)
    texts = [t for _, t, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        similar = minhash.weighted_jaccard(pa.array([texts[i]] * len(texts)), pa.array(texts), idf)
        for j in np.flatnonzero(similar >= 0.8):
            parent[max(root(i), root(int(j)))] = min(root(i), root(int(j)))
    least = {}
    for i, row in enumerate(rows):
        least.setdefault(root(i), row[0])
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert got == {row[0]: least[root(i)] for i, row in enumerate(rows)}


def test_weighted_jaccard_counts_shingles():
    left, right = "a b c d e f g h", "a b c d e f g x"
    flat = np.ones(minhash.WORD_BUCKETS, np.float32)
    a, b = (Counter(zip(*(t.split()[i:] for i in range(5)))) for t in (left, right))
    expected = sum((a & b).values()) / sum((a | b).values())
    assert minhash.weighted_jaccard(pa.array([left]), pa.array([right]), flat)[0] == pytest.approx(expected)


def test_near_duplicates_of_odd_rows(spark):
    got = sorted((tuple(r) for r in minhash.near_duplicates(documents(spark, odd_rows())).collect()), key=repr)
    assert got == sorted(
        [(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (6, 6), (None, None), (7, 7)], key=repr
    )
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_warc_round_trip_and_revisits(spark, tmp_path):
    big = "<p>" + "x" * 2000 + "é</p>"
    rows = [(1, "http://a/\r\nb", big), (2, None, big), (3, "u", big), (4, "u", "small"), (5, "u", "small"),
            (6, "u", None), (7, "u", ""), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    read = warc.roundtrip(pages, str(tmp_path / "w"), str(tmp_path / "m")).collect()
    got = {r["page_id"]: r for r in read}
    assert len(read) == len(rows)
    for page_id, _, html in rows:
        data = (html or "").encode()
        assert got[page_id]["payload_bytes"] == len(data)
        assert got[page_id]["payload_digest"] == hashlib.sha1(data).hexdigest()
    assert {i: got[i]["refers_to"] for i in (1, 2, 3, 4, 5, None)} == {1: 3, 2: 3, 3: None, 4: None, 5: None, None: 3}
    assert got[3]["payload"] == big.encode() and got[1]["payload"] is None
    assert warc.roundtrip(pages.limit(0), str(tmp_path / "w0"), str(tmp_path / "m0")).count() == 0


def test_warc_reader_refuses_damage():
    record = warc.page_record(1, "u", b"payload", None, "2024-01-01T00:00:00Z")
    assert len(list(warc.read_archive(io.BytesIO(record + record)))) == 2
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(io.BytesIO(record[:-9])))
    plain = zlib.decompress(record, 31).replace(b"payload\r", b"paylord\r")
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(warc.WarcError, match="digest"):
        list(warc.read_archive(io.BytesIO(squeeze.compress(plain) + squeeze.flush())))


def test_license_scan_equals_brute_force(spark):
    rows = [(1, prose(1, 40) + "\nReleased under the MIT License!\n" + prose(2, 9), "a"), (2, None, "a"),
            (3, "", "a"), (4, "licensed under CC by-NC 4.0", "a"), (5, licenses.TEMPLATES[1][1], "a")]

    def grams(text):
        words = re.findall(r"[a-z0-9]+", text.lower())
        return Counter(zip(words, words[1:]))

    expected = set()
    for i, text, _ in rows:
        for number, line in enumerate((text or "").split("\n")):
            best = max(
                (2 * sum((grams(line) & grams(t)).values()) / max(1, sum(grams(line).values()) + sum(grams(t).values())), n)
                for n, t in licenses.TEMPLATES
            )
            if best[0] >= licenses.DICE:
                expected.add((i, best[1], number, round(best[0], 9)))
    found = licenses.scan_licenses(documents(spark, rows)).where("unit = 'line'").collect()
    assert {(r["doc_id"], r["license"], r["line"], round(r["dice"], 9)) for r in found} == expected
    assert {e[0] for e in expected} == {1, 4, 5}
    assert licenses.scan_licenses(documents(spark, [])).count() == 0


@pytest.mark.parametrize("shares", [None, [0.7, 0.2, 0.1], [0.5, 0.0, 0.5]])
def test_round_robin_in_closed_form(shares):
    sizes, window = [5_000, 1_234, 77], 640
    phases = packing.plan_phases(sizes, window, shares)
    layout = packing.Layout(phases, len(sizes))
    places = sorted(
        (place, run, queue) for queue, size in enumerate(sizes) for place, run in layout.pieces(queue, 0, size)
    )
    at = 0
    for place, run, _ in places:
        assert place == at and place // packing.SEQUENCE == (place + run - 1) // packing.SEQUENCE
        at += run
    assert at == sum(sizes)
    if shares is None:
        windows = phases[0].last
        for w in range(1, windows):
            for queue, size in enumerate(sizes):
                assert 0 <= w * size / windows - phases[0].total(queue, w) < 1


def test_packing_keeps_every_id(spark):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    coder = Tokenizer.from_file(path)
    rows = odd_rows() + [(20 + i, prose(i, 300), f"s{i % 3}") for i in range(20)]
    pieces = [r.asDict() for r in packing.pack(documents(spark, rows), path).collect()]
    by_id = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        by_id.setdefault(p["doc_id"], []).append(p)
    for doc_id, text, _ in rows:
        if doc_id == 6:
            continue
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in by_id[doc_id]:
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    at = 0
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["sequence_id"] * packing.SEQUENCE + p["offset"] == at
        at += p["length"]
    assert packing.pack(documents(spark, []), path).count() == 0


def test_languages_are_told_apart(spark):
    speech = {"en": "the water and with her", "de": "das wasser und mit ihr", "fr": "avec elle et son eau", "es": "con ella y el agua"}
    rows = []
    for i in range(400):
        lang = list(speech)[i % 4]
        words = np.random.default_rng(i).permutation(speech[lang].split() * 3)
        rows.append((i, " ".join(words), lang, "s", 0, "x"))
    rows += [(1000, None, "en", "s", 0, "x"), (1001, "123 ...", None, "s", 0, "x"), (None, "the water", "en", "s", 0, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: r for r in language.identify(docs, language.train(docs)).collect()}
    held = [r for r in got.values() if r["held_out"] and r["lang_pred"] != "und" and r["doc_id"] is not None]
    assert len(held) > 40 and np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert got[1000]["lang_pred"] == got[1001]["lang_pred"] == "und"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items() if i is not None)
    blank = documents(spark, [])
    assert language.identify(blank, language.train(blank)).count() == 0


def test_neighbours_against_brute_force(spark):
    random = np.random.default_rng(2)
    data = random.standard_normal((1500, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    odd = [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [None] * 16), (5004, [1.0]), (None, [1.0] * 16)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    found = neighbours.search(frame).collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = []
    for q in range(0, 1500, 20):
        scores = data @ data[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(1500), -scores))[:20]
        assert sorted(got[q]) == list(range(1, 21))
        assert all(s == pytest.approx(float(data[v] @ data[q]), abs=1e-12) for v, s in got[q].values())
        hits.append(len({v for v, _ in got[q].values()} & set(best.tolist())) / 20)
    assert np.mean(hits) >= 0.9 and set(got) == set(range(0, 1500, 20))
    assert neighbours.search(frame.limit(0)).count() == 0


def test_shards_are_even_and_gapless(spark):
    rows = odd_rows() + [(100 + i, prose(i, 20 + i % 50), "a") for i in range(1500)]
    rows += [(5000 + i, "a very common text " * 5, "a") for i in range(800)]
    got = [r.asDict() for r in shards.pack_shards(documents(spark, rows[9:])).collect()]
    totals, slots, homes = Counter(), {}, {}
    for r in got:
        totals[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == len(rows) - 9 and set(totals) == set(range(16))
    assert max(totals.values()) < 1.05 * min(totals.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = {i: t for i, t, _ in rows}
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 1 and r["text_crc32"] == zlib.crc32(data)
        homes.setdefault(data, set()).add(r["shard"])
    assert shards.pack_shards(documents(spark, odd_rows())).count() == 9
    assert shards.pack_shards(documents(spark, [])).count() == 0


def test_packing_of_items_takes_the_highest_dot_product():
    vectors = np.array([[4.0, 0, 0], [0, 4.0, 0], [2.0, 2, 0], [2.0, 2, 4]])
    share = vectors.sum(axis=0) / 2
    scaled, residual, expected = vectors / share, np.ones((2, 3)), {}
    for i in sorted(range(4), key=lambda i: -scaled[i].max()):
        expected[i] = int(np.argmax(residual @ scaled[i]))
        residual[expected[i]] -= scaled[i]
    assert shards.pack_items(vectors, 2).tolist() == [expected[i] for i in range(4)]


def test_grades_are_learned(spark):
    rows, labels = [], []
    for i in range(900):
        text = prose(i, 60)
        grade = i % 3
        if grade == 0:
            text += " scum"
        elif grade == 1:
            text = " ".join(w + "%%%" for w in text.split())
        rows.append((i, text, "a"))
        if i % 4:
            labels.append((i, int(grade != 1), int(grade == 0)))
    docs = documents(spark, rows + [(5000, None, "a"), (5001, "", "a")])
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert (np.diff(model.thresholds) > 0).all()
    got = {r["doc_id"]: r for r in quality.grade_documents(docs, model).collect()}
    unseen = [i for i in range(900) if not i % 4]
    assert np.mean([got[i]["keep"] == (i % 3 == 2) for i in unseen]) > 0.95
    assert not got[5000]["keep"] and not got[5001]["keep"]
    assert quality.train(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")) is None
    assert quality.grade_documents(documents(spark, []), None).count() == 0


def brute_lines(rows):
    """Lines kept by the definition, over windows of all texts."""
    seen, gone = set(), {}
    for i, text in sorted(rows):
        own = [(n, x.strip(" \r")) for n, x in enumerate(text.split("\n")) if x.strip(" \r")]
        for at in range(len(own) - 2):
            window = tuple(x for _, x in own[at : at + 3])
            if window in seen:
                gone.setdefault(i, set()).update(n for n, _ in own[at : at + 3])
            seen.add(window)
    return {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(i, ())) for i, t in rows}


def test_line_windows_equal_brute_force(spark):
    random = np.random.default_rng(4)
    rows = [(i, "\n".join(random.choice(["a", "b", "c", "", " d "], 12))) for i in range(60)]
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(docs).collect()}
    assert got == brute_lines(rows)


def test_line_dedup_of_odd_rows(spark):
    docs = documents(spark, odd_rows() + [(8, "x\ny\nz", "a"), (9, "0\nx\ny\nz\n1", "a"), (9, "0\nx\ny\nz\n1", "a")])
    out = lines.dedup_lines(docs)
    assert out.columns == [*docs.columns, "lines_removed"]
    got = sorted(((r["doc_id"], r["text"], r["lines_removed"]) for r in out.collect()), key=repr)
    assert (8, "x\ny\nz", 0) in got and (1, None, 0) in got and (2, "", 0) in got
    assert len(got) == 12 and [g[1:] for g in got if g[0] == 9] == [("0\n1", 3)] * 2
    assert lines.dedup_lines(documents(spark, [])).count() == 0


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_length_by_bits():
    random = np.random.default_rng(6)
    for _ in range(50):
        a, b = (random.integers(0, 6, random.integers(1, 90)).tolist() for _ in range(2))
        assert contamination.common_length(a, b) == longest_common(a, b)


def rich(seed, count):
    """Prose of a large vocabulary."""
    return " ".join(a + b for a, b in zip(prose(seed, count).split(), prose(seed + 5000, count).split()))


def test_leaks_are_found(spark):
    items = [(i, rich(900 + i, 20 + 3 * i) + ". " + rich(950 + i, 8) + ".") for i in range(12)]
    rows = [(i, rich(i, 400), "a") for i in range(60)]
    for i, text in items:
        words = text.split()
        rows.append((100 + i, rich(200 + i, 90) + " " + text.upper() + " " + rich(300 + i, 77), "a"))
        other = rich(700 + i, len(words)).split()
        changed = [w if at % 9 else other[at] for at, w in enumerate(words)]
        rows.append((200 + i, rich(400 + i, 50) + " " + " ".join(changed), "a"))
    docs = documents(spark, rows + [(1, None, "a"), (2, "", "a")])
    bench = spark.createDataFrame([*items, (50, None), (51, "")], "item_id long, text string")
    got = {}
    for r in contamination.decontaminate(docs, bench).collect():
        got.setdefault(r["doc_id"], []).append(r["leaked_items"])
    for i, _ in items:
        assert got[100 + i] == [[i]] and got[200 + i] == [[i]], i
    assert all(x == [] for i in range(60) for x in got[i])
    assert contamination.decontaminate(documents(spark, []), bench).count() == 0
    assert contamination.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, set()
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = ids or {r["doc_id"] for r in docs.collect()}
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), f"test-stage-{number}")
        ids = {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
        assert ids <= before
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert ids


def classes_by_force(texts, idf):
    """The least row of each row's component of links at 0.8, over all pairs."""
    row, shingle, weight, starts = minhash.features(pa.array(texts), idf)
    _, place = np.unique(shingle, return_inverse=True)
    totals = np.add.reduceat(weight.astype(float), starts[:-1])
    dense, root = np.zeros(place.max() + 1), np.arange(len(texts))
    for i in range(len(texts)):
        own = slice(starts[i], starts[i + 1])
        dense[place[own]] = weight[own]
        shared = np.add.reduceat(np.minimum(dense[place], weight), starts[:-1])
        dense[place[own]] = 0
        linked = np.unique(root[shared / (totals + totals[i] - shared) >= 0.8])
        if len(linked) > 1:
            root[np.isin(root, linked)] = linked[0]
    return root


def check_classes(spark, texts):
    docs = documents(spark, [(i, t, "a") for i, t in enumerate(texts)])
    expected = classes_by_force(texts, minhash.inverse_frequencies(docs))
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert got == dict(enumerate(expected.tolist()))
    return expected


def drifted(texts, base, random, steps, words, prefix):
    """A chain of copies of ``base``, each with some words of the one before replaced."""
    at = list(base)
    for n in range(steps):
        for place in random.choice(len(at), words, replace=False):
            at[place] = f"{prefix}{n}x{place}"
        texts.append(" ".join(at))


def test_chains_of_a_large_family_equal_brute_force(spark):
    random, texts = np.random.default_rng(11), []
    base = rich(1, 200).split()
    for branch in range(150):
        drifted(texts, base, random, 12, 3, f"v{branch}n")
    roots = check_classes(spark, texts)
    assert len(texts) == 1800 and 1 < len(set(roots.tolist())) < len(texts)


def test_pairs_in_a_family_on_one_template_equal_brute_force(spark):
    random, texts = np.random.default_rng(12), []
    base = rich(2, 200).split()
    for i in range(300):
        drifted(texts, base, random, 1, 3, f"t{i}n")
        if i % 2:
            drifted(texts, texts[-1].split(), random, 1, 3, f"u{i}n")
    roots = check_classes(spark, texts)
    assert 1 < len(set(roots.tolist())) < len(texts)


def test_keep_one_of_repeated_and_null_ids(spark):
    one, two, three, four, five = (prose(60 + i, 40) for i in range(5))
    rows = [(1, one, "a"), (1, one, "a"), (1, one, "b"), (2, two, "a"), (None, two, "a"), (None, three, "a"),
            (None, four, "a"), (None, four, "a"), (5, one, "a"), (5, five, "a"), (6, None, "a"), (6, None, "a"), (7, "", "a")]
    docs = documents(spark, rows)
    got = minhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(
        [(1, one), (2, two), (None, three), (None, four), (5, five), (6, None), (6, None), (7, "")], key=repr
    )
    assert minhash.keep_one(documents(spark, [])).count() == 0


def test_leaks_equal_the_checks_over_all_pairs(spark):
    random = np.random.default_rng(13)
    items = [(i, rich(1900 + i, 6 + 2 * i) + ". " + rich(1950 + i, 3) + ".") for i in range(16)]
    rows = [(i, rich(2000 + i, 300), "a") for i in range(40)]
    for i, text in items:
        words = text.split()
        for n, lost in enumerate((0.0, 0.3, 0.4, 0.5)):
            other, kept = rich(2200 + 10 * i + n, len(words)).split(), list(words)
            for at in random.choice(len(words) - 3, int(lost * len(words)), replace=False):
                kept[at] = other[at]
            rows.append((100 + 10 * i + n, f"{rich(2600 + i, 45)} {' '.join(kept)} {rich(2700 + i, 61)}", "a"))
    docs = documents(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    idf, made = contamination.inverse_frequencies(docs), contamination.read_items([(*i, None) for i in items])
    expected = {}
    for doc_id, text, _ in rows:
        words, _ = hashing.word_hashes(pa.array([text]))
        found = {n for n, w, a in zip(made.ids, made.words, made.answers, strict=True) if contamination.check(words, w, a, idf)}
        expected[doc_id] = sorted(found)
    got = {r["doc_id"]: r["leaked_items"] for r in contamination.decontaminate(docs, bench).collect()}
    assert got == expected
    assert sum(len(e) for e in expected.values()) > 40 and all(not expected[i] for i in range(40))


def test_licenses_within_longer_texts(spark):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 500)
    parts = mit.replace("conditions: ", "conditions:\n\n").replace("Software. THE", "Software.\n\nTHE")
    assert parts.count("\n\n") == 2
    gpl = dict(licenses.all_templates())["GPL-3.0"]
    rows = [
        (1, f"{prose(1, 300)}\n\n{parts}\n\n{prose(2, 500)}", "a"),
        (2, f"{prose(3, 30)} Licensed under the MIT License. {prose(4, 30)}", "a"),
        (3, f"{prose(5, 30)}\r\n \r\n{mit}\r\n\r\n{prose(6, 40)}", "a"),
        (4, f"{prose(7, 2000)}\n{gpl}\n{prose(8, 2000)}", "a"),
        (5, prose(9, 500), "a"),
    ]
    got = {}
    for r in licenses.scan_licenses(documents(spark, rows)).collect():
        got.setdefault(r["doc_id"], set()).add((r["license"], r["unit"]))
    assert got[1] == got[2] == {("MIT", "window")}
    assert ("MIT", "line") in got[3] and ("GPL-3.0", "window") in got[4] and 5 not in got
    words = hashing.word_hashes(pa.array(["a b\n \r\nc d\r\n\r\ne\nf"]))[0]
    assert licenses.blocks(pa.array(["a b\n \r\nc d\r\n\r\ne\nf"]))[3].tolist() == [0, 0, 1, 1, 2, 2] and len(words) == 6


def test_every_source_has_a_queue(spark):
    path = packing.default_tokenizer()
    rows = [(i, prose(i, 5 + i % 7), f"s{i % 90}" if i % 91 else None) for i in range(400)]
    docs = documents(spark, rows)
    source = {i: s for i, _, s in rows}
    pieces = packing.pack(docs, path).collect()
    held = {}
    for p in pieces:
        held.setdefault(p["queue"], set()).add(source[p["doc_id"]])
    assert len(held) == 91 and all(len(names) == 1 for names in held.values())
    ends = sorted((p["sequence_id"] * packing.SEQUENCE + p["offset"], p["length"]) for p in pieces)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:])) and ends[0][0] == 0
    parts = spark.createDataFrame([(0, f"s{i}", 10, 100 - i) for i in range(90)], "part int, source string, n long, rows long")
    shares = packing.wanted_shares(packing.number_queues(parts), {"s80": 0.75, "s0": 0.25}, 90)
    assert shares[80] == 0.75 and shares[0] == 0.25 and sum(shares) == 1.0
    with pytest.raises(ValueError, match="nowhere"):
        packing.pack(docs, path, shares={"nowhere": 1.0})


def test_queue_totals_of_large_numbers():
    phase = packing.Phase(3, 10**9, (5, 0, 7), (10**17 + 1, 3, 0), 10**13 + 7)
    for window in (3, 4, 10**6, 10**8 + 1):
        assert phase.totals(window).tolist() == [phase.total(j, window) for j in range(3)]


def test_pipeline_run_equals_plain_stages(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    items = [(i, rich(3000 + i, 24) + ". " + rich(3050 + i, 6) + ".") for i in range(4)]
    rows = [(i, rich(3100 + i, 150), f"s{i % 5}") for i in range(40)]
    for i in range(6):
        copy = rows[i][1].split()
        copy[70] = copy[110] = "changed"
        rows.append((100 + i, " ".join(copy), "s0"))
    shared = [rich(3300 + n, 8) for n in range(3)]
    for i in range(5):
        rows.append((200 + i, "\n".join([rich(3400 + i, 60), *shared, rich(3450 + i, 60)]), "s1"))
    rows += [(300 + i, f"{rich(3500 + i, 60)} {text} {rich(3600 + i, 60)}", "s2") for i, text in items]
    rows += [(400, None, "s0"), (401, "123 ...", "s0"), (402, "\n".join(shared), "s0")]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    kept = [(i, t) for i, t, _ in rows if t and re.search(r"[a-z]", t)]
    cleaned = brute_lines(kept)
    kept = [(i, cleaned[i]) for i, t in kept if cleaned[i].strip() or cleaned[i] == t]
    frame = documents(spark, [(i, t, "s") for i, t in kept])
    roots = classes_by_force([t for _, t in kept], minhash.inverse_frequencies(frame))
    kept = [row for n, row in enumerate(kept) if roots[n] == n]
    idf = contamination.inverse_frequencies(documents(spark, [(i, t, "s") for i, t in kept]))
    made = contamination.read_items([(*i, None) for i in items])

    def leaks(text):
        words, _ = hashing.word_hashes(pa.array([text]))
        return any(contamination.check(words, w, a, idf) for w, a in zip(made.words, made.answers, strict=True))

    kept = [(i, t) for i, t in kept if not leaks(t)]
    coder = Tokenizer.from_file(packing.default_tokenizer())
    expected = {i: [*coder.encode(t, add_special_tokens=False).ids, 1] for i, t in kept}
    assert set(expected) == {*range(40), *range(200, 205)}
    at, found = 0, Counter()
    for p in sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda p: (p["sequence_id"], p["offset"])):
        ids = np.array(expected[p["doc_id"]], "<u4")
        assert p["doc_tokens"] == len(ids) and p["sequence_id"] * packing.SEQUENCE + p["offset"] == at
        assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
        at, found[p["doc_id"]] = at + p["length"], found[p["doc_id"]] + p["length"]
    assert found == {i: len(ids) for i, ids in expected.items()}


def test_slices_of_text_do_not_change_the_packing(spark, monkeypatch):
    """The pipeline codes a quarter as much text at a time as the operator by itself."""
    import corpus_pipeline

    path = packing.default_tokenizer()
    docs = documents(spark, [(i, prose(i, 60), f"s{i % 3}") for i in range(30)]).coalesce(1)
    whole, cut = (sorted(map(tuple, packing.pack(docs, path, slice_bytes=n).collect())) for n in (4_000_000, 500))
    assert whole == cut
    wanted = []
    monkeypatch.setattr(packing, "pack", lambda docs, path, slice_bytes: wanted.append(slice_bytes) or docs.withColumn("queue", docs.doc_id))
    corpus_pipeline.packing_stage(spark, docs, "")
    assert wanted[0] * 4 <= packing.SLICE
