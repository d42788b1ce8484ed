"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, extra and clashing columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import chat, components, decontam, html, licenses, lines, packing, quality, simhash, substrings, vectors
from cairn.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, source string, fp long, n_lines int, ids string"
LONG = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
ROWS = [(1, "alpha beta gamma delta epsilon", "s", 1, 1, "a"), (2, None, "s", 1, 1, "a"), (3, "", None, 1, 1, "a"), (None, "no id here at all", "s", None, None, None), (5, LONG, "s", 1, 1, "a"), (6, LONG, "s", 1, 1, "a"), (6, LONG, "s", 1, 1, "a"), (7, " \n \n", "s", 1, 1, "a")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3, "doc_id")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_packing(spark, docs, nothing):
    out = packing.pack_documents(docs, tokenizer_path())
    per = {(r.doc_id, r.doc_tokens): r.n for r in out.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect()}
    long_tokens = max(n for _, n in per)
    assert per[2, 1] == 1 and per[3, 1] == 1 and per[7, 1] == 1 and per[5, long_tokens] == long_tokens and per[6, long_tokens] == 2 * long_tokens
    assert any(d is None for d, _ in per)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
    assert packing.pack_documents(nothing, tokenizer_path()).count() == 0


def test_packer_keeps_a_bounded_number_open():
    done = []
    packer = packing.Packer(100, 4, 8, done.append)
    rng = np.random.default_rng(0)
    for n in rng.integers(1, 260, 500):
        packer.add([0, 0, int(n), int(n), b"\0\0\0\0" * int(n)])
        assert len(packer.open) <= 4
    assert all(92 < sum(p[2] for p in w) <= 100 for w in done)
    assert packing.power_cuts(3000) == [2048, 512, 256, 128, 32, 16, 8]


def test_word_encoder_is_exact_on_odd_texts():
    encode = packing.encoder(tokenizer_path())
    for t in ["I'm <|endoftext|>x don't 's ÀÉ×ß ﬁ İs Σίσυφος", "é éx µ ªº naïve-é.. \x1c y", "\n\n a  b\n", "", "12345 ...!!!@@ a'b'ss", "퟿ 漢字 ☃☃"]:
        assert encode(t) == np.asarray(encode.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_lines(spark, docs, nothing):
    out = {(r.doc_id, r.text): (r.n_lines, r.n_dropped) for r in lines.drop_boilerplate(docs).collect()}
    assert out[2, None] == (0, 0) and out[3, ""] == (1, 0) and out[7, " \n \n"] == (3, 0)
    assert lines.drop_boilerplate(docs).columns == ["doc_id", "text", "source", "fp", "ids", "n_lines", "n_dropped"]
    assert lines.drop_boilerplate(nothing).count() == 0
    site = spark.createDataFrame([(k, f"menu\nbody {k}\nmenu\n" + ("rare" if k < 8 else "end"), "a" if k < 100 else None) for k in range(120)], "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in lines.drop_boilerplate(site).collect()}
    assert got[50] == "body 50" and got[3] == "body 3\nrare"  # exactly at the ratio: stays
    assert got[110] == "menu\nbody 110\nmenu\nend"


def test_lines_without_a_broadcast(spark, sf, monkeypatch):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    wanted = sorted(map(tuple, lines.drop_boilerplate(table).select("doc_id", "text", "n_dropped").collect()))
    monkeypatch.setattr(lines, "BROADCAST_ROWS", -1)
    assert sorted(map(tuple, lines.drop_boilerplate(table).select("doc_id", "text", "n_dropped").collect())) == wanted


def test_substrings(spark, docs, nothing):
    out = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.remove_repeats(docs).collect()}
    assert out == {1: (5, 0), 2: (0, 0), 3: (0, 0), None: (5, 0), 5: (30_000, 0), 6: (30_000, 30_000), 7: (0, 0)}
    assert substrings.remove_repeats(docs).count() == len(ROWS)
    assert substrings.remove_repeats(nothing).count() == 0
    same = spark.createDataFrame([(1, "a " * 21), (2, "b " * 20)], "doc_id long, text string")
    assert {r.doc_id: (r.n_words, r.n_removed) for r in substrings.remove_repeats(same).collect()} == {1: (21, 20), 2: (20, 0)}


def test_substrings_dont_depend_on_blocks_and_ranges(spark, sf, monkeypatch):
    table = spark.read.parquet(f"{sf}/documents.parquet").withColumn("doc_id", F.col("doc_id") * 64)
    wanted = sorted(map(tuple, substrings.remove_repeats(table).collect()))
    for name, value in (("KEY_BYTES", 500), ("SKETCH_BYTES", 700), ("BLOCK_BYTES", 20_000)):
        monkeypatch.setattr(substrings, name, value)
    assert sorted(map(tuple, substrings.remove_repeats(table.repartition(7)).collect())) == wanted


def test_substrings_spread_rows_without_an_id(spark):
    rows = [(None, "z " * 30)] * 5 + [(1, "z " * 30), (2, "z " * 30), (2, "z " * 30)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("1", 30, 29)] + [("2", 30, 30)] * 2 + [("None", 30, 0)] * 5


def test_window_hashes_by_doubling():
    words = np.random.default_rng(0).integers(0, 3, 400).astype(np.uint64)
    for n in (1, 5, 8, 20):
        h, seen = substrings.gram_hashes(words, n, substrings._MIX), {}
        assert len(h) == 400 - n + 1
        for i, x in enumerate(h):
            assert seen.setdefault(tuple(words[i : i + n]), x) == x
        assert len(set(h.tolist())) == len(seen)


def test_chat_round_trip_and_ties(spark):
    rows = [(1, 0, "user", "</s>[INST] \\< x"), (1, 1, "user", None), (1, 2, "assistant", "[TURN]<\\"), (1, 2, "assistant", "[TURN]<\\"), (1, None, None, "late"), (None, 0, "assistant", "free")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, n_turns int")
    got = {r.conv_id: r for r in chat.format_chats(df).select("conv_id", "n_turns", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"), "formatted").collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "</s>[INST] \\< x"), ("user", ""), ("assistant", "[TURN]<\\"), ("assistant", "[TURN]<\\"), ("", "late")]
    assert got[1].loss == "[TURN]<\\[TURN]<\\" and got[1].formatted.count("<s>") == 3 and got[1].n_turns == 5
    assert got[None].loss == "free"
    assert chat.format_chats(df.limit(0)).count() == 0


def test_decontamination_tolerates_substitutions(spark, docs, nothing):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    bench = spark.createDataFrame([(1, item), (2, "too short"), (None, item), (4, None), (1, item)], "item_id long, text string")
    worn = item.replace("five", "FIVE,").replace("eight", "8").split()
    texts = spark.createDataFrame([(1, "a b " + " ".join(worn) + " c"), (2, "one two three four x y z five six seven"), (3, None), (None, item), (5, " ".join(worn[4:])), (1, "a b " + " ".join(worn) + " c")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id, r.n_matched, r.doc_start) for r in decontam.contaminated(texts, bench).collect()] == [(1, 1, 13, 2)]
    assert decontam.contaminated(nothing, bench).count() == 0 and decontam.contaminated(docs, bench.limit(0)).count() == 0
    assert decontam.contaminated(docs, bench).count() == 0


def test_licenses(spark, nothing):
    rows = [(1, "x\nSoftware released under the MIT License.\nmore words"), (2, None), (3, ""), (None, "Licensed under the Apache License, Version 2.0."), (5, "he has a driving license and released the car"), (6, LONG + "\nLicensed under CC BY-NC 4.0."), (6, "Licensed under CC BY-NC 4.0.")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, family string")
    got = sorted((str(r.doc_id), r.paragraph, r.family) for r in licenses.scan_licenses(df).where("confirmed").collect())
    assert got == [("1", 1, "mit"), ("6", 0, "cc-by-nc"), ("6", 1, "cc-by-nc"), ("None", 0, "apache")]
    assert licenses.scan_licenses(nothing).count() == 0


def test_simhash(spark, docs, nothing):
    out = {(r.doc_id, r.fp, r.component_id) for r in simhash.simhash_components(docs).collect()}
    by = {d: (f, c) for d, f, c in out}
    assert by[2] == by[3] == by[7] == (0, 2) and by[5][0] == by[6][0] and by[6][1] == 5
    assert simhash.simhash_components(docs).count() == len(ROWS)
    assert simhash.simhash_components(nothing).count() == 0


@pytest.mark.parametrize(("rows_per_prefix", "distance"), [(20_000, 4), (3, 4), (20_000, 3), (20_000, 1)])
def test_ball_links_equal_brute_force(spark, monkeypatch, rows_per_prefix, distance):
    monkeypatch.setattr(simhash, "PREFIX_ROWS", rows_per_prefix)
    monkeypatch.setattr(simhash, "CHUNK_VARIANTS", 20_000)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64) * np.uint64(2)
    fps = set(base.tolist())
    for b in base.tolist()[:20]:
        x = b
        for flips in (1, 2, 3, 4, 4, 5, 6):
            for bit in rng.choice(64, flips, replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    fps |= {base.tolist()[30] ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)}  # one crowded ball
    values = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = simhash.fingerprint_links(df, distance)
    found = links.collect()
    assert all(0 < ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= distance for r in found)
    assert len(found) < 200 * 137  # forests, not all pairs
    got = {r.node: r.component for r in components.connected_components(links).collect()}
    label = values.view(np.int64).copy()
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    for _ in range(len(values)):
        label = np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1)
    assert {int(v): int(c) for v, c in zip(values.view(np.int64), label, strict=True) if (label == c).sum() > 1} == got


def test_variants_come_once_whatever_the_pieces():
    rng = np.random.default_rng(2)
    fp = np.unique(rng.integers(0, 2**63, 50, dtype=np.uint64))
    prefix = np.full(len(fp), fp[0] >> np.uint64(48))
    fp = (fp & np.uint64((1 << 48) - 1)) | (prefix << np.uint64(48)) ^ np.uint64(1 << 50)
    whole = [sorted(zip(*(c.tolist() for c in piece), strict=True)) for piece in simhash.variants_under(prefix, 16, fp, 2, 10**9)]
    pieces = list(simhash.variants_under(prefix, 16, fp, 2, 300))
    assert len(whole) == 1 and len(pieces) > 5 and max(len(p[0]) for p in pieces) <= 300
    assert sorted(r for p in pieces for r in zip(*(c.tolist() for c in p), strict=True)) == whole[0]


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (9, 8), (5, 5), (None, 1), (2, 1)] + [(100 + k, 101 + k) for k in range(40)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8} | {100 + k: 100 for k in range(41)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [4096, 16])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 24))
    x = np.concatenate([base, base[:20] + 0.05 * rng.standard_normal((20, 24)), base[:20] + 0.12 * rng.standard_normal((20, 24)), np.repeat(base[:1], 30, axis=0)]).astype(np.float32)
    rows = [(k, [float(v) for v in r], 1) for k, r in enumerate(x)]
    odd = [(900, None, 1), (901, [], 1), (902, [0.0] * 24, 1), (903, [float("nan")] * 24, 1), (904, [None] * 24, 1), (None, rows[0][1], 1), (905, [1.0, 2.0], 1)]
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.link_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, rep int")).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.where(near, label[None, :], len(x)).min(axis=1)
    wanted = {k: (int(near[k].sum()) - 1, int(label[k]), bool(label[k] == k)) for k in range(len(x))}
    assert {k: out[k] for k in wanted} == wanted
    assert all(out[k] == (0, k, True) for k in range(900, 906)) and out[None] == (0, None, None)
    assert vectors.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_hash_plan_reaches_its_recall():
    for n in (100, 50_000, 10**9):
        k, tables = vectors.plan(n)
        near = vectors.collision((2 - 2 * 0.95) ** 0.5) ** k
        assert 1 - (1 - near) ** tables >= 0.998


def test_quality(spark, docs, nothing):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)] + [(None, 1, 0), (3, None, 0), (1, 0, 1)], "doc_id long, quality int, toxic int")
    texts = spark.createDataFrame([(k, ("fine words stand here " if k % 2 else "%%% !!! ### ") * 5) for k in range(40)], "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in quality.score_quality(texts, labels).collect()}
    assert sum(got[k] == k % 2 for k in got) >= 38
    out = quality.score_quality(docs, labels).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    assert {round(r.score, 6) for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(nothing, labels).count() == 0


def test_quality_sample_is_bounded_in_rows_and_bytes(spark):
    texts = spark.createDataFrame([(k, ("fine words stand here " if k % 2 else "%%% !!! ### ") * 5) for k in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    whole = quality.train(texts, labels)
    again = quality.train(texts.unionByName(texts), labels)  # repeated rows count once
    assert (again.weights == whole.weights).all() and again.bias == whole.bias
    few = quality.train(texts, labels, sample_bytes=2000)
    assert np.count_nonzero(few.weights) < np.count_nonzero(whole.weights) or few.bias != whole.bias
    assert quality.train(texts, labels, sample_bytes=1).slope == 0.0


def test_features_dont_depend_on_slices(monkeypatch):
    texts = ["", "a", "ab ab", LONG[:5000], "é" * 30]
    whole = [quality.features(t) for t in texts]
    monkeypatch.setattr(quality, "SLICE", 7)
    assert all((quality.features(t) == w).all() for t, w in zip(texts, whole, strict=True))


def test_html(spark):
    page = "<p>a <b>b</b>  c<br>d<ul><li>x<li>y<ol start=3><li>q<li>r</ol><li>z</ul><table><tr><td>aa<td>b<tr><td>c<td>dddd</table><pre>  k\n   l</pre><div hidden>no</div><div style='display:none'>no</div>tail &amp; end<details><summary>S</summary>no</details><style>.q{display:none}</style><i class=q>no</i>"
    assert html.page_text(page) == "a b c\nd\n\n- x\n- y\n  3. q\n  4. r\n- z\n\naa | b\nc  | dddd\n\n  k\n   l\n\ntail & end\nS"
    assert html.page_text("<div>" * 5000 + "deep") == "deep"
    assert "deep" in html.page_text("<table><tr><td>" * 60 + "deep")
    assert html.page_text("<![if x]>a<!-- b <!bad").strip()
    df = spark.createDataFrame([(1, "u", "<p>x", "old"), (2, None, None, "old"), (None, "u", "", None), (1, "u", "<p>x", "old")], "page_id long, url string, html string, text string")
    assert sorted((str(r.page_id), r.text) for r in html.extract_text(df).collect()) == [("1", "x"), ("1", "x"), ("2", ""), ("None", "")]
    assert html.extract_text(df.limit(0)).count() == 0


def test_vectors_of_extreme_size_link_by_their_direction(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1.01e200]), (3, [1.0, 1.0]), (4, [1e-200, 1e-200]), (5, [5e-324, 5e-324]), (6, [1e308, -1e308]), (7, [1.7e308, 1.7e308]), (8, [0.0, 0.0]), (9, [1e-300, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {**dict.fromkeys((1, 2, 3, 4, 5, 7), (5, 1)), 6: (0, 6), 8: (0, 8), 9: (0, 9)}
