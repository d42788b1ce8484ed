"""The registered queries over whole test tables, against SQL or brute force."""

import hashlib
import zlib

import numpy as np
import pytest
import xxhash
from compare import expected, rows
from test_near import kept

from cairn.llm import queries as Q

pytestmark = pytest.mark.usefixtures("spark")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    df = Q.QUERIES[name](spark, sf)
    columns, wanted = expected(Q.ORACLES[name], sf)
    assert sorted(df.columns) == columns
    assert rows(df) == wanted


def test_op1_pieces_are_the_tokenizer_s_ids(spark, sf, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(Q.tokenizer_path())
    ids = {d: np.asarray([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in docs.items()}
    at, sequences = dict.fromkeys(ids, 0), {}
    for r in sorted(Q.op1_packing(spark, sf).collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert at == {d: len(x) for d, x in ids.items()}
    padding = total = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= 4096
        total += end
        padding += 0 if end & (end - 1) == 0 else 4096 - end
    assert padding < 0.01 * total


def test_op3_equals_brute_force(spark, sf, docs):
    first, wanted = {}, set()
    for d in sorted(docs):
        words = (docs[d] or "").encode().split()
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - 19):
            if first.setdefault(tuple(words[i : i + 20]), (d, i)) != (d, i):
                gone[i : i + 20] = True
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        wanted.add((d, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    assert {tuple(r) for r in Q.op3_substrings(spark, sf).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()} == wanted


def test_op4_finds_every_notice_and_nothing_else(spark, sf, docs):
    got = {(r.doc_id, r.paragraph) for r in Q.op4_licenses(spark, sf).collect() if r.confirmed}
    notices = ("Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "All rights reserved.")
    assert got == {(d, k) for d, t in docs.items() for k, line in enumerate(t.split("\n")) if any(n in line for n in notices)}


def test_op6_equals_brute_force(spark, sf, docs):
    import regex

    split = lambda t: [w for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if w]
    wanted = set()
    words = {d: " ".join(["", *split(t), ""]) for d, t in docs.items()}
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        item = split(r.text)
        if len(item) >= 12:
            runs = [" " + " ".join(item[i : i + min(13, len(item))]) + " " for i in range(max(1, len(item) - 12))]
            wanted |= {(d, r.item_id) for d, t in words.items() if any(x in t for x in runs)}
    got = {(r.doc_id, r.item_id) for r in Q.op6_decontamination(spark, sf).collect()}
    assert wanted and wanted <= got
    assert len(got) <= len(wanted) + 2  # overlaps with substitutions


def test_op7_equals_brute_force(spark, sf, docs):
    fps = {}
    for d, t in docs.items():
        w = t.encode().lower().split()
        shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        fps[d] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
    parent = {d: d for d in fps}
    ids = sorted(fps)
    values = np.array([fps[d] for d in ids], np.uint64)
    for i, d in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 4):
            a, b = find(parent, d), find(parent, ids[i + 1 + int(j)])
            parent[max(a, b)] = min(a, b)
    wanted = {(d, f"{fps[d]:016x}", find(parent, d)) for d in ids}
    assert {tuple(r) for r in Q.op7_simhash(spark, sf).select("doc_id", "fingerprint", "component_id").collect()} == wanted


def test_op9_is_accurate_on_held_out_rows(spark, sf):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    scored = Q.op9_quality(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    held = [r for r in scored if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)


def test_op10_shows_text_and_no_code(spark, sf):
    for r in Q.op10_html(spark, sf).collect():
        assert r.text and "<" not in r.text.replace("<3", "") and "track(" not in r.text


def test_pipeline_equals_its_stages_on_the_side(spark, sf, docs):
    """Each stage against what its operator, tested above, decides on the stage's own input."""
    import corpus_pipeline as P

    table = spark.read.parquet(f"{sf}/documents.parquet")
    names = table.columns
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    keep = {r.doc_id for r in Q.op9_quality(spark, sf).collect() if r.predicted == 1}
    one = P.materialize(P.quality(spark, table, sf))
    assert one.columns == names and texts(one) == {d: docs[d] for d in keep}
    two = P.materialize(P.boilerplate_lines(spark, one, sf))
    assert two.columns == names and set(texts(two)) == keep and two.where("n_chars <> length(text)").count() == 0
    three = P.materialize(P.near_duplicates(spark, two, sf))
    assert set(texts(three)) == kept(texts(two))
    four = P.materialize(P.decontamination(spark, three, sf))
    leaked = {r.doc_id for r in P.contaminated(three, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert set(texts(four)) == set(texts(three)) - leaked
    packed = P.run(spark, sf)
    totals = {r.doc_id: r.n for r in packed.groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert set(totals) == set(texts(four)) and [n for n, _ in P.STAGES][0] == "quality" and len(P.STAGES) == 5
