import collections
import importlib.util
import os
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from stemma.llm import packing, quality, queries, secrets_scan, simhash
from tests.llm.tables import documents, empty

DATA = "/root/testdata/sf0.001"


def test_encode_counts_every_byte():
    text = ("One two, three! 4$ " * 50).encode()
    x = quality.encode(text)
    words = text.split()
    assert len(x) == -(-len(words) // quality.PASSAGE) and x.shape[1] == quality.WIDTH
    sizes = [len(b" ".join(words[i : i + quality.PASSAGE])) + (i + quality.PASSAGE < len(words)) for i in range(0, len(words), quality.PASSAGE)]
    counts = (x[:, : quality._C] * np.array(sizes)[:, None]).sum(axis=0)
    buf = b" ".join(words)
    want = [sum(quality._TABLE[b] == k for b in buf) for k in range(quality._C)]
    assert np.allclose(counts, want, atol=1e-2)
    assert quality.encode(None).shape == quality.encode(b" \n").shape == (1, quality.WIDTH)


def test_gradients_are_the_loss_s():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, quality.WIDTH)) for n in (1, 3, 2)]
    model = quality.Attention.new(np.concatenate(bags), 0.5)
    model.c = rng.normal(size=model.c.shape)
    x, starts, y = np.concatenate(bags), np.array([0, 1, 4]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = model.forward(x, starts)[0]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    p, kept = model.forward(x, starts)
    for name, grad in model.gradients(kept, starts, p - y).items():
        value = getattr(model, name)
        for at in [tuple(rng.integers(s) for s in value.shape) for _ in range(5)]:
            old, step = value[at], 1e-5
            value[at] = old + step
            up = loss()
            value[at] = old - step
            down = loss()
            value[at] = old
            assert (up - down) / (2 * step) == pytest.approx(grad[at], abs=1e-4)


def plain_score(m, text):
    """The score, passage by passage and number by number."""
    import math

    dot = lambda a, b: sum(float(x) * float(y) for x, y in zip(a, b, strict=True))
    codes, levels = [], []
    for row in quality.encode(text):
        z = [min(8.0, max(-8.0, (float(x) - a) / s)) for x, a, s in zip(row, m.mean, m.scale, strict=True)]
        h = [math.tanh(dot(z, m.w[:, k]) + m.b[k]) for k in range(quality.CODE)]
        gate = [math.tanh(dot(h, m.v[:, k])) / (1 + math.exp(-dot(h, m.u[:, k]))) for k in range(quality.GATE)]
        codes.append(h)
        levels.append(dot(gate, m.g))
    share = [math.exp(x) for x in levels]
    pooled = [sum(a * h[k] for a, h in zip(share, codes, strict=True)) / sum(share) for k in range(quality.CODE)]
    return 1 / (1 + math.exp(-(dot(pooled, m.c) + m.d[0])))


def test_scores_against_a_plain_version(spark):
    rows, labels = made_corpus(80)
    rows += [(900, None), (901, ""), (902, "word " * 1000)]
    docs = documents(spark, rows)
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(plain_score(model, t.encode() if t else None), abs=1e-5)


def test_training_is_bounded(spark):
    """One row for each id and evenly spaced passages of it, whatever is repeated or long."""
    assert quality.spaced(np.arange(100)[:, None], 4).ravel().tolist() == [0, 33, 66, 99]
    rows, labels = made_corpus(40)
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int")
    once, often = (quality.train(documents(spark, rows * n), lab) for n in (1, 3))
    assert np.array_equal(once.w, often.w)


def made_corpus(n):
    draw = random.Random(11)
    word = lambda: "".join(draw.choice(["an", "the", "or", "ti", "es", "ou", "ha"]) for _ in range(draw.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        good = draw.random() < 0.7
        words = [word() for _ in range(draw.randint(5, 300))]
        rows.append((i, " ".join(words) + "." if good else " ".join(w.upper() + draw.choice(["!!", "$$$"]) for w in words)))
        labels.append((i, int(good)))
    return rows, labels


def test_classify_learns_without_held_out_rows(spark):
    rows, labels = made_corpus(300)
    lab = spark.createDataFrame([*labels, (None, 1), (999_999, 0), (5, None)], "doc_id bigint, quality int")
    docs = documents(spark, [*rows, (7_000, None), (7_001, ""), (None, "some words"), (7_002, "x" * 500_000)])
    got = {r.doc_id: r for r in quality.classify(docs, lab).collect()}
    assert len(got) == 304 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in rows)
    held = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    assert sum(p == y for p, y in held) / len(held) >= 0.95
    flipped = spark.createDataFrame([(i, 1 - y if got[i].held_out else y) for i, y in labels], "doc_id bigint, quality int")
    again = {r.doc_id: r.score for r in quality.classify(docs, flipped).collect()}
    assert again == {i: r.score for i, r in got.items()}  # labels of held-out rows change nothing


def test_without_labels_everything_stays(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in quality.classify(documents(spark), none).collect()} == {1.0}
    assert quality.keep_good(documents(spark), none).count() == documents(spark).count()
    rows, labels = made_corpus(60)
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int")
    assert quality.classify(empty(spark), lab).count() == 0
    docs = documents(spark, rows)
    kept = quality.keep_good(docs, lab)
    assert kept.columns == docs.columns and 0 < kept.count() < 60


def test_held_out_accuracy_on_driver_rows(spark):
    got = queries.op10_quality(spark, "/root/testdata/sf0.01")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.where("held_out").join(lab, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.97


def brute_near(texts):
    """Identifiers that stay: of all pairs, those at a Jaccard similarity of 0.8 or more of five-word shingles are linked."""
    shingles, root = {}, {i: i for i in texts}
    for i, t in texts.items():
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).replace("\x0b", " ").replace("\x0c", " ")
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
        shingles[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = shingles[a], shingles[b]
            if x and y and min(len(x), len(y)) * 5 >= max(len(x), len(y)) * 4 and len(x & y) * 5 >= len(x | y) * 4 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return {i for i, r in root.items() if i == r}


def test_recall_of_near_copies_on_driver_rows(spark):
    """Against all pairs of sf0.01: nothing else goes, and nine in ten of what should go do."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = set(texts) - brute_near(texts)
    gone = set(texts) - {r.doc_id for r in simhash.drop_near_duplicates(docs).select("doc_id").collect()}
    assert gone <= want and len(gone) >= 0.9 * len(want) > 50


def test_pipeline_stages_against_plain_versions(spark):
    """Each stage on its predecessor's rows: what stays, what changes, and that columns are kept."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    named = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "simhash near-dedup", "secret scans", "best-fit packing"]
    good = named["quality classifier"](spark, docs, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality")
    model = quality.train(docs, labels)
    score = {r.doc_id: plain_score(model, r.text.encode()) for r in docs.collect() if len(r.text) < 20_000}
    good = good.cache()
    stayed = {r.doc_id for r in good.collect()}
    assert {i for i in stayed if i in score} == {i for i, p in score.items() if p >= quality.THRESHOLD} and good.columns == columns
    once = named["exact dedup"](spark, good, DATA).cache()
    first = {}
    for r in sorted(good.collect(), key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    kept = set(first.values())
    assert {r.doc_id for r in once.collect()} == kept and once.columns == columns
    apart = named["simhash near-dedup"](spark, once, DATA).cache()
    assert apart.columns == columns and {r.doc_id for r in apart.collect()} == brute_near({r.doc_id: r.text for r in once.collect()})
    clean = named["secret scans"](spark, apart, DATA).cache()
    before = {r.doc_id: r for r in apart.collect()}
    assert clean.columns == columns
    for r in clean.collect():
        assert r.text == secrets_scan.redact(before[r.doc_id].text) and r.n_chars == len(r.text) and not secrets_scan.find_spans(r.text)
    packed = named["best-fit packing"](spark, clean, DATA).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean.collect()}
    places = collections.defaultdict(list)
    for r in packed:
        places[r.sequence_id].append((r.offset, r.length))
    assert all(sum(n for _, n in p) <= packing.CAPACITY for p in places.values())


def test_pipeline_survives_odd_rows(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = [(1, "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" and words"), (2, None), (3, ""), (None, "nobody"), (4, "same text here"), (4, "same text here"), (5, "same  text\there")]
    docs = documents(spark, rows).withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("bigint")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "4", "None"]


def test_entry_lists_every_query():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert len([k for k in names if k.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and "op1_exact_dedup" in entry.oracle_sql() and corpus_pipeline.ORACLE_SQL is None


def test_rest_does_not_import_this_subpackage():
    root = os.path.dirname(importlib.util.find_spec("stemma").origin)
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    assert "stemma.llm" not in f.read(), name
