"""The pipeline's stages on a small table, each against plain code over its own input."""

from __future__ import annotations

import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_operators import prose
from tokenizers import Tokenizer

from tidemark.llm import language_id, quality, suffix_dedup
from tidemark.llm.common import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage, from the given table with planted copies and passages."""
    import os
    import random

    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("the given tables aren't here")
    docs, scratch, rng = spark.read.parquet(f"{data}/documents.parquet"), Scratch(spark), random.Random(41)
    some = [r["text"] for r in docs.where("length(text) > 600").limit(4).collect()]
    planted = []
    for i, text in enumerate(some):
        words = text.split(" ")
        words[len(words) // 2] = "changed"
        planted += [(10_000 + 3 * i, text, None, None, None), (10_001 + 3 * i, " ".join(words), None, None, None), (None, text, None, None, None)]
        planted.append((10_002 + 3 * i, prose(rng, 80) + ". " + text[:400] + " " + prose(rng, 60) + ".", "en", None, None))
    docs = scratch.cut(docs.unionByName(spark.createDataFrame(planted, docs.schema)).unionByName(docs.limit(3)))
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(scratch.cut(stage(spark, out[-1], data)))
    return data, out


def listed(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=str)


def test_columns_and_counts(stages):
    _, out = stages
    assert all(df.columns == COLUMNS for df in out[:-1])
    n = [df.count() for df in out[:-1]]
    assert all(a >= b > 0 for a, b in zip(n, n[1:], strict=False)) and n[-1] >= 0.5 * n[0]


def test_quality_stage(spark, stages):
    data, out = stages
    model = quality.fit(spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet"), ~quality.held_out(), Scratch(spark))
    pool = quality.Pooler(model.words, model.vectors)
    good = [(i, t) for i, t in listed(out[0]) if model.score(pool.text(t)[None].astype(float))[0] >= quality.THRESHOLD]
    assert listed(out[1]) == good


def test_language_stage(spark, stages):
    data, out = stages
    judge = language_id.Predictor(language_id.fit(spark.read.parquet(f"{data}/documents.parquet"), ~language_id.held_out()))
    want = sorted((i, t, judge.text(t)[0]) for i, t in listed(out[1]) if i is not None and judge.text(t)[0] != language_id.UNKNOWN)
    assert sorted(tuple(r) for r in out[2].where("doc_id IS NOT NULL").select("doc_id", "text", "lang").collect()) == want


def shingles(text):
    words = [w for w in bytes(text, "utf-8").lower().split() if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicate_stage(stages):
    _, out = stages
    rows = sorted(set(listed(out[2])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for _ in rows:
        before = list(label)
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    assert listed(out[3]) == sorted((r for i, r in enumerate(rows) if label[i] == i), key=str) and len(out[3].collect()) < len(rows)


def test_repeats_stage(stages):
    _, out = stages
    rows = sorted(((r["doc_id"], r["text"]) for r in out[3].collect()), key=lambda r: (r[0] is None, r[0]))
    seen, want, n = set(), [], suffix_dedup.LENGTH
    for i, t in rows:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - n + 1 if i is not None else 0):
            if raw[k : k + n] in seen:
                gone[k : k + n] = True
            seen.add(raw[k : k + n])
        # a character stays whole where any byte of it stays
        left, at = [], 0
        for c in t:
            size = len(c.encode())
            if not gone[at : at + size].all():
                left.append(c)
            at += size
        if left:
            want.append((i, "".join(left)))
    assert listed(out[4]) == sorted(want, key=str)
    assert all(r["n_chars"] == len(r["text"]) for r in out[4].collect())


def test_packing_stage(stages):
    _, out = stages
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in listed(out[4]):
        ids = np.array([*own.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want += [(i, k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    got = out[5].collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert ends[-1] <= 4096 and [a for a, _ in sorted(places)] == [0, *ends[:-1]]
    assert len(bins) <= 1.02 * sum(w[3] for w in want) / 4096 + 1


def test_odd_rows_pass_through(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", None, None, None), (10**9 + 1, None, "en", None, None), (10**9 + 1, "two texts of an id", "en", None, None)], docs.schema)
    mixed = docs.limit(30).unionByName(odd).unionByName(odd).withColumn("id", F.lit("clash")).withColumn("_id", F.lit("clash"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, mixed, data).count() > 0, name
        assert stage(spark, mixed.limit(0), data).count() == 0, name


def test_rows_without_an_id_are_kept_unless_they_are_copies(spark, data):
    import random

    rng = random.Random(42)
    texts = [prose(rng, 80) for _ in range(3)]
    rows = [(1, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[1]), (2, texts[2]), (2, prose(rng, 70))]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    got = listed(corpus_pipeline.without_near_duplicates(spark, docs, data))
    assert got == sorted([(1, texts[0]), (None, texts[1]), (2, texts[2]), (2, rows[-1][1])], key=str)


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "MinHash near-dedup", "suffix-array dedup", "best-fit packing"]
