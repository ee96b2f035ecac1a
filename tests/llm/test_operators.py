"""Each corpus operator against brute force on small tables, odd rows included."""

from __future__ import annotations

import base64
import hashlib
import math
import os
import random
import re
import zlib
from collections import defaultdict
from itertools import combinations
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, language_id, minhash, packing, quality, sharding, simhash, suffix_dedup, url_filter, vector_join
from tidemark.llm.common import Scratch, components

EXTRA = ("id", "n", "key", "hash", "raw", "kept", "shard", "text_hash", "w")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"{c} string" for c in EXTRA)
SYLLABLES = ["an", "the", "tion", "re", "sh", "or", "nd", "ing", "ly", "wh"]


def prose(rng, words):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))


def odd_texts():
    rng = random.Random(1)
    base, passage = prose(rng, 120), prose(rng, 60)
    words = base.split()
    near = [" ".join([*words[:at], "changed", *words[at + 1 :]]) for at in (5, 60, 110)]
    texts = [None, "", " \n\t", "x", "One", "ñandú été ß", "a" * 400, passage * 3, base, base, *near]
    texts += [prose(rng, 40) + " " + passage + " " + prose(rng, 30) for _ in range(4)]
    texts += [prose(rng, 60_000), "<|endoftext|> a'll 12  \u00a0 e\u0301 \u1e9b\u0323", "é" * 300 + "è" * 300, "é" * 299 + "x" + "è" * 300]
    return texts


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en" if k % 2 else None, None, None, *["clash"] * len(EXTRA)) for k, (i, t) in enumerate(zip(ids, texts, strict=True))], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    return odd_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return documents(spark, texts).repartition(3).persist()


def given(spark, name):
    """A given table; sf0.01 has a thousand documents."""
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("the given tables aren't here")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: str(r))


def by(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# repeated strings


def kept_of(texts, length=suffix_dedup.LENGTH):
    seen, out = set(), []
    for t in texts:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            part = raw[i : i + length]
            if part in seen:
                gone[i : i + length] = True
            seen.add(part)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~gone])).hexdigest()))
    return out


def test_suffix_dedup(spark, docs, texts):
    got = by(suffix_dedup.dedup(docs, Scratch(spark), keep=("source",)))
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in (got[i] for i in range(len(texts)))] == kept_of(texts)
    assert got[9]["kept"] == "" and all(r["kept"].encode().decode() is not None for r in got.values())


def test_scratch_tables_have_no_checksum_files(spark):
    kept = Scratch(spark).cut(spark.range(10).repartition(3))
    folder = urlparse(kept.inputFiles()[0]).path.rsplit("/", 1)[0]
    assert kept.count() == 10 and not list(Path(folder).glob(".*part*.crc"))


def test_longest_previous_factor():
    rng = random.Random(2)
    text = "".join(rng.choices("ab", k=60))
    order = sorted(range(60), key=lambda i: text[i:])
    common = lambda i, j: next((k for k in range(60) if text[i + k : i + k + 1] != text[j + k : j + k + 1] or not text[max(i, j) + k :]), 60)
    lcp = [0, *(common(a, b) for a, b in zip(order, order[1:], strict=False))]
    got = dict(zip(order, suffix_dedup.longest_previous_factor(order, lcp), strict=True))
    assert all(got[i] == max((common(i, j) for j in range(i)), default=0) for i in range(60))


def test_segments_of_long_texts_hold_every_start(monkeypatch):
    rng = random.Random(3)
    sample = ["".join(rng.choices("abcd", k=3000)).encode(), b"", b"z" * 500]
    starts = lambda c: {(t, s + k, h, o - k) for t, h, _, s, n, o in zip(*map(np.ndarray.tolist, c), strict=True) for k in range(n)}
    whole = starts(suffix_dedup.contexts(sample))
    monkeypatch.setattr(suffix_dedup, "BUFFER", 250)
    assert starts(suffix_dedup.contexts(sample)) == whole
    assert suffix_dedup.contexts(sample, True)[0].tolist() == suffix_dedup.contexts(sample)[1].tolist()


def test_texts_are_hashed_by_the_size_of_a_cores_cache(monkeypatch):
    sizes, own, rng = [], suffix_dedup.piece_hashes, random.Random(22)
    monkeypatch.setattr(suffix_dedup, "piece_hashes", lambda raw: sizes.append(len(raw)) or own(raw))
    suffix_dedup.contexts(["".join(rng.choices("abcd", k=n)).encode() for n in (200_000, *[30_000] * 9)])
    assert sum(sizes) >= 470_000 and max(sizes) < 70_000
    few = own(b"ab" * 200)
    many = np.random.default_rng(1).integers(0, 1 << 63, 3000, np.uint64)
    for h in (many, few, many[rng.choices(range(5), k=3000)], many[:77]):
        assert suffix_dedup.leftmost_minimum(h, 77).tolist() == [i + int(h[i : i + 77].argmin()) for i in range(len(h) - 76)]


def test_many_unlike_contexts_of_one_passage(spark):
    rng = random.Random(21)
    passage = prose(rng, 24)[:150]
    made = [f"{rng.randrange(10**9)} {passage[rng.randrange(4) :]}{rng.randrange(10**9)}" for _ in range(700)]
    got = by(suffix_dedup.dedup(documents(spark, made).repartition(4), Scratch(spark)))
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in (got[i] for i in range(len(made)))] == kept_of(made)


def test_repeated_ids_of_suffix_dedup(spark):
    text = prose(random.Random(22), 60)
    got = rows(suffix_dedup.dedup(documents(spark, [text, text, text + "x", text, text], [7, 7, 9, 8, 8]).select("doc_id", "text", "key"), Scratch(spark)))
    assert {(r["doc_id"], r["n_removed"]) for r in got} == {(7, 0), (8, len(text)), (9, len(text))}
    got = rows(suffix_dedup.dedup(documents(spark, [text, text + "y", text], [7, 7, 9]), Scratch(spark)))
    assert {r["n_removed"] for r in got} == {0}


def test_blocks_of_equal_strings_share_their_core():
    rng = random.Random(23)
    common = prose(rng, 40)[:130]
    a, b = (f"{x}{common}{y}".encode() for x, y in (("left one ", "tail"), ("other ", "end of it, longer")))
    seen: list[dict[bytes, set[int]]] = []
    for raw in (a, b):
        _, _, _, start, n, offset = suffix_dedup.contexts([raw])
        parts = [raw[s : s + k + suffix_dedup.LENGTH - 1] for s, k in zip(start, n, strict=True)]
        lengths = np.array([len(x) for x in parts])
        of, core, _, at, m = suffix_dedup.blocks(b"".join(parts), np.cumsum(lengths) - lengths, n, offset)
        assert sorted(s + k for i, t, c in zip(of, at, m, strict=True) for s in [start[i] + t] for k in range(c)) == list(range(len(raw) - suffix_dedup.LENGTH + 1))
        cores = defaultdict(set)
        for i, c, t, k in zip(of, core, at, m, strict=True):
            for x in range(t, t + k):
                cores[parts[i][x : x + suffix_dedup.LENGTH]].add(int(c))
        seen.append(cores)
    assert len(seen[0].keys() & seen[1].keys()) >= 31 and all(seen[0][x] == seen[1][x] for x in seen[0].keys() & seen[1].keys())


def test_spans_are_drawn_in_to_whole_characters():
    raw = "aéñb".encode()
    assert suffix_dedup.whole_characters(raw, [(2, 4)]) == "aéñb"
    assert suffix_dedup.whole_characters(raw, [(1, 4)]) == "añb"


# vectors


def test_vector_join(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "HOME_BLOCK", 16)
    monkeypatch.setattr(vector_join, "AWAY_BLOCK", 24)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 12))
    vectors = [(centres[rng.integers(6)] + rng.normal(size=12) * rng.choice([0.02, 0.25])).tolist() for _ in range(150)]
    vectors += [vectors[0], vectors[0], [3 * x for x in vectors[1]], None, [], [0.0] * 12, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [None] + [1.0] * 11, [1.0] * 5, [1.0] * 5]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, unit string").repartition(3)
    got = by(vector_join.link(df, Scratch(spark)), "vec_id")
    usable = lambda v: bool(v) and None not in v and np.isfinite(v).all() and any(v)
    links = defaultdict(set)
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors[:i]):
            if usable(a) and usable(b) and len(a) == len(b) and np.dot(a, b) >= 0.95 * np.linalg.norm(a) * np.linalg.norm(b):
                links[i].add(j), links[j].add(i)
    for i in range(len(vectors)):
        reach, todo = {i}, [i]
        while todo:
            todo += (new := links[todo.pop()] - reach)
            reach |= new
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (len(links[i]), min(reach), min(reach) == i)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(k, k + 1) for k in range(100, 140)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    label = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == {n: c for n, c in label.items() if n != c}


# packing


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(spark, docs, texts, capacity):
    got = packing.pack_documents(docs, Scratch(spark), capacity=capacity).collect()
    tk = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in enumerate(texts):
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(i, k, at, len(ids[at : at + capacity]), zlib.crc32(np.array(ids[at : at + capacity], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= 1.15 * math.ceil(sum(w[3] for w in want) / capacity) + 1


ODD = ["a", "B", "word", "É", "ß", "ñ", "'s", "'", "don't", ".", "###", "<", "|", ">", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "12", " ", "  ", "\n", "\t", "\x1c", "\x85", "\u00a0", "文", "İ", "Σ", "ς", "J\u030c", "×", "÷", "_", "\\", "e\u0301", "\u0301", "😀"]


def test_a_word_is_encoded_once_whatever_its_case_and_marks(monkeypatch):
    asked, own = [], packing.Ids._words
    monkeypatch.setattr(packing.Ids, "_words", lambda self, words: asked.extend(words) or own(self, words))
    whole, known = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), packing.Ids(public_tokenizers.path(packing.VOCABULARY))
    for text in ("Thoning,", "thoning", "THONING (thoning) señor", "Señor SEÑOR!"):
        assert np.frombuffer(known.of([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert asked.count(b"thoning") == 1


def test_ids_of_odd_strings():
    """Both tokenizers' remembered parts against the libraries over whole texts."""
    rng = random.Random(5)
    made = ["".join(rng.choices(ODD, k=rng.randint(1, 14))) for _ in range(4000)]
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    known = packing.Ids(public_tokenizers.path(packing.VOCABULARY))
    assert all(np.frombuffer(raw, "<u4").tolist() == own.encode(t, add_special_tokens=False).ids for t, raw in zip(made, known.of(made), strict=True))
    ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.codec(public_tokenizers.path(byte_bpe.VOCABULARY), public_tokenizers.PATTERN)
    assert all((x, y) == (",".join(map(str, enc.encode_ordinary(t))), t.encode()) for t, (x, y) in zip(made, codec.written(made), strict=True))


def test_best_fit_takes_the_tightest_room():
    which, offset, fill = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert fill.tolist() == [10, 10] and which.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 6, 5, 8]


def test_packing_rounds(spark):
    # of the first 800 each bin holds one of either kind
    sizes = [2500] * 400 + [1500] * 400 + list(np.random.default_rng(3).integers(1, 1200, 3000))
    items = spark.createDataFrame([(i, int(s), None) for i, s in enumerate(sizes)], "i long, length long, offset2 string").repartition(5, "i").sortWithinPartitions(F.xxhash64("i"))
    got = packing.pack(items, "length", Scratch(spark), fan_in=2, group=100).collect()
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert ends[-1] <= 4096 and [a for a, _ in sorted(places)] == [0, *ends[:-1]]
    assert len(got) == len(sizes) and len(bins) <= 1.02 * sum(sizes) / 4096 + 1
    with pytest.raises(ValueError):
        packing.pack_documents(spark.createDataFrame([(1, "x")], "piece long, text string"), Scratch(spark), id_col="piece")


# urls


def test_url_filter(spark):
    urls = {
        1: "https://a.Example.ORG/es/1?x=1", 2: "http://example.org/es/1", 3: "https://example.org/en/12", 4: "https://x.com/fr/1#a", 5: "https://x.com/de/1", 6: None, 7: "no scheme", 8: "https://", 9: "https://x.org", 10: "ftp://blog.therthing.net/fr/9", 11: "http://notexample.org/es/2", 12: "a://b.net?u=/x", 13: "http://m.shly.net/de/" + "9" * 50_000,
    }
    pages = spark.createDataFrame([(k, u, f"<p>the thing {k} there</p>" if k % 3 else None, "z") for k, u in urls.items()], "page_id long, url string, html string, host string")
    got = by(url_filter.judge(pages), "page_id")
    rule = {k: (r["rule"], r["verdict"]) for k, r in got.items()}
    assert rule[1] == ("example.org/es/", "block") == rule[2] and rule[3] == ("example.org/en/1", "block") and rule[4] == ("com/fr/", "allow") and rule[5] == ("com/de/", "block") and rule[11] == ("org/", "allow")
    assert all(rule[k][0] is None and rule[k][1] in ("allow", "block") for k in (6, 7, 8, 9, 10, 12, 13))
    assert [(got[k]["host"], got[k]["path"]) for k in (1, 6, 7, 8, 9, 12)] == [("a.example.org", "/es/1"), ("", ""), ("", ""), ("", ""), ("x.org", ""), ("b.net", "")]
    assert rows(url_filter.judge(pages.limit(0))) == []


def test_words_of_a_host():
    s = url_filter.Segmenter({"the": 50, "there": 20, "thing": 30, "ring": 5, "here": 5})
    assert s.words("therething.the-ring2") == ["there", "thing", "the", "ring", "2"]
    assert s.words("zzthing") == ["zz", "thing"] and s.words("fr") == ["fr"] and s.words("x" * 5000) == ["x" * 5000]


def test_segmentation_is_the_cheapest():
    rng = random.Random(24)
    s = url_filter.Segmenter({w: rng.randrange(1, 40) for w in ("a", "ab", "ba", "bab", "abba", "bb", "cab")}, 400)
    price = lambda w: min(s.cost.get(w, math.inf), s.unknown + s.letter * len(w))
    for _ in range(60):
        run = "".join(rng.choices("abc", k=rng.randint(1, 9)))
        splits = ([run[i:j] for i, j in zip([0, *cuts], [*cuts, len(run)], strict=True)] for n in range(len(run)) for cuts in map(list, combinations(range(1, len(run)), n)))
        assert math.isclose(sum(map(price, s.words(run))), min(sum(map(price, x)) for x in splits))


def test_rare_words_and_tokens_count(spark):
    rng, letters = random.Random(12), "abcdefghijklmnopqrstuvwxyz"
    hot = sorted({"".join(rng.choices(letters, k=6)) for _ in range(31_000)})
    long = "donaudampfschifffahrtsgesellschaft"
    urls = ["http://zebraquilt.net/", f"http://zebra{long}.com/de/1"]
    pages = spark.createDataFrame([(0, urls[0], " ".join(hot + hot)), (1, urls[1], f"zebra quilt {long}")], "page_id long, url string, html string")
    judged = url_filter.judged_by_rules(pages)
    counts, total = url_filter.word_counts(pages, judged, Scratch(spark))
    assert counts["zebra"] == counts["quilt"] == counts[long] == 1 and total == 2 * len(hot) + 3
    got = by(url_filter.judge(pages), "page_id")
    assert got[0]["words"] == "host:zebra host:quilt host:net" and got[1]["words"].startswith(f"host:zebra host:{long} ")
    tokens = [(1, True, [f"t{i:05d}" for i in range(30_001)])]
    assert len(url_filter.naive_bayes(spark.createDataFrame(tokens, "page_id long, seeded boolean, tokens array<string>"))[1]) == 30_001


def test_hosts_that_keep_company_with_seeds(spark):
    """Held out: a host whose words were seen with seeds only, and plain hosts in every path language."""
    urls = [f"http://{a}{b}{i}.net/{p}/{i}" for i, (a, b, p) in enumerate([("casino", "win", "en"), ("win", "casino", "de"), ("win", "poker", "fr")] * 9)]
    plain = [f"http://{a}{b}.net/{p}/{i}" for i, (a, b, p) in enumerate(zip(*([random.Random(25).choice(x) for _ in range(200)] for x in (["garden", "river", "stone"], ["house", "works", "books"], ["en", "de", "fr", "es"])), strict=True))]
    words = "casino win poker garden river stone house works books " * 3
    pages = spark.createDataFrame([(i, u, words, "x", "y") for i, u in enumerate([*urls, "http://winwin.net/en/5", *plain, plain[0], None])], "page_id long, url string, html string, words string, block_score string")
    got = by(url_filter.judge(pages), "page_id")
    assert all(got[i]["verdict"] == "block" for i in range(len(urls) + 1)) and all(got[i]["verdict"] == "allow" for i in range(len(urls) + 1, len(urls) + 1 + len(plain) + 2))


def test_plain_hosts_of_the_given_pages_are_allowed(spark):
    pages = given(spark, "pages")
    got = [r for r in url_filter.judge(pages).collect() if r["rule"] is None]
    seeded = [r for r in got if {f"host:{w}" for w in url_filter.SEEDS} & set(r["words"].split())]
    assert all(r["verdict"] == "block" for r in seeded)
    assert sum(r["verdict"] == "block" for r in got) - len(seeded) <= 0.02 * len(got)


def test_rules_against_plain_code(spark):
    got = url_filter.judge(given(spark, "pages")).collect()
    urls = {r["page_id"]: r["url"] for r in given(spark, "pages").collect()}
    for r in got:
        _, found, rest = (urls[r["page_id"]] or "").partition("://")
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0] if found else ""
        host = host.lower() if found else ""
        fits = [(len(rule), rule, v) for rule, v in url_filter.RULES if f".{host}".endswith("." + rule.split("/")[0]) and path.startswith(rule[rule.index("/") :])]
        assert (r["host"], r["path"], r["rule"]) == (host, path, max(fits)[1] if fits else None)
        assert not fits or r["verdict"] == max(fits)[2]


# language and quality


def test_language(spark):
    rng = random.Random(6)
    kinds = {"aa": ["tion", "ing", "the"], "bb": ["oje", "ado", "cion"]}
    made = [(i, " ".join("".join(rng.choices(kinds[l], k=rng.randint(1, 3))) for _ in range(20)), l) for i, l in enumerate(["aa", "bb"] * 40)]
    odd = [(100, None, "aa"), (101, "", None), (102, "12 !? ²", "bb"), (103, "ojeadoojeado " * 20_000, None), (None, "thething", "aa")]
    df = spark.createDataFrame([(*r, "x") for r in made + odd], "doc_id long, text string, lang string, w string")
    got = by(language_id.predict(df, language_id.fit(df, ~language_id.held_out())))
    assert sum(got[i]["lang_pred"] == l for i, _, l in made) >= 78
    assert [got[k]["lang_pred"] for k in (100, 101, 102, 103)] == ["und", "und", "und", "bb"]
    assert got[100]["lang_score"] == 0 and all(0 <= r["lang_score"] <= 1 for r in got.values())
    assert all(r["lang_pred"] == "und" for r in language_id.predict(df, language_id.fit(df.limit(0), ~language_id.held_out())).collect())


def test_languages_of_the_given_documents(spark):
    docs = given(spark, "documents")
    found = language_id.predict(docs, language_id.fit(docs, ~language_id.held_out()), keep=("lang",)).where(language_id.held_out()).collect()
    judged = [r for r in found if r["lang"] is not None and r["lang_pred"] != language_id.UNKNOWN]
    assert len(judged) > 200 and sum(r["lang"] == r["lang_pred"] for r in judged) >= 0.98 * len(judged)


def test_language_by_hand(spark):
    """Every score against sums of log frequencies, ties by name, empty tables."""
    train = [(0, "la la lo", "b"), (2, "la lo lo", "a"), (3, "tu tu", "b"), (5, "zu", "a")]
    df = spark.createDataFrame([(i, t, x) for i, t, x in train], "doc_id long, text string, lang string")
    model = language_id.fit(df, F.lit(True))
    counts = {"a": {"la": 1, "lo": 2, "zu": 1}, "b": {"la": 2, "lo": 1, "tu": 2}}
    log = lambda lang, w: math.log(counts[lang].get(w, 0) + 0.5) - math.log(sum(counts[lang].values()) + 0.5 * 4)
    for text in ("la", "tu la zu", "LO lo"):
        sums = {x: sum(log(x, w) for w in text.lower().split()) for x in "ab"}
        best = max("ab", key=lambda x: sums[x])
        got = language_id.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
        assert got["lang_pred"] == best and math.isclose(got["lang_score"], 1 / sum(math.exp(v - sums[best]) for v in sums.values()))
    even = language_id.fit(df.where("doc_id < 0").unionByName(spark.createDataFrame([(1, "same", "y"), (2, "same", "x")], df.schema)), F.lit(True))
    assert language_id.predict(df, even).first()["lang_pred"] == "x"
    assert language_id.predict(df.limit(0), model).collect() == [] and {r["lang_pred"] for r in language_id.predict(df, language_id.fit(df.limit(0), F.lit(True))).collect()} == {"und"}


def test_backoff_shortens():
    m = language_id.Model(["a", "b"], {"a": {"xyzxyz": 5, "q": 1}, "b": {"mnomno": 5}})
    assert m.word("zxyz")[0] > m.word("zxyz")[1] and m.word("mn")[1] > m.word("mn")[0]
    assert m.word("ξ").tolist() == [0, 0]


def test_rare_language_keeps_its_words_beside_a_hot_one():
    made = {"".join("abcdefghij"[int(d)] for d in f"{i:05d}"): 3 for i in range(70_000)}
    rare = {"zzyx": 1, "wvut": 1}
    m = language_id.Model(["hot", "rare"], {"hot": made, "rare": rare})
    assert len(m.words) == len(made) + len(rare) and all(m.word(w)[1] > m.word(w)[0] for w in [*rare, "qzzy"])


def test_quality(spark):
    rng = random.Random(7)
    made = [(i, prose(rng, 30) + "." if i % 2 else prose(rng, 30).upper().replace(" ", "!! "), i % 2) for i in range(160)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in made] + [(900, None, "x"), (901, "", "x"), (None, "a b", "x"), (902, "z " * 100_000, "x")], "doc_id long, text string, vec string")
    labels = spark.createDataFrame([(i, q, None) for i, _, q in made] + [(900, 1, 0), (None, 0, 0), (3, None, 1), (777, 0, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    scored = quality.score(docs, quality.fit(docs, labels, ~quality.held_out(), Scratch(spark)))
    got = by(scored)
    assert all(0 <= r["quality_score"] <= 1 and r["predicted"] == (r["quality_score"] >= 0.3) for r in got.values())
    assert sum(got[i]["predicted"] == q for i, _, q in made) >= 155 and got[900]["quality_score"] == got[901]["quality_score"]
    alone = quality.fit(docs, labels.limit(0), ~quality.held_out(), Scratch(spark))
    assert {r["predicted"] for r in quality.score(docs, alone).collect()} == {1}


def test_quality_of_the_given_documents(spark):
    docs, labels = given(spark, "documents"), given(spark, "labels")
    scored = quality.score(docs, quality.fit(docs, labels, ~quality.held_out(), Scratch(spark)))
    got = scored.join(labels, "doc_id").where(quality.held_out() & F.col("quality").isNotNull()).collect()
    good, bad = ([r["quality_score"] for r in got if r["quality"] == q] for q in (1, 0))
    assert len(good) > 20 and len(bad) > 5 and sum((g > b) + (g == b) / 2 for g in good for b in bad) >= 0.97 * len(good) * len(bad)
    assert sum(g >= quality.THRESHOLD for g in good) >= 0.97 * len(good)
    assert quality.score(docs.limit(0), quality.Model()).collect() == []


def test_vectors_of_words_by_hand(spark):
    texts = ["Ab cd, ef ab", "ef gh", None, ""]
    words, vectors = quality._contexts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2), "text")
    names = ["ab", "cd", "ef", "gh"]
    assert words.tolist() == sorted(quality.hashes(names).tolist())
    index = dict(zip(names, quality.index_vectors(quality.hashes(names)), strict=True))
    for w in names:
        want = np.zeros(quality.DIM)
        for t in (["ab", "cd", "ef", "ab"], ["ef", "gh"]):
            want += sum((index[t[j]] for i in range(len(t)) for j in range(len(t)) if t[i] == w and 0 < abs(i - j) <= quality.WINDOW), np.zeros(quality.DIM))
        assert np.allclose(vectors[words.tolist().index(int(quality.hashes([w])[0]))], want / np.linalg.norm(want), atol=1e-3)


def test_long_tokens_are_read_to_their_end():
    pool = quality.Pooler(quality.hashes(["word"]), np.ones((1, quality.DIM), np.float16))
    assert quality.pieces("ab  " + "x" * 130) == ["ab", "x" * 64, "x" * 64, "xx"]
    assert (pool.text("文" * 64 + "字" * 200) != pool.text("文" * 64 + "9!9!" * 50)).any()
    assert pool.text("-" * 64 + "word")[: quality.DIM].any()


# near-duplicates


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


@pytest.mark.parametrize(("size", "percent"), [(2, 80), (5, 80), (2, 60)])
def test_minhash(spark, docs, texts, size, percent):
    rng = random.Random(8)
    more = list(texts)
    for _ in range(6):  # families of copies with a few words changed, chains included
        words = prose(rng, 80).split()
        for _ in range(7):
            words = list(words)
            words[rng.randrange(80)] = "w%d" % rng.randrange(99)
            more.append(" ".join(words))
    got = by(minhash.near_duplicates(documents(spark, more).repartition(3), Scratch(spark), words=size, percent=percent))
    sets = [shingles(t, size) for t in more]
    label = list(range(len(more)))
    for _ in range(len(more)):
        before = list(label)
        for i in range(len(more)):
            for j in range(i):
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    assert [(got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) for i in range(len(more))] == [(len(s), c, c == i) for i, (s, c) in enumerate(zip(sets, label, strict=True))]


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_signatures_within_the_distance_share_a_key(percent):
    rng, ends = np.random.default_rng(9), minhash.bounds(percent)
    a = rng.integers(0, 1 << 16, (200, minhash.HASHES)).astype(np.uint16)
    b = a.copy()
    for row in b:
        at = rng.choice(minhash.HASHES, minhash.farthest(percent), replace=False)
        row[at] ^= 1
    assert all(len(np.intersect1d(x, y)) for x, y in zip(minhash.keys_of(a, ends), minhash.keys_of(b, ends), strict=True))


# tokens


def test_byte_bpe(spark, docs, texts):
    ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by(byte_bpe.round_trip(docs))
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest() and got[i]["same"]
    there = by(byte_bpe.encode(docs))
    back = by(byte_bpe.decode(byte_bpe.encode(docs)))
    for i, t in enumerate(texts):
        assert back[i]["text"] == "".join(back[i]["pieces"]) == (t or "") and there[i]["ids"] == enc.encode_ordinary(t or "")
        parts = enc.decode_tokens_bytes(there[i]["ids"])
        assert there[i]["starts"] == [0, *np.cumsum([len(x) for x in parts]).tolist()][: len(parts)]
        raw = (t or "").encode()
        assert there[i]["characters"] == [len(raw[:x].decode(errors="ignore")) for x in there[i]["starts"]]
    own = byte_bpe.codec(public_tokenizers.path(byte_bpe.VOCABULARY), public_tokenizers.PATTERN)
    for text in (" " * 300_000 + "x", "é漢🎉 x🎉", "ab" * 20_000):
        ids = own.encode(text)[0]
        assert own.decode(ids) == text.encode() and "".join(own.pieces(ids)) == text
    assert own.decode([10**6, *own.encode("a")[0]], "ignore") == b"a"
    with pytest.raises(KeyError):
        own.decode([10**6])
    every = bytes(range(256))
    assert byte_bpe.from_visible(byte_bpe.visible(every)) == every and len(set(byte_bpe.visible(every))) == 256


# fingerprints


def test_simhash(spark, docs, texts):
    got = by(simhash.compare_with_edits(docs, Scratch(spark), queries=2))
    full = [t or "" for t in texts]
    for i, t in enumerate(full):
        edited = t[: len(t) - len(t) // 4] + full[(i + 1) % len(full)][: len(t) // 4]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[i]["near_edited"] <= 1 and len(got[i]["fingerprint"]) == 32
        bits = lambda k: int(got[i][k], 16)  # noqa: E731, B023
        assert got[i]["near_edited"] == 1 - (bits("fingerprint") ^ bits("edited_fingerprint")).bit_count() / 128
        assert got[i]["near_next"] == 1 - (bits("fingerprint") ^ int(got[(i + 1) % len(full)]["fingerprint"], 16)).bit_count() / 128
        others = [j for j in range(len(full)) if j != i and (bits("fingerprint") ^ int(got[j]["fingerprint"], 16)).bit_count() <= simhash.RADIUS]
        assert got[i]["n_near"] == (None if i % 2 else len(others))
    assert got[0]["fingerprint"] == got[1]["fingerprint"] and got[8]["fingerprint"] == got[9]["fingerprint"]


def test_fingerprint_bits(spark, docs, texts):
    """Every bit against a vote counted term by term."""
    got = by(simhash.compare_with_edits(docs, Scratch(spark)))
    for i, text in enumerate(texts):
        if len(text or "") > 20_000:
            continue
        words = [w[k : k + 8] for w in re.findall(r"[^ \t\n\x0b\f\r]+", text or "") for k in range(0, len(w), 8)] or [""]
        terms = spark.createDataFrame(list(zip(words, [*words[1:], None], strict=True)), "w string, x string")
        hashes = [(r[0], r[1]) for r in terms.select(F.xxhash64(F.lit(1), "w", "x"), F.xxhash64(F.lit(2), "w", "x")).collect()]
        want = 0
        for half, shift in ((0, 64), (1, 0)):
            for b in range(64):
                if 2 * sum(h[half] >> b & 1 for h in hashes) > len(hashes):
                    want |= 1 << (shift + b)
        assert int(got[i]["fingerprint"], 16) == want, i


def test_every_row_has_a_fingerprint(spark):
    got = rows(simhash.compare_with_edits(documents(spark, ["a b", "a b", "c", None, "d e", "d e"], [5, 5, 5, None, None, None]), Scratch(spark), queries=1))
    assert len(got) == 6 and sum(r["doc_id"] is None for r in got) == 3 and all(r["n_near"] is None for r in got if r["doc_id"] is None)
    assert [r["n_near"] for r in got if r["doc_id"] == 5 and r["n_chars"] == 3] == [1, 1]


def test_near_copies_are_found(spark):
    rng, made = random.Random(13), []
    for _ in range(60):  # pairs of 200 words, one of them changed
        words = ["w%d" % rng.randrange(10**6) for _ in range(200)]
        made += [" ".join(words), " ".join([*words[:90], "changed", *words[91:]])]
    got = by(simhash.compare_with_edits(documents(spark, made), Scratch(spark), queries=1))
    assert sum(r["n_near"] == 1 for r in got.values()) >= 0.9 * len(made) and all(r["n_near"] <= 1 for r in got.values())


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6, 8, 11])
def test_hamming_search_gives_each_pair_once(spark, radius):
    rng = random.Random(radius)
    found = [rng.getrandbits(128) for _ in range(40)]
    found += [x ^ sum(1 << b for b in rng.sample(range(128), rng.randint(1, radius + 2))) for x in found for _ in range(3)]
    key = lambda x: ((x >> 64) - (x >> 127 << 64), (x & (1 << 64) - 1) - ((x >> 63 & 1) << 64))
    df = spark.createDataFrame([key(x) for x in found], "high long, low long")
    asked = found[::3]
    some = spark.createDataFrame([key(x) for x in asked], "high long, low long")
    got = sorted(((r["a_high"], r["a_low"]), (r["b_high"], r["b_low"]), r["distance"]) for r in simhash.near_fingerprints(some, df, Scratch(spark), radius).collect())
    assert got == sorted((key(a), key(b), (a ^ b).bit_count()) for a in set(asked) for b in set(found) if a != b and (a ^ b).bit_count() <= radius)


# shards


def test_sharding(spark, texts):
    rng = random.Random(10)
    more = [*(t for t in texts if len(t or "") < 10_000), *[prose(rng, rng.randint(5, 60)) for _ in range(400)]]
    more += [more[40]] * 60  # a large group, and equal rows
    df = documents(spark, more, [*range(len(more) - 2), None, 3])
    got = sharding.shard(df, Scratch(spark), shards=8).collect()
    assert len(got) == len(more)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in more)
    sizes, places, of = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        sizes[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
        of[r["text_crc32"]].add(r["shard"])
    assert set(sizes) == set(range(8)) and max(sizes.values()) <= 1.15 * sum(sizes.values()) / 8
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    large = {zlib.crc32(more[40].encode())}
    assert all(len(s) == 1 for c, s in of.items() if c not in large)


# empty tables


def test_splits_are_at_the_weighted_medians(spark):
    """Every cut of the tree against all cuts that there are."""
    rng = random.Random(31)
    df = spark.createDataFrame([(i, prose(rng, rng.randint(1, 90)), rng.choice(["de", "en", "fr"]), f"src{rng.randrange(12)}") for i in range(400)], "doc_id long, text string, lang string, source string")
    raw = F.col("text").cast("binary")
    rows_ = df.select(F.col("doc_id").alias("id"), (F.octet_length("text").cast("long") + 1).alias("size"), F.octet_length("text").cast("long").alias("text_size"), F.xxhash64(raw).alias("text_hash"), "lang", "source")
    points = sharding._dimension_key(sharding._groups(rows_, 10**9, 0.25)).withColumn("mixed", F.xxhash64("text_hash")).persist()
    places = points.agg(*(F.count_distinct(c).alias(c) for c in ("lang", "source"))).first()
    assert (places["lang"], places["source"]) == (3, 12)
    splits, parents = sharding.k_d_tree(points, 8), {0: 8}
    assert len(splits) == 7
    for s in splits:
        parents |= {s["left"]: parents[s["node"]] // 2, s["right"]: -(-parents[s["node"]] // 2)}
    for k, s in enumerate(splits):
        upto = [x for x in splits if x["node"] < s["node"]]
        order = F.expr(s["dim"])
        keyed = sharding.assigned(points, upto).where(f"node = {s['node']}").select("weight", sharding._order(order, F.col("mixed")).alias("key")).collect()
        total = sum(r["weight"] for r in keyed)
        left = lambda cut: sum(r["weight"] for r in keyed if r["key"] < cut)  # noqa: B023, E731
        want = total * (parents[s["node"]] // 2) / parents[s["node"]]
        assert abs(left(s["cut"]) - want) == min(abs(left(c) - want) for c in [*(r["key"] for r in keyed), 1 << 62])


def test_empty_tables(spark, docs):
    none, scratch = docs.limit(0), Scratch(spark)
    for out in (suffix_dedup.dedup(none, scratch), packing.pack_documents(none, scratch), minhash.near_duplicates(none, scratch), byte_bpe.round_trip(none), simhash.compare_with_edits(none, scratch), sharding.shard(none, scratch)):
        assert out.count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_join.link(vectors, scratch).count() == 0


@pytest.mark.parametrize("with_text", [True, False])
def test_rows_without_an_id(spark, with_text):
    text = prose(random.Random(11), 60) if with_text else None
    df, scratch = documents(spark, [text, text, text], [None, 4, 5]), Scratch(spark)
    assert suffix_dedup.dedup(df, scratch).count() == packing.pack_documents(df, scratch).count() == sharding.shard(df, scratch).count() == byte_bpe.round_trip(df).count() == 3
    found = minhash.near_duplicates(df, scratch).collect()
    assert len(found) == 3 and sum(r["kept"] for r in found) == (1 if with_text else 2)
    assert simhash.compare_with_edits(df, scratch).count() == 3


def test_one_text_larger_than_a_shard_leaves_the_others_even(spark):
    rng = random.Random(12)
    df = documents(spark, ["long " * 20_000, *[prose(rng, 30) for _ in range(200)]])
    sizes = defaultdict(int)
    for r in sharding.shard(df, Scratch(spark), shards=5).collect():
        sizes[r["shard"]] += r["size"]
    rest = sorted(sizes.values())[:-1]
    assert len(sizes) == 5 and max(rest) <= 1.2 * min(rest)
