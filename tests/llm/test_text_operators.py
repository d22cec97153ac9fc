"""Encoding, token counts, classifier, language and rules against plain versions, with nulls, empty and long texts."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
import tokenizers
from pyspark.sql import functions as F

from holdshort.llm import byte_bpe, language_id, license_scan, quality_classifier, quality_rules, token_counts
from holdshort.session import scratch_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [
    None, "", " ", "\n\n", "a", "It's 12 o'clock,  isn't it?\tYes!\r\n", "x" * 30_000, "ab " * 20_000, "  lead", "trail  ",
    "漢字 と かな 😀😀", "  wide  space", "<|endoftext|> special <|endoftext|>", "naïve façade ſ", "zz\x85\x1f zz", "ab",
]


@pytest.fixture(scope="module")
def vocabulary(spark):
    return byte_bpe.Vocabulary.read(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(ODD)] + [(None, "no id", "en", "s", 1), (0, "a", "en", "s", 1), (0, "a", "en", "s", 1)]
    return spark.createDataFrame(rows, DOCS)


def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def test_bpe_equals_the_library_and_decodes(odd_docs, vocabulary):
    expected = library(vocabulary)
    rows = byte_bpe.decode(byte_bpe.encode(odd_docs, vocabulary), vocabulary).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        assert row.ids == expected.encode_ordinary(row.text or "")
        assert bytes(row.data) == (row.text or "").encode()


def test_bpe_of_random_strings(vocabulary):
    pick = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "é", "1", ".", "!", "'s", "the", "ing", "漢", "😀", "thing", "\t", "=-"]
    encoder, expected = byte_bpe.Encoder(vocabulary), library(vocabulary)
    for _ in range(3000):
        text = "".join(pick.choices(parts, k=pick.randint(0, 25)))
        assert encoder.text(text) == expected.encode_ordinary(text)


def test_bpe_of_an_empty_table_and_of_clashing_names(odd_docs, vocabulary):
    assert byte_bpe.encode(odd_docs.limit(0), vocabulary).collect() == []
    with pytest.raises(ValueError, match="ids"):
        byte_bpe.encode(odd_docs.withColumn("ids", F.lit(1)), vocabulary)
    extra = odd_docs.withColumnRenamed("n_chars", "data")
    assert byte_bpe.encode(extra, vocabulary).columns == [*extra.columns, "ids"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_equal_the_library(spark, odd_docs, name):
    path = public_tokenizers.path(name)
    tokenizer = token_counts.Tokenizer(path)
    assert tokenizer.by_unit == (name == "byte_bpe_50k.json")
    store = scratch_path(spark, "test-store")
    rows = token_counts.token_counts(odd_docs, tokenizer, store).collect()
    if name.endswith(".json"):
        plain = tokenizers.Tokenizer.from_file(path)
        plain.no_truncation()
        count = lambda t: len(plain.encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece
        plain = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(plain.encode(t))
    texts = [r.text or "" for r in odd_docs.collect()]
    expected = sorted((len(t.encode()), count(t)) for t in texts)
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == expected


def test_token_counts_are_encoded_once_and_kept(spark, odd_docs):
    tokenizer = token_counts.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    store = scratch_path(spark, "test-store")
    empty = token_counts.token_counts(odd_docs.limit(0), tokenizer, store)
    assert empty.collect() == []
    token_counts.token_counts(odd_docs, tokenizer, store).collect()
    first = spark.read.parquet(store).count()
    assert first == len({t or "" for t in ODD} | {"no id"})
    again = token_counts.token_counts(odd_docs.withColumn("n_tokens", F.lit("clash")), tokenizer, store)
    assert again.columns == ["doc_id", "n_bytes", "n_tokens"] and again.count() == odd_docs.count()
    assert spark.read.parquet(store).count() == first
    token_counts.token_counts(spark.createDataFrame([(1, "quite new")], "doc_id long, text string"), tokenizer, store).collect()
    assert spark.read.parquet(store).count() == first + 1


def clean(i, words=120):
    pick = random.Random(i)
    return " ".join(pick.choices(["the", "thing", "over", "ater", "inline", "river", "stone", "walks", "green", "often"], k=words))


def junk(i):
    pick = random.Random(i)
    return " ".join(w.upper() + "!!" for w in clean(i, 80).split()) if pick.random() < 0.5 else " ".join(w + "***" for w in clean(i, 80).split())


def test_classifier_on_rows_it_did_not_learn_from(spark):
    rows = [(i, clean(i) if i % 4 else junk(i), int(i % 4 > 0)) for i in range(240)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (None, "the river"), (902, "long " * 50_000)],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (950, None), (3, 1)], "doc_id bigint, quality int")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = quality_classifier.fit(docs, labels, fold != 1)
    scores = {r.doc_id: r.score for r in quality_classifier.score(docs, model).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    held = [(scores[r.doc_id], rows[r.doc_id][2]) for r in docs.where((fold == 1) & (F.col("doc_id") < 900)).collect()]
    assert len(held) > 40 and sum((s >= 0.5) == q for s, q in held) / len(held) > 0.97
    assert scores[900] == scores[901]
    changed = labels.withColumn("quality", F.when(fold == 1, 0).otherwise(F.col("quality")))
    again = quality_classifier.fit(docs, changed, fold != 1)
    assert (again.logits == model.logits).all() and again.bias == model.bias
    with pytest.raises(ValueError):
        quality_classifier.score(docs.withColumn("score", F.lit(0.0)), model)


def test_classifier_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality_classifier.fit(docs, none, F.lit(True))
    assert {r.score for r in quality_classifier.score(docs, model).collect()} == {0.5}
    assert quality_classifier.score(docs.limit(0), model).collect() == []


TONGUES = {"en": "the and of with this from that have for not", "de": "der und die mit das von nicht ein auch für",
           "fr": "le et les avec une dans que pas pour sur"}


def tongue(lang, i, words=30):
    return " ".join(random.Random(f"{lang}{i}").choices(TONGUES[lang].split(), k=words))


def test_language_fuses_text_declaration_and_host(spark):
    docs = spark.createDataFrame([(i, tongue(lang, i), lang) for lang in TONGUES for i in range(40)], "doc_id bigint, text string, lang string")
    model = language_id.fit(docs)
    assert model.languages == ["de", "en", "fr"]
    rows = [(f"{lang}{i}", tongue(lang, i + 100), lang if i % 2 else None, f"h.{lang}") for lang in TONGUES for i in range(20)]
    rows += [("short", "die", None, "h.de"), ("short2", "die", None, None), ("none", None, "fr", "h.fr"), ("empty", "", None, None),
             ("glyphs", "漢字 かな 漢字 変換 交じり 文章 言語 判定 " * 5, None, None), (None, tongue("en", 1), "en", "h.en"),
             ("lies", tongue("de", 7), "fr", "h.de"), ("dup", "le et", "fr", "h.fr"), ("dup", "le et", "fr", "h.fr"),
             ("long", tongue("fr", 3, 60_000), None, "h.en")]
    table = spark.createDataFrame(rows, "key string, text string, declared string, host string").withColumn("lang", F.lit("clash"))
    out = language_id.identify(table, model).collect()
    assert len(out) == len(rows)
    found = {r.key: r for r in out}
    assert all(found[f"{lang}{i}"].lang == lang and found[f"{lang}{i}"].reliable for lang in TONGUES for i in range(20))
    assert found["short"].lang == "de" and found["short"].probability >= found["short2"].probability
    assert found["none"].lang == "fr" and not found["none"].reliable and not found["empty"].reliable
    assert found["glyphs"].lang == "und" and not found["glyphs"].reliable
    assert found["lies"].lang == "de" and found["dup"].lang == "fr" and found["long"].lang == "fr"
    assert language_id.identify(table.limit(0), model).collect() == []


def test_language_without_labelled_rows(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id bigint, text string, lang string")
    model = language_id.fit(docs)
    table = spark.createDataFrame([("a", "text", None, None)], "key string, text string, declared string, host string")
    assert language_id.identify(table, model).first().lang == "und"


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_a_plain_version(spark, odd_docs):
    pick = random.Random(2)
    texts = [" ".join(pick.choices("abc", k=pick.randint(0, 40))) for _ in range(60)]
    texts += ["\n".join(pick.choices(["x y", "", " ", "z", "x y "], k=12)) for _ in range(20)]
    docs = odd_docs.unionByName(spark.createDataFrame([(i + 100, t, None, None, None) for i, t in enumerate(texts)], DOCS))
    rows = quality_rules.measures(docs).collect()
    got = Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == Counter(plain_measures(r.text) for r in docs.collect())


def test_rules_find_accuracies_and_judge(spark):
    rows = [(i, clean(i) + f" w{i}", 1) for i in range(150)] + [(i, junk(i) + " # # $ % & * | <", 0) for i in range(150, 190)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None), (500, ""), (501, "a " * 60_000)], "doc_id bigint, text string")
    out = {r.doc_id: r for r in quality_rules.judge(docs.withColumn("quality", F.lit("clash"))).collect()}
    assert len(out) == docs.count()
    right = sum((out[i].quality >= 0.5) == bool(q) for i, _, q in rows)
    assert right / len(rows) > 0.95
    assert out[501].n_repeat_words == 60_000
    assert quality_rules.judge(docs.limit(0)).collect() == []


def test_expectation_maximisation_against_a_plain_version(spark):
    pick = random.Random(3)
    votes = [tuple(pick.choices((-1, 0, 1), weights=((7, 2, 1) if i % 5 == 0 else (1, 2, 7)))[0] for _ in range(4)) for i in range(500)]
    table = spark.createDataFrame(list(votes), "a int, b int, c int, d int")
    patterns = table.groupBy("a", "b", "c", "d").agg(F.count(F.lit(1)).alias("n"))
    got = {tuple(r[:4]): r[4] for r in table.distinct().withColumn("p", quality_rules.estimate(patterns, list("abcd"))).collect()}

    good, bad, share = [0.995] * 4, [0.9] * 4, [0.05] * 4

    def odds(v):
        start = [s / (1 - sum(share)) for s in share]
        return [start[j] * {-1: bad[j] / (1 - good[j]), 1: (1 - bad[j]) / good[j], 0: 1}[v[j]] for j in range(4)]

    for _ in range(40):
        faults = [[o / (1 + sum(odds(v))) for o in odds(v)] for v in votes]
        extra = 0.02 * len(votes)
        new = []
        for j in range(4):
            mine, at, sound = [f[j] for f in faults], [v[j] for v in votes], [1 - sum(f) for f in faults]
            new.append((
                sum(mine) / len(votes),
                min(0.9999, (sum(f for f, v in zip(sound, at) if v == 1) + 0.995 * extra) / (sum(f for f, v in zip(sound, at) if v) + extra)),
                min(0.9999, (sum(f for f, v in zip(mine, at) if v == -1) + 0.9 * extra) / (sum(f for f, v in zip(mine, at) if v) + extra))))
        share, good, bad = (list(x) for x in zip(*new))
    assert all(abs(1 / (1 + sum(odds(v))) - p) < 1e-3 for v, p in got.items())


def test_licences(spark):
    mit = ('Copyright (c) 2020 Someone\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and '
           'associated documentation files.\n\nThe above copyright notice and this permission notice shall be included in all\ncopies of '
           'it.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED.')
    texts = {1: "A line.\nReleased under the MIT License.\nMore.", 2: "Licensed under CC BY-NC 4.0.", 3: mit,
             4: "This work is licensed under the GNU General Public License, version 3. Licensed under the Apache License, Version 2.0.",
             5: "No licence here.", 6: None, 7: "", 8: "Nothing at all", 9: "x. " * 30_000 + "Released under the MIT License.",
             10: "Licensed under CC BY 4.0."}
    docs = spark.createDataFrame([*texts.items(), (1, texts[1]), (None, texts[2])], "doc_id bigint, text string")
    rows = license_scan.scan(docs.withColumn("known", F.lit("clash"))).collect()
    assert len(rows) == 12
    found = {r.doc_id: r for r in rows}
    assert [found[i].licenses for i in (1, 2, 3, 5, 6, 7, 8, 9, 10)] == [
        ["MIT"], ["CC-BY-NC-4.0"], ["MIT"], [], [], [], [], ["MIT"], ["CC-BY-4.0"]]
    assert sorted(found[4].licenses) == ["Apache-2.0", "GPL-3.0"] and found[5].n_unknown == 1
    assert found[3].known == ["mit-permission", "mit-notice", "mit-provided"] and found[None].licenses == ["CC-BY-NC-4.0"]
    assert license_scan.scan(docs.limit(0)).collect() == []


def test_digests_of_the_query(spark, vocabulary):
    from holdshort.llm import queries  # noqa: F401
    from holdshort.llm.registry import QUERIES

    rows = QUERIES["op5_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    expected = library(vocabulary)
    assert len(rows) == len(texts)
    for row in rows:
        ids = expected.encode_ordinary(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()
