"""Packing, source divergence and spelling variants against brute force, with nulls, ties, repeats and empty tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from holdshort.llm import pattern_packing, source_divergence, spelling_variants, token_counts
from holdshort.llm.queries import op12_source_divergence, op13_spelling_variants
from holdshort.llm.units import separated

DOCS = "doc_id bigint, text string, lang string, source string"
TOKENIZER = token_counts.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def odd_texts(pick, n):
    parts = ["word", "Élan", "  ", "\n", " \n ", "\t", "x", "12", "'s", "<|endoftext|>", "漢字", " ", "\x1c", ".", "a b", " "]
    return ["".join(pick.choice(parts) for _ in range(pick.randint(0, 12))) for _ in range(n)]


def test_units_keep_the_librarys_ids():
    encoder, whole = pattern_packing._Encoder(TOKENIZER.data, TOKENIZER.by_unit), library()
    texts = odd_texts(random.Random(1), 3000) + ["", " ", "\n", "a", " a", "a ", "a  b", "a\n b", "a b\n", "a b\n c"]
    expected = [whole.encode(text, add_special_tokens=False).ids for text in texts]
    for size in (1, 7, 128):
        found = [x for i in range(0, len(texts), size) for x in encoder.ids(texts[i:i + size])]
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in found] == expected


@pytest.mark.parametrize("capacity", [1, 2, 7, 64, 1024])
def test_plan_fills_sequences_without_gaps(capacity):
    pick = np.random.default_rng(capacity)
    for counts in (np.zeros(capacity + 1), pick.integers(0, 50, capacity + 1), pick.integers(0, 2, capacity + 1),
                   np.bincount(pick.integers(1, capacity + 1, 500), minlength=capacity + 1)):
        counts = counts.astype(np.int64)
        counts[0] = 0
        plan = pattern_packing.Plan.of(counts, capacity)
        used = defaultdict(list)
        for length in np.flatnonzero(counts):
            ranks = np.arange(counts[length])
            for s, o in zip(*plan.find(np.full(len(ranks), length), ranks)):
                used[int(s)].append((int(o), int(length)))
        assert sorted(used) == list(range(plan.n_sequences))
        for parts in used.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        total = int((counts * np.arange(capacity + 1)).sum())
        least = max(-(-total // capacity), int(counts[capacity // 2 + 1:].sum()))
        assert least <= plan.n_sequences <= least * 1.02 + 2


def test_patterns_and_their_fit():
    rows = pattern_packing.patterns(np.arange(1, 31), 30)
    brute = {(a, b, 30 - a - b) for a in range(31) for b in range(a, 31) if b <= 30 - a - b and (a == 0 or a > 0)}
    assert {tuple(r) for r in rows.tolist()} == brute
    truth = np.zeros(len(rows))
    truth[[3, 10, 20]] = [500, 40, 7]
    counts = sum(np.bincount(c, truth, 31) for c in rows.T)
    counts[0] = 0
    found = pattern_packing.least_squares(rows, counts, steps=3000)
    again = sum(np.bincount(c, found, 31) for c in rows.T)
    assert (found >= 0).all() and np.abs(again[1:] - counts[1:]).max() < 0.5


def packing_rows():
    pick = random.Random(3)
    rows = [(i, " ".join(pick.choice(["alpha", "beta", "gamma", "delta,", "\n"]) for _ in range(pick.randint(0, 300))), "en", "s") for i in range(150)]
    rows += [(200, None, None, None), (201, "", "en", "s"), (None, "no id", "en", "s"), (None, "no id", "en", "s"), (5, "again", "en", "s"),
             (202, "long text " * 5000, "en", "s"), (203, "x" * 3000, "en", "s"), (204, " ".join(["one"] * 1023), "en", "s")]
    return rows + [(300 + i, "the same copy of it all " * 20, "en", "hot") for i in range(60)]


def test_packing_against_the_library(spark):
    rows = packing_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumn("length", F.lit("clash")).withColumn("offset", F.lit("clash"))
    out = pattern_packing.pack(docs, TOKENIZER, ids=True).collect()
    assert out[0].asDict().keys() == {"doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"}
    expected, whole = Counter(), library()
    for doc_id, text, *_ in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            part = np.array(ids[a:b], dtype="<u4")
            expected[doc_id, piece, a, b - a, zlib.crc32(part.tobytes()), tuple(ids[a:b])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in out) == expected
    places = defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 1024
    total = sum(r.length for r in out)
    assert len(places) <= -(-total // 1024) * 1.05 + 1
    plain = pattern_packing.pack(docs.select("doc_id", "text"), TOKENIZER)
    assert "ids" not in plain.columns and plain.count() == len(out)
    assert pattern_packing.pack(docs.limit(0), TOKENIZER).collect() == []
    with pytest.raises(ValueError, match="capacity"):
        pattern_packing.pack(docs, TOKENIZER, capacity=1 << 14)


def plain_audit(rows, min_docs, top):
    groups, lang_docs, lang_n = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang, source].update(terms)
        lang_docs[lang].update(set(terms))
        lang_n[lang].update(terms)
    out = set()
    for lang in lang_docs:
        kept = [t for t, n in lang_docs[lang].items() if n >= min_docs]
        v = len(kept)

        def p(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 5) // (n + 5 * v) for t in kept}

        q = p(lang_n[lang])
        own = {s: p(c) for (x, s), c in groups.items() if x == lang}
        for s in own:
            pairs = [(-sum(abs(own[s][t] - own[o][t]) for t in kept), o.encode(), o) for o in own if o != s]
            terms = [(q[t] - own[s][t], t.encode(), t) for t in kept if groups[lang, s][t] and own[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                out |= {(lang, s, part, item, -less, i + 1) for i, (less, _, item) in enumerate(sorted(found)[:most])}
    return out


def audit_rows():
    pick = random.Random(5)
    words = ["river", "Fluß", "été", "naïve", "İzmir", "alpha", "beta", "gamma", "漢字", "don't", "A1B", "x_y", "the", "and", "aa", "ab"]
    rows = [(i, " ".join(pick.choice(words[: 6 + i % 11]) for _ in range(pick.randint(0, 40))), pick.choice(["en", "de", None, ""]),
             pick.choice(["s1", "s2", "s3", "é", None])) for i in range(400)]
    rows += [(500, None, "en", "only null"), (501, "12 34", "en", "no terms"), (502, "lonely word", "fr", "a"), (503, None, "fr", "b"),
             (504, "it " * 200_000, "en", "s1"), (None, "river river", "en", "s1")]
    return rows + [(600, "copy of river and alpha", "en", "hot")] * 90


def test_audit_against_brute_force(spark, monkeypatch):
    rows = audit_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumn("term", F.lit("clash")).withColumn("n", F.lit("clash"))
    for block in (source_divergence.BLOCK, 3):
        monkeypatch.setattr(source_divergence, "BLOCK", block)
        out = source_divergence.audit(docs, min_docs=12, top=4)
        assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert {tuple(r) for r in out.collect()} == plain_audit(rows, 12, 4)
    assert source_divergence.audit(docs.limit(0)).collect() == []


def test_audit_query_against_brute_force(spark, tmp_path):
    rows = audit_rows()
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert {tuple(r) for r in op12_source_divergence(spark, str(tmp_path)).collect()} == plain_audit(rows, 30, 50)


def test_gallop_and_prices():
    pick = np.random.default_rng(2)
    for sizes in ((0, 5), (1, 1), (3, 400), (50, 60), (200, 5000)):
        a, b = (np.sort(pick.choice(6000, n, replace=False)) for n in sizes)
        at, where = source_divergence.gallop(a, b)
        assert np.array_equal(a[at], np.intersect1d(a, b)) and np.array_equal(a[at], b[where])
    counts = np.array([0, 1, 7, 10**6, 10**15])
    for divisor in (5, 999, 10**9 + 7, 10**15 + 3, 10**17):
        own = counts[counts + 5 <= divisor]
        assert source_divergence.prices(own, divisor).tolist() == [1 + 10**9 * (int(c) + 5) // divisor for c in own]


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_groups(counts, ratio=10):
    words, out = sorted(counts), {}
    forms = {}
    for w in words:
        beside = [v for v in words if near(w, v)]
        best = min(beside, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
        out[w] = len(beside)
    rows = set()
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, forms[w], root, counts[w], out[w], counts[forms[w]] if forms[w] else None))
    return rows


def variants(pick, n, letters="abéñz"):
    base = ["".join(pick.choice(letters) for _ in range(pick.randint(7, 12))) for _ in range(n)]
    out = set(base) | {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "bbbbbbb", "éééñzab"}
    for w in base:
        for _ in range(4):
            at = pick.randrange(len(w) + 1)
            out |= {w[:at] + pick.choice(letters) + w[at:], w[:at] + w[at + 1:], w[:at] + pick.choice(letters) + w[at + 1:]}
    return [w for w in sorted(out) if len(w) >= 7]


@pytest.mark.parametrize("shard", [1 << 17, 60])
def test_variants_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(spelling_variants, "SHARD_CHARS", shard)
    monkeypatch.setattr(spelling_variants, "SEARCHED", 50)
    pick = random.Random(7)
    counts = {w: pick.choice([2, 2, 3, 20, 30, 300, 4000]) for w in variants(pick, 60)}
    counts["y" * 500], counts["y" * 501] = 2, 20
    df = spark.createDataFrame(list(counts.items()) + [(None, 5)], "word string, n bigint").withColumn("shard", F.lit("clash"))
    out = spelling_variants.group(df)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in out.collect()} == plain_groups(counts)
    assert spelling_variants.group(df.limit(0)).collect() == []


@pytest.mark.parametrize("table_bytes", [1 << 20, 4000, 200])
def test_index_finds_all_words_one_error_away(table_bytes):
    pick = random.Random(9)
    words = [w.encode("latin-1") for w in variants(pick, 40)]
    index = spelling_variants.Index(sorted(words), table_bytes)
    words.sort()
    asked = words + [b"notherequ", b"zzzzzzzzzz"]
    for exact in (3, 0):
        sizes = np.full(len(asked), exact)
        q, found = index.near(asked, sizes)
        expected = {(i, j) for i, w in enumerate(asked) for j, v in enumerate(words) if near(w, v) and w[:exact] == v[:exact]}
        assert set(zip(q.tolist(), found.tolist())) == expected and len(q) == len(expected)


def plain_words(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_spelling_query_against_brute_force(spark, tmp_path):
    pick = random.Random(11)
    vocabulary = [pick.choice(["", "É", "pre"]) + w for w in variants(pick, 12, "abcÀéÿ÷")] + ["short", "naïveté", "Wörterbuch", "STRASSENß"]
    rows = [(i, " ".join(pick.choice(vocabulary[: 5 + i % 40]) for _ in range(40)) + "—x漢字y", "en", "s") for i in range(300)]
    rows += [(400, None, None, None), (401, "", "en", "s"), (None, "nowhere nowhere", "en", "s"), (402, "Longtext " * 200_000, "en", "s")]
    rows += [(500, "thousands of copies, thousandz", "en", "hot")] * 80
    spark.createDataFrame(rows, DOCS).withColumn("n", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    counts = plain_words(rows)
    found = spelling_variants.vocabulary(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert dict(map(tuple, found.collect())) == counts
    assert {tuple(r) for r in op13_spelling_variants(spark, str(tmp_path)).collect()} == plain_groups(counts)


def test_long_texts_are_parted_at_spaces():
    data = b"ab cde  fghij klm " + b"z" * 50 + b" end"
    for size in (1, 3, 10, 1000):
        parts = list(separated(data, size))
        assert b" ".join(parts) == data and [w for p in parts for w in p.split()] == data.split()
