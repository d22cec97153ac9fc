"""Shards, mixing, top-k, fingerprints and the pipeline against brute force, with nulls, ties, repeats and empty tables."""

import math
import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from holdshort.llm import golay_simhash, hilbert_shards, mixing, ordering, top_k
from holdshort.llm.components import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize(("dims", "bits"), [(1, 3), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = hilbert_shards.hilbert_index(points, bits)
    assert sorted(index) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(index)], axis=0)).sum(1) == 1).all()


def test_shards_are_gapless_runs_of_the_curve(spark):
    pick = random.Random(1)
    rows = [(i if i % 20 else None, pick.choice(["en", "de", None]), pick.choice(["src1", "src2", "src10", "other", None]), pick.randint(1, 9))
            for i in range(1003)] + [(7, "en", "src1", 3)] * 500
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, size bigint")
    out = hilbert_shards.shards(df, ["lang", "source", "size"], ["doc_id"], n_shards=8, bits=6)
    found = out.collect()
    assert len(found) == len(rows)
    by = defaultdict(list)
    for r in found:
        by[r.shard].append(r)
    assert sorted(by) == list(range(8)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    ends = []
    for shard in sorted(by):
        ordered = sorted(by[shard], key=lambda r: r.slot)
        assert [r.slot for r in ordered] == list(range(len(ordered)))
        ends += [r.curve_index for r in ordered]
    assert ends == sorted(ends)
    again = {(r.shard, r.slot): (r.doc_id, r.lang, r.source, r.size) for r in hilbert_shards.shards(
        df.repartition(7), ["lang", "source", "size"], ["doc_id"], n_shards=8, bits=6).collect()}
    assert again == {(r.shard, r.slot): (r.doc_id, r.lang, r.source, r.size) for r in found}


def test_shards_of_few_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", None)], "doc_id bigint, lang string, size bigint")
    assert sorted(r.slot for r in hilbert_shards.shards(df, ["lang", "size"], ["doc_id"]).collect()) == [0, 0]
    assert hilbert_shards.shards(df.limit(0), ["lang", "size"], ["doc_id"]).collect() == []
    with pytest.raises(ValueError, match="slot"):
        hilbert_shards.shards(df.withColumn("slot", F.lit(1)), ["lang"], ["doc_id"])


def test_positions_and_sums(spark):
    df = spark.createDataFrame([(i * 7 % 500, i % 3 if i % 5 else None) for i in range(500)], "k int, v long")
    rows = ordering.in_order(df, [F.col("k")], {"before": "v"}).orderBy("k").collect()
    total = 0
    for i, r in enumerate(rows):
        assert (r._position, r.before) == (i, total)
        total += r.v or 0


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("seed", range(3))
def test_mix_meets_its_targets(spark, seed):
    pick = random.Random(seed)
    sources = ["a", "b", "B", "é", "zz", None][:pick.randint(3, 6)]
    rows = [(i, pick.choice(sources), pick.choice([0, 1, 5, 50, 3000]), pick.random() + 0.01) for i in range(300)]
    rows += [(None, "a", 10, 1.0), (1, "a", 10, 1.0), (1, "a", 10, 1.0)] + [(i + 1000, "hot", 7, 0.5) for i in range(600)]
    df = spark.createDataFrame(rows, "key bigint, source string, size bigint, weight double")
    out = mixing.mix(df).collect()
    sizes = defaultdict(int)
    for _, s, n, _ in rows:
        sizes[s] += n
    targets, taken = plain_targets(dict(sizes)), defaultdict(int)
    assert len(out) == len(rows)
    for r in out:
        assert math.isclose(r.target, targets[r.source], rel_tol=1e-9) and r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    as_set = lambda rows_: sorted((str(r.key), str(r.source), r.size, r.taken) for r in rows_)
    assert as_set(out) == as_set(mixing.mix(df.repartition(5)).collect())


def test_mix_prefers_weight_and_takes_whole_epochs_first(spark):
    rows = [(i, "a", 10, 50.0 if i < 100 else 0.02) for i in range(200)] + [(i + 500, "b", 10, 1.0) for i in range(200)]
    out = mixing.mix(spark.createDataFrame(rows, "key bigint, source string, size bigint, weight double"), weights=(1, 5), share=1.2).collect()
    a = [r for r in out if r.source == "a"]
    assert sum(r.taken for r in a if r.key < 100) > 5 * sum(r.taken for r in a if r.key >= 100)
    assert all(r.taken >= 10 for r in out if r.source == "b")


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "key bigint, source string, size bigint, weight double")
    assert mixing.mix(empty).collect() == []
    none = spark.createDataFrame([(1, None, 0, 1.0)], empty.schema)
    assert [r.taken for r in mixing.mix(none).collect()] == [0]


def plain_top(rows, k=5):
    out = []
    for at, (q, v) in enumerate(rows):
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), c) for i, (c, w) in enumerate(rows) if i != at and len(w) == len(v))
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [1, 1 << 26])
def test_top_k_equals_brute_force(spark, scale, monkeypatch):
    monkeypatch.setattr(top_k, "SHARD_ROWS", 64)
    monkeypatch.setattr(top_k, "BLOCK_ROWS", 16)
    monkeypatch.setattr(top_k, "SHARDS_PER_CHUNK", 3)
    pick = random.Random(4)
    vectors = {i: [pick.randint(-9, 9) * scale for _ in range(6)] for i in range(-100, 500)}
    vectors |= {i: [1 * scale] * 6 for i in range(500, 700)} | {1000: [1, 2], 1001: [3, 4], 1050: [], 1100: [1, 2, 3]}
    # ids that come again, with the same vector and with others, also a query's
    rows = [*vectors.items(), (3, vectors[3]), (3, [9 * scale] * 6), (50, [8 * scale] * 6), (50, vectors[50]), (1000, [5, 6])]
    df = spark.createDataFrame([*rows, (None, [1] * 6), (2000, None)], "vec_id bigint, vector array<bigint>").withColumn("score", F.lit("clash"))
    is_query = F.col("vec_id") % 50 == 0
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k.top_k(df, is_query).collect()]
    assert sorted(got) == plain_top(rows)
    assert top_k.top_k(df.limit(0), is_query).collect() == []
    assert top_k.blocks_scored(df.limit(0), is_query).first() == (0, 0)


def test_top_k_leaves_blocks_out(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SHARD_ROWS", 256)
    monkeypatch.setattr(top_k, "BLOCK_ROWS", 16)
    pick = random.Random(5)
    # eight directions: a query's own comes first, the bounds of the others stay below its fifth score
    rows = [(i, [100 * (i % 8 == j) + pick.randint(0, 3) for j in range(8)]) for i in range(1024)]
    df = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>")
    scored, met = top_k.blocks_scored(df, F.col("vec_id") % 50 == 0).first()
    assert met == 21 * 64 and scored < met / 2


def test_top_k_sql_takes_repeated_ids(spark, tmp_path):
    import duckdb

    from holdshort.llm import queries

    pick = random.Random(7)
    rows = [(i % 70, [pick.uniform(-1, 1) for _ in range(4)]) for i in range(200)] + [(3, None), (None, [1.0] * 4), (4, [None] * 4)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    ours = queries.op4_top_k(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, ours)) == sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({queries.OP4_SQL})").fetchall())


def test_quantised_vectors(spark):
    df = spark.createDataFrame([([0.5, -0.001],), ([None, 1.0],), ([float("nan")],), ([float("inf")],), (None,), ([],)], "v array<float>")
    assert [r[0] for r in df.select(top_k.quantised(F.col("v"))).collect()] == [[128, -1], None, None, None, None, []]


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(set(fps)), 2):
        if (a ^ b).bit_count() <= 3:
            parent[find(a)] = find(b)
    return [find(f) for f in fps]


def test_links_of_fingerprints_equal_brute_force(spark):
    pick = random.Random(6)
    base = [pick.getrandbits(64) for _ in range(200)]
    near = [x ^ sum(1 << b for b in pick.sample(range(64), pick.randint(1, 5))) for x in base for _ in range(4)]
    crowd = [base[0] ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 6))) for _ in range(800)]
    fps = sorted({*base, *near, *crowd, 0, 1, 2**64 - 1})
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    roots = {r.node: r.root for r in components(golay_simhash.links(df)).collect()}
    groups, expected = defaultdict(set), defaultdict(set)
    for x, root in zip(signed, plain_components(fps)):
        groups[roots.get(x, x)].add(x)
        expected[root].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))
    assert golay_simhash.links(df.limit(0)).collect() == []


def test_large_groups_are_cut_without_loss(monkeypatch):
    monkeypatch.setattr(golay_simhash, "LARGE_GROUP", 50)
    pick = random.Random(8)
    base = pick.getrandbits(64)
    fps = np.array(sorted({base ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 7))) for _ in range(1500)}), dtype=np.uint64)
    keys, owners = golay_simhash.link_keys(fps, golay_simhash.Golay())
    order = np.argsort(keys, kind="stable")
    parent = {int(x): int(x) for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(*golay_simhash.group_links(keys[order], owners[order])):
        parent[find(int(a))] = find(int(b))
    expected = plain_components(fps.tolist())
    assert len({find(int(x)) for x in fps}) == len(set(expected))


TEXT = "the quick brown fox jumps over the lazy dog while seven old men walk slowly along a quiet river bank in spring"


def texts_with_copies():
    pick = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    out = [" ".join(pick.choices(words, k=pick.randint(1, 80))) for _ in range(60)]
    long = [" ".join(pick.choices(words, k=3000)) for _ in range(6)]
    for x in long:
        parts = x.split()
        parts[pick.randrange(3000)] = "other"
        out += [x, " ".join(parts), x.upper()]
    return out + ["", None, " \n", "one", "one", "One", "two words", "x " * 60_000] + [TEXT] * 50


def test_fingerprint_groups_equal_brute_force(spark):
    texts = texts_with_copies()
    rows = [(i * 3, t, None, None, None) for i, t in enumerate(texts)] + [(None, TEXT, "en", "s", 1), (0, texts[0], None, None, None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit("clash"))
    out = golay_simhash.grouped(df).collect()
    assert len(out) == len(rows)
    fps = [plain_fingerprint(r[1]) for r in rows]
    least = {}
    for root, r in zip(plain_components(fps), rows):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    expected = sorted((str(r[0]), f, least[root]) for r, f, root in zip(rows, fps, plain_components(fps)))
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in out) == expected
    assert golay_simhash.grouped(df.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(300)] + [(7, 7), (2000, 1999)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    roots = {r.node: r.root for r in components(df).collect()}
    assert roots == {i: 0 for i in range(1, 101)} | {500 + i: 500 for i in range(1, 300)} | {2000: 1999}
    assert components(df.limit(0)).collect() == []
