"""The corpus job: its stages by their effects and against brute force, odd tables, and the rows of the whole."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_table_operators import plain_components, plain_fingerprint

import corpus_pipeline

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOCABULARY = {"en": "the and of with this from that have for not river", "de": "der und die mit das von nicht ein auch für Haus"}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(lang, i, words=120):
    pick = random.Random(f"{lang}{i}")
    return " ".join(pick.choice(VOCABULARY[lang].split()) + (str(pick.randint(0, 400)) if pick.random() < 0.3 else "") for _ in range(words))


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rows = [(i, prose("en" if i % 3 else "de", i), "en" if i % 3 else "de", f"src{i % 4}", 1) for i in range(160)]
    rows += [(200 + i, " ".join(w.upper() + "!!" for w in prose("en", i).split()), "en", "src1", 1) for i in range(40)]
    rows += [(300 + i, rows[i][1], rows[i][2], "src0", 1) for i in range(10)]
    rows += [(400, None, None, None, None), (401, "", "en", "src1", 0), (None, prose("en", 999), "en", None, 1), (5, prose("en", 998), "en", "src1", 1),
             (402, "漢字 変換 " * 60, None, "src1", 1)]
    # a group of over 32 near copies, each with another word at one place of a long text
    base = prose("en", 777, 900).split()
    rows += [(1000 + i, " ".join(base[:20 * i] + ["changed"] + base[20 * i + 1:]), "en", "src2", 1) for i in range(45)]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("ids", "score", "_words", "_stage_row", "_size", "with.dot"):
        docs = docs.withColumn(name, F.lit("clash"))
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i in range(0, 240, 2)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Name -> documents before and after; what the job writes between its stages."""
    out, docs = {}, spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp('stages')}/{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = docs.collect(), after.collect()
        docs = after
    return out


def test_stages_keep_clean_documents_and_their_columns(stages):
    assert list(stages) == ["language", "quality", "near copies", "mixing", "encoding"]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after[0].__fields__ == before[0].__fields__, name
    language, quality = ({r.doc_id for r in stages[n][1]} for n in ("language", "quality"))
    assert language >= {*range(160), *range(200, 240), None} and not language & {400, 401, 402}
    assert quality >= set(range(160)) | {None} and not quality & set(range(200, 240))


def test_one_of_each_group_stays(stages):
    before, after = stages["near copies"]
    group_of = plain_components([plain_fingerprint(r.text) for r in before])
    groups = defaultdict(list)
    for r, root in zip(before, group_of):
        groups[root].append(r)
    assert max(map(len, groups.values())) > 32
    left = Counter(after)
    for rows in groups.values():
        assert sum(min(left[r], n) for r, n in Counter(rows).items()) == 1
    assert len(after) == len(groups)


def plain_mix(rows):
    """Row -> words taken, by the definitions alone."""
    sources = sorted({r.source for r in rows}, key=lambda s: (s is None, s))
    size = {id(r): len(WORD.findall(r.text or "")) for r in rows}
    total = {s: sum(size[id(r)] for r in rows if r.source == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    target, free, rest = {}, set(sources), 1.5 * sum(total.values())
    while free:
        level = rest / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] >= 2 * total[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * total[s] for s in full}
        rest -= sum(2 * total[s] for s in full)
        free -= full
    taken = {}
    for s in sources:
        def key(r):
            text = r.text or ""
            u = (int(hashlib.md5(f"17:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
            symbols = sum(text.count(x) for x in "#*$%&|<>!")
            return -math.log(u) * (1 + 10 * symbols / max(size[id(r)], 1)), r.doc_id is None, r.doc_id or 0, size[id(r)]
        budget = round(target[s])
        epochs = budget // total[s] if total[s] else 0
        left = budget - epochs * total[s]
        for r in sorted((r for r in rows if r.source == s), key=key):
            more = min(size[id(r)], max(left, 0))
            left -= more
            taken[id(r)] = epochs * size[id(r)] + more
    return taken


def test_mixed_and_encoded_rows_equal_brute_force(spark, sf_dir, stages):
    import tiktoken

    before, after = stages["mixing"]
    taken, expected = plain_mix(before), Counter()
    for r in before:
        parts = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", r.text or "")
        whole, rest = divmod(taken[id(r)], len(parts)) if parts else (0, 0)
        expected[r.doc_id, r.source, r.text] += whole
        if rest:
            expected[r.doc_id, r.source, "".join(parts[:rest])] += 1
    assert Counter((r.doc_id, r.source, r.text) for r in after) == +expected
    ranks = {}
    import base64
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        for line in lines:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = Counter()
    for (doc_id, source, text), n in (+expected).items():
        coded[doc_id, source, tuple(library.encode_ordinary(text)), True] += n
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert all(r.n_tokens == len(r.ids) for r in out)
    assert Counter((r.doc_id, r.source, tuple(r.ids), r.decodes) for r in out) == coded


def test_empty_tables(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
