import struct

import corpus_pipeline
import public_tokenizers
import pytest
from conftest import TESTDATA
from frames import DOCS, prose
from test_decontaminate import brute as leaks
from test_hamming import lower
from test_secrets import brute as secret_spans
from tokenizers import Tokenizer

FOLDER = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage got and what it returned."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage"))
        stage(spark, docs, FOLDER).write.mode("overwrite").parquet(path)
        out.append((docs, docs := spark.read.parquet(path)))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_all_but_the_last_return_the_columns_of_documents(spark, stages):
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "minhash near-dedup", "benchmark decontamination", "secret scans", "bpe encoding"]
    assert all(after.columns == columns for _, after in stages[:-1])


def test_classifier_keeps_good_documents(spark, stages):
    before, after = stages[0]
    kept = set(texts(after))
    rows = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    good = [r["doc_id"] in kept for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r["doc_id"] in kept for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.2


def sets(text, width=5):
    w = lower(text).split()
    size = min(width, len(w))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()


def test_one_document_of_each_group_stays(stages):
    before, after = (texts(x) for x in stages[1])
    own = {d: sets(t) for d, t in before.items()}
    where, pairs = {}, set()
    for d, s in own.items():
        for x in s:
            pairs.update((o, d) for o in where.setdefault(x, []))
            where[x].append(d)
    root = {d: d for d in own}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in pairs:
        if 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b]):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert set(after) == {d for d in own if find(d) == d}
    assert len(after) < len(before)


def test_leaks_go_and_nothing_else(spark, stages):
    before, after = (texts(x) for x in stages[2])
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r[0] for r in leaks(list(before.items()), items) if not r[-1]}
    assert set(after) == clean and len(clean) < len(before)


def test_secrets_are_redacted_and_all_documents_stay(stages):
    before, after = (texts(x) for x in stages[3])
    assert set(before) == set(after)
    for doc_id, text in before.items():
        spans = [tuple(map(int, s.split(":")[1:])) for s in secret_spans(text)[4].split(",") if s]
        out, at = [], 0
        for start, end in sorted(spans):
            if start >= at:
                out += [text[at:start], "[SECRET]"]
            at = max(at, end)
        assert after[doc_id] == "".join([*out, text[at:]])
    assert any(before[d] != after[d] for d in before)


def test_ids_are_those_of_the_library(spark, stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    before, after = stages[4]
    want = {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in texts(before).items()}
    for r in after.collect():
        ids = [*struct.unpack(f"<{r['n_tokens']}I", r["ids"])]
        assert ids == want.pop(r["doc_id"])
    assert not want


def test_run_equals_the_stages(spark, stages):
    got = {r["doc_id"]: bytes(r["ids"]) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == {r["doc_id"]: bytes(r["ids"]) for r in stages[-1][1].collect()}


def test_awkward_rows_pass_every_stage(spark, tmp_path):
    rows = [(1, None, None, None, None), (None, prose(30, 1), "en", "a", 1), (3, "", "en", "a", 0), (4, prose(30, 1), "en", "a", 1), (4, prose(30, 1), "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    assert corpus_pipeline.bpe_encoding(spark, docs, FOLDER).count() == 5
