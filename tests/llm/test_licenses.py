import math
import random
import re

from cabrank.llm import licenses, queries
from conftest import TESTDATA
from frames import DOCS, awkward, empty, save

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, templates=licenses.TEMPLATES, threshold=0.8):
    """Every block at every word against every template, without any filter."""
    w = words(text)
    places = [(i, label) for i in range(len(w)) for p, label in licenses.PHRASES if w[i : i + len(p.split())] == p.split()]
    found = []
    for label, t in templates:
        tokens, width = set(words(t)), 2 * len(words(t))
        own = set(w) & tokens
        if not tokens or len(own) < math.ceil(threshold * len(tokens) - 1e-9):
            continue
        for start in range(len(w)):
            shared = len(tokens.intersection(w[start : start + width]))
            if shared >= math.ceil(threshold * len(tokens) - 1e-9):
                found.append((label, shared / len(tokens)))
    at = [i for i, _ in places]
    said = lambda x: ",".join(sorted(set(x)))
    base = [label for _, label in places]
    return (len(w), len(at), min(at, default=None), max(at, default=None), said(base), said(base + [x for x, _ in found]), max([s for _, s in found], default=0.0))


def check(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = sorted([(r["doc_id"], *brute(r["text"])) for r in docs], key=repr)
    got = sorted([tuple(r) for r in queries.op7_license_containment(spark, folder).collect()], key=repr)
    assert got == want
    return want


def test_query_equals_brute_force(spark):
    want = check(spark, f"{TESTDATA}/sf0.01")
    assert {x for w in want for x in w[6].split(",")} > {"apache-2.0", "cc-by", "cc-by-nc-4.0", "gpl", "gpl-3.0", "mit", "reserved"}


def test_random_mixtures_equal_brute_force(spark, tmp_path):
    rng = random.Random(5)
    pool = [w for _, t in licenses.TEMPLATES for w in t.split()] + "cc by all rights reserved general public license x y z".split()
    texts = []
    for _ in range(200):
        parts = []
        for _ in range(rng.randrange(1, 9)):
            if rng.random() < 0.5:
                line = rng.choice(licenses.TEMPLATES)[1].split()
                parts.append(" ".join(w for w in line if rng.random() < 0.85))
            else:
                parts.append(" ".join(rng.choices(pool, k=rng.randrange(30))))
        texts.append(rng.choice([" ", "\n", " \n\n"]).join(parts))
    texts += ["cc by cc by CC-BY cc  by", "ccby cc\nby", "all rights reserved" * 2]
    check(spark, save(spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS), tmp_path))


def test_awkward_rows(spark, tmp_path):
    check(spark, save(awkward(spark), tmp_path))
    assert queries.op7_license_containment(spark, save(empty(spark), tmp_path)).count() == 0
    out = licenses.scan(awkward(spark, ("N_WORDS", "base_places")), templates=(("none", "..."), ("one", "One")))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(out.columns) == 8 and [b["label"] for b in rows[-3]["license_blocks"]] == ["one"]


def test_no_loss_against_sliding_blocks_in_many_mixtures():
    """Sentences with words left out, put in between, and shuffled around them, wherever they stand."""
    rng = random.Random(8)
    index = licenses.TemplateIndex(licenses.TEMPLATES, licenses.PHRASES, {}, 0.8)
    fillers = [f"x{i}" for i in range(50)]
    hits = 0
    for _ in range(10_000):
        label, text = rng.choice(licenses.TEMPLATES)
        line = [w for w in words(text) if rng.random() < 0.95]
        for _ in range(rng.randrange(len(line) + 4)):
            line.insert(rng.randrange(len(line) + 1), rng.choice(fillers))
        line = rng.choices(fillers, k=rng.randrange(60)) + line + rng.choices(fillers, k=rng.randrange(60))
        _, blocks = index.scan([w.encode() for w in line])
        want = brute(" ".join(line))
        assert ",".join(sorted({b["label"] for b in blocks} | {x for x in want[4].split(",") if x})) == want[5]
        assert max((b["share"] for b in blocks), default=0.0) == want[6]
        hits += label in want[5]
    assert hits > 8_000


def test_license_headers_and_bodies_are_found(spark):
    other = " ".join(f"w{i % 60}" for i in range(400))
    df = spark.createDataFrame([(i, f"{other} {text} {other}", "en", "a", 0) for i, (_, text) in enumerate(licenses.TEMPLATES)], DOCS)
    for r in licenses.scan(df).collect():
        label, text = licenses.TEMPLATES[r["doc_id"]]
        own = [b for b in r["license_blocks"] if b["label"] == label]
        assert own and max(b["share"] for b in own) == 1.0
        at, n = len(words(other)), len(words(text))
        assert all(b["start"] <= at + n and b["end"] >= at for b in own)
