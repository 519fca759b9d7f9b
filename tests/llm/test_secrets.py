import collections
import hashlib
import math
import random
import re
import time

import pytest
from cabrank.llm import queries, secrets
from conftest import TESTDATA
from frames import DOCS, awkward, empty, save
from pyspark.sql import functions as F

LETTERS = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
NAMES = "|".join(map(LETTERS, ["password", "passwd", "secret", "token", "api_?key"]))
BASE = [
    ("assign", re.compile(rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def entropy(window):
    return -sum(window.count(c) / len(window) * math.log2(window.count(c) / len(window)) for c in set(window))


def brute(text):
    text = text or ""
    base = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(BASE) for m in p.finditer(text) if ok(m)]
    spans = list(base)
    for i, kind in enumerate(secrets.CLASSES):
        for m in re.finditer(kind.pattern[:-1] + "{24,}", text):
            if any(re.fullmatch(c.pattern, m[0]) for c in secrets.CLASSES[:i]) or any(re.search(p, m[0]) for p in secrets.ALLOWED):
                continue
            hits = [j for j in range(len(m[0]) - 23) if entropy(m[0][j : j + 24]) >= kind.bits - 1e-12]
            if hits and i < 2:
                spans.append((m.start(), 3 + i, m.end(), kind.kind))
            elif hits:
                spans.append((m.start() + hits[0], 3 + i, m.start() + hits[-1] + 24, kind.kind))
    said = lambda x: ",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in sorted(x))
    n = lambda kind: sum(s[3] == kind for s in base)
    return n("assign"), n("access"), n("hex"), hashlib.sha256(said(base).encode()).hexdigest(), said(spans)


def check(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = sorted([(r["doc_id"], *brute(r["text"])) for r in docs], key=repr)
    got = sorted([tuple(r) for r in queries.op2_entropy_secrets(spark, folder).collect()], key=repr)
    assert got == want
    return want


def random_text(rng):
    parts = ["password", "Token=", "API-key: ", "api_key = '", "secret:secret:", "AKIA", "PASSWD", '"', "'", " ", "\n", "é", "\U0001f600", "=", ":"]
    kinds = ["0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", secrets.SYMBOLS, "abcd"]
    out = []
    for _ in range(rng.randrange(12)):
        out.append(rng.choice(parts))
        out.append("".join(rng.choice(rng.choice(kinds)) for _ in range(rng.choice([0, 3, 8, 12, 24, 33, 60]))) if rng.random() < 0.3
                   else "".join(rng.choices(rng.choice(kinds), k=rng.choice([0, 3, 8, 12, 16, 24, 31, 32, 60]))))
    return "".join(out)


CASES = [
    "token=ſecret=abcdefgh", "paſsword=abcdefgh12", "toKen=abcdefgh12", "password: secret: abcdefghij",
    "apikey=aaaaaaaa api_key='bbbbbbbb", "AKIAAKIA00000000000", "AKIA123 AKIA1234567890AB", "f" * 31 + "g" + "e" * 32,
    "wJalrXUtnFEMI7K7MDENGbPxRfiCYzz9example00", "abcdefghijklmnopqrstuvwxyz0123", "deadbeef" * 6,
    "Quietly-Walking_Stones/And-Long_Words", "x" + "q7Rz+" * 4000, "secret=" + "=" * 9, "TOKEN : \"A.b-c/d+e_=\"",
]


def test_random_and_special_texts_equal_brute_force(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, t, "en", "a", 0) for i, t in enumerate([*CASES, *(random_text(rng) for _ in range(400))])]
    want = check(spark, save(spark.createDataFrame(rows, DOCS), tmp_path))
    assert all(any(kind in w[5] for w in want) for kind in secrets.KINDS)


def test_query_equals_brute_force(spark):
    check(spark, f"{TESTDATA}/sf0.01")


def test_no_python_runs(spark):
    df = queries.op2_entropy_secrets(spark, f"{TESTDATA}/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_awkward_rows(spark, tmp_path):
    check(spark, save(awkward(spark), tmp_path))
    assert queries.op2_entropy_secrets(spark, save(empty(spark), tmp_path)).count() == 0
    df = awkward(spark, ("secret_spans", "c"))
    assert secrets.redact(df).columns == df.columns and secrets.redact(df).count() == 13
    assert [r["text"] for r in secrets.redact(df).where("doc_id = 2").collect()] == [None]


def test_redaction_leaves_no_secret_and_keeps_the_rest(spark):
    rows = [(1, "é token = '9233A8ECF7C5B09FE5949719B6B82BC439E9329B' end", "en", "a", 0), (2, "nothing here", "en", "a", 0)]
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(spark.createDataFrame(rows, DOCS)).collect()}
    assert clean == {1: "é [SECRET]' end", 2: "nothing here"}


@pytest.mark.parametrize("allowed", [(), ("^wJalr",)])
def test_allow_list_is_a_parameter(spark, allowed):
    df = spark.createDataFrame([(1, "wJalrXUtnFEMI7K7MDENGbPxRfiCYzz900", "en", "a", 0)], DOCS)
    spans = secrets.scan(df, allowed=allowed).select(F.size("secret_spans")).head()[0]
    assert spans == (0 if allowed else 1)


GLUED = [
    # text, and the span of the key in it, counted by hand
    ("KEY=9B3F07A1C64E82D5F01B7C93A6E8452D", "entropy_hex:4:36"),
    ("key=9B3F07A1C64E82D5F01B7C93A6E8452D", "entropy_hex:4:36"),
    ("AUTH_KEY=9B3F07A1C64E82D5F01B7C93A6E8452D end", "entropy_hex:9:41"),
    ("see /9B3F07A1C64E82D5F01B7C93A6E8452D/", "entropy_hex:5:37"),
    ("NAME=Q7ZK3MW9XB5TR1VD8HN4LC6PY2GJ0SFA", "entropy_upper:5:37"),
    ("example_KEY=9B3F07A1C64E82D5F01B7C93A6E8452D", "entropy_hex:12:44"),
]


def test_keys_glued_to_a_name_have_a_span_of_their_own(spark):
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, (t, _) in enumerate(GLUED)], DOCS)
    found = secrets.scan(df).select("doc_id", secrets.listed(F.col("secret_spans"))).collect()
    for doc_id, spans in found:
        assert GLUED[doc_id][1] in spans.split(",")
    for text in (r["text"] for r in secrets.redact(df).collect()):
        assert "[SECRET]" in text and not re.search("[0-9]", text)


@pytest.mark.parametrize("alphabet", ["0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"])
def test_random_glued_keys_are_covered_in_full(spark, alphabet):
    rng = random.Random(5)
    glue = ["", "KEY=", "key=", "AUTH_KEY=", "/"]
    texts = [(glue[i % 5], "".join(rng.choices(alphabet, k=32))) for i in range(1000)]
    df = spark.createDataFrame([(i, g + key, "en", "a", 0) for i, (g, key) in enumerate(texts)], DOCS)
    whole = collections.Counter()
    for doc_id, out in secrets.redact(df).select("doc_id", "text").collect():
        g = texts[doc_id][0]
        whole[g] += out.endswith("[SECRET]") and g.startswith(out.removesuffix("[SECRET]"))
    assert all(whole[g] >= 196 for g in glue), whole


def test_words_and_names_without_a_key_stay(spark):
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(["Quietly-Walking_Stones/And-Long_Words", "MAXIMUM_ALLOWED_CONNECTIONS=100"])]
    assert [r["text"] for r in secrets.redact(spark.createDataFrame(rows, DOCS)).collect()] == [r[1] for r in rows]


@pytest.mark.parametrize("glue", ["", "KEY=", "key=", "AUTH_KEY=", "/"])
def test_the_query_finds_glued_hex_keys(spark, tmp_path, glue):
    rng = random.Random(len(glue))
    keys = ["".join(rng.choices("0123456789ABCDEF", k=32)) for _ in range(200)]
    df = spark.createDataFrame([(i, glue + k, "en", "a", 0) for i, k in enumerate(keys)], DOCS)
    got = queries.op2_entropy_secrets(spark, save(df, tmp_path)).collect()
    assert sum(f"entropy_hex:{len(glue)}:{len(glue) + 32}" in r["spans"].split(",") for r in got) >= 190


def test_the_allow_list_leaves_keys_beside_words_and_placeholders(spark):
    rng = random.Random(9)
    random_key = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    lower = [random_key("abcdefghijklmnopqrstuvwxyz", 40) for _ in range(200)]
    beside = [f"example_key={random_key(secrets.SYMBOLS[:62], 40)}" for _ in range(200)]
    digits = [f"0123456789{random_key(secrets.SYMBOLS[:62], 40)}" for _ in range(200)]
    allowed = ["example_words=placeholder_value", "abcdefghijklmnopqrstuvwxyz0123", "wJalrXUtnFEMI7K7MDENGbPxRfiCYEXAMPLEKEY", "one_long_name_of_words_joined/by/paths", "internationalization-characteristics"]
    texts = lower + beside + digits + allowed
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    found = {r["doc_id"] for r in secrets.scan(df).where(F.size("secret_spans") > 0).collect()}
    # A window of 24 random letters of 26 does not always reach the bits that a base64 key has.
    for at, least in ((0, 140), (200, 190), (400, 190)):
        assert len(found & set(range(at, at + 200))) >= least
    assert not found & set(range(600, 600 + len(allowed)))


def test_time_grows_with_the_text(spark, tmp_path):
    """Twice the keys in one text of a megabyte take about twice the time."""
    rng = random.Random(4)
    keys = ["".join(rng.choices("0123456789abcdef", k=32)) for _ in range(30_000)]
    seconds = {}
    for n in (10, 15_000, 30_000):  # the first one compiles
        text = " é".join(keys[:n])
        folder = save(spark.createDataFrame([(1, text, "en", "a", 0)], DOCS), f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        start = time.perf_counter()
        clean = secrets.redact(docs).head()["text"]
        spans = queries.op2_entropy_secrets(spark, folder).head()
        seconds[n] = time.perf_counter() - start
        assert clean == " é".join(["[SECRET]"] * n) and spans["n_hex"] == n
        assert spans["spans"].endswith(f"hex:{34 * (n - 1)}:{34 * n - 2},entropy_hex:{34 * (n - 1)}:{34 * n - 2}")
    assert seconds[30_000] <= 2.3 * seconds[15_000] + 1, seconds


def test_overlapping_spans_across_blocks_of_the_text(spark):
    key = "9b3f07a1c64e82d5f01b7c93a6e8452d"
    texts = []
    for shift in (0, 4090, 4096, 8180):
        texts.append("é" * shift + f" token={key} AKIA{'Z1' * 8} end " + "\U0001f600" * 5000)
        texts.append("x " * (shift // 2) + f"secret: {key}{key}")
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    got = [r["text"] for r in secrets.redact(df).orderBy("doc_id").collect()]
    want = [re.sub(rf"(token=|secret: )({key})+|AKIA\w+", "[SECRET]", t) for t in texts]
    assert got == want
