import collections
import math
import re

import duckdb
import pytest
from cabrank.llm import divergence, queries
from cabrank.llm.oracle import ORACLE
from compare import differences
from conftest import TESTDATA
from frames import awkward, empty, prose, save

BLANK = " \t\n\x0b\x0c\r"


def brute(rows):
    """Contract columns, distances and verdict of (doc_id, text, lang) rows."""
    lists = divergence._word_lists()
    counted = []
    for doc_id, text, lang in rows:
        text = text or ""
        w = [x for x in re.split(f"[{BLANK}]+", text) if x]
        lines = [x for x in text.split("\n") if x.strip(BLANK)]
        windows = collections.defaultdict(list)
        for i in range(len(w) - 7):
            windows[tuple(w[i : i + 8])].append(i)
        repeat = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
        lang = lang.lower() if (lang or "").lower() in divergence.COMMON_WORDS else "other"
        classes = collections.Counter()
        for c in text:
            kind = next((n for n, p in divergence.CHAR_CLASSES[:-1] if re.match(p, c)), None)
            classes[kind or ("letter" if c.isalpha() else "rest")] += 1
        chars = [classes[n] for n, _ in divergence.CHAR_CLASSES] + [classes["rest"]]
        low = collections.Counter(x.lower() for x in w)
        common = [low[x] for x in lists[lang]]
        common.append(len(w) - sum(common))
        failed = len(w) < 20 or 100 * len(repeat) > 30 * len(w)
        base = (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeat))
        counted.append((doc_id, base, failed, lang, chars, common))
    share = lambda bins: [b / max(1, sum(bins)) for b in bins]
    refs = {}
    for lang in lists:
        own = [x for x in counted if x[3] == lang and not x[2] and x[1][0] >= divergence.MIN_WORDS]
        if own:
            mean = lambda k: [sum(v) / len(own) for v in zip(*[share(x[k]) for x in own])]  # noqa: B023, E731
            refs[lang] = mean(4), mean(5)

    def distance(p, q):
        kl = lambda a, m: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
        m = [(x + y) / 2 for x, y in zip(p, q)]
        return math.sqrt(max(0.0, (kl(p, m) + kl(q, m)) / 2))

    out = []
    for doc_id, base, failed, lang, chars, common in counted:
        ref = refs.get(lang)
        far = ref and [distance(share(chars), ref[0]), distance(share(common), ref[1])]
        bad = base[0] >= divergence.MIN_WORDS and ref and (far[0] > divergence.MAX_CHAR_DISTANCE or far[1] > divergence.MAX_WORD_DISTANCE)
        out.append((doc_id, *base, failed, far, not failed and not bad))
    return out


def check(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()
    key = lambda r: repr(r[:7])
    want = sorted(brute(docs), key=key)
    got = queries.op6_distribution_divergence(spark, folder).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"
    ).collect()
    got = sorted([(*r[:7], None if r[7] is None else [r[7], r[8]], r[9]) for r in got], key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:7] == w[:7] and g[8] == w[8]
        assert (g[7] is None) == (w[7] is None) and (g[7] is None or g[7] == pytest.approx(w[7], abs=1e-6))
    return want


def test_query_equals_brute_force(spark):
    want = check(spark, f"{TESTDATA}/sf0.01")
    assert sum(r[5] > 0 for r in want) > 20 and 0 < sum(r[6] for r in want) < len(want) / 4


def test_documents_labelled_good_are_kept_and_others_found(spark):
    folder = f"{TESTDATA}/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries.op6_distribution_divergence(spark, folder).join(labels, "doc_id").where("not base_failed and n_words >= 100").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.999
    assert sum(bad) / len(bad) < 0.5


def test_awkward_rows(spark, tmp_path):
    check(spark, save(awkward(spark), tmp_path))
    assert queries.op6_distribution_divergence(spark, save(empty(spark), tmp_path)).count() == 0
    df = awkward(spark, ("Kept", "_words", "ref_lang", "chars"))
    out = divergence.judge(df)
    assert out.count() == 13 and [c.lower() for c in out.columns].count("kept") == 1


def test_repeats(spark, tmp_path):
    line = "a b c d e f g h"
    rows = [(1, line + " " + line, "en"), (2, (line + "\n") * 3, "en"), (3, "x " * 9, "en"), (4, "x " * 8, "en"), (5, line + " z " + line + " " + prose(100, 2), "en")]
    want = check(spark, save(spark.createDataFrame(rows, "doc_id long, text string, lang string"), tmp_path))
    assert [w[5] for w in want] == [16, 24, 9, 0, 16] and want[1][4] == 2


def test_no_python_runs(spark):
    df = queries.op6_distribution_divergence(spark, f"{TESTDATA}/sf0.001")
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_sql_equals_the_query_on_awkward_rows(spark, tmp_path):
    folder = save(awkward(spark), tmp_path)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    got = queries.op6_distribution_divergence(spark, folder)
    assert differences(got, connection, ORACLE["op6_distribution_divergence"]) is None
    assert {r["n_words"] for r in got.where("doc_id = 9").collect()} == {6}
