import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from transitlake.llm import langid, queries

DOCS = "doc_id long, text string, lang string"
WORDS = {"xx": ["kala", "maja", "puu", "kass", "vesi"], "yy": ["thorn", "whist", "grith", "shoal", "fjord"], "zz": ["ñoño", "çela", "ûbro", "ésto"]}


def made(n, langs=("xx", "yy", "zz"), seed=1):
    rng = np.random.default_rng(seed)
    return [(i, " ".join(rng.choice(WORDS[langs[i % len(langs)]], 12)), langs[i % len(langs)]) for i in range(n)]


def side(i):
    return zlib.crc32(str(i).encode()) % 4


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    out = queries.op13_language_id(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text"), "doc_id")
    return out.collect()


def test_held_out_accuracy_and_calibration(table):
    held = [r for r in table if r["held_out"]]
    assert len(held) > 30 and all(r["held_out"] == (side(r["doc_id"]) == 2) for r in table)
    right = [r["lang"] == r["lang_pred"] for r in held]
    assert np.mean(right) >= 0.95
    assert abs(np.mean([r["score"] for r in held]) - np.mean(right)) < 0.05
    assert all(0 <= r["score"] <= 1 for r in table)


def test_rows_and_columns(spark, sf_dir):
    out = queries.op13_language_id(spark, sf_dir)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert out.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_layout_does_not_matter_nor_do_other_inputs(spark):
    rows = made(400)
    one = spark.createDataFrame(rows, DOCS).repartition(1)
    many = spark.createDataFrame(rows[::-1], DOCS).repartition(7)
    a = {r["doc_id"]: r[2:] for r in langid.identify(spark, one).collect()}
    assert a == {r["doc_id"]: r[2:] for r in langid.identify(spark, many).collect()}
    # held-out rows' lang is never read
    lied = [(i, t, "xx" if side(i) == 2 else lang) for i, t, lang in rows]
    assert a == {r["doc_id"]: r[2:] for r in langid.identify(spark, spark.createDataFrame(lied, DOCS)).collect()}
    assert all(a[i][0] == lang for i, _, lang in rows)


def test_odd_rows(spark):
    rows = made(200) + [(1000, None, "xx"), (1001, "", "yy"), (1002, "12 !? 34\n", "xx"), (1003, "kala maja " * 30_000, "xx"),
                        (1004, "KALA, MAJA! Puu", None), (None, "kala maja", "xx"), (5, "thorn shoal", "yy"), (5, "thorn shoal", "yy"),
                        (1005, "ñ", "zz"), (1006, "😀 kala puu", "xx")]
    got = [tuple(r) for r in langid.identify(spark, spark.createDataFrame(rows, DOCS)).collect()]
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r[0], []).append(r)
    for i in (1000, 1001, 1002):
        assert by[i][0][2:] == ("und", 0.0)
    assert by[1003][0][2] == by[1004][0][2] == by[1006][0][2] == by[None][0][2] == "xx" and by[None][0][1] is False
    assert [r[2] for r in by[5]].count("yy") >= 2


def test_nothing_to_learn_one_language_and_empty(spark):
    none = [(i, "kala", None) for i in range(8)]
    assert {tuple(r[2:]) for r in langid.identify(spark, spark.createDataFrame(none, DOCS)).collect()} == {("und", 0.0)}
    one = made(40, ("xx",))
    assert {tuple(r[2:]) for r in langid.identify(spark, spark.createDataFrame(one, DOCS)).collect()} == {("xx", 1.0)}
    assert langid.identify(spark, spark.createDataFrame([], DOCS)).count() == 0


def test_other_columns_clash(spark):
    df = spark.createDataFrame([(*r, 5, "a", 0.5) for r in made(90)], DOCS + ", n int, bucket string, chance double")
    assert langid.identify(spark, df).where("lang_pred = 'und'").count() == 0


def ngrams(text):
    """The n-grams by definition, as strings with blanks for separators."""
    words = "".join(ch.lower() if ch.isalpha() else " " for ch in text).split()
    if not words:
        return Counter()
    s = " " + " ".join(words) + " "
    out = Counter(ch for ch in s if ch != " ")
    out.update(s[i:i + 2] for i in range(len(s) - 1))
    out.update(s[i:i + 3] for i in range(len(s) - 2) if s[i + 1] != " ")
    return out


def test_grams_match_their_definition():
    texts = ["Ab, c!", "", "123", "ÄÖ äö", "a", "ab ab", "x--y  Z\n", "..a"]
    owner, bucket = langid.grams(texts)
    seen = {}
    for i, t in enumerate(texts):
        mine = Counter(bucket[owner == i].tolist())
        want = ngrams(t)
        assert sum(mine.values()) == sum(want.values())
        assert sorted(mine.values()) == sorted(want.values())
        alone = Counter(langid.grams([t])[1].tolist())
        assert alone == mine
        seen[t] = set(mine)
    assert seen["a"] == seen["..a"]
    assert (np.diff(owner) >= 0).all()


def test_document_frequencies_are_exact(spark):
    rows = made(120)
    texts, held = langid.statistics(spark, langid._training(spark.createDataFrame(rows, DOCS)))
    used = [r for r in rows if side(r[0]) != 2]
    assert texts == Counter(r[2] for r in used)
    want = np.zeros(langid.BUCKETS, dtype=int)
    for _, t, _ in used:
        want[np.unique(langid.grams([t])[1])] += 1
    assert (held == want).all()


def test_sample_is_bounded_and_even(spark, monkeypatch):
    monkeypatch.setattr(langid, "PER_LANG", 20)
    rows = made(2000, ("xx", "xx", "xx", "yy"))
    training = langid._training(spark.createDataFrame(rows, DOCS))
    texts, _ = langid.statistics(spark, training)
    got = Counter(r["lang"] for r in langid.sample(spark, training, texts).collect())
    assert 10 <= got["xx"] <= 20 and 10 <= got["yy"] <= 20


def test_penalty_makes_weights_sparse():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        label = i % 2
        noise = rng.choice(np.arange(10, 2000), 20, replace=False)
        rows.append((label, np.append(noise, label), np.ones(21)))
    w = langid.ftrl(rows, 2)
    assert w[0, 0] > 0 > w[0, 1] and w[1, 1] > 0 > w[1, 0]
    assert (w[10:2000] == 0).mean() > 0.8


def test_temperature_undoes_a_scale():
    rng = np.random.default_rng(2)
    z = rng.normal(size=(20_000, 3)) * 2
    labels = np.array([rng.choice(3, p=p) for p in langid._softmax(z)])
    assert abs(langid.temperature(z * 5, labels, np.ones(len(z))) - 5) < 0.3


def test_sources_of_a_prediction(spark):
    """The same text gets the same prediction whatever its row says."""
    df = spark.createDataFrame(made(100), DOCS)
    model = langid.fit(spark, df)
    same = df.withColumn("doc_id", F.col("doc_id") + 7).withColumn("lang", F.lit("q"))
    a = sorted(r[2:] for r in langid.predict(spark, df, model).collect())
    assert a == sorted(r[2:] for r in langid.predict(spark, same, model).collect())
