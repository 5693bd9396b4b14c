import collections
import re

from transitlake.llm import quality_rules as q

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def measures(r):
    return (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])


def test_measures_match_brute_force(spark, documents):
    got = rows(q.judge(spark, documents))
    for d in documents.collect():
        assert measures(got[d["doc_id"]]) == brute(d["text"]), d["doc_id"]


def test_edge_texts(spark, make_docs):
    eight = "a b c d e f g h"
    texts = [None, "", " \t\n", "x", eight, eight + " " + eight, " ".join(["z"] * 40), "é b # $", "a\n\na\n b\nb",
             prose(1, 30_000), eight + " q " + eight + " " + prose(2, 50)]
    docs = make_docs([(i, t, "s") for i, t in enumerate(texts)])
    got = rows(q.judge(spark, docs))
    assert all(measures(got[i]) == brute(t) for i, t in enumerate(texts))


def test_common_lines_deplete(spark, make_docs):
    line = prose(3, 30)
    bad = [(i, f"{line}\nonly {i} here", "h") for i in range(30)]
    fine = [(100 + i, prose(100 + i, 60), "h") for i in range(20)]
    other = [(200, f"{line}\n" + prose(7, 5), "other"), (201, line, None)]
    docs = make_docs(bad + fine + other)
    kept = {i for i, r in rows(q.judge(spark, docs)).items() if r["kept"]}
    assert kept == {100 + i for i in range(20)} | {200, 201}
    assert {r["doc_id"] for r in q.clean(spark, docs).collect()} == kept


def test_exact_copies_count_once(spark, make_docs):
    text = prose(4, 50) + "\n" + prose(5, 50)
    docs = make_docs([(i, text, "h") for i in range(60)])
    assert q.clean(spark, docs).count() == 60


def test_removed_lines_leave_the_text(spark, make_docs):
    line = "all of it is boiler plate"
    docs = make_docs([(i, f"{prose(i, 40)}\n  All of it  is boiler plate\n{prose(i + 500, 40)}", "h") for i in range(25)]
                     + [(100, prose(900, 40), "h")]).withColumnRenamed("lang", "pos")
    out = rows(q.clean(spark, docs))
    assert len(out) == 26 and list(out[0].asDict()) == docs.columns
    assert out[3]["text"] == f"{prose(3, 40)}\n{prose(503, 40)}" and out[3]["n_chars"] == len(out[3]["text"])
    assert out[100]["text"] == prose(900, 40) and line not in out[3]["text"]


def test_line_feeds_of_removed_lines_do_not_deplete(spark, make_docs):
    lines = "".join(f"\nw{k:04d}" for k in range(120))          # 600 characters and 120 line feeds of 1,000
    docs = make_docs([(i, prose(i, 80)[:280] + lines, "h") for i in range(25)])
    kept = {r["doc_id"] for r in q.judge(spark, docs).collect() if r["kept"]}
    assert len(kept) == 25
    assert {r["doc_id"] for r in q.clean(spark, docs).collect()} == kept


def test_empty_and_repeated_rows(spark, make_docs):
    assert q.judge(spark, make_docs([])).count() == 0
    assert q.clean(spark, make_docs([])).count() == 0
    same = make_docs([(None, prose(1, 40), None)] * 3)
    assert [r["kept"] for r in q.judge(spark, same).collect()] == [True] * 3
    assert q.clean(spark, same).count() == 3
