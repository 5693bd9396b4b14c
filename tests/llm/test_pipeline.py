from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from transitlake.llm import queries

from .conftest import prose


def test_queries_are_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]


def test_stages_follow_each_other(spark, make_docs):
    copies = [(i, prose(1, 120), "a") for i in range(3)]
    near = [(10, prose(2, 150), "a"), (11, prose(2, 150) + " end", "b")]
    junk = [(20, "too short", "a"), (21, "z " * 300, "b")]
    passage = prose(3, 70)
    shared = [(30 + i, f"{prose(40 + i, 90)} {passage} {prose(60 + i, 90)}", "ab"[i % 2]) for i in range(6)]
    plain = [(100 + i, prose(200 + i, 80), "abc"[i % 3]) for i in range(30)]
    docs = make_docs(copies + near + junk + shared + plain)
    out = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out[name] = docs.collect()
    ids = {k: sorted({r["doc_id"] for r in v}) for k, v in out.items()}
    assert set(ids["quality_rules"]) == set(range(3)) | {10, 11} | {30 + i for i in range(6)} | {100 + i for i in range(30)}
    assert set(ids["minhash_near_dedup"]) == set(ids["quality_rules"]) - {1, 2, 11}
    assert ids["suffix_array_dedup"] == ids["minhash_near_dedup"]
    assert all(passage[:200] not in r["text"] for r in out["suffix_array_dedup"] if 30 <= r["doc_id"] < 40)
    assert all(r["text"] == prose(100 + r["doc_id"], 80) for r in out["suffix_array_dedup"] if r["doc_id"] >= 100)
    assert set(ids["mixing"]) <= set(ids["suffix_array_dedup"])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {p["doc_id"] for p in pieces} == set(ids["mixing"])


def brute_taken(docs, pieces):
    """Ids of every piece against the tokenizer's ids of the mixed texts (multiset of whole documents)."""
    import public_tokenizers

    from transitlake.llm.tokens import encoder
    enc = encoder(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((r["doc_id"], np.append(enc.ids(r["text"]).astype("<u4"), np.uint32(1)).tobytes()) for r in docs)
    rows, got = {}, Counter()
    for p in pieces:
        rows.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], bytes(p["ids"])))
    for (doc_id, n), found in rows.items():
        starts = sum(s == 0 for s, _ in found)
        if starts == 1:                                  # one document of this id and length: its pieces in order
            got[doc_id, b"".join(x for _, x in sorted(found))] += 1
            assert sum(len(x) for _, x in found) == 4 * n
        else:
            assert sum(len(x) for _, x in found) == 4 * n * starts
            for key in [k for k in want if k[0] == doc_id and len(k[1]) == 4 * n]:
                got[key] += want[key]
    assert got == want


def test_odd_rows_through_all_stages(spark, make_docs):
    """Null texts, sources and ids, repeated rows, a very long text, ties, and extra columns with the stages' own names."""
    rows = [(1, None, "a"), (2, "", None), (3, prose(1, 100), None), (None, prose(2, 100), "b"), (4, prose(3, 30_000), "b"),
            (5, prose(4, 90), "c"), (5, prose(4, 90), "c"), (6, prose(5, 80), "a"), (6, prose(6, 80), "a"), (7, " \n ", "a")]
    docs = make_docs(rows).withColumns({"size": F.lit("x"), "node": F.lit(1), "tokens": F.lit("y"), "shard": F.lit(2)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), docs.schema)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "node", "tokens", "shard"]
        held = Counter(r["doc_id"] for r in docs.collect())
        if name in ("quality_rules", "minhash_near_dedup", "suffix_array_dedup"):
            # texts without enough words go, all others stay; of the repeated row one stays after the near-dedup
            assert held == Counter({3: 1, None: 1, 4: 1, 5: 2 if name == "quality_rules" else 1, 6: 2}), name
        else:
            assert set(held) <= {3, None, 4, 5, 6} and 4 in held
    mixed = docs.collect()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    brute_taken(mixed, pieces)


def test_empty_table_through_all_stages(spark, make_docs):
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_run_on_the_tables(spark, sf_dir):
    """The pieces of the whole run are the mixed documents' ids; the stages' own tests hold them against brute force."""
    out = corpus_pipeline.run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
    brute_taken(docs.collect(), out.collect())
