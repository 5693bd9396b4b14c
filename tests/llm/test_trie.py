import hashlib
import random
import zlib

import pytest
from pyspark.sql import types as T

from transitlake.llm import queries, trie

TURNS = "conv_id long, turn long, role string, text string"


def remainder(c):
    return c - int(c / 20) * 20 if abs(c) < 2 ** 52 else c % 20      # SQL's sign rule


def rebuilt(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(ts)] for c, ts in convs.items()}
    out = {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - remainder(c), [])[:h] + ts[h:]
    return out


def words(text):
    return len([w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if w])


def brute(rows):
    convs = rebuilt(rows)
    if not convs:
        return []
    members = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = []

    def total(p):
        leaves, saved = 0, (len(members[p]) - 1) * words(p[-1][1]) if p else 0
        for k in kids.get(p, []):
            a, b = total(k)
            leaves, saved = leaves + a, saved + b
        leaves += p not in kids
        ends = ",".join(map(str, sorted(c for c in members[p] if len(convs[c]) == len(p))))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids.get(p, [])), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    total(())
    return sorted(out, key=repr)


def run(spark, rows):
    return sorted([tuple(r) for r in trie.conversation_trie(spark, spark.createDataFrame(rows, TURNS)).collect()], key=repr)


def test_tables_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted([tuple(r) for r in queries.op11_conversation_trie(spark, sf_dir).collect()], key=repr) == brute(rows)


def test_shared_turns_nulls_ties_and_repeats(spark):
    rng = random.Random(5)
    rows = [(c, rng.choice([None, 0, 1, 1, 2, 3]), rng.choice(["user", "assistant", None]), rng.choice(["a", "a b", "", None, "x\ty z"]))
            for c in [rng.randint(-45, 120) for _ in range(260)]]
    rows += rows[:30] + [(None, 0, "user", "nobody's"), (7, None, None, None)]
    assert run(spark, rows) == brute(rows)


def test_few_and_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []
    # no conversation 20 to borrow from: its own first turns are gone, it ends in the root
    turnless = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 1)
    rows = [(turnless, 0, "user", "x")]
    assert run(spark, rows) == brute(rows) == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_long_chain_and_wide_star_contract_in_few_rounds(spark, monkeypatch):
    """A chain of 400 turns needs far fewer rounds than turns; a star of 300 ends in one."""
    staged = []
    plain = trie.stage
    monkeypatch.setattr(trie, "stage", lambda s, df, label: staged.append(label) or plain(s, df, label))
    chain = [(0, i, "user", f"t{i} x") for i in range(400)] + [(40, i, "user", f"t{i} x") for i in range(390)]
    assert run(spark, chain) == brute(chain)
    assert staged.count("trie-left") < 40
    staged.clear()
    star = [(20 * i, 0, "user", f"t{i}") for i in range(300)]
    assert run(spark, star) == brute(star)
    assert staged.count("trie-left") == 1


def test_many_ends_in_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    rows = [(c, 0, "user", "same") for c in range(0, 2000, 20)] + [(c, 1, "user", "end " * 3) for c in range(0, 400, 20)]
    assert run(spark, rows) == brute(rows)


def test_very_long_text_and_control_characters(spark):
    rows = [(0, 0, "user", "w " * 60_000), (20, 0, "user", "w " * 60_000), (40, 0, "user:", "a"), (60, 0, "user", ":a"), (80, 0, "us", "er:a")]
    assert run(spark, rows) == brute(rows)


def test_other_columns_clash(spark):
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("depth", T.StringType()), T.StructField("node", T.IntegerType()),
                           T.StructField("__range", T.IntegerType())])
    rows = [(0, 0, "user", "a", "x", 1, 9), (0, 1, "user", "b", "x", 1, 9), (20, 0, "user", "a", "y", 2, 9)]
    got = trie.conversation_trie(spark, spark.createDataFrame(rows, schema))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute([r[:4] for r in rows])


@pytest.mark.parametrize("seed", [1, 2])
def test_random_trees(spark, seed):
    """Subtree totals of random trees, deep and bushy, against a walk."""
    rng = random.Random(seed)
    parent = [None] + [rng.choice([i - 1, rng.randrange(i)]) if rng.random() < 0.9 else 0 for i in range(1, 300)]
    kids = [sum(p == i for p in parent) for i in range(300)]
    rows = [(f"n{i}", None if p is None else f"n{p}", kids[i], int(not kids[i]), rng.randint(0, 9)) for i, p in enumerate(parent)]
    got = {r["node"]: (r["leaves"], r["saved"]) for r in trie.subtree_totals(
        spark, spark.createDataFrame(rows, "node string, parent string, kids long, leaves long, saved long")).collect()}
    want = [[r[3], r[4]] for r in rows]
    for i in range(299, 0, -1):
        want[parent[i]][0] += want[i][0]
        want[parent[i]][1] += want[i][1]
    assert got == {f"n{i}": tuple(w) for i, w in enumerate(want)}
