"""Prefix trie of conversations with subtree totals by parallel tree contraction (operator 11).

1. Turns get their place in the conversation by a scan over ranges of equal volume, so even a conversation that
   holds a third of all rows spans many tasks. A second scan adds up, per conversation, four 32-bit numbers of the
   sha256 of (depth, role, text) of every turn: the four sums name the sequence of turns so far (128 bits; the depth
   is part of every summand, so the order counts). No task ever walks down a whole conversation or trie.
2. Rows with the same sums are one node: members are counted by partial aggregation, so a first turn that half of
   the conversations share moves one row per task.
3. Subtree totals come from tree contraction on the table of nodes (id, parent). Rounds alternate between
   * rake: leaves go, their totals are added to their parents (partial sums, so a parent of millions is no hot key);
   * compress: of the nodes with exactly one child left, those go whose coin shows heads and whose child does not go
     too; the child moves up to the grandparent and carries what it has to bring along.
   Every round takes out all leaves and a share of all chain links: their number grows with the logarithm of the
   nodes, also in a trie that is one long chain. Then the contracted nodes are expanded again, last round first:
   a raked node knows its total, a spliced one adds its own part to its child's.
4. Conversations that end in a node are hashed in ascending order: ranges of (node, conv_id) are joined to pieces of
   at most `PIECE` ids, and a node's pieces stream through one hash, so no list of ids is ever held whole.

Every round is a table in the shared folder; a lost executor costs its tasks only.

Edge cases: null role or text counts as empty; turns are ordered by turn (null first), then role and text; repeated
rows are turns of their own; rows with a null conv_id belong to no conversation and are left out; negative conv_ids
use SQL's remainder (-7 % 20 = -7); a conversation without turns after borrowing is a member of the root only; an
empty table has no root and gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequences import RangeScan
from .common import n_words, release, ship, stage

ROOT = "0:0:0:0:0"
PIECE = 50_000
NO_IDS = hashlib.sha256(b"").hexdigest()


def own_turns(spark: SparkSession, df: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), body (digest of role and text), words of every turn of df (conv_id, turn, role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = df.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("has_turn"), "turn",
        role.alias("role"), text.alias("text"))
    rows = rows.withColumns({"body": F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256),
                             "words": n_words(F.col("text"))})
    scan = RangeScan(rows, ["conv_id"], ["has_turn", "turn", "role", "text"]).running_sum(F.lit(1), "pos")
    return stage(spark, scan.result().select("conv_id", "pos", "body", "words"), "trie-turns")


def borrow_openings(spark: SparkSession, own: DataFrame, span: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Every conversation c rebuilt from the first h turns of conversation c - c % span and its own turns after its
    first h, where h = crc32(c) % most. Returns (conv_id, depth, body, words) and (conv_id, n_turns)."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    lengths = own.groupBy("conv_id").agg(F.max("pos").alias("n"))
    convs = lengths.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % span).alias("base"))
    bases = lengths.where(F.col("conv_id") % span == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    convs = stage(spark, convs, "trie-conversations")
    opening = own.where((F.col("conv_id") % span == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    lent = convs.join(opening, "base").where("pos <= taken").select("conv_id", F.col("pos").alias("depth"), "body", "words")
    kept = own.join(convs, "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "body", "words")
    return lent.unionByName(kept), convs.select("conv_id", "n_turns")


def _name(depth: Column, sums: list[Column]) -> Column:
    return F.concat_ws(":", depth.cast("string"), *[s.cast("string") for s in sums])


def steps(turns: DataFrame) -> DataFrame:
    """conv_id, depth, node, parent, words: the node that a conversation is in after `depth` turns."""
    digest = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), F.col("body")), 256)
    part = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    rows = turns.select("conv_id", F.col("depth").cast("long").alias("depth"), "words", F.array(*part).alias("p"))
    scan = RangeScan(rows, ["conv_id"], ["depth"]).running_sums({f"s{i}": F.col("p")[i] for i in range(4)}).result()
    sums = [F.col(f"s{i}") for i in range(4)]
    return scan.select("conv_id", "depth", _name(F.col("depth"), sums).alias("node"),
                       _name(F.col("depth") - 1, [s - F.col("p")[i] for i, s in enumerate(sums)]).alias("parent"), "words")


# ---- tree contraction ----------------------------------------------------------------------------------------

SUMS = ("leaves", "saved")


def subtree_totals(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """Sums of `leaves` and `saved` over the subtree of every node; nodes: node, parent (null: the root), kids, leaves,
    saved. Returns node and the two sums."""
    own = [f"own_{c}" for c in SUMS]         # of the node and all that was raked into it
    up = [f"up_{c}" for c in SUMS]           # what it hands to its parent besides its own total
    state = stage(spark, nodes.select("node", "parent", "kids", *[F.col(c).alias(f"own_{c}") for c in SUMS],
                                      *[F.lit(0).cast("long").alias(c) for c in up]), "trie-round")
    rounds = []
    while state.where("parent IS NOT NULL").limit(1).count():
        # rake
        gone = (F.col("kids") == 0) & F.col("parent").isNotNull()
        given = state.where(gone).groupBy(F.col("parent").alias("node")).agg(
            F.count("*").alias("raked"), *[F.sum(F.col(o) + F.col(u)).alias(f"in_{o}") for o, u in zip(own, up)])
        left = state.where(~gone).join(given, "node", "left").select(
            "node", "parent", (F.col("kids") - F.coalesce("raked", F.lit(0))).alias("kids"),
            *[(F.col(o) + F.coalesce(f"in_{o}", F.lit(0))).alias(o) for o in own], *up)
        # compress
        heads = (F.col("kids") == 1) & F.col("parent").isNotNull() & (F.xxhash64("node", F.lit(len(rounds))) % 2 == 0)
        left = left.withColumn("heads", heads)
        only = left.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.min_by(F.struct("node", "heads", *up), "node").alias("child"))     # read only where it is the only one
        left = left.join(only, "node", "left").withColumn("spliced", F.col("heads") & ~F.col("child.heads"))
        left = stage(spark, left, "trie-left")
        moved = left.where("spliced").select(
            F.col("child.node").alias("node"), F.col("parent").alias("new_parent"),
            *[(F.col(o) + F.col(u)).alias(f"add_{u}") for o, u in zip(own, up)])
        rounds.append((state, left))
        state = stage(spark, left.where("NOT spliced").join(moved, "node", "left").select(
            "node", F.coalesce("new_parent", "parent").alias("parent"), "kids", *own,
            *[(F.col(u) + F.coalesce(f"add_{u}", F.lit(0))).alias(u) for u in up]), "trie-round")

    totals = [state.select("node", *[F.col(o).alias(c) for o, c in zip(own, SUMS)])]      # the root
    for before, left in reversed(rounds):
        # a spliced node's child was still there after its round: its total is among those of later rounds
        known = totals[0]
        for more in totals[1:]:
            known = known.unionByName(more)
        spliced = left.where("spliced").select(F.col("node").alias("upper"), F.col("child.node").alias("node"),
                                               *[(F.col(o) + F.col(f"child.{u}")).alias(f"add_{c}") for o, u, c in zip(own, up, SUMS)])
        totals.append(stage(spark, spliced.join(known, "node").select(
            F.col("upper").alias("node"), *[(F.col(c) + F.col(f"add_{c}")).alias(c) for c in SUMS]), "trie-totals"))
        totals.append(before.where("kids = 0 AND parent IS NOT NULL").select("node", *[F.col(o).alias(c) for o, c in zip(own, SUMS)]))
    out = totals[0]
    for more in totals[1:]:
        out = out.unionByName(more)
    out = stage(spark, out, "trie-sums")
    release(spark, state, *[df for pair in rounds for df in pair], *[df for df in totals if hasattr(df, "staged_at")])
    return out


# ---- digests of the conversations that end in a node ----------------------------------------------------------

def ends_digests(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """node, ends_sha256 of ends (node, conv_id): sha256 of the ids as decimals, ascending, joined by commas."""
    ship(spark)

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, ids in batch.groupby("node", sort=False)["conv_id"]:
                ids = ids.tolist()
                for i in range(0, len(ids), PIECE):
                    yield pd.DataFrame({"node": [node], "first": [ids[i]], "ids": [",".join(map(str, ids[i:i + PIECE]))]})

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, digest = None, None
        for batch in batches:
            out = []
            for at, ids in zip(batch["node"], batch["ids"]):
                if at != node:
                    if digest is not None:
                        out.append((node, digest.hexdigest()))
                    node, digest = at, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if out:
                yield pd.DataFrame(out, columns=["node", "ends_sha256"])
        if digest is not None:
            yield pd.DataFrame([(node, digest.hexdigest())], columns=["node", "ends_sha256"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = ends.select("node", "conv_id").repartitionByRange(n, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = dealt.mapInPandas(pieces, "node string, first long, ids string")
    return joined.repartition(n, "node").sortWithinPartitions("node", "first").mapInPandas(hashed, "node string, ends_sha256 string")


# ---- the trie --------------------------------------------------------------------------------------------------

def trie(spark: SparkSession, turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of conversations.

    turns: conv_id, depth (from 1, without gaps), body (equal for equal turns), words; convs: conv_id, n_turns, every
    conversation once, also those without turns. Returns conv_id (smallest member; with depth it names the node),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs = stage(spark, convs, "trie-members")
    whole = convs.agg(F.min("conv_id").alias("c"), F.count("*").alias("n")).first()
    walked = stage(spark, steps(turns), "trie-steps")
    nodes = walked.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"),
                                       F.count("*").alias("n_convs"), F.min("words").alias("words"))
    root = spark.range(1 if whole["n"] else 0).select(
        F.lit(ROOT).alias("node"), F.lit(whole["c"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("string").alias("parent"), F.lit(whole["n"]).alias("n_convs"), F.lit(0).cast("long").alias("words"))
    nodes = stage(spark, nodes.unionByName(root), "trie-nodes")
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("kids"))
    nodes = nodes.join(kids, "node", "left").select(
        "node", "conv_id", "depth", "parent", "n_convs", F.coalesce("kids", F.lit(0)).cast("long").alias("kids"),
        F.col("kids").isNull().cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    nodes = stage(spark, nodes, "trie-weights")
    totals = subtree_totals(spark, nodes)
    last = walked.select("conv_id", "depth", "node").unionByName(convs.where("n_turns = 0").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node")))
    digests = ends_digests(spark, last.join(convs, "conv_id").where("depth = n_turns"))
    # the root's children, a hot key, know their parent; the others look it up
    above = nodes.where("depth > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    top = nodes.where("depth < 2").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(whole["c"])).cast("long"))
    out = nodes.where("depth > 1").join(above, "parent").unionByName(top).join(totals, "node").join(digests, "node", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"), totals["leaves"].alias("n_leaves"), totals["saved"].alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))


def conversation_trie(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The trie of the conversations of df (conv_id, turn, role, text) after each has borrowed its opening."""
    return trie(spark, *borrow_openings(spark, own_turns(spark, df)))
