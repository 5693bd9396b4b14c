"""Quality rules with cross-document line frequency (operator 10), DataFrame functions only.

Per document: text measures (words, code points in words, symbols, repeated lines, words in
repeated 8-word windows) and the base rule on them. Across documents: lines are normalised
(lower case, white space collapsed) and hashed; per host (`source`) the number of distinct
document texts holding a line is counted, so exact copies of a document count once. Lines in
more than `line_share` of a host's texts, and in at least `min_docs` of them, are boilerplate
and are removed; a document that keeps fewer than `min_left` of its characters is depleted and
rejected.

Edge cases: a null text has no words and fails the base rule; a null source is a host of its
own; repeated rows are judged alike, each on its own row; an empty table gives an empty
result; other columns are ignored by `judge` and kept by `clean`.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, WORD, stage, words

LINE_SHARE, MIN_DOCS, MIN_LEFT = 0.10, 20, 0.30
WINDOW = 8


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Hash of a normalised line."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, SPACES, " "))))


def _pairs(hashes: Column, step: int) -> Column:
    """Hash of each element with the one `step` further on (the last `step` have none)."""
    rest = F.slice(hashes, step + 1, F.greatest(F.size(hashes) - step, F.lit(0)))
    return F.zip_with(hashes, rest, lambda a, b: F.xxhash64(a, b))


def _count_repeats(hashes: Column) -> Column:
    """Positions covered by the windows (each `WINDOW` long) whose hash occurs twice or more.

    A distinct set settles texts without a repeat; the others sort (hash, position), mark equal
    neighbours and add up how far each marked window reaches before the next one starts."""
    def repeats(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            at = F.transform(s, lambda x, j: F.when(
                (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]), x["i"]))
            return F.sort_array(F.filter(at, lambda p: p.isNotNull()))

        def covered(p: Column) -> Column:
            return F.aggregate(
                F.transform(p, lambda x, j: F.least(F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
                F.lit(0), lambda a, x: a + x)

        return _let(_let(ordered, marked), covered)

    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeats(h)))


def _let(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measured(df: DataFrame, text: str, full: bool = True) -> DataFrame:
    """`df` with n_words and n_repeat_words of its text column and, if `full`, the other measures.

    One projection per step: each array is computed once and read by the next one. Hashes of 8-word
    windows are built by doubling (1, 2, 4, 8 words)."""
    own = [c for c in df.columns]
    sized = [F.size("qm_words").cast("long").alias("n_words")]
    if full:
        filled = F.filter(_lines(F.col(text)), lambda x: F.rlike(x, F.lit(WORD)))
        sized += [F.length(F.array_join("qm_words", "")).cast("long").alias("word_chars"),
                  F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                  _let(filled, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")]
    out = df.select(*own, words(F.col(text)).alias("qm_words"))
    out = out.select(*own, *sized, F.transform("qm_words", lambda w: F.xxhash64(w)).alias("qm_h"))
    own = [c for c in out.columns if c != "qm_h"]
    for step in (1, 2, 4):
        out = out.select(*own, _pairs(F.col("qm_h"), step).alias("qm_h"))
    windows = F.slice("qm_h", 1, F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)).cast("int"))
    out = out.select(*own, windows.alias("qm_h"))
    return out.select(*own, _count_repeats(F.col("qm_h")).cast("long").alias("n_repeat_words"))


def _key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull()).alias("qk_hash")


def _host(source: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(source), F.lit("")), F.col(source).isNull()).alias("qk_host")


def _keyed(docs: DataFrame) -> DataFrame:
    """Own names: qk_* identify a row's content, qk_host its host."""
    return docs.select(
        F.col("doc_id").alias("qk_id"), F.col("text").alias("qk_text"),
        _key("text"), _host("source"))


def common_lines(spark: SparkSession, docs: DataFrame, line_share: float = LINE_SHARE,
                 min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(all lines with a word: qk_id, qk_hash, qk_host, pos, line, words; the lines above the limits: qk_host, line)."""
    d = _keyed(docs)
    lines = stage(spark, d.select(
        "qk_id", "qk_hash", "qk_host",
        F.posexplode(F.transform(_lines(F.col("qk_text")), lambda x: F.struct(
            line_key(x).alias("line"), F.length(x).alias("chars"))))).select(
        "qk_id", "qk_hash", "qk_host", "pos", "col.line", "col.chars").where(F.col("line") != line_key(F.lit(""))), "lines")
    hosts = d.groupBy("qk_host").agg(F.countDistinct("qk_hash").alias("texts"))
    held = lines.groupBy("qk_host", "line").agg(F.countDistinct("qk_hash").alias("n")).where(F.col("n") >= min_docs)
    above = held.join(hosts, "qk_host").where(F.col("n") > line_share * F.col("texts")).select("qk_host", "line")
    return lines, stage(spark, above, "common-lines")


def _lost(lines: DataFrame, above: DataFrame) -> DataFrame:
    """l_id, l_hash, l_host, n_removed_chars, cut (line hashes): what the lines above the limits take from a text."""
    return (lines.join(above, ["qk_host", "line"])
            .groupBy("qk_id", "qk_hash", "qk_host", "pos").agg(F.max("chars").alias("chars"), F.first("line").alias("line"))
            .groupBy("qk_id", "qk_hash", "qk_host").agg(F.sum("chars").alias("n_removed_chars"), F.collect_set("line").alias("cut"))
            .withColumnsRenamed({"qk_id": "l_id", "qk_hash": "l_hash", "qk_host": "l_host"}))


def _depleted(chars: Column, removed: Column, min_left: float) -> Column:
    """Whether a text is left with too little; line feeds of removed lines do not count as removed."""
    return chars - removed < min_left * chars


def judge(spark: SparkSession, docs: DataFrame, line_share: float = LINE_SHARE, min_docs: int = MIN_DOCS,
          min_left: float = MIN_LEFT) -> DataFrame:
    """doc_id, the five measures, base_failed, n_removed_chars (in lines above the limits), kept."""
    lines, above = common_lines(spark, docs, line_share, min_docs)
    lost = _lost(lines, above).drop("cut")
    base = measured(_keyed(docs).withColumn("qk_chars", F.length("qk_text")), "qk_text").drop("qk_text")
    both = base.join(lost, F.col("qk_id").eqNullSafe(F.col("l_id")) & (F.col("qk_hash") == F.col("l_hash"))
                     & (F.col("qk_host") == F.col("l_host")), "left")
    removed = F.coalesce(F.col("n_removed_chars"), F.lit(0)).cast("long")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    depleted = _depleted(F.col("qk_chars"), removed, min_left)
    return both.select(F.col("qk_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", failed.alias("base_failed"), removed.alias("n_removed_chars"),
                       (~failed & ~depleted).alias("kept"))


def clean(spark: SparkSession, docs: DataFrame, line_share: float = LINE_SHARE, min_docs: int = MIN_DOCS,
          min_left: float = MIN_LEFT) -> DataFrame:
    """The documents that `judge` keeps, with their columns; lines above the limits are cut from `text`
    and `n_chars` follows it (a text without such lines stays as it is)."""
    lines, above = common_lines(spark, docs, line_share, min_docs)
    cut = _lost(lines, above).withColumnsRenamed({
        "l_id": "qk_lid", "l_hash": "qk_lhash", "l_host": "qk_lhost", "n_removed_chars": "qk_removed", "cut": "qk_cut"})
    rows = docs.select(F.struct(*docs.columns).alias("qk_row")).select("qk_row", _key("qk_row.text"), _host("qk_row.source"))
    both = rows.join(cut, F.col("qk_row.doc_id").eqNullSafe(F.col("qk_lid")) & (F.col("qk_hash") == F.col("qk_lhash"))
                     & (F.col("qk_host") == F.col("qk_lhost")), "left")
    own = F.col("qk_row.text")
    left = F.array_join(F.filter(_lines(own), lambda x: ~F.array_contains(F.col("qk_cut"), line_key(x))), "\n")
    both = both.select("qk_row", own.alias("qk_own"), F.coalesce("qk_removed", F.lit(0)).alias("qk_removed"),
                       F.when(F.col("qk_cut").isNull(), own).otherwise(left).alias("qk_text"))
    # Through a generator: a filter on plain columns would be pushed down and compute the window hashes again
    # for every place that reads them.
    done = measured(both, "qk_own", full=False).select(
        "qk_row", "qk_own", "qk_removed", "qk_text", F.explode(F.array(F.struct("n_words", "n_repeat_words"))).alias("qk_m"))
    kept = done.where(
        (F.col("qk_m.n_words") >= 20) & (100 * F.col("qk_m.n_repeat_words") <= 30 * F.col("qk_m.n_words"))
        & ~_depleted(F.length("qk_own"), F.col("qk_removed"), min_left))
    changed = {"text": F.col("qk_text"), "n_chars": F.when(F.col("qk_text") == F.col("qk_own"), F.col("qk_row.n_chars"))
               .otherwise(F.length("qk_text"))}
    return kept.select(*[changed.get(f.name, F.col(f"qk_row.`{f.name}`")).cast(f.dataType).alias(f.name)
                         for f in docs.schema])
