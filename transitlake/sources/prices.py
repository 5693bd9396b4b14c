"""Fuel price sources S4-S7 and their normalisation.

S4 daily archive JSON (`prices` map; key drift "Bensiin 95" vs "95", trap D7)
S5 price table rows in HTML pages (`<tr><td>name</td><td>1,754 €</td></tr>`)
S6 electricity series JSON (last element, EUR/MWh -> EUR/kWh, 6 dp)
S7 CNG price sentence mined from free text (first match, plausibility range)

All are regex / JSON expressions on the JVM over whole documents; every page or
document is processed independently (no grouping).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas, seeds
from ..functions import classify, html
from ..operators.once import evaluate_once

PRICE_TYPE = "decimal(18,7)"


def archive_fuel_name(key: Column) -> Column:
    """Archive key -> fuel code: old long names through the name map, others as is."""
    return F.coalesce(classify.price_fuel_type(key), key)


def parse_fuel_archive(docs: DataFrame, text_col: str = "doc",
                       keep: list[str] | None = None) -> DataFrame:
    """Archive documents -> (fuel_type, price_eur, source_date, source, scraped_at)."""
    keep = keep or []
    j = evaluate_once(docs, keep, {"j": F.from_json(F.col(text_col), schemas.FUEL_ARCHIVE)})
    e = j.select(*keep, "j.date", "j.scraped_at", "j.source",
                 F.explode("j.prices").alias("key", "price"))
    return e.select(
        *keep,
        archive_fuel_name(F.col("key")).alias("fuel_type"),
        F.col("price").cast(PRICE_TYPE).alias("price_eur"),
        F.col("date").try_cast("date").alias("source_date"),
        F.coalesce(F.col("source"), F.lit("archive")).alias("source"),
        F.col("scraped_at").try_cast("timestamp_ntz").alias("scraped_at"),
    )


def price_rows(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None,
               lo: float = seeds.FUEL_PRICE_MIN, hi: float = seeds.FUEL_PRICE_MAX) -> DataFrame:
    """Every row of a table that has >= 2 cells and names a fuel: (row_pos, fuel_type, price_text, price, reason).

    Fuel from the first cell by the ordered name map; price = second cell stripped to digits/./, with ',' -> '.'.
    `reason` says why a price is not taken; it is NULL for those that are. A row's cells are all cells below it, and
    tables, rows and cells end by tag depth (`functions.html`), so nested tables are rows of their own as well.

    Rows and cells are found once per page and then exploded: filters on the exploded fields cannot be pushed below the
    generator, so no page is taken apart twice."""
    keep = keep or []
    rows = pages.select(*keep, F.inline(html.table_cells(F.col(html_col), 2)))
    cand = evaluate_once(rows, [*keep, "row_pos"], {
        "name": F.lower(F.col("texts")[0]),
        "price_text": F.regexp_replace(F.regexp_replace(F.col("texts")[1], r"[^\d.,]", ""), ",", ".")})
    price = F.when(F.col("price_text") != "", F.col("price_text").try_cast("double"))
    parsed = cand.select(*keep, "row_pos", classify.price_fuel_type("name").alias("fuel_type"), "price_text", price.alias("price"))
    reason = (F.when(F.col("price_text") == "", "no price").when(F.col("price").isNull(), "no number")
               .when(~F.col("price").between(lo, hi), "out of range"))
    return parsed.filter(F.col("fuel_type").isNotNull()).withColumn("reason", reason)


def parse_price_tables(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None,
                       lo: float = seeds.FUEL_PRICE_MIN, hi: float = seeds.FUEL_PRICE_MAX
                       ) -> DataFrame:
    """The accepted rows of `price_rows`."""
    keep = keep or []
    rows = price_rows(pages, html_col, keep, lo, hi)
    return rows.filter(F.col("reason").isNull()).select(*keep, "row_pos", "fuel_type", "price")


def parse_electric(docs: DataFrame, text_col: str = "doc", keep: list[str] | None = None) -> DataFrame:
    """Last element of `data.ee` in EUR/MWh -> EUR/kWh rounded to 6 dp; no row when
    the series is empty or missing."""
    keep = keep or []
    j = evaluate_once(docs, keep, {"j": F.from_json(F.col(text_col), schemas.ELECTRIC_RESPONSE)})
    last = F.element_at(F.col("j.data.ee"), -1)
    return (j.filter(F.size(F.col("j.data.ee")) > 0)
             .select(*keep, F.lit("electric").alias("fuel_type"),
                     F.round(last["price"].cast("decimal(20,6)") / 1000, 6).cast(PRICE_TYPE)
                      .alias("price_eur")))


def cng_rows(texts: DataFrame, text_col: str = "text", keep: list[str] | None = None,
             lo: float = seeds.CNG_PRICE_MIN, hi: float = seeds.CNG_PRICE_MAX) -> DataFrame:
    """First `<number> euroni kilogrammist` / `<number> €/kg` in each text: (fuel_type, price_text, price, reason).
    Texts without a match yield no row. Pages go through `functions.html.page_text` first."""
    keep = keep or []
    plain = F.translate(F.col(text_col), "\u00a0\u2007\u202f", "   ")       # a non-breaking space is white space too
    raw = F.regexp_extract(plain, seeds.CNG_PRICE_PATTERN, 1)
    m = evaluate_once(texts, keep, {"raw": raw}).filter(F.col("raw") != "")   # one regex pass per text
    price_text = F.regexp_replace("raw", ",", ".")
    rows = m.select(*keep, F.lit("CNG").alias("fuel_type"), price_text.alias("price_text"), price_text.try_cast("double").alias("price"))
    return rows.withColumn("reason", F.when(F.col("price").isNull(), "no number").when(~F.col("price").between(lo, hi), "out of range"))


def mine_cng_price(texts: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                   lo: float = seeds.CNG_PRICE_MIN, hi: float = seeds.CNG_PRICE_MAX) -> DataFrame:
    """The accepted rows of `cng_rows`."""
    keep = keep or []
    return cng_rows(texts, text_col, keep, lo, hi).filter(F.col("reason").isNull()).select(*keep, "fuel_type", "price")


def write_checked(rows: DataFrame, path: str) -> dict[str, int]:
    """Accepted and rejected rows (P12: `reason` is NULL or not) into `<path>/outcome=accepted` and `.../outcome=rejected` by
    one write; the counts of both come from the same job."""
    seen = Observation()
    bad = F.col("reason").isNotNull()
    flagged = rows.withColumn("outcome", F.when(bad, "rejected").otherwise("accepted"))
    flagged = flagged.observe(seen, F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))
    flagged.write.mode("append").partitionBy("outcome").parquet(path)
    return dict(seen.get)


def ingest_batch(tables: DataFrame, electric: DataFrame, cng: DataFrame) -> DataFrame:
    """The day's prices of the three sources in the order they are asked (S5, S6, S7): columns seq, fuel_type,
    price_eur, source_date, source. Each input has id, row_pos, fuel_type, price_eur and source_date; any of them
    may be empty. `seq` orders the rows within a day, so the first price of a fuel wins on insert (S14)."""
    parts = [df.select(F.struct(F.lit(n).alias("source"), "id", "row_pos").alias("seq"), "fuel_type",
                       F.col("price_eur").cast(PRICE_TYPE).alias("price_eur"), "source_date", F.lit(name).alias("source"))
             for n, (name, df) in enumerate((("table", tables), ("electric", electric), ("cng", cng)))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def daily_archive_docs(prices: DataFrame, order_col: str = "seq") -> DataFrame:
    """S4 writer + A10: one archive document per day, `prices` = {fuel: price} where the
    last price of a fuel that day wins. Each fuel is reduced to one value before the
    per-day map is built, so a day's group holds one entry per fuel type."""
    last = (prices.groupBy("source_date", "fuel_type")
                  .agg(F.max_by("price_eur", F.col(order_col)).alias("price"),
                       F.max("scraped_at").alias("scraped_at")))
    day = (last.groupBy("source_date")
               .agg(F.map_from_entries(F.collect_list(F.struct("fuel_type", "price"))).alias("prices"),
                    F.max("scraped_at").alias("scraped_at")))
    doc = F.to_json(F.struct(F.col("source_date").cast("string").alias("date"),
                             F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"),
                             F.col("prices")))
    return day.select("source_date", doc.alias("doc"))
