"""Fleet page extraction -> vehicle_models.

Input: a pages DataFrame `(page_rank int, page_id long, line_type_code int, html string)`
where `page_rank` is the scrape order of the page family. Every `<h2>` heading is a
model candidate; its vehicle count comes from the immediately following `p/div/ul`
sibling (`N tükki`), else from the known-amount table. The first occurrence of a
model name across all pages (page_rank, page_id, position) wins.

All extraction is done by column expressions (`functions.html`); the
dedupe is `row_number() = 1`, which is map-side limited so a model that appears on
a third of all pages does not concentrate in one task.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import seeds
from ..functions import html
from ..operators.broadcast import seed_broadcast
from ..operators.latest import first_per_key
from ..operators.once import evaluate_once
from ..operators.surrogate import assign_ids
from . import reference

SIBLINGS = ("p", "div", "ul")


def extract_headings(pages: DataFrame) -> DataFrame:
    """-> (page_rank, page_id, line_type_code, pos, model, sibling_text). The sibling is the element that follows the
    heading; its text counts only if it is a `p`, `div` or `ul`, whole, whatever is nested in it."""
    keep = ["page_rank", "page_id", "line_type_code"]
    t = evaluate_once(pages, keep, {"t": html.tokens(F.col("html"))})
    m = evaluate_once(t, [*keep, "t"], {"tags": html.marks(F.col("t"))})
    e = evaluate_once(m, [*keep, "t", "tags"], {"h2": html.elements(F.col("tags"), F.size("t"), "h2"),
                                                "blocks": html.elements(F.col("tags"), F.size("t"), *SIBLINGS)})
    text = lambda x: html.text_between(F.col("t"), x["start"], x["stop"])

    def sibling(h):
        """The block that opens at the first tag after the heading; none if that tag closes the parent."""
        following = F.filter("tags", lambda x: x["at"] > h["stop"])
        return F.filter("blocks", lambda b: b["start"] == F.get(following, F.lit(0))["at"])

    found = F.transform("h2", lambda h: F.struct(text(h).alias("model"), F.coalesce(F.get(F.transform(sibling(h), text), F.lit(0)), F.lit(""))
                                                 .alias("sibling_text")))
    return evaluate_once(e, keep, {"b": found}).select(*keep, F.posexplode("b").alias("pos", "b")).select(
        *keep, "pos", "b.model", "b.sibling_text")


def vehicle_amount(text):
    """'23 tükki' -> 23; NULL when absent."""
    return F.regexp_extract(F.lower(text), seeds.VEHICLE_AMOUNT_PATTERN, 1).try_cast("int")


def scrape_fleet(pages: DataFrame, valid_from: dt.date | None = None) -> DataFrame:
    """Fleet pages -> TLT vehicle_models rows (before the train models are added)."""
    spark = pages.sparkSession
    heads = extract_headings(pages)
    skip = [s.lower() for s in seeds.SKIP_HEADINGS]
    heads = heads.filter((F.length("model") >= seeds.MIN_HEADING_LENGTH)
                         & ~F.lower(F.col("model")).isin(skip))
    first = first_per_key(heads, ["model"], ["page_rank", "page_id", "pos"])
    known = seed_broadcast(reference.known_amounts(spark))
    joined = first.join(
        known,
        (known.operator_code == F.lit(seeds.GPS_OPERATOR))
        & (known.line_type_code == first.line_type_code)
        & (known.model == first.model),
        "left")
    models = joined.select(
        F.lit(seeds.GPS_OPERATOR).alias("operator_code"),
        first.line_type_code,
        first.model,
        F.coalesce(vehicle_amount(first.sibling_text), known.known_amount).alias("vehicle_amount"))
    return reference.finish_models(models, valid_from)


def vehicle_models(pages: DataFrame, valid_from: dt.date | None = None) -> DataFrame:
    """Scraped TLT models + hand-entered train models."""
    spark = pages.sparkSession
    return scrape_fleet(pages, valid_from).unionByName(reference.train_models(spark, valid_from))


MODEL_KEY = ["operator_code", "line_type_code", "model"]


def with_model_ids(models: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Vehicle models with their surrogate `id`: stored models keep theirs, new ones get the next."""
    return assign_ids(models, MODEL_KEY, stored)
