"""HTML column expressions against hand-made pages."""
import html as stdlib

import pytest
from pyspark.sql import functions as F

from transitlake.functions import html
from transitlake.sources import fleet, prices


def column(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, h string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("h"))).collect()]


def test_entities_as_in_the_standard_library(spark):
    texts = ["k&uuml;tus &amp; gaas", "1,5&nbsp;&euro;", "&#8364; &#x20AC; &#X20ac; &#128;", "&Otilde;&otilde;&Scaron;&zcaron;", "AT&T & co &unknown;",
             "&#0; &#xD800; &#1114112;", "", "plain", "&lt;b&gt;", "&quot;&apos;", None, "🚌 &#128652;"]
    want = [None if t is None else stdlib.unescape(t) for t in texts]
    assert column(spark, texts, html.unescape) == want


def test_elements_end_by_depth(spark):
    page = "<table><tr><td>a<table><tr><td>x</td></tr></table>b</td></tr><tr><td>c</table></tr>"
    df = spark.createDataFrame([(page,)], "h string").select(html.tokens(F.col("h")).alias("t"))
    rows = df.select("t", F.explode(html.elements(html.marks(F.col("t")), F.size("t"), "tr")).alias("e")).select(
        html.text_between(F.col("t"), F.col("e.start"), F.col("e.stop"))).collect()
    assert [r[0] for r in rows] == ["axb", "x", "c"]


def test_no_tokens_from_comments_scripts_and_void_tags(spark):
    page = "a<!-- <p>b</p> -->c<script>if (a < b) '<p>';</script>d<BR/>e<br>f<!DOCTYPE html>g<style>p{}</style> 1 < 2 <img src='x>h"
    assert column(spark, [page], html.page_text)[0].startswith("acdefg 1 < 2 ")


def pages(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, html string")


def found(df):
    return sorted((r.id, r.fuel_type, r.price) for r in df.collect())


def test_prices_in_nested_tables_and_with_entities(spark):
    nested = ("<table><tr><td>Bensiin&nbsp;95<table><tr><td>Diislik&uuml;tus</td><td>1,499&nbsp;&euro;</td></tr></table></td>"
              "<td> <b>1,754</b> &#8364;</td></tr></table>")
    df = prices.parse_price_tables(pages(
        spark, nested, "<table><tr><td>Bensiin 98</td><td>1<!-- 9 -->,899</td></tr></table>", "<tr><td>95</td><td>1,5</td></tr>",
        "<TABLE><TR><TD><i>bensiin 95</i></TD><TD>1,6&euro;</TD></TR></TABLE>"), keep=["id"])
    got = found(df)
    # the outer row's cells are all below it, the nested ones included: its second cell is the nested first
    assert ("Diesel" in {f for i, f, _ in got if i == 0}) and (0, "Diesel", 1.499) in got
    assert (1, "98", 1.899) in got and (3, "95", 1.6) in got
    assert not [g for g in got if g[0] == 2]                                  # no table around the row


def test_rejected_prices_have_a_reason(spark):
    df = prices.price_rows(pages(spark, "<table><tr><td>Bensiin 95</td><td>9,99</td></tr><tr><td>Bensiin 98</td><td>1.2.3</td></tr><tr><td>"
                                        "Bensiin 98</td><td>n/a</td></tr><tr><td>piim</td><td>9</td></tr><tr><td>Bensiin 95</td><td>1,7</td></tr></table>"),
                           keep=["id"])
    got = sorted((r.fuel_type, r.price_text, r.reason or "") for r in df.collect())
    assert got == [("95", "1.7", ""), ("95", "9.99", "out of range"), ("98", "", "no price"), ("98", "1.2.3", "no number")]


def test_cng_price_in_html(spark):
    df = pages(spark, "<p>CNG hind: 2,299&nbsp;&euro;&nbsp;/&nbsp;kg</p>", "<p>2.<b>5</b>00 euroni kilogrammist</p>", "<p>0,5 &euro;/kg</p>", "<p>none</p>")
    df = df.withColumn("text", html.page_text(F.col("html")))
    assert found(prices.mine_cng_price(df, keep=["id"])) == [(0, "CNG", 2.299), (1, "CNG", 2.5)]
    assert [(r.id, r.reason) for r in prices.cng_rows(df, keep=["id"]).where("reason IS NOT NULL").collect()] == [(2, "out of range")]


def test_accepted_and_rejected_rows_in_one_write(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1.7, None), (2, 9.9, "out of range"), (3, None, "no number")], "id int, price double, reason string")
    assert prices.write_checked(rows, str(tmp_path / "p")) == {"accepted": 1, "rejected": 2}
    got = spark.read.parquet(str(tmp_path / "p"))
    assert sorted((r.id, r.outcome) for r in got.collect()) == [(1, "accepted"), (2, "rejected"), (3, "rejected")]


@pytest.mark.parametrize("sibling,want", [
    ("<p>Kokku 23 tükki</p>", "Kokku 23 tükki"), ("text <div><div>5</div> <b>12</b> tükki</div>", "512tükki"), ("<span>9 tükki</span><p>1 tükki</p>", ""),
    ("</div><p>4 tükki</p>", ""), ("<ul><li>7&nbsp;t&uuml;kki</li><li>x</li></ul>", "7\xa0tükkix"), ("", "")])
def test_heading_and_its_next_sibling(spark, sibling, want):
    page = f"<div><h2>Solaris <i>Urbino</i>&nbsp;12</h2>{sibling}</div>"
    df = spark.createDataFrame([(1, 1, 2, page)], "page_rank int, page_id long, line_type_code int, html string")
    r = fleet.extract_headings(df).first()
    assert r.model == "SolarisUrbino12" and r.sibling_text == want


def test_table_cells_agree_with_elements_and_texts(spark):
    """The walk over a page against the array functions, on pages of random pieces."""
    import random

    from pyspark.sql import functions as F

    from transitlake.functions import html
    rng = random.Random(7)
    bits = ["<table>", "</table>", "<TR>", "</tr>", "<td>", "</td>", "<tD a='b'>", "<td/>", "</td >", "<tdx>", "<th>", "<b>", "</b>", "x", " y ", "&nbsp;z", "&euro",
            "&#8364;", "&#x20AC;", "&#128;", "&#xD800;", "&#99999999;", "&foo;", "&", "a & b", "<", "< td", "<!-- <td> -->", "<!-- ", "<script>x<td></Script >",
            "<STYLE>a</style>", "<script>", "<!doctype x>", "</", ">", "\U0001f600", "<td:x>", "\u0085", "&Abreve;"]
    pages = [(i, "<table>" * (i % 2) + "".join(rng.choice(bits[:9] if rng.random() < .5 else bits) for _ in range(rng.randint(0, 40)))) for i in range(600)]
    df = spark.createDataFrame([*pages, (-1, None), (-2, "")], "id long, html string").repartition(4).localCheckpoint()
    walked = df.select("id", F.inline(html.table_cells(F.col("html"), 2)))
    t = df.select("id", html.tokens(F.col("html")).alias("t")).localCheckpoint()
    e = t.select("id", "t", *[html.elements(html.marks(F.col("t")), F.size("t"), n).alias(n) for n in ("table", "tr", "td")]).localCheckpoint()
    inside = lambda x, of: (x["start"] > of["start"]) & (x["start"] < of["stop"])
    rows = F.filter("tr", lambda r: F.exists("table", lambda a: inside(r, a)))
    cells = F.transform(rows, lambda r, i: F.struct(i.alias("row_pos"), F.transform(F.slice(F.filter("td", lambda c: inside(c, r)), 1, 2), lambda c: html.text_between(
        F.col("t"), c["start"], c["stop"])).alias("texts")))
    want = e.select("id", F.inline(F.filter(cells, lambda x: F.size(x["texts"]) == 2)))
    got = sorted(map(str, walked.collect()))
    assert len(got) > 50
    assert got == sorted(map(str, want.collect()))


def test_a_page_with_many_rows(spark):
    """The work for a page grows with its length: 30,000 rows, nested ones among them."""
    from pyspark.sql import functions as F

    from transitlake.sources import prices
    page = "<table>" + "".join(f"<tr><td>Diisel<td>1,{i:06}</td></td></tr>" for i in range(29_999)) + "<tr><td><table><tr><td>Diisel</td><td>x</td></tr></table></td></tr></table>"
    df = spark.createDataFrame([(1, page)], "id long, html string")
    row = prices.price_rows(df, keep=["id"]).agg(F.count("*"), F.sum("row_pos"), F.count("reason")).first()
    assert tuple(row) == (30_001, sum(range(30_001)), 2)
