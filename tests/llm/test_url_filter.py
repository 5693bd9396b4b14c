import random
import re
from collections import Counter
from itertools import combinations

from transitlake.llm import url_filter as u

PAGES, LABELS = "page_id long, url string", "doc_id long, quality int, toxic int"
RULES = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}


def brute(url):
    """host, path, rule, verdict of the rule."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for (h, p), v in RULES.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = [None, "", "example.net/en/1", "://", "http://", "http://net", "http://net/", "HTTP://A.EXAMPLE.NET/en/x?y#z", "http://xexample.net/en/",
        "http://example.net/EN/", "http://example.net?/en/", "http://a.b.example.com/de/1", "http://example.com/de", "http://x.org/fr/#a",
        "http://org/fr/", "http://porg/fr/", "http://x.com://net/", "http://user@h.net:80/p", "http://É.net/a\nb?c", "http://x.org/" + "a" * 50_000,
        "http://#net/", "http://x.net#/y"]


def judged(spark, pages, labels, **how):
    df = u.judge(spark, spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS), **how)
    return {r["page_id"]: r for r in df.collect()}


def test_host_path_and_policy(spark):
    got = judged(spark, list(enumerate(URLS)), [])
    for i, url in enumerate(URLS):
        host, path, rule, verdict = brute(url)
        assert tuple(got[i])[1:] == (host, path, rule, verdict or "allow"), url


def test_whole_table_against_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = u.judge(spark, pages, labels).collect()
    urls = {r["page_id"]: r["url"] for r in pages.select("page_id", "url").collect()}
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = brute(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_mined_rules_block(spark):
    pages, labels = [], []
    for i in range(200):
        spam, shop = i % 4 == 0, i % 2 == 0
        pages.append((i, f"https://{'win' if spam else 'news'}.{'shop' if shop else 'blog'}.example.com/{'bets' if shop else 'x'}/{i}"))
        labels.append((i, 1, int(spam)) if i % 3 else (i, 0 if spam else 1, None))
    pages += [(1000, "https://win.shop.example.com/bets/9"), (1001, "https://win.other.example.com/x/9"), (1002, "https://news.shop.example.com/bets/9"),
              (1003, None), (1003, None), (1004, "https://win.shop.example.net/en/bets/"), (None, "https://win.shop.example.com/bets/9")]
    labels += [(5000, 0, 1), (None, 0, 1), (3, None, None)]
    got = judged(spark, pages, labels)
    assert got[1000]["verdict"] == got[None]["verdict"] == "block"
    assert got[1002]["verdict"] == got[1003]["verdict"] == "allow"
    assert got[1004]["verdict"] == "allow" and got[1004]["rule"] == "example.net/en/"
    rules = u.mine(spark, spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS)).collect()
    # Brute force: support and confidence over the labelled rows, and no rule within another.
    held = {r["page_id"]: set(r["t"]) for r in spark.createDataFrame(pages, PAGES).select("page_id", u.tokens(u.F.col("url")).alias("t")).collect()}
    known = {i: (t == 1 or q == 0) for i, q, t in labels if i in held and i is not None and not (q is None and t is None)}
    every = expected({i: held[i] for i in known}, known)
    assert {tuple(r["tokens"]): round(r["confidence"], 9) for r in rules} == every and every
    for r in rules:
        assert r["key"] in r["tokens"]


def expected(held, known, most=u.MOST_TOKENS):
    """All rules by definition: every set of tokens, its support, the bound of its confidence, no rule within another."""
    n = len(held)
    count = Counter(t for ts in held.values() for t in ts)
    kept = {i: frozenset(sorted((t for t in ts if count[t] >= u.MIN_SUPPORT * n), key=lambda t: (-count[t], t))[:most]) for i, ts in held.items()}
    rows, bad = Counter(), Counter()
    for i, ts in kept.items():
        for k in range(1, len(ts) + 1):
            for some in combinations(sorted(ts), k):
                rows[some] += 1
                bad[some] += known[i]
    out = {}
    for some, m in rows.items():
        p, z = bad[some] / m, u.Z
        low = (p + z * z / (2 * m) - z * (p * (1 - p) / m + z * z / (4 * m * m)) ** 0.5) / (1 + z * z / m)
        if bad[some] >= u.MIN_SUPPORT * n and p >= u.MIN_CONFIDENCE and low >= u.MIN_CONFIDENCE:
            out[some] = round(p, 9)
    return {s: p for s, p in out.items() if not any(set(o) < set(s) for o in out)}


def test_no_rule_is_missing_on_random_urls(spark):
    rng = random.Random(4)
    pages, labels = [], []
    for i in range(400):
        words = [rng.choice("abcdefgh") * 3 for _ in range(rng.randint(1, 5))]
        pages.append((i, f"https://{words[0]}.example.com/" + "/".join(words[1:]) + f"?{rng.choice(['utm', 'ref', 'pid'])}={i}"))
        labels.append((i, int(not (("aaa" in words and "bbb" in words) or rng.random() < 0.1)), 0))
    df = spark.createDataFrame(pages, PAGES)
    held = {r["page_id"]: set(r["t"]) for r in df.select("page_id", u.tokens(u.F.col("url")).alias("t")).collect()}
    known = {i: q == 0 for i, q, _ in labels}
    rules = u.mine(spark, df, spark.createDataFrame(labels, LABELS)).collect()
    want = expected(held, known)
    assert {tuple(r["tokens"]): round(r["confidence"], 9) for r in rules} == want and want
    got = judged(spark, pages, labels)
    for i, url in pages:
        verdict = brute(url)[3] or ("block" if any(set(s) <= held[i] for s in want) else "allow")
        assert got[i]["verdict"] == verdict


def test_the_same_rule_at_every_size(spark):
    """Copies of all rows change no support and can only firm up a confidence."""
    pages = [(i, f"https://{'bad' if i % 10 == 0 else 'good'}{chr(97 + i % 3) * 3}.example.com/x") for i in range(300)]
    labels = [(i, int(i % 10 != 0), 0) for i in range(300)]
    few = {tuple(r["tokens"]) for r in u.mine(spark, spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS)).collect()}
    more = [(i + 1000 * k, url) for k in range(20) for i, url in pages]
    many = {tuple(r["tokens"]) for r in u.mine(spark, spark.createDataFrame(more, PAGES), spark.createDataFrame(
        [(i + 1000 * k, q, t) for k in range(20) for i, q, t in labels], LABELS)).collect()}
    assert few and few == many


def test_a_family_with_many_tokens_stays_bounded(spark):
    path = "/".join(f"part{chr(97 + i)}" for i in range(24))
    pages = [(i, f"https://x.example.com/{path}") for i in range(40)]
    rules = u.mine(spark, spark.createDataFrame(pages, PAGES), spark.createDataFrame([(i, 0, 1) for i in range(40)], LABELS))
    assert 1 <= rules.count() <= 2 ** u.MOST_TOKENS


def test_rare_tokens_of_long_urls_give_rules_too(spark):
    """Urls of 16 tokens; the bad ones differ in the two rarest, which a limit to a url's commonest tokens would leave out."""
    path = "/".join(f"part{chr(97 + i)}" for i in range(13))
    mark = lambda i: ("xxx" if i % 4 < 2 else "uuu", "yyy" if i % 2 else "vvv")
    pages = [(i, f"https://example.com/{path}/" + "/".join(mark(i))) for i in range(200)]
    labels = [(i, int(mark(i) != ("xxx", "yyy")), 0) for i in range(200)]
    rules = u.mine(spark, spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS)).collect()
    assert [(sorted(r["tokens"]), r["confidence"], round(r["support"], 9)) for r in rules] == [(["p:xxx", "p:yyy"], 1.0, 0.25)]
    got = judged(spark, pages, labels)
    assert all(got[i]["verdict"] == ("block" if mark(i) == ("xxx", "yyy") else "allow") for i in range(200))


def test_all_tokens_against_brute_force_on_random_long_urls(spark):
    rng = random.Random(9)
    pages, labels = [], []
    for i in range(150):
        words = rng.sample([c * 3 for c in "abcdefghijklmn"], 11)
        pages.append((i, f"https://x.com/{'/'.join(words)}"))
        labels.append((i, int(not ({"aaa", "bbb", "ccc"} <= set(words) or rng.random() < 0.2)), 0))
    df = spark.createDataFrame(pages, PAGES)
    held = {r["page_id"]: set(r["t"]) for r in df.select("page_id", u.tokens(u.F.col("url")).alias("t")).collect()}
    assert max(map(len, held.values())) > u.MOST_TOKENS
    rules = u.mine(spark, df, spark.createDataFrame(labels, LABELS)).collect()
    want = expected(held, {i: q == 0 for i, q, _ in labels}, most=99)
    assert {tuple(r["tokens"]): round(r["confidence"], 9) for r in rules} == want and want


def test_columns_with_clashing_names(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", 1, 2, "t"), (2, None, 1, 2, "t")], PAGES + ", hit int, k1 int, token string")
    labels = spark.createDataFrame([(1, 0, 1, "u")], LABELS + ", url string")
    assert {r["page_id"]: r["verdict"] for r in u.judge(spark, pages, labels).collect()} == {1: "block", 2: "allow"}


def test_empty_tables(spark):
    assert judged(spark, [], []) == {}
    assert judged(spark, [], [(1, 0, 1)]) == {}
