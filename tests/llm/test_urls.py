import re

from aerolith.llm import registry, urls

ROWS = [
    ("http://A.example.ORG/en/12?x=/es/", "a.example.org", "/en/12", "example.org/en/1", "block"),
    ("https://org/x#y?z", "org", "/x", "org/", "allow"),
    ("https://example.com/fr/1", "example.com", "/fr/1", "com/fr/", "allow"),
    ("https://x.com/de/", "x.com", "/de/", "com/de/", "block"),
    ("https://x.com/FR/", "x.com", "/FR/", None, None),
    ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("https://xorg/", "xorg", "/", None, None),
    ("ftp://b.org", "b.org", "", None, None),
    ("https://c.net?q=://d.org/", "c.net", "", None, None),
    ("no scheme.org/", "", "", None, None),
    ("://e.org/\nx", "e.org", "/\nx", "org/", "allow"),
    (None, "", "", None, None),
    ("", "", "", None, None),
]


def pages_of(spark, extra=()):
    rows = [(i, u, "<title>the cheap house bank</title>") for i, u in enumerate([r[0] for r in ROWS] + list(extra))]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_hosts_paths_and_rules(spark):
    got = {r.page_id: r for r in urls.report(pages_of(spark)).collect()}
    assert len(got) == len(ROWS)
    for i, (_, host, path, rule, verdict) in enumerate(ROWS):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdict or "allow")


def test_every_rule_by_brute_force(spark, sf_dir):
    pages = {r.page_id: r.url for r in registry.table(spark, sf_dir, "pages").collect()}
    rows = registry.op5_url_filter(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for row in rows:
        found = re.match(r"^.*?://([^/?#]*)([^?#]*)", pages[row.page_id])
        host, path = found[1].lower(), found[2]
        fits = [
            (len(site + start), site + start, verdict)
            for verdict, site, start in urls.RULES
            if (host == site or host.endswith("." + site)) and path.startswith(start)
        ]
        best = max(fits, default=(0, None, None))
        assert (row.host, row.path, row.rule) == (host, path, best[1])
        assert row.verdict == (best[2] or row.verdict) and row.verdict in ("allow", "block")
        if row.rule is None and not set(re.split("[^a-z]+", host)) & set(urls.BLOCK_WORDS):
            assert row.verdict == "allow"


def test_names_are_split_into_their_likeliest_words():
    words = urls.Words.of({"cheap": 10, "pills": 10, "house": 5, "he": 1, "ap": 1, "c": 1})
    assert words.split("cheappills") == ["cheap", "pills"]
    assert words.split("cheapqzzzz") == ["cheapqzzzz"]
    assert words.split("") == []


def test_concatenated_and_plain_sites(spark):
    bad = ["https://cheapcasino.net/x", "http://www.house-poker.net/"]
    good = ["https://cheaphouse.net/x", "https://www.roads.net/adsorption"]
    got = urls.report(pages_of(spark, bad + good)).orderBy("page_id").collect()[len(ROWS) :]
    assert [r.verdict for r in got] == ["block", "block", "allow", "allow"]


def test_clashing_columns_and_empty_tables(spark):
    pages = pages_of(spark).selectExpr("*", "1 as host", "2 as title", "3 as rule")
    assert urls.judged(pages).select("doc.rule").distinct().collect()[0][0] == 3
    assert urls.report(pages.limit(0)).count() == 0


def test_words_of_the_tail_and_long_words_are_known(spark):
    # More than 50,000 commoner words beside the two words that occur once.
    common = " ".join(chr(97 + i // 17576) + "".join(chr(97 + i // 26**k % 26) for k in range(3)) + "q" for i in range(60_000))
    long = "abcdefghijklmnopqrstuvwxyzabcdef"
    titles = [common, common, f"quiltz {long}", "x", "x", "x"]
    addresses = ["n.net/a", "n.net/b", "n.net/c", "quiltzcasino.net/", f"{long}poker.net/", "quiltzhouse.net/"]
    rows = [(i, f"http://{a}", f"<title>{t}</title>") for i, (a, t) in enumerate(zip(addresses, titles, strict=True))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.report(pages).collect()}
    assert [got[i] for i in (3, 4, 5)] == ["block", "block", "allow"]


def test_splits_with_long_words_equal_all_substrings():
    long = "abc" * 20
    logs = {"a": -3.0, "b": -3.0, "c": -3.0, "abc": -4.0, long: -5.0, long + "a": -20.0, "ca": -1.0}

    def plain(name):
        best = [(0.0, 0)]
        for end in range(1, len(name) + 1):
            best.append(max((best[s][0] + logs.get(name[s:end], float("-inf")), -s) for s in range(end)))
        words = []
        while name and best[len(name)][0] > float("-inf"):
            start = -best[len(name)][1]
            words.insert(0, name[start:])
            name = name[:start]
        return words or [name]

    for name in (long, long + "a", "x" + long, "abcab", long * 3 + "b", "ca" * 40, "x"):
        assert urls.Words(logs).split(name) == plain(name)


def test_long_urls(spark):
    # A run of the path is a word itself, and one word is likelier than thousands; a host is only split.
    path = "casino" * 30_000
    extra = [f"https://plain.net/{path}", f"https://{path[:90_000]}.net/x", f"https://cheap{'ab' * 5000}.net/"]
    got = urls.report(pages_of(spark, extra)).orderBy("page_id").collect()[len(ROWS) :]
    assert [r.verdict for r in got] == ["allow", "block", "allow"]
    assert got[0].path == "/" + path
