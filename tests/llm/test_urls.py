"""URL filters: parsing, listed rules, mined rules, odd rows."""

from pyspark.sql import functions as F

from rowmill.llm import urls
from rowmill.llm.queries import URL_RULES


def judged(spark, rows, labels=()):
    pages = spark.createDataFrame(rows, "page_id long, url string")
    known = spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")
    return {r.id: r for r in urls.judge(pages.withColumn("features", F.lit(1)), known, URL_RULES).collect()}


def test_listed_rules(spark):
    cases = {
        "http://a.b.example.net/en/1": ("a.b.example.net", "/en/1", "example.net/en/", "allow"),
        "HTTP://Example.NET/EN/1?x#y": ("example.net", "/EN/1", "net/", "block"),
        "x://net": ("net", "", None, "allow"),
        "x://notnet/": ("notnet", "/", None, "allow"),
        "x://badexample.com/de/": ("badexample.com", "/de/", None, "allow"),
        "x://example.com/de/?q": ("example.com", "/de/", "example.com/de/", "block"),
        "x://a.org/fr/#/z": ("a.org", "/fr/", "org/fr/", "allow"),
        "x://a.org?b://c.net/": ("a.org", "", None, "allow"),
        "É://ÉA.org/fr": ("Éa.org", "/fr", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    got = judged(spark, list(enumerate(cases)))
    for i, want in enumerate(cases.values()):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want


def test_mined_rules(spark):
    rows = [(i, f"https://s{i % 2}.{'spam' if i % 4 == 0 else 'fine'}.example.edu/{'xx' if i % 3 == 0 else 'yy'}/{i}") for i in range(240)]
    labels = [(i, int(i % 12 != 0), 0) for i in range(120)] + [(0, None, None), (None, 0, 0), (5, None, 1)]
    got = judged(spark, rows, labels)
    assert all((got[i].verdict == "block") == (i % 12 == 0) for i in range(240))


def test_tokens_in_any_place_make_rules(spark):
    """A word in a path, one pair of a query and one host label under many hosts, each in few rows."""
    plain = [(i, f"https://w{i % 7}.site{i % 11}.example.org/a/{i}?id={i}") for i in range(2000)]
    marked = [
        *((2000 + i, f"https://w{i % 7}.site{i % 11}.example.org/a/free-casino-{i}.html") for i in range(24)),
        *((2100 + i, f"https://site{i % 11}.example.org/b/{i}?page={i}&cat=adult") for i in range(24)),
        *((2200 + i, f"https://{'abcdefgh'[i % 8]}.pills.site{i % 11}.example.org/{i}") for i in range(24)),
    ]
    labels = [(i, 1, 0) for i in range(1000)] + [(2000 + 100 * k + i, 0, 1) for k in range(3) for i in range(12)]
    got = judged(spark, plain + marked, labels)
    assert {i for i, r in got.items() if r.verdict == "block"} == {i for i, _ in marked}


def test_too_few_or_too_mixed_make_none(spark):
    rows = [(i, f"https://a.example.org/{'few' if i < 9 else 'mixed' if i < 100 else 'rest'}/{i}") for i in range(300)]
    labels = [(i, int(not (i < 9 or (i < 100 and i % 2))), 0) for i in range(300)]
    assert {r.verdict for r in judged(spark, rows, labels).values()} == {"allow"}


def test_repeats_and_nothing(spark):
    assert judged(spark, []) == {}
    pages = spark.createDataFrame([(None, "x://a.net/"), (1, "x://a.net/"), (1, "x://a.net/")], "page_id long, url string")
    known = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    assert [r.verdict for r in urls.judge(pages, known, URL_RULES).collect()] == ["block"] * 3


def test_rules_beyond_the_items_of_fp_growth(spark):
    """Two words tell together only, in URLs with twelve features that tell more by themselves."""
    decoys = [f"d{i}" for i in range(12)]
    rows = [(i, f"https://a.example.org/{'/'.join(decoys)}/one/two/{i}") for i in range(12)]
    rows += [(1000 + 100 * k + i, f"https://a.example.org/{d}/{i}") for k, d in enumerate(decoys) for i in range(8)]
    rows += [(3000 + i, f"https://a.example.org/{'one' if i % 2 else 'two'}/{i}") for i in range(36)]
    rows += [(4000 + i, f"https://a.example.org/plain/{i}") for i in range(200)]
    labels = [(i, int(i >= 12), 0) for i, _ in rows]
    asked = [(9001, "https://a.example.org/two/x/one"), (9002, "https://a.example.org/one"), (9003, "https://a.example.org/d3/z/d7")]
    got = judged(spark, rows + asked, labels)
    assert [got[i].verdict for i, _ in asked] == ["block", "allow", "block"]
    assert got[9001].confidence == 1.0
    assert {i for i, r in got.items() if r.verdict == "block" and i < 9000} == set(range(12))


def test_features_of_the_same_rows_stand_for_one_another(spark):
    """Thirty words that go together are one kind; any of them fits."""
    words = "/".join(f"w{i}" for i in range(30))
    rows = [(i, f"https://a.example.org/{words}/{i}") for i in range(20)] + [(100 + i, f"https://a.example.org/x/{i}") for i in range(80)]
    labels = [(i, int(i in (3, 7) or i >= 100), 0) for i, _ in rows]
    got = judged(spark, [*rows, (900, "https://b.example.com/w17"), (901, "https://b.example.com/w31")], labels)
    assert (got[900].verdict, got[901].verdict) == ("block", "allow")
    assert got[900].confidence == 0.9
