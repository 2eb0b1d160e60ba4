import os

import pytest
from pyspark.sql import functions as F

from prosemill.llm.registry import ORACLES
from prosemill.llm.url_rules import BASE_RULES, judge_urls, op4_url_rules, site_rule
from tests.conftest import plan_of
from tests.oracle import compare, connect

CASES = {
    "http://a.example.net/en/1?x=1": ("a.example.net", "/en/1", "example.net/en/", "allow"),
    "http://EXAMPLE.net/en/": ("example.net", "/en/", "example.net/en/", "allow"),
    "http://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
    "http://example.net/en": ("example.net", "/en", "net/", "block"),
    "http://badexample.net/en/": ("badexample.net", "/en/", "net/", "block"),
    "https://b.example.com/de/x": ("b.example.com", "/de/x", "example.com/de/", "block"),
    "https://x.org/fr/#top": ("x.org", "/fr/", "org/fr/", "allow"),
    "https://x.org.evil.com/fr/": ("x.org.evil.com", "/fr/", None, "allow"),
    "http://net": ("net", "", None, "allow"),
    "http://net/": ("net", "/", "net/", "block"),
    "http://a.net?q=/": ("a.net", "", None, "allow"),
    "http://www.free-bets.com/x": ("www.free-bets.com", "/x", None, "block"),
    "http://free-bets.com": ("free-bets.com", "", None, "block"),
    "http://free-betsy.com/x": ("free-betsy.com", "/x", None, "allow"),
    "http://a.com/free-bets.b/": ("a.com", "/free-bets.b/", None, "allow"),
    "x://y://z.net/": ("y:", "//z.net/", None, "allow"),
    "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
    "http://Ä.net/ß": ("Ä.net", "/ß", "net/", "block"),
}


def test_cases(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "page_id bigint, url string").withColumn("host", F.lit(1)).withColumn("token", F.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df).collect()}
    for i, (url, want) in enumerate(CASES.items()):
        assert got[i] == want, url


def test_repeated_and_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a.net/")] * 3 + [(None, None)] * 2, "page_id bigint, url string")
    assert judge_urls(df).count() == 5
    assert judge_urls(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        site_rule("a b/", "block")
    assert judge_urls(df, BASE_RULES[:1]).where("verdict = 'block'").count() == 3


def test_query_equals_its_sql_and_runs_no_python(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        if os.path.isdir(sf):
            assert compare(spark, connect(sf), op4_url_rules, ORACLES["op4_url_rules"], sf) is None
    assert "Python" not in plan_of(op4_url_rules(spark, "/root/testdata/sf0.001"))
