import pytest
from pyspark.sql import functions as F

from tidemark.llm import reputation as rep


def test_host_path_and_rules(spark):
    urls = [
        ("HTTP://WWW.Example.ORG/es/x?q#f", "www.example.org", "/es/x", "example.org/es/"),
        ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/"),
        ("x://a.com/fr/?u=://b.org/", "a.com", "/fr/", "com/fr/"),
        ("x://com/de/", "com", "/de/", "com/de/"),
        ("x://org", "org", "", None),
        ("x://İ.net?x", "İ.net", "", None),
        ("a.com/fr/", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
        ("http://h.net/a\nb?c", "h.net", "/a\nb", None),
    ]
    df = spark.createDataFrame([(i, u[0]) for i, u in enumerate(urls)], "i int, url string")
    df = df.withColumns({"h": rep.host_of(F.col("url")), "p": rep.path_of(F.col("url"))})
    df = df.withColumn("r", rep.rule_for(F.col("h"), F.col("p")))
    got = [(r.url, r.h, r.p, r.r.rule if r.r else None) for r in df.orderBy("i").collect()]
    assert got == urls


def test_registered_domains(spark):
    hosts = {"a.b.co.uk": "b.co.uk", "b.example.com": "example.com", "com": "com", "": "", "x.co": "x.co", "1.2": "1.2"}
    df = spark.createDataFrame([(h,) for h in hosts], "h string").withColumn("d", rep.domain_of(F.col("h")))
    assert {r.h: r.d for r in df.collect()} == hosts


def test_hosts_are_shrunk_towards_their_domain(spark):
    rows = [("a.bad.com", False)] * 200 + [("b.bad.com", False)] * 200 + [("new.bad.com", None)] + [("x.good.com", True)] * 300
    rows += [("y.good.com", True)] * 40 + [("few.good.com", False)] + [("z.net", True)] * 10 + [("", None)]
    got = {r.host: r for r in rep.reputation(spark.createDataFrame(rows, "host string, good boolean")).collect()}
    assert got["new.bad.com"].n == 0 and got["new.bad.com"].mean < 0.2 < 0.5 < got["few.good.com"].mean
    assert got["x.good.com"].bound > got["few.good.com"].bound and got["a.bad.com"].bound < 0.1
    assert all(0 < r.mean < 1 and r.bound < r.mean for r in got.values())


@pytest.mark.parametrize("rated", [True, False])
def test_clashing_names_repeats_and_empty_tables(spark, rated):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, None), (2, 0, None), (None, 1, 1), (3, None, None)] if rated else [], "doc_id long, quality int, toxic int"
    )
    data = [(1, "http://a.net/", "h", 1), (1, "http://a.net/", "h", 1), (None, None, None, None), (2, "http://a.net/", "x", 2)]
    pages = spark.createDataFrame(data, "page_id long, url string, host string, _site int")
    got = rep.judge(pages, labels).collect()
    assert len(got) == 4 and {(r.host, r.n_labelled) for r in got} == {("a.net", 3 * rated), ("", 0)}
    assert rep.judge(pages.limit(0), labels).count() == 0
    assert {r._site for r in got} == {1, 2, None}


def test_runs_without_python(spark, sf, plan_of):
    from tidemark.llm.queries import QUERIES

    assert "Python" not in plan_of(QUERIES["op7_host_reputation"](spark, sf))
