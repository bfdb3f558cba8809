from collections import Counter

import pytest

from tidemark.llm import site_lines


def brute(rows, ratio, least):
    """What each (host, text) row keeps."""
    pages, held = Counter(h for h, _ in rows), Counter()
    for host, text in rows:
        for line in set((text or "").split("\n") if text is not None else ()):
            held[host, line] += 1
    out = []
    for host, text in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if not x.strip(" ") or held[host, x] < least or held[host, x] / pages[host] <= ratio]
        out.append((None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_same_as_brute_force_with_nulls_ties_and_clashing_names(spark):
    rows = []
    for i in range(60):
        host = ["a", "b", None][i % 3]
        rows.append((host, "\n".join(["Menu"] * (i % 4 > 0) + ["", f"own {i}"] + ["Foot"] * (i % 10 == 0) + ["Menu"] * (i % 5 == 0))))
    rows += [("a", None), ("a", ""), ("a", "Menu"), ("c", "Menu"), ("a", "x " * 50_000), ("a", "x " * 50_000)]
    data = [(i, h, t, 7, "k", 1) for i, (h, t) in enumerate(rows)]
    docs = spark.createDataFrame(data, "doc_id long, source string, text string, n_lines int, _keys string, host int")
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in site_lines.drop_boilerplate(docs, 0.3, 3).collect()}
    assert [got[i] for i in range(len(rows))] == brute(rows, 0.3, 3)


def test_extra_columns_stay_and_empty_tables_pass(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string, host int, _site string")
    out = site_lines.drop_boilerplate(docs)
    assert out.columns == ["doc_id", "source", "text", "host", "_site", "n_lines", "n_dropped"] and out.count() == 0


@pytest.mark.parametrize("name", ["op10_site_lines"])
def test_runs_without_python(spark, sf, plan_of, name):
    from tidemark.llm.queries import QUERIES

    assert "Python" not in plan_of(QUERIES[name](spark, sf)) and "Arrow" not in plan_of(QUERIES[name](spark, sf))
