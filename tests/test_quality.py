"""Quarantine, expectations, constraints, cleaning steps and sinks on small dirty rows."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.functions.text import EMAIL, parsed_date, repaired_email, strip, title_case
from tidemark.operators import cleaning as C
from tidemark.operators import quality as Q
from tidemark.plans import calls as P
from tidemark.plans import clean_retail as R
from tidemark.plans import shop
from tidemark.schemas import CHANGES
from tidemark.sinks import files as K


def test_valid_and_rejected_changes_make_up_the_input(spark):
    rows = [
        ("1", "A", "x", "30", "2023-01-01", "INSERT", "2024-01-01 00:00:00"),
        (None, "A", "x", "30", "2023-01-01", "INSERT", "2024-01-01 00:00:00"),
        ("x", "A", "x", "30", "2023-01-01", "INSERT", "2024-01-01 00:00:00"),
        ("2", "A", "x", "30", "2023-01-01", None, "2024-01-01 00:00:00"),
        ("3", "A", "x", "30", "2023-01-01", "MERGE", None),
        ("4", "A", "x", "30", "2023-01-01", "UPDATE", None),
        ("5", "A", "x", "old", "later", "DELETE", "soon"),
        ("6", "A", "x", "old", "later", "DELETE", "2024-01-01 00:00:00"),
    ]
    valid, rejects = P.split_changes(spark.createDataFrame(rows, CHANGES))
    assert sorted(r["customer_id"] for r in valid.collect()) == [1, 6]
    assert sorted(r["reject_reason"] for r in rejects.collect()) == [
        "invalid_operation", "invalid_operation", "null_customer_id", "null_update_ts", "uncastable_customer_id",
        "uncastable_update_ts",
    ]
    # a reject keeps the text that was delivered
    assert {r["update_ts"] for r in rejects.collect()} >= {"soon"}


def test_null_breaks_an_expectation(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    rules = {"positive": F.col("v") > 0}
    assert Q.expect_or_drop(df, rules).count() == 1
    seen = Observation("rules")
    assert Q.warn(df, rules, seen).count() == 3
    assert seen.get == {"positive": 2}


def test_constraints(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    df = spark.createDataFrame([(1, 1, 5), (1, 3, -5), (None, None, None)], "id int, p int, q int")
    report = Q.validate(df, [
        Q.Unique("pk", ("id",)), Q.Unique("unique", ("p",), not_null=False), Q.Check("positive", F.col("q") > 0),
        Q.ForeignKey("parent", "p", parent, "id"), Q.not_null("q"),
    ])
    assert {r["constraint"]: r["violations"] for r in report.collect()} == {
        "pk": 2, "unique": 0, "positive": 1, "parent": 1, "q_not_null": 1,
    }
    with pytest.raises(Q.IntegrityError, match="parent: 1"):
        Q.require(report)


def test_text_repair(spark):
    cases = ["o'brien mary-jane", "NEW DELHI", " x2y ", "école", None, ""]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r[0] for r in df.select(title_case(F.col("t"))).collect()]
    assert got == [c.title() if c is not None else None for c in cases]
    mails = [" A@B.CON ", "a@b.com", "a b@c.de", "x", "", None, "a@b.con.de"]
    got = [r[0] for r in spark.createDataFrame([(m,) for m in mails], "m string").select(repaired_email(F.col("m"))).collect()]
    assert got == ["a@b.com", "a@b.com", None, None, None, None, "a@b.con.de"]
    dates = ["2024-01-05", "2024-1-5", "05/01/2024", "13/13/2024", "soon", None]
    got = [str(r[0]) for r in spark.createDataFrame([(d,) for d in dates], "d string").select(parsed_date(F.col("d"))).collect()]
    assert got == ["2024-01-05"] * 3 + ["None"] * 3


def test_first_copy_wins(spark):
    df = spark.createDataFrame([("a", 2, "later"), ("a", 1, "first"), ("b", 3, None)], "k string, s int, v string")
    assert sorted(tuple(r) for r in C.dedup_first(df, ["k"], ["s"]).collect())[0] == ("a", 1, "first")
    last = C.dedup_first(df, ["k"], ["s"], last=True, copies="n").filter("k = 'a'").first()
    assert (last["v"], last["n"]) == ("later", 2)


def test_median_mode_and_group_median(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "y"), (5, "x"), (9, None)], "v int, g string")
    assert sorted(r["v"] for r in C.fill_median(df, "v", to_whole=True).collect()) == [1, 2, 4, 5, 9]
    assert sorted(r["g"] for r in C.fill_mode(df, "g").collect()) == ["x", "x", "x", "y", "y"]
    assert sorted(r["v"] for r in C.fill_group_median(df.na.drop(subset=["g"]), "v", "g").collect()) == [1.0, 2.0, 2.0, 5.0]


def test_price_gaps_use_the_median_before_the_sign_is_mended(spark):
    rows = [("a", "n", "c", "10", "1"), ("b", "n", "c", "-30", "x"), ("d", "n", "c", "", None), ("e", "n", "c", "20", "0")]
    raw = spark.createDataFrame(rows, "product_id string, product_name string, category string, unit_price string, active string")
    got = {r["product_id"]: (r["unit_price"], r["active"]) for r in R.clean_products(raw).collect()}
    assert got == {"a": (10.0, 1), "b": (30.0, 1), "d": (10.0, 1), "e": (20.0, 0)}


def shop_rows(spark):
    customers = spark.createDataFrame([(1,), (2,)], "customer_id int")
    products = spark.createDataFrame([(1, 5), (2, 5)], "product_id int, stock_qty int")
    orders = spark.createDataFrame([(9, 1)], "order_id int, customer_id int")
    return customers, products, orders


@pytest.mark.parametrize("items, stock, problems", [
    ([(9, 1, 2), (9, 1, 3), (9, 2, 1)], [(1, 0), (2, 4)], []),
    ([(9, 1, 6)], [(1, 5), (2, 5)], ["short_stock"]),
    ([(9, 7, 1), (8, 1, 1)], [(1, 5), (2, 5)], ["unknown_order", "unknown_product"]),
    ([(9, 1, 0)], [(1, 5), (2, 5)], ["bad_quantity"]),
])
def test_order_batch_is_all_or_nothing(spark, items, stock, problems):
    customers, products, orders = shop_rows(spark)
    lines = spark.createDataFrame(items, "order_id int, product_id int, quantity int")
    found = shop.batch_problems(customers, products, orders, lines)
    assert sorted(r["problem"] for r in found.collect()) == problems
    after = shop.apply_batch(customers, products, orders, lines)
    assert sorted((r["product_id"], r["stock_qty"]) for r in after.collect()) == stock


def test_single_csv_refuses_what_is_not_small(spark, tmp_path):
    df = spark.range(20)
    with pytest.raises(ValueError):
        K.write_single_csv(df, str(tmp_path / "a"), max_rows=19)
    K.write_single_csv(df, str(tmp_path / "b"), max_rows=20)
    assert len(list((tmp_path / "b").glob("*.csv"))) == 1


def copied(spark, tmp_path):
    rows = spark.range(60).select("id", (F.col("id") % 7).cast("string").alias("s"), F.map_from_arrays(F.array(F.lit("k")), F.array("id")).alias("m"))
    rows.withColumn("s", F.when(F.col("id") % 5 > 0, F.col("s"))).repartition(3).write.parquet(str(tmp_path / "a"))
    return K.copy_dataset(spark, str(tmp_path / "a"), str(tmp_path / "b"), step=2)


def test_copy_compares_source_and_target(spark, tmp_path):
    before, after = copied(spark, tmp_path)
    assert before == after and before.n_rows == 60 and len(before.files) == 3
    assert before.columns == (("id", "bigint"), ("s", "string"), ("m", "map<string,bigint>"))
    assert spark.read.parquet(str(tmp_path / "b")).columns == ["id", "s", "m"]
    spark.range(0).write.parquet(str(tmp_path / "c"))
    with pytest.raises(K.CopyError):
        K.copy_dataset(spark, str(tmp_path / "c"), str(tmp_path / "d"))


@pytest.mark.parametrize("what", ["value", "swapped", "missing", "null"])
def test_a_copy_with_other_content_is_refused(spark, tmp_path, what):
    copied(spark, tmp_path)
    file = sorted((tmp_path / "b").glob("*.parquet"))[0]
    rows = spark.read.parquet(str(file))
    ids = sorted(r.id for r in rows.select("id").collect())
    if what == "missing":
        file.unlink()
    else:
        one, two = F.col("id") == ids[0], F.col("id") == ids[1]
        changed = {
            "value": rows.withColumn("s", F.when(one, "other").otherwise(F.col("s"))),
            # the values of one column change places between two rows
            "swapped": rows.withColumn("id", F.when(one, ids[1]).when(two, ids[0]).otherwise(F.col("id"))),
            "null": rows.withColumn("s", F.when(one, F.when(F.col("s").isNull(), "")).otherwise(F.col("s"))),
        }[what]
        changed.coalesce(1).write.parquet(str(tmp_path / "x"))
        next((tmp_path / "x").glob("*.parquet")).replace(file)
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(K.CopyError, match="lacks" if what == "missing" else "differs"):
        K.verify_copy(spark, str(tmp_path / "a"), str(tmp_path / "b"))


def test_a_resumed_copy_does_not_copy_again(spark, tmp_path):
    copied(spark, tmp_path)
    noted = spark.read.parquet(str(tmp_path / "b-manifest")).collect()
    assert len(noted) == 3
    held = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "b").glob("*.parquet")}
    # the second step had not been noted yet
    for p in (tmp_path / "b-manifest").glob("*.parquet"):
        if spark.read.parquet(str(p)).count() == 1:
            p.unlink()
    K.copy_dataset(spark, str(tmp_path / "a"), str(tmp_path / "b"), step=2)
    now = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "b").glob("*.parquet")}
    assert now.keys() == held.keys() and sum(now[n] != held[n] for n in now) == 1


def test_digests_sum_hashes_exactly_as_whole_numbers(spark, tmp_path, plan_of):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("s"))
    rows.repartition(3).write.parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    found = K.digests(stored, F.col("_metadata.file_path"), F.sha1)
    null = [F.col(c).isNull() for c in ("id", "s")]
    plain = lambda *parts: F.sum(F.xxhash64(*parts).cast("decimal(38,0)"))
    want = stored.groupBy(F.sha1("_metadata.file_path").alias("file")).agg(
        F.count("*"), plain("id", null[0], "s", null[1]), plain("id", null[0]), plain("s", null[1])
    )
    got = [(r["file"], r["n_rows"], r["rows"], r["columns"]["id"], r["columns"]["s"]) for r in found.collect()]
    assert sorted(got) == sorted(map(tuple, want.collect())) and len(got) == 3
    # a row costs hashes and whole sums only: names are digested and DECIMALs added once per file and task
    scan = plan_of(found, "simple").split("Exchange")[-1]
    assert "partial_sum" in scan and "sha1" not in scan and "decimal" not in scan


def test_latest_attributes_win_in_dimensions(spark):
    rows = [(1, 1, "Old", "p", 1), (1, 2, "New", "p", 2)]
    wide = spark.createDataFrame(rows, "customer_id int, order_id int, city string, product_id string, line_number int")
    for c in ("customer_name", "segment", "region", "product_name", "category", "sub_category"):
        wide = wide.withColumn(c, F.lit(c))
    parts = K.split_sales(wide, ["order_id", "line_number"])
    assert [r["city"] for r in parts["customers"].collect()] == ["New"]
    assert parts["orders"].count() == 2


def test_email_pattern_and_strip(spark):
    df = spark.createDataFrame([("\t a b \n",)], "t string")
    assert df.select(strip(F.col("t"))).first()[0] == "a b"
    assert EMAIL.startswith("^")
