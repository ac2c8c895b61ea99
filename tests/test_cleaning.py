import csv
import random
from datetime import datetime

import pyarrow as pa
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from clientela.functions.privacy import pseudonymize_customers
from clientela.operators import cleaning
from clientela.sources import quoted, raw
from registry import queries

ORDER_SCHEMA = (
    "ingest_seq long, order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp string, order_approved_at string, "
    "order_delivered_customer_date string, order_estimated_delivery_date string"
)


@pytest.fixture
def orders(spark):
    d = "2018-03-0%d 10:00:00"
    rows = [
        (1, "o1", "c1", "delivered", d % 1, d % 1, d % 4, d % 6),
        (2, "o2", "c2", "canceled", d % 1, d % 1, d % 4, d % 6),
        (3, "o3", "c3", None, d % 1, d % 1, d % 4, d % 6),
        (4, "o4", "c4", "shipped", None, d % 1, None, d % 6),
        (5, "o5", "c5", "invoiced", "not a date", "?", None, None),
        (6, "o1", "later", "shipped", d % 2, d % 2, d % 5, d % 7),
        (7, "o6", "c6", "shipped", d % 3, None, None, d % 9),
    ]
    return spark.createDataFrame(rows, ORDER_SCHEMA).repartition(5)


def test_orders_status_dates_and_first_row(orders):
    got = {r["order_id"]: r for r in cleaning.clean_orders(orders).collect()}
    assert set(got) == {"o1", "o5", "o6"}
    assert got["o1"]["customer_id"] == "c1"
    assert got["o1"]["order_purchase_timestamp"] == datetime(2018, 3, 1, 10)
    # unreadable dates turn null after the null check, so the row stays
    assert got["o5"]["order_purchase_timestamp"] is None
    assert got["o5"]["order_approved_at"] is None


def test_orders_other_statuses_and_absent_columns(orders):
    narrow = orders.drop("order_approved_at", "order_estimated_delivery_date")
    got = cleaning.clean_orders(narrow, ["canceled"]).collect()
    assert [r["order_id"] for r in got] == ["o2"]


def test_empty_orders(spark):
    assert cleaning.clean_orders(spark.createDataFrame([], ORDER_SCHEMA)).count() == 0


def test_customers_trim_upper_last_row(spark):
    rows = [
        (1, "c1", "u1", " são paulo\t", "sp "),
        (2, "c2", "u1", "\nrio ", " rj "),
        (3, None, "u2", "x", "mg"),
        (4, "c4", None, "x", "mg"),
        (5, "c5", "u3", None, None),
    ]
    schema = "ingest_seq long, customer_id string, customer_unique_id string, customer_city string, customer_state string"
    got = {r["customer_unique_id"]: r for r in cleaning.clean_customers(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"u1", "u3"}
    assert (got["u1"]["customer_id"], got["u1"]["customer_city"], got["u1"]["customer_state"]) == ("c2", "rio", "RJ")
    assert got["u3"]["customer_city"] is None


def test_reviews_score_range_and_first_row(spark):
    scores = [5, None, 1, 6, 3, 0, 4]
    rows = [(i, f"r{i % 6}", f"o{i}", s, "2018-01-01", "bad") for i, s in enumerate(scores)]
    schema = (
        "ingest_seq long, review_id string, order_id string, review_score long, "
        "review_creation_date string, review_answer_timestamp string"
    )
    got = cleaning.clean_reviews(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["review_id"], r["review_score"]) for r in got) == [("r0", 5), ("r2", 1), ("r4", 3)]
    assert {r["review_answer_timestamp"] for r in got} == {None}


def test_payments_positive_with_type(spark):
    rows = [("o", "card", 10.0), ("o", "card", 0.0), ("o", "card", -1.0), ("o", None, 5.0), ("o", "card", None)]
    df = spark.createDataFrame(rows, "order_id string, payment_type string, payment_value double")
    assert [r["payment_value"] for r in cleaning.clean_payments(df).collect()] == [10.0]


def test_transactions_keep_every_item(spark, orders):
    items = spark.createDataFrame(
        [("o1", 1, "p1", "s1", 10.0, 1.0), ("o1", 2, "p2", "s1", 20.0, 2.0), ("o2", 1, "p1", "s2", 5.0, 1.0), ("zz", 1, "p9", "s9", 1.0, 0.0)],
        "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double",
    )
    payments = spark.createDataFrame(
        [("o1", "card", 2, 0.1), ("o1", "card", 5, 0.2), ("o2", "card", 1, 6.0)],
        "order_id string, payment_type string, payment_installments long, payment_value double",
    )
    tx = cleaning.build_transactions(cleaning.clean_orders(orders), items, payments)
    assert tx.columns == [
        "order_id", "customer_id", "product_id", "seller_id", "price", "freight_value", "payment_value",
        "payment_installments", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    got = {(r["order_id"], r["product_id"]): r for r in tx.collect()}
    assert len(got) == 4
    assert got["o1", "p2"]["payment_value"] == 0.3
    assert got["o1", "p2"]["payment_installments"] == 5
    # an order dropped by the cleaning still brings its payments, but no customer
    assert (got["o2", "p1"]["customer_id"], got["o2", "p1"]["payment_value"]) == (None, 6.0)
    assert got["zz", "p9"]["payment_value"] is None


def test_transactions_shuffle_each_table_once(spark, tmp_path):
    """Plain joins on the order: three exchanges, none into one task, each table scanned once."""
    items = spark.range(4000).select(F.concat(F.lit("o"), F.col("id") % 900).alias("order_id"), F.col("id").cast("string").alias("product_id"))
    orders = items.select("order_id").distinct().withColumn("customer_id", F.concat(F.lit("c"), "order_id"))
    payments = orders.select("order_id", F.lit(1.5).alias("payment_value"), F.lit(2).alias("payment_installments"))
    stored = {}
    for name, df in {"items": items, "orders": orders.withColumn("ingest_seq", F.lit(1)), "payments": payments}.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = cleaning.keep_one(stored["orders"], "order_id", "ingest_seq")
        tx = cleaning.build_transactions(kept, stored["items"], stored["payments"])
        plan = tx._jdf.queryExecution().sparkPlan().toString(), tx._jdf.queryExecution().executedPlan().toString()
        assert tx.count() == 4000
        assert tx.where((F.col("customer_id") == F.concat(F.lit("c"), "order_id")) & (F.col("payment_value") == 1.5)).count() == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan[1].count("Exchange hashpartitioning") == 3
    assert "SinglePartition" not in plan[1]
    assert plan[0].count("FileScan") == 3


def test_customers_lose_readable_ids(spark):
    df = spark.createDataFrame([("c1", "u1", "rio", "RJ")], "customer_id string, customer_unique_id string, customer_city string, customer_state string")
    got = pseudonymize_customers(df, "salt")
    assert got.columns == ["customer_city", "customer_state", "customer_id_hash", "customer_unique_id_hash"]


def test_csv_keeps_file_order_and_matches_by_header(spark, tmp_path):
    for name, start in (("a.csv", 0), ("b.csv", 500)):
        lines = "\n".join(f"rj,u{i % 7},c{i},extra" for i in range(start, start + 500))
        (tmp_path / name).write_text("customer_state,customer_unique_id,customer_id,other\n" + lines + "\n")
    df = raw.read_csv(spark, str(tmp_path), raw.RAW_SCHEMAS["customers"])
    assert df.columns == ["customer_id", "customer_unique_id", "customer_state", "ingest_seq"]
    last = cleaning.keep_one(df.repartition(7), "customer_unique_id", "ingest_seq", last=True)
    got = {r["customer_unique_id"]: r["customer_id"] for r in last.collect()}
    assert got == {f"u{i % 7}": f"c{i}" for i in range(993, 1000)}


def test_csv_review_text_with_line_breaks(spark, tmp_path):
    text = 'review_id,order_id,review_score,review_comment_message\nr1,o1,5,"two\nlines, ""quoted"""\nr2,o2,4,\n'
    (tmp_path / "reviews.csv").write_text(text)
    got = raw.read_raw_tables(spark, {"order_reviews": str(tmp_path / "reviews.csv")})["order_reviews"].collect()
    assert [r["review_score"] for r in got] == [5, 4]
    assert got[0]["review_comment_message"] == 'two\nlines, "quoted"'
    with pytest.raises(ValueError, match="unknown"):
        raw.read_raw_tables(spark, {"nothing": "x"})


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_files_with_other_headers_fail(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text("order_id,payment_type,payment_sequential\no1,credit_card,1\n")
    (tmp_path / "b.csv").write_text("order_id,payment_sequential,payment_type\no2,2,voucher\n")
    with pytest.raises((Py4JJavaError, ValueError), match="header"):
        raw.read_csv(spark, str(tmp_path), raw.RAW_SCHEMAS["order_payments"], multi_line).collect()


def one_task_read(spark, path):
    """The same files through the reader that takes a whole file in one task."""
    options = {"header": True, "multiLine": True, "escape": '"', "enforceSchema": False}
    return spark.read.options(**options).schema("review_id string, order_id string, message string, review_score bigint").csv(path)


SPLIT_SCHEMA = "review_id string, order_id string, message string, review_score bigint"


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [7, 64, 1000, None])
def test_csv_splits_equal_the_one_task_read(spark, tmp_path, split, end):
    """Quotes, doubled quotes, breaks and long fields at every kind of split border."""
    rng = random.Random(split or 1)
    bits = ["a", "é", ",", '"', '""', end, end + end, " ", "word " * 30, "😀", "'", ""]
    for name, rows in (("a.csv", 40), ("b.csv", 3), ("c.csv", 0)):
        with open(tmp_path / name, "w", newline="") as f:
            out = csv.writer(f, lineterminator=end)
            out.writerow(["review_id", "order_id", "message", "review_score"])
            for i in range(rows):
                message = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
                out.writerow([f"{name}{i}", rng.choice(["o1", 'o"2"']), message, rng.choice(["", 1, 5])])
            f.write(end if rows else "")
    got = raw.read_csv(spark, str(tmp_path), SPLIT_SCHEMA, multi_line=True, split_bytes=split)
    want = one_task_read(spark, str(tmp_path))
    assert got.columns == ["review_id", "order_id", "message", "review_score", "ingest_seq"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got.drop("ingest_seq").collect())) == sorted(map(key, want.collect()))
    order = [r["review_id"] for r in got.orderBy("ingest_seq").collect()]
    assert order == [f"a.csv{i}" for i in range(40)] + [f"b.csv{i}" for i in range(3)]


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    with open(tmp_path / "a.csv", "w", newline="") as f:
        csv.writer(f).writerows([["review_id", "order_id", "message", "review_score"]] + [[i, "o", f"line\n{i}", 1] for i in range(5000)])
    with quoted.split_size(spark, 4096):
        lines = quoted._lines(spark, str(tmp_path / "a.csv"))
        assert lines.select(F.spark_partition_id().alias("p")).distinct().count() > 10
    got = raw.read_csv(spark, str(tmp_path / "a.csv"), SPLIT_SCHEMA, multi_line=True, split_bytes=4096)
    assert got.select("ingest_seq.block").distinct().count() > 10
    assert got.count() == got.select("message").distinct().count() == 5000


def test_quotes_inside_unquoted_fields_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text('review_id,order_id,message,review_score\nr1,o1,"fine ""so""",1\nr2,o2,size 7",2\nr3,o3,"x",3\n')
    with pytest.raises(Exception, match="quote inside an unquoted field"):
        raw.read_csv(spark, str(tmp_path), SPLIT_SCHEMA, multi_line=True).collect()


def test_texts_of_crossing_records_are_not_brought_to_one_window(spark):
    rows = [("f", 0, 0, "open", "a"), ("f", 10, 5, "middle", "b"), ("f", 20, 7, "tail", "c"), ("f", 20, 9, "open", "d"), ("f", 30, 11, "tail", "e"), ("g", 0, 0, "open", "x"), ("g", 30, 9, "tail", "y")]
    pieces = spark.createDataFrame(rows, quoted.PIECES)
    joined = quoted._joined(pieces)
    got = {tuple(r) for r in joined.select("file", "block", "row", "text").collect()}
    assert got == {("f", 0, 0, "a\nb\nc"), ("f", 20, 9, "d\ne"), ("g", 0, 0, "x\ny")}
    plan = joined._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [plan[i + 1] for i, line in enumerate(plan) if "Window [" in line]
    assert below and all("Aggregate [" in line for line in below)


def test_split_reviews_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    texts = [(i, f'word {i}, "quoted"\n' * (i % 50), "en", "web", i) for i in range(300)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(texts, schema).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    folder = str(tmp_path / "csv")
    monkeypatch.setattr(queries, "new_folder", lambda *_: folder)
    got = queries.QUERIES["s1_split_reviews"](spark, str(tmp_path))
    assert len(list((tmp_path / "csv").glob("*.csv"))) > 1
    wanted = {(str(i), f'"{t}",\n""\nend') for i, t, *_ in texts}
    assert {(str(r[0]), r[1]) for r in got.select("review_id", "review_comment_message").collect()} == wanted


def test_small_splits_share_tasks(spark, tmp_path, monkeypatch):
    """Splits stay as small as asked for, but there are no more tasks than the session's own split size needs."""
    with open(tmp_path / "a.csv", "w", newline="") as f:
        csv.writer(f).writerows([["review_id", "order_id", "message", "review_score"]] + [[i, "o", f"line\n{i}", 1] for i in range(5000)])
    stored, materialise = {}, quoted.materialise
    monkeypatch.setattr(quoted, "materialise", lambda df, name: stored.setdefault(name, materialise(df, name)))
    got = raw.read_csv(spark, str(tmp_path / "a.csv"), SPLIT_SCHEMA, multi_line=True, split_bytes=2048)
    assert got.select("message").distinct().count() == 5000
    blocks = stored["csv-pieces"].select("block").distinct().count()
    assert len(stored["csv-pieces"].inputFiles()) <= spark.sparkContext.defaultParallelism < blocks


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_records_are_cut_alike_in_any_batches(size):
    """Line by line, as the docstring says, against batches whose ends fall anywhere."""
    rng = random.Random(size)
    lines, row = [], 0
    for file in "fg":
        odd = False
        for block in range(0, 60, 10):
            inside = odd
            for _ in range(rng.choice([1, 2, 5, 12])):
                value = rng.choice(["", "\r", "a", "é,b", 'x"', '"', '""', '"q"'])
                odd ^= value.count('"') % 2 == 1
                lines.append((file, block, row, value, inside, value.count('"') % 2 == 1))
                row += 1
    want, held, at, quoted_now, crossing = [], [], None, False, False
    for file, block, number, value, inside, odd in [*lines, (None, None, None, "", False, False)]:
        if (file, block) != at:
            if held:
                want.append((*at, held[0][0], "middle" if crossing else "open", "\n".join(v for _, v in held)))
            at, held, quoted_now, crossing = (file, block), [], inside, inside
        held.append((number, value))
        quoted_now ^= odd
        if not quoted_now:
            want.append((file, block, held[0][0], "tail" if crossing else "whole", "\n".join(v for _, v in held)))
            held, crossing = [], False
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("row", pa.int64()), ("value", pa.string()), ("inside", pa.bool_()), ("odd", pa.bool_())])
    batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in lines[i : i + size]], schema) for i in range(0, len(lines), size)]
    got = [tuple(r.values()) for b in quoted._cut(iter(batches)) for r in b.to_pylist()]
    assert [r[:5] for r in got] == want[:-1]
    firsts = {}
    for r in got:
        if r[3] == "whole" and r[4] not in ("", "\r"):
            firsts.setdefault(r[:2], r)
    assert all(r[5] for r in firsts.values())
    assert not any(r[5] for r in got if r[3] != "whole" or r[4] in ("", "\r"))
