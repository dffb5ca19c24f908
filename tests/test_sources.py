import datetime
import glob
import json

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import churn, nested
from tidemark.sources import models, readers, sinks


def test_csv_keeps_korean_text_and_reads_blank_as_null(spark, tmp_path):
    df = spark.createDataFrame([("가", 1, None), ("나,다", 2, 3.5)], "`이름` STRING, n INT, x DOUBLE")
    path = str(tmp_path / "csv")
    sinks.write_csv(df, path, one_file=True)
    files = glob.glob(path + "/*.csv")
    assert len(files) == 1 and open(files[0], "rb").read(3) == b"\xef\xbb\xbf"
    back = readers.read_csv(spark, path, "`이름` STRING, n INT, x DOUBLE")
    assert sorted(rows(back)) == sorted(rows(df))


def test_raw_csv_is_all_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,quantity\nx,12\ny,\n")
    got = rows(readers.read_raw_csv(spark, str(tmp_path / "a.csv"), ["order_id", "quantity"]))
    assert got == [("x", "12"), ("y", None)]


def test_web_log_csv(spark, tmp_path):
    (tmp_path / "log.csv").write_text(
        "ip,timestamp,method,path,status,bytes,user_agent\n1.2.3.4,2025-03-01T00:00:05,GET,/,500,120,curl\n")
    got = rows(readers.read_csv(spark, str(tmp_path / "log.csv"), readers.WEB_LOGS))
    assert got == [("1.2.3.4", datetime.datetime(2025, 3, 1, 0, 0, 5), "GET", "/", 500, 120, "curl")]


def test_api_envelope(spark, tmp_path):
    users = [
        {"id": 501, "username": "mira", "email": "mira@post.test", "age": 63, "is_active": True,
         "signup_date": "2019-11-30", "profile": {"country": "IS", "tier": "gold", "score": 17.25}, "tags": []},
        {"id": 502, "username": "oto", "age": 21, "is_active": False, "signup_date": "2020-02-29",
         "profile": {"country": "PE", "tier": "trial", "score": 4.5}, "tags": ["chess", "rowing"]},
    ]
    envelope = {"status": "ok", "count": 2, "results": users}
    (tmp_path / "api.json").write_text(json.dumps(envelope, indent=2))
    got = rows(readers.read_api(spark, str(tmp_path / "api.json")).orderBy("id"),
               "id", "email", "signup_date", "profile.score", F.size("tags"))
    assert got == [(501, "mira@post.test", datetime.date(2019, 11, 30), 17.25, 0),
                   (502, None, datetime.date(2020, 2, 29), 4.5, 2)]


def test_feeds_keep_their_source(spark):
    shelf = spark.createDataFrame([("p1", 3)], "product_id STRING, stock INT")
    store = spark.createDataFrame([("p2", "cold")], "product_id STRING, place STRING")
    got = readers.union_sources({"매대": shelf, "창고": store}).orderBy("product_id")
    assert rows(got, "product_id", "stock", "place", "source") == [
        ("p1", 3, None, "매대"), ("p2", None, "cold", "창고")]


def test_flatten(spark):
    df = spark.createDataFrame(
        [(41, "kettle", "kitchen", 23.5, 12, ["steel", "1.5l"], (9, "NO")), (42, "rope", "camping", 7.25, 3, [], (8, "CL"))],
        "id INT, name STRING, category STRING, price DOUBLE, quantity INT, tags ARRAY<STRING>, "
        "seller STRUCT<id: INT, region: STRING>")
    got = rows(nested.flatten_products(df))
    assert got == [(41, "kettle", "kitchen", 23.5, 12, "steel|1.5l", 9, "NO"), (42, "rope", "camping", 7.25, 3, "", 8, "CL")]


def test_saved_model_scores_like_the_fitted_one(spark, tmp_path):
    n = F.col("id")
    customers = spark.range(400).select(
        F.format_string("CUST-%05d", n).alias("customer_id"),
        F.when(n % 2 == 0, "Male").otherwise("Female").alias("gender"), (n % 4 == 0).cast("int").alias("senior"),
        (n % 73).cast("int").alias("tenure_months"), (18 + n % 100).cast("double").alias("monthly_charges"),
        F.when(n % 50 != 0, n * 3.0).alias("total_charges"),
        F.when(n % 3 == 0, "Month-to-month").otherwise("Two year").alias("contract"),
        F.lit("Mailed check").alias("payment_method"), (n % 8 + 1).cast("int").alias("num_services"),
        ((n % 3 == 0) & (n % 73 < 50)).cast("int").alias("churn"))
    train, test = churn.hold_out(customers, "customer_id")
    assert train.count() + test.count() == 400 and 40 < test.count() < 120
    model = churn.fit_churn(train, trees=20)
    models.save_model(model, str(tmp_path / "model"))
    loaded = models.load_model(str(tmp_path / "model"))
    a, b = churn.score(model, test).orderBy("customer_id"), churn.score(loaded, test).orderBy("customer_id")
    assert rows(a) == rows(b)
    assert churn.evaluate(loaded, test).first()["auc"] > 0.9
    picked = churn.take_sample(customers, "customer_id", 20)
    assert picked.count() == 20
    assert rows(picked, "customer_id") == rows(churn.take_sample(customers.repartition(7), "customer_id", 20), "customer_id")
