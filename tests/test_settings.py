from barlake.__main__ import arguments, run
from barlake.plans import jobs
from barlake.schemas import GOLD_TABLES
from barlake.session import object_store_conf
from barlake.settings import Settings
from tests.test_jobs import append_bronze, bronze_rows


def test_object_store_is_addressed_by_path():
    assert object_store_conf("http://h:9000", "u", "p") == {
        "spark.hadoop.fs.s3a.endpoint": "http://h:9000",
        "spark.hadoop.fs.s3a.access.key": "u",
        "spark.hadoop.fs.s3a.secret.key": "p",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": "false",
    }
    assert "spark.hadoop.fs.s3a.access.key" not in object_store_conf("https://h", tls=True)


def test_environment_decides():
    plain = Settings({})
    assert (plain.servers, plain.topic) == ("localhost:9092", "stock-prices")
    assert plain.warehouse().url == "jdbc:postgresql://localhost:5432/stock_warehouse"
    assert plain.spark_conf() == {}
    own = Settings({"WAREHOUSE_HOST": "db", "MINIO_ENDPOINT": "https://store", "KAFKA_TOPIC": "bars"})
    assert own.warehouse().url == "jdbc:postgresql://db:5432/stock_warehouse"
    assert own.spark_conf()["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert own.topic == "bars"


def test_command_line():
    args = arguments(["batch", "--dates", "2026-01-01", "2026-01-02", "--run-date", "2026-01-03"])
    assert (args.job, args.dates, args.run_date) == ("batch", ["2026-01-01", "2026-01-02"], "2026-01-03")
    assert (args.bronze, args.gold) == ("s3a://bronze/stock-prices", "s3a://gold")
    assert arguments(["gold"]).dates is None


def test_jobs_run_from_the_command_line(spark, tmp_path, capsys):
    layers = jobs.Layers(f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/gold")
    append_bronze(spark, layers, bronze_rows(40))
    paths = ["--bronze", layers.bronze, "--silver", layers.silver, "--gold", layers.gold]
    for job in ("silver", "gold"):
        run(spark, Settings({}), arguments([job, *paths, "--run-date", "2026-01-01"]))
    assert jobs.read_star(spark, layers).ticker.count() == 4
    shown = capsys.readouterr().out
    assert "'bronze': 40" in shown and "effective_from" in shown
    assert [f"{layers.gold}/{name}" for name in GOLD_TABLES] == [layers.dim_date, layers.dim_ticker, layers.fact]
