"""Files, tables, connectors."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe import session as sessions
from tallyframe.operators import active_days, bucket_join, cumulate_dates
from tallyframe.sources import (
    JdbcTarget,
    KafkaSource,
    append_snapshot,
    bucket_count,
    decode_events,
    jdbc_sink,
    materialise,
    read_csv,
    read_snapshot,
    rejected_events,
    text_schema,
    total_bytes,
    upsert_partition,
    write_bucketed,
    write_state,
    write_table,
)


class Cluster:
    """A session on a cluster, as far as its settings go."""

    def __init__(self, conf):
        self.conf = conf
        self.sparkContext = self
        self.master = "yarn"

    def getCheckpointDir(self):
        return None


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_is_all_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,flag\n1,true\n,x\n")
    df = read_csv(spark, str(tmp_path))
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert read_csv(spark, str(tmp_path), text_schema("id", "flag")).count() == 2


def test_snapshots_are_replaced_not_doubled(spark, tmp_path):
    path = str(tmp_path / "t")
    for day, value in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)):
        df = spark.createDataFrame([(value, dt.date.fromisoformat(day))], "v int, day date")
        append_snapshot(df, path, "day")
    assert rows(spark.read.parquet(path).select("v")) == [(1,), (3,)]
    one = read_snapshot(spark, path, "day", dt.date(2024, 1, 2))
    assert rows(one.select("v")) == [(3,)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_upsert_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_partition(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, "p")
    stored = spark.read.parquet(path).where("p = 'a'")
    upsert_partition(stored.select((F.col("v") + 10).alias("v"), "p"), path, "p")
    assert rows(spark.read.parquet(path)) == [(2, "b"), (11, "a")]


def test_write_table_appends_and_overwrites(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "v int")
    for mode, n in (("append", 1), ("append", 2), ("overwrite", 1)):
        write_table(df, "plain_table", mode, str(tmp_path / "plain"))
        assert spark.table("plain_table").count() == n
    spark.sql("DROP TABLE plain_table")


def test_bucketed_state_shuffles_only_the_day(spark, tmp_path):
    day1, day2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    n = 16
    start = spark.range(1000).select(
        F.col("id").alias("u"), F.array(F.lit(day1)).alias("dates"), F.lit(day1).alias("day")
    )
    write_state(start, "state_t", ("day", day1), ["u"], n, str(tmp_path / "s"))
    events = spark.createDataFrame([(5, dt.datetime(2024, 1, 2, 8))], "u long, ts timestamp_ntz")
    prev = spark.table("state_t").where(F.col("day") == F.lit(day1))
    step = cumulate_dates(prev, active_days(events, ["u"], "ts", day2), ["u"], "dates", "day")
    plan = step._jdf.queryExecution().executedPlan().toString()
    state_side = plan.split("SortMergeJoin")[1].split("\n      +-")[0]
    assert "Bucketed: true" in state_side and "Exchange" not in state_side
    write_state(step, "state_t", ("day", day2), ["u"], n)
    now = spark.table("state_t").where(F.col("day") == F.lit(day2))
    assert now.count() == 1000
    assert now.where("u = 5").first().dates == [day1, day2]
    write_state(step, "state_t", ("day", day2), ["u"], n)
    assert spark.table("state_t").count() == 2000
    spark.sql("DROP TABLE state_t")


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


@pytest.fixture
def games(spark, tmp_path):
    """Details, matches and medals; one match has two thirds of the players."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    match = F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id"))
    details = spark.range(3000).select(match.alias("m"), F.col("id").alias("p"), F.lit(1).alias("kills"))
    medals = details.select("m", "p", F.lit("x").alias("medal"))
    matches = details.select("m").distinct()

    def stored(keys):
        return [
            write_bucketed(df, f"games_{k}", 16, [c for c in keys if c in df.columns], str(tmp_path / f"{k}"))
            for k, df in enumerate((details, matches, medals))
        ]

    yield stored
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for k in range(3):
        spark.sql(f"DROP TABLE IF EXISTS games_{k}")


def test_details_and_medals_meet_without_an_exchange(spark, games):
    details, matches, medals = games(["m", "p"])
    joined = bucket_join(details, matches, medals, "m", "p")
    inner = details.hint("merge").join(medals, ["m", "p"])
    assert exchanges(inner) == 0 and exchanges(joined) == 1
    assert joined.count() == 3000
    tasks = inner.where("m = 0").select(F.spark_partition_id()).distinct().count()
    assert tasks > 4


def test_three_tables_bucketed_by_match_need_no_exchange(spark, games):
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(name, "false")
    try:
        joined = bucket_join(*games(["m"]), "m", "p")
        assert exchanges(joined) == 0 and joined.count() == 3000
    finally:
        spark.conf.unset(name)


def test_bucket_count_has_no_cap():
    assert bucket_count(0) == 1 and bucket_count((256 << 20) + 1) == 2
    assert bucket_count(100 << 40) == 409600


def test_materialise_cuts_the_plan(spark):
    out = materialise(spark.range(3).withColumn("x", F.lit(1)), "cut")
    assert "FileScan" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 3


def test_shared_dir_of_the_session_wins(spark):
    assert sessions.shared_dir(spark) == sessions.shared_dir(spark)
    assert sessions.shared_dir(Cluster({sessions.CHECKPOINT_CONF: "hdfs:///state/"})) == (
        "hdfs:///state"
    )


def test_a_cluster_without_shared_dir_is_an_error():
    with pytest.raises(ValueError, match="shared"):
        sessions.shared_dir(Cluster({}))


def test_kafka_options():
    env = {"BROKERS": "broker:9092", "TOPIC": "web", "READERS": "g", "KEY": "k", "SECRET": "s"}
    names = {"servers": "BROKERS", "topic": "TOPIC", "group": "READERS", "key": "KEY", "secret": "SECRET"}
    options = KafkaSource.from_settings(env, names, {"maxOffsetsPerTrigger": "1000"}).options()
    assert options["maxOffsetsPerTrigger"] == "1000"
    assert options["kafka.bootstrap.servers"] == "broker:9092"
    assert options["startingOffsets"] == "earliest"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="k" password="s";' in options["kafka.sasl.jaas.config"]


def test_decode_events(spark):
    good = '{"ip": "1", "event_time": "2024-05-01T10:00:00.250Z", "host": "h", "extra": 1}'
    df = spark.createDataFrame([(good,), ("no json",), (None,)], "value string")
    out = decode_events(df).collect()
    assert out[0].window_timestamp == dt.datetime(2024, 5, 1, 10, 0, 0, 250_000)
    assert out[0].url is None
    assert [r.window_timestamp for r in out[1:]] == [None, None]
    assert [r.value for r in rejected_events(df).collect()] == ["no json", None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        seconds = decode_events(df).select(F.unix_timestamp("window_timestamp").alias("s")).first().s
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seconds == 1714557600


def test_jdbc_sink_appends_each_batch():
    calls = []

    class Writer:
        def format(self, kind):
            calls.append(kind)
            return self

        def options(self, **options):
            calls.append(options)
            return self

        def mode(self, mode):
            calls.append(mode)
            return self

        def save(self):
            calls.append("saved")

    class Batch:
        write = Writer()

        def withColumn(self, name, value):  # noqa: N802
            calls.append(name)
            return self

    jdbc_sink(JdbcTarget("jdbc:postgresql://db/x", "u", "p", batch_column="batch"))(Batch(), 3)
    assert calls[0] == "batch"
    calls.clear()
    batch = Batch()
    jdbc_sink(JdbcTarget("jdbc:postgresql://db/x", "u", "p"))(batch, 3)
    assert calls[0] == "jdbc" and calls[2:] == ["append", "saved"]
    assert calls[1]["dbtable"] == "processed_events_aggregated"
    assert calls[1]["batchsize"] == "1000"
