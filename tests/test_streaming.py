from collections import Counter

from agrolith.streaming import journal


def test_folder_or_file(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    one = journal.run_once(journal.windowed_totals(journal.event_stream(spark, data)), "one_file").collect()
    many = journal.run_once(journal.windowed_totals(journal.event_stream(spark, str(tmp_path))), "many_files").collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, many)) and one


def test_balances_over_several_batches(spark, tmp_path):
    rows = [[(1, 7, "signup"), (2, 7, "signup"), (3, 8, "purchase")], [(4, 7, "purchase"), (5, 8, "signup"), (6, 9, "view")]]
    folder = tmp_path / "events.parquet"
    for i, part in enumerate(rows):
        df = spark.createDataFrame([(e, u, k) for e, u, k in part], "event_id bigint, user_id bigint, event_type string")
        df.selectExpr("event_id", "timestamp_ntz '2024-01-01 00:00:00' as ts", "user_id", "event_type", "1.0D as value", "'{}' as props").coalesce(1).write.mode("append").parquet(str(folder))
    out = journal.run_once(journal.open_reservations(journal.event_stream(spark, str(tmp_path))), "balances", "update")
    last = {}
    for r in out.orderBy("batch").collect():
        last[r["user_id"]] = (r["opened"], r["settled"], r["open"])
    assert last == {7: (2, 1, 1), 8: (1, 1, 0)}


def test_states_whatever_the_order_of_arrival(spark, tmp_path):
    rows = [
        (1, 5, "purchase", 3), (2, 5, "signup", 1), (3, 6, "signup", 4), (4, 6, "error", 2), (5, 7, "signup", 1), (6, 8, "error", 9), (7, 9, "signup", 1), (8, 9, "purchase", 2), (9, 9, "error", 3), (10, 4, "signup", 1), (11, 4, "error", 2), (12, 3, "signup", 1), (13, 3, "signup", 2), (14, 2, "view", 1),
    ]
    df = spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, day int").selectExpr("event_id", "timestampadd(DAY, day, timestamp_ntz '2024-01-01 00:00:00') as ts", "user_id", "event_type", "1.0D as value", "'{}' as props")
    want = {5: "settled", 6: "resolved early", 7: "open", 8: "never reserved", 9: "resolved twice", 4: "released", 3: "reserved twice"}
    assert {r["user_id"]: r["state"] for r in journal.reservation_states(df, ["user_id"]).collect()} == want
    for part in ("event_id > 7", "event_id <= 7 and event_id > 2", "event_id <= 2"):
        df.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    stream = journal.reservation_states(journal.event_stream(spark, str(tmp_path)), ["user_id"])
    assert {r["user_id"]: r["state"] for r in journal.run_once(stream, "states").collect()} == want


def test_no_machine_local_checkpoints_on_a_cluster():
    import pytest

    from agrolith.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError, match="checkpoint"):
        ensure_checkpoint_dir(Session)
