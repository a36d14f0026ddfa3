"""Profiles kept by a stream equal those of a batch; late rows and restarts are defined."""

import datetime

from pyspark.sql import functions as F
from table_rows import rows
from tastegrid.streaming import profiles

SCHEMA = "ts timestamp, user_id bigint, value double"


def at(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def add(spark, folder, events):
    spark.createDataFrame(events, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, delay, **kwargs):
    stream = profiles.parquet_stream(spark, str(tmp_path / "in"), SCHEMA, **kwargs)
    states = profiles.window_states(stream, "user_id", "value", "ts", "1 day", delay)
    profiles.maintain(states, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    return rows(profiles.current(spark, str(tmp_path / "out"), ["user_id"]))


def batch(events, left_out=()):
    groups = {}
    for when, user, value in events:
        if when is not None and (when, user, value) not in left_out:
            groups.setdefault((datetime.datetime(when.year, when.month, when.day), user), []).append(value)
    out = []
    for (start, user), values in groups.items():
        known = [v for v in values if v is not None]
        out.append((start, user, len(values), len(known), sum(known) / len(known) if known else None))
    return sorted(out, key=repr)


FIRST = [(at(1, h), h % 3, float(h)) for h in range(24)] + [(at(2), None, 1.0), (None, 1, 5.0), (at(2), 4, None)]
SECOND = [(at(2, h), h % 2, h / 2) for h in range(20)] + [(at(1, 23), 7, 2.5), (at(2), 4, 8.0)]


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    folder = str(tmp_path / "in")
    add(spark, folder, FIRST)
    assert run(spark, tmp_path, "10 days") == batch(FIRST)
    add(spark, folder, SECOND)
    add(spark, folder, SECOND[:5])
    assert run(spark, tmp_path, "10 days", files_per_batch=1) == batch(FIRST + SECOND + SECOND[:5])
    assert run(spark, tmp_path, "10 days") == batch(FIRST + SECOND + SECOND[:5])  # nothing new


def test_rows_behind_the_watermark_are_left_out(spark, tmp_path):
    folder = str(tmp_path / "in")
    early = [(at(10, 1), 1, 1.0)]
    add(spark, folder, early)
    assert run(spark, tmp_path, "1 day") == batch(early)
    more = [(at(9, 3), 1, 4.0), (at(8, 3), 1, 2.0), (at(1), 2, 3.0)]  # the 9th ends within the delay, the others do not
    late = rows(profiles.late_rows(spark.createDataFrame(more, SCHEMA), at(10, 1), "ts", "1 day", "1 day"))
    assert late == sorted(more[1:], key=repr)
    add(spark, folder, more)
    assert run(spark, tmp_path, "1 day") == batch(early + more, late)


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    out = str(tmp_path / "out")
    state = spark.createDataFrame([(at(1), 1, 2, 2, 3.0)], "window_start timestamp, user_id bigint, n_events long, n_values long, total double")
    for _ in range(2):
        profiles.replace_partitions(state.withColumn("batch", F.lit(0).cast("bigint")), out, ["batch"])
    assert rows(profiles.current(spark, out, ["user_id"])) == [(at(1), 1, 2, 2, 1.5)]
    assert spark.read.parquet(out).count() == 1
