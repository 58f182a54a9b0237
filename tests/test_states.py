"""Stored states against results from the stops."""

import datetime
import glob
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from spoorlens.operators import rollup, states

DAY = datetime.date(2023, 12, 30)


def stops(spark, seed, n=800):
    rng = random.Random(seed)
    given = []
    for _ in range(n):
        day = DAY + datetime.timedelta(days=rng.randrange(5))
        flag = lambda: rng.choice([True, False, False, None])
        given.append((day, rng.randrange(4), rng.choice([None, *range(40), 70_000, 10**12]), flag(), flag(), rng.choice([0.0, -1.0, 2.0, 11.5])))
    return spark.createDataFrame(given, "day date, hour int, service long, cancelled boolean, part_cancelled boolean, delay double")


def rounded(df, *columns):
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(df, *columns)]


def test_states_give_the_report(spark):
    per_service = rollup.service_hours(stops(spark, 1))
    whole = per_service.groupBy(F.year("day").alias("year")).agg(*rollup.delay_counts()).withColumns(dict(zip(rollup.SHARES, rollup.delay_shares())))
    columns = ["year", "services_in_hour", *rollup.SHARES.values(), *rollup.SHARES, "avg_avg_delay_all_services", "avg_avg_delay_delays_only"]
    got = states.merged(states.hour_states(per_service), [F.year("day").alias("year")])
    assert rounded(got, *columns) == rounded(whole, *columns)
    assert states.merged(states.hour_states(per_service).limit(0), ["day"]).count() == 0


def test_refreshed_days_replace_stored_ones(spark, folder):
    old, new = stops(spark, 2), stops(spark, 3).filter(F.col("day") != DAY)
    make = lambda s: states.hour_states(rollup.service_hours(s))
    states.write_states(make(old), folder)
    changed = [DAY, DAY + datetime.timedelta(days=2)]
    states.refresh_days(make(new), folder, spark.createDataFrame([(d,) for d in changed], "day date"))
    want = make(old.filter(~F.col("day").isin(*changed)).unionByName(new.filter(F.col("day").isin(*changed))))
    kept = spark.read.parquet(folder).withColumn("day", F.col("day").cast("date"))
    columns = ["day", "hour", "services_in_hour", "late_mean_n"]
    assert rows(kept, *columns) == rows(want, *columns)
    assert not glob.glob(f"{folder}/day={DAY}")


def test_sets_of_services_are_exact(spark):
    s = stops(spark, 4)
    year = F.year("day").alias("year")
    want = rows(s.groupBy(year).agg(F.countDistinct("service")))
    assert rows(states.different_services(states.service_sets(s), [year])) == want
    named = s.withColumn("service", F.concat(F.lit("train "), F.col("service").cast("string")))
    with pytest.raises(ValueError, match="numbers"):
        states.service_sets(named)
    numbers = states.numbered(named, "service")
    assert rows(states.different_services(states.service_sets(named, numbers), [year])) == want
    found = sorted(r["number"] for r in numbers.collect())
    assert found == list(range(len(found)))
