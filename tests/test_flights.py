"""Flight presets against direct SQL over the registered views, and the tuning studies."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from brindle.functions.dates import with_date_parts
from brindle.plans import flights as presets
from brindle.plans import studies
from brindle.session import scratch_path
from brindle.sources import readers

COLUMNS = ("FL_DATE date, AIRLINE string, AIRLINE_CODE string, DOT_CODE int, ORIGIN string, ORIGIN_CITY string, "
           "DEST string, ARR_DELAY double, CANCELLED double, DISTANCE double, ") + ", ".join(
               f"{c} double" for c in presets.CAUSES)


@pytest.fixture(scope="module")
def flights(spark):
    random.seed(11)
    codes = {"AA": "Alpha", "BB": "Beta", "CC": "Gamma", "DD": "Delta"}
    airports = ["JFK", "LAX", "SFO", "ORD"]
    data = []
    for _ in range(3000):
        code = random.choice(list(codes))
        cancelled = float(random.random() < 0.1)
        delay = None if cancelled or code == "DD" else float(random.choice([-5, 0, 10, 30, 60, 61, 200, 2000][:7 + (random.random() < 0.02)]))
        origin = random.choice(airports)
        causes = [None if random.random() < 0.5 else float(random.randint(0, 50)) for _ in presets.CAUSES]
        data.append((date(2021, 11, 1) + timedelta(days=random.randrange(500)), codes[code], code,
                     ord(code[0]), origin, f"{origin} city", random.choice(airports), delay, cancelled,
                     float(random.choice([400, 500, 501, 900])), *causes))
    df = with_date_parts(spark.createDataFrame(data, COLUMNS), "FL_DATE").cache()
    readers.register(df, "flights")
    presets.airlines(df), presets.airports(df)
    return df


SQL = {
    "winter_long_delays": """SELECT * FROM flights WHERE month(FL_DATE) IN (1, 2, 12) AND ARR_DELAY >= 60
        AND NOT CANCELLED = 1 AND DISTANCE > 500""",
    "airline_summary": """SELECT AIRLINE_CODE, count(*) total_flights, sum(CANCELLED) cancellations,
        avg(ARR_DELAY) avg_arr_delay, max(ARR_DELAY) max_arr_delay, min(ARR_DELAY) min_arr_delay
        FROM flights GROUP BY AIRLINE_CODE""",
    "delay_by_airline_origin_month": """SELECT AIRLINE_CODE, ORIGIN, MONTH, avg(ARR_DELAY) avg_arr_delay,
        count(ARR_DELAY) n FROM flights GROUP BY ALL HAVING count(ARR_DELAY) > 0""",
    "most_delayed_routes": """SELECT ORIGIN, DEST, avg(ARR_DELAY) avg_delay, count(*) flights FROM flights
        GROUP BY ORIGIN, DEST HAVING count(*) > 100 ORDER BY avg_delay DESC, ORIGIN, DEST LIMIT 20""",
    "cumulative_cancellations": """SELECT DISTINCT AIRLINE_CODE, FL_DATE, sum(CANCELLED) OVER (PARTITION BY
        AIRLINE_CODE, FL_DATE) daily_cancel, sum(CANCELLED) OVER (PARTITION BY AIRLINE_CODE ORDER BY FL_DATE
        RANGE UNBOUNDED PRECEDING) cum_cancel FROM flights""",
    "worse_than_average": """SELECT AIRLINE_CODE, avg(ARR_DELAY) avg_delay FROM flights GROUP BY AIRLINE_CODE
        HAVING avg(ARR_DELAY) > (SELECT avg(ARR_DELAY) FROM flights)""",
    "delay_by_airline_name": """SELECT a.AIRLINE, avg(ARR_DELAY) avg_delay FROM flights f JOIN airlines_dim a
        USING (AIRLINE_CODE) GROUP BY a.AIRLINE""",
    "delay_by_origin_city": """SELECT s.ORIGIN_CITY, avg(ARR_DELAY) avg_delay FROM flights f JOIN airport_stats s
        USING (ORIGIN) GROUP BY s.ORIGIN_CITY""",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_preset_equals_sql(spark, flights, rows, name):
    expected = spark.sql(SQL[name])
    assert rows(presets.QUERIES[name](flights), *expected.columns) == rows(expected)


def test_all_presets_run(flights):
    assert len(presets.QUERIES) == 12
    for build in presets.QUERIES.values():
        build(flights).write.format("noop").mode("overwrite").save()


def test_variants(spark, flights, rows):
    assert presets.delay_by_airline_origin_month(flights, drop_null=False).where("avg_arr_delay is null").count() > 0
    ranked = presets.on_time_ranking(flights, "row_number")
    assert ranked.groupBy("YEAR", "MONTH", "rnk").count().where("count > 1").count() == 0
    assert presets.most_delayed_routes(flights, min_count=10_000).count() == 0
    assert "DD" not in [r[0] for r in presets.delay_by_airline_name(flights, how="left").collect()]
    assert ("Delta", None) in rows(presets.delay_by_airline_name(flights))
    assert presets.delay_by_origin_city(flights, drop_null=True).count() == 4
    samp, pop = presets.delay_outliers(flights).count(), presets.delay_outliers(flights, sd="pop").count()
    assert 0 < samp <= pop
    causes = presets.top_delay_cause(flights)
    best = F.greatest(*presets.CAUSES)
    assert all(r[r["top_cause"]] == r["best"] for r in causes.withColumn("best", best).collect())


def test_studies(spark, flights):
    question = presets.delay_by_airline_origin_month
    path = scratch_path(spark, "csv")
    flights.write.option("header", True).csv(path)
    text = readers.read_csv(spark, path, flights.schema)
    table = studies.partitioned_copy(flights, scratch_path(spark, "year"))
    assert studies.pruned(table).count() == flights.where("YEAR = 2022").count()
    with pytest.raises(ValueError):
        studies.pruned(table, "MONTH = 1")
    assert set(studies.format_study(text, table, question)) == {"csv", "parquet"}
    assert set(studies.cache_study(table, presets.airline_summary)) == {"cold", "warm"}
    before = [spark.conf.get(k, None) for k in studies.SHUFFLE]
    took = studies.shuffle_study(table, question, (2, 4))
    assert set(took) == {2, 4} and [spark.conf.get(k, None) for k in studies.SHUFFLE] == before
    log = studies.log(spark, {("Q", "SQL"): 1.0, ("Q", "DataFrame"): 2.0})
    assert log.count() == 2
    for heading in ("Parsed", "Analyzed", "Optimized", "Physical"):
        assert heading in studies.plans(flights)
