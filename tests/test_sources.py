import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tollhouse.sources.fixtures import SERVICE_A
from tollhouse.plans import report
from tollhouse.sources import files, sinks
from tollhouse.sources.tables import csv_tables, parquet_tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_ids_get_their_zeros_back(spark, tmp_path):
    (tmp_path / "accounts").mkdir()
    (tmp_path / "accounts" / "a.csv").write_text("account_id,payer_account_id,company,internal,email_domain\n7,,Co,external,x\n8,7,,external,y\n")
    got = rows(csv_tables(spark, str(tmp_path)).accounts.select("account_id", "payer_account_id"))
    assert got == [("000000000007", None), ("000000000008", "000000000007")]


def test_region_comes_from_the_file_name(spark, tmp_path):
    for region in ("IAD", "PDX"):
        (tmp_path / f"{region}.csv").write_text(f"domain\n1:{region.lower()}\n")
    assert rows(files.read_by_region(spark, str(tmp_path))) == [("1:iad", "IAD"), ("1:pdx", "PDX")]


def test_account_list_with_bars(spark, tmp_path):
    (tmp_path / "list.csv").write_text("account_id|name\n12|x\n")
    assert rows(files.read_account_list(spark, str(tmp_path / "list.csv"), sep="|")) == [("000000000012", "x")]


def test_configurations_from_a_file_and_from_a_column(spark, tmp_path):
    line = '{"client_id": "5", "domain": "d", "data_node_type": "m3.large", "data_node_count": "3x m3.large"}'
    (tmp_path / "c.json").write_text(line + "\n")
    want = [("5", "d", "m3.large", "3x m3.large")]
    assert rows(files.read_domain_configs(spark, str(tmp_path))) == want
    assert rows(files.parse_domain_configs(spark.createDataFrame([(line,)], "line string"))) == want


def test_price_plans(spark, tmp_path):
    paths = {}
    for plan, price in ((1, "0"), (2, "0.5")):
        paths[plan] = str(tmp_path / f"{plan}.csv")
        (tmp_path / f"{plan}.csv").write_text(f"Usage.Type,Price.Unit\nu,{price}\n")
    assert [(p, u, float(x)) for p, u, x in rows(files.read_price_plan(spark, paths))] == [(1, "u", 0.0), (2, "u", 0.5)]


def test_bars_without_quotes(spark, tmp_path):
    path = tmp_path / "out"
    sinks.write_pipe(spark.createDataFrame([("a", 'x"y,z')], "k string, v string").coalesce(1), str(path))
    text = "".join(p.read_text() for p in path.glob("*.csv"))
    assert text == 'k|v\na|x"y,z\n'


def test_a_week_written_again_replaces_itself_only(spark, tmp_path):
    path = str(tmp_path / "weekly")
    frame = lambda data: spark.createDataFrame(data, "year int, week int, v int")
    sinks.write_weeks(frame([(1996, 1, 1), (1996, 2, 2)]), path)
    sinks.write_weeks(frame([(1996, 2, 3)]), path)
    assert rows(spark.read.parquet(path).select("year", "week", "v")) == [(1996, 1, 1), (1996, 2, 3)]


def test_history_keeps_the_weeks_it_has(spark, tmp_path):
    path = str(tmp_path / "history")
    frame = lambda data: spark.createDataFrame(data, "year int, week int, v int")
    sinks.append_history(frame([(1996, 1, 1)]), path)
    got = sinks.append_history(frame([(1996, 1, 9), (1995, 1, 5)]), path)
    assert rows(got.select("year", "week", "v")) == [(1995, 1, 5), (1996, 1, 1)]


def test_read_through_computes_only_what_is_missing(spark, tmp_path):
    asked = []

    def compute(weeks):
        asked.append(weeks)
        return spark.createDataFrame([(y, w, y + w) for y, w in weeks], "year int, week int, v int")

    path = str(tmp_path / "buffer")
    sinks.read_through(spark, path, [(1996, 1)], compute)
    got = sinks.read_through(spark, path, [(1996, 1), (1996, 2)], compute)
    assert asked == [[(1996, 1)], [(1996, 2)]] and got.count() == 2


def test_one_directory_per_region(spark, tmp_path):
    path = tmp_path / "regions"
    data = [(1996, 6, "IAD", "N", "a"), (1996, 6, "PDX", "Y", "b")]
    sinks.write_by_region(spark.createDataFrame(data, "year int, week int, region string, is_internal_flag string, x string"), str(path))
    week = path / "year=1996" / "week=6"
    assert (week / "region=IAD" / "is_internal_flag=N").is_dir() and (week / "region=PDX" / "is_internal_flag=Y").is_dir()


def test_files_per_week_are_bounded(spark, tmp_path):
    df = spark.range(500).selectExpr("1996 AS year", "6 AS week", "id").repartition(40)
    sinks.write_weeks(df, str(tmp_path / "w"))
    assert len(list((tmp_path / "w").glob("*/*/*.parquet"))) <= sinks.FILES_PER_KEY
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 500


def test_what_is_there(spark, tmp_path, star):
    assert not sinks.exists(spark, str(tmp_path / "none"))
    star.test_accounts.write.parquet(str(tmp_path / "test_accounts"))
    t = parquet_tables(spark, str(tmp_path))
    assert "test_accounts" in t and "payer_map" not in t and "payer_map" in t.replace(payer_map=star.test_accounts)


def test_wide_prices_keep_their_types(spark, tmp_path):
    (tmp_path / "p.csv").write_text("product,client_product_code,usage_type,IAD,PDX\nx,EC2,t,0.1,\n")
    got = files.read_price_csv(spark, str(tmp_path / "p.csv"))
    assert [f.dataType.typeName() for f in got.schema] == ["string"] * 3 + ["decimal"] * 2
    assert [(str(r.IAD), r.PDX) for r in got.collect()] == [("0.1000", None)]


def test_tables_from_parquet(spark, tmp_path, star):
    star.test_accounts.write.parquet(str(tmp_path / "test_accounts"))
    assert rows(parquet_tables(spark, str(tmp_path)).test_accounts) == rows(star.test_accounts)


def test_report_run_writes_every_output(spark, star, tmp_path):
    written = report.report_run(star, [(1996, 6)], SERVICE_A, str(tmp_path))
    assert len(written) == 9
    lists = spark.read.csv(f"{tmp_path}/top_customers", header=True)
    assert "company" in lists.columns and lists.count() > 0
    assert list((tmp_path / "top_by_region").glob("year=1996/week=6/region=*/is_internal_flag=*/*.csv"))
    positions = []
    for file in sorted((tmp_path / "top_customers").glob("year=1996/week=6/*.csv")):
        with file.open() as f:
            positions += [int(r["position"]) for r in csv.DictReader(f)]
    assert positions == list(range(1, len(positions) + 1)) and len(positions) == lists.count()
    n = lists.count()
    report.report_run(star, [(1996, 6)], SERVICE_A, str(tmp_path))  # again: nothing twice
    assert spark.read.csv(f"{tmp_path}/top_customers", header=True).count() == n
    assert spark.read.parquet(f"{tmp_path}/compute_adoption").count() == 1
    metrics = spark.read.parquet(f"{tmp_path}/weekly_metrics")
    assert {(r.year, r.week) for r in metrics.select("year", "week").distinct().collect()} == {(1996, 6)}
    again = report.weekly_metrics_history(star, (1996, 6), SERVICE_A, 1, metrics)
    assert again.count() == metrics.count()  # nothing computed twice


def test_ordered_lists_in_many_files(spark, tmp_path):
    rows = [(1996, w, (i * 37) % 1000, f"a{i}") for w in (5, 6) for i in range(1000)]
    df = spark.createDataFrame(rows, "year int, week int, position int, account_id string").repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_ordered_lists(df, str(tmp_path / "out"), [F.desc("position")])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for w in (5, 6):
        files = sorted((tmp_path / "out").glob(f"year=1996/week={w}/*.csv"))
        got = []
        for file in files:
            with file.open() as f:
                got += [int(r["position"]) for r in csv.DictReader(f)]
        assert len(files) > 1 and got == list(range(999, -1, -1))


def test_in_days_uses_a_range_only_when_it_may(spark):
    from tollhouse.operators.periods import in_days

    d = [dt.date(1996, 1, i) for i in range(1, 6)]
    df = spark.createDataFrame([(x,) for x in d], "day date")
    assert in_days(df, "day", d[:3]).count() == 3
    assert in_days(df, "day", [d[0], d[4]]).count() == 2
    assert in_days(df, "day", []).count() == 0


def test_far_weeks_are_refused(spark, star, tmp_path):
    with pytest.raises(ValueError):
        report.report_run(star, [(1996, 6)], SERVICE_A, str(tmp_path), as_of=dt.date(1999, 1, 1))
