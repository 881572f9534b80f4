from decimal import Decimal

from tollhouse.sources import files, quarantine

PRICES = "usage_type string, price decimal(12,4), sold_on date"


def test_broken_csv_rows_go_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text('usage_type,price,sold_on\nsmall,0.5,1996-01-02\nlarge,,\nodd,1.2.3,1996-01-02\nshort,1\nlong,1,1996-01-02,more\n"a, b",2.25,1996-01-03\n')
    (tmp_path / "in/b.csv").write_text("usage_type,price,sold_on\n\nday,1,not a day\nlast,3,1996-02-01")
    found = quarantine.checked_csv(spark, str(tmp_path / "in"), PRICES)
    got = {r["usage_type"]: r["price"] for r in found.rows.collect()}
    assert got == {"small": Decimal("0.5"), "large": None, "a, b": Decimal("2.25"), "last": Decimal(3)}
    assert found.rows.columns == ["usage_type", "price", "sold_on"]
    bad = {(r["file"].rsplit("/", 1)[1], r["record"].split(",")[0]) for r in found.bad.collect()}
    assert bad == {("a.csv", "odd"), ("a.csv", "short"), ("a.csv", "long"), ("b.csv", "day")}
    assert found.rows.count() == 4 and found.bad.count() == 4  # also when only rows are counted
    counts = quarantine.set_aside(found.bad, str(tmp_path / "bad"))
    assert {r["file"].rsplit("/", 1)[1]: r["records"] for r in counts.collect()} == {"a.csv": 3, "b.csv": 1}


def test_broken_json_lines_go_aside(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"client_id": "1", "n": 2}\n{"client_id": "2", "n": \n{"client_id": "3", "n": "many"}\n{"n": 4}\n\n{"client_id": "5", "other": 1}\n')
    found = quarantine.checked_json(spark, str(path), "client_id string, n int", required=("client_id",))
    assert sorted((r["client_id"], r["n"]) for r in found.rows.collect()) == [("1", 2), ("5", None)]
    assert sorted(r["record"][:16] for r in found.bad.collect()) == ['{"client_id": "2', '{"client_id": "3', '{"n": 4}']


def test_bars_and_no_rows(spark, tmp_path):
    path = tmp_path / "l.txt"
    path.write_text("account_id|n\n7|1\n8|x\n")
    found = quarantine.checked_csv(spark, str(path), "account_id string, n int", sep="|")
    assert [r["account_id"] for r in found.rows.collect()] == ["7"] and found.bad.count() == 1
    path.write_text("account_id|n\n")
    found = quarantine.checked_csv(spark, str(path), "account_id string, n int", sep="|")
    assert found.rows.isEmpty() and found.bad.isEmpty()


def broken(checked):
    return sorted((r["file"].rsplit("/", 1)[1], r["record"]) for r in checked.bad.collect())


def rows(df):
    return sorted(df.collect(), key=str)


def test_price_list(spark, tmp_path):
    path = tmp_path / "prices.csv"
    path.write_text("family,type,unit,IAD,EU.1\nm3,m3.large,h,0.5,\nm3,m3.huge,h,1.0,n/a\nm3,short,h\n,none,h,1,2\n\"m, 4\",m4.large,h,.25,2\n")
    got = files.checked_price_csv(spark, str(path))
    assert [tuple(r) for r in rows(got.rows)] == [("m, 4", "m4.large", "h", Decimal("0.25"), Decimal(2)), ("m3", "m3.large", "h", Decimal("0.5"), None)]
    assert [r for _, r in broken(got)] == [",none,h,1,2", "m3,m3.huge,h,1.0,n/a", "m3,short,h"]
    path.write_text("family,type,unit,IAD,EU.1\nm3,m3.large,h,0.5,\n\"m, 4\",m4.large,h,.25,2\n")
    # without broken rows both readers give the same
    assert rows(files.checked_price_csv(spark, str(path)).rows) == rows(files.read_price_csv(spark, str(path)))


def test_account_lists(spark, tmp_path):
    path = tmp_path / "accounts.txt"
    path.write_text("account_id|why\n7|test\n |blank\n8\n9|a|b\n")
    got = files.checked_account_list(spark, str(path), "|")
    assert [tuple(r) for r in got.rows.collect()] == [("000000000007", "test")]
    assert [r for _, r in broken(got)] == [" |blank", "8", "9|a|b"]


def test_regions(spark, tmp_path):
    (tmp_path / "IAD.csv").write_text("domain\n1/a\n2/b,c\n")
    (tmp_path / "DUB.csv").write_text("domain\n1/a\n")
    got = files.checked_by_region(spark, str(tmp_path))
    assert [tuple(r) for r in rows(got.rows)] == [("1/a", "DUB"), ("1/a", "IAD")] == [tuple(r) for r in rows(files.read_by_region(spark, str(tmp_path)).where("domain = '1/a'"))]
    assert broken(got) == [("IAD.csv", "2/b,c")]
    counts = quarantine.set_aside(got.bad, str(tmp_path / "bad"))
    assert [(r["file"].rsplit("/", 1)[1], r["records"]) for r in counts.collect()] == [("IAD.csv", 1)]


def test_configurations(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"client_id": "1", "domain": "a", "data_node_type": "m3.large", "data_node_count": "2x m3"}\n{"client_id": "2"}\n[oops\n')
    got = files.checked_domain_configs(spark, str(path))
    assert [tuple(r) for r in got.rows.collect()] == [("1", "a", "m3.large", "2x m3")]
    assert [r for _, r in broken(got)] == ['[oops', '{"client_id": "2"}']


def test_price_plans(spark, tmp_path):
    (tmp_path / "p1.csv").write_text("Usage.Type,Price.Unit,note\nsmall,0.1,x\nlarge,1;2,y\n")
    (tmp_path / "p2.csv").write_text("Price.Unit,Usage.Type\n3,small\n,large\n4,\n")
    got = files.checked_price_plan(spark, {1: str(tmp_path / "p1.csv"), 2: str(tmp_path / "p2.csv")})
    assert {tuple(r) for r in got.rows.collect()} == {(1, "small", Decimal("0.1")), (2, "small", Decimal(3)), (2, "large", None)}
    assert broken(got) == [("p1.csv", "large,1;2,y"), ("p2.csv", "4,")]
