"""Files in and out, the run log, and the whole way from a raw file to the star."""

import pytest
from pyspark.sql import functions as F

from freightlens.functions.features import PROFIT
from freightlens.plans.staging import batch_tag, latest_batch
from freightlens.plans.views import register_views
from freightlens.plans.warehouse import Warehouse
from freightlens.schemas import READY_HEADERS
from freightlens.sources import csv, sinks

ENCODED = 'name,city\n"José, ""J""",München\n'


def test_latin_and_utf8_files(spark, tmp_path):
    latin, utf8 = tmp_path / "latin.csv", tmp_path / "utf8.csv"
    latin.write_bytes(ENCODED.encode("latin-1"))
    utf8.write_bytes(ENCODED.encode("utf-8"))
    want = ('José, "J"', "München")
    assert tuple(csv.read_raw_csv(spark, str(latin)).first()) == want
    assert tuple(csv.read_derived_csv(spark, [str(tmp_path / "none.csv"), str(utf8)]).first()) == want
    assert tuple(csv.read_derived_csv(spark, [str(latin)]).first()) == want  # falls back as it is not valid UTF-8
    with pytest.raises(FileNotFoundError):
        csv.first_existing(spark, [str(tmp_path / "none.csv")])


def test_cp1252_file(spark, tmp_path):
    path = tmp_path / "cp1252.csv"
    path.write_bytes('name,price €\n"„José“ – ‚J‘",5 €\nŒuvre™,é\n'.encode("cp1252"))
    got = csv.read_raw_csv(spark, str(path), ("utf-8", "cp1252"))
    assert got.columns == ["name", "price €"]
    assert {tuple(r) for r in got.collect()} == {("„José“ – ‚J‘", "5 €"), ("Œuvre™", "é")}
    assert csv.read_raw_csv(spark, str(path)).first()[1] == "5 \x80"  # latin-1 comes first and decodes anything
    utf8 = tmp_path / "utf8.csv"
    utf8.write_text("name\n€\n")
    assert csv.read_raw_csv(spark, str(utf8), ("utf-8", "cp1252")).first()[0] == "€"


def test_records_over_several_lines(spark, ws, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text('a,b\n1,"two\nlines"\n2,x\n')
    assert csv.inspect(spark, str(path)) == (True, True)
    assert csv.read_raw_csv(spark, str(path)).count() == sinks.count_exported(ws, str(path)) == 2


def ready_line(**values):
    return ",".join(values.get(h, "") for h in READY_HEADERS)


def test_ready_file_with_defects(spark, ws, at, tmp_path):
    base = {"order_item_id": "1", "days_for_shipping": "3", "days_for_shipment": "4.0", "sales": " 10.5 ", "order_date": "1/31/2018 22:56",
            "is_late_delivery": "0", "order_zipcode": "1234", "customer_zipcode": "00725"}
    lines = [
        ready_line(**base),
        ready_line(**{**base, "order_item_id": "2", "days_for_shipping": "", "sales": "n/a", "customer_first_order_date": "2018-01-31"}),
        ready_line(**{**base, "order_item_id": "3"}) + ",one,too,many",
    ]
    lines[0] = lines[0][: lines[0].rindex(",") + 1] + "Healthy\r"
    path = tmp_path / "ready.csv"
    path.write_text("\n".join([",".join(READY_HEADERS), *lines]) + "\n", newline="")
    rejects = {(r.order_item_id, r.column) for r in csv.rejected_cells(csv.read_ready_csv(spark, str(path))).collect()}
    assert rejects == {("2", "sales"), ("2", "customer_first_order_date"), ("3", "_malformed")}
    rows = {r.order_item_id: r for r in csv.load_staging(ws, str(path), at, "ready.csv").collect()}
    one, two = rows[1], rows[2]
    assert (one.shipping_delay_days, one.delivery_performance, one.is_on_time_delivery, one.is_late_delivery) == (-1, "Early", 1, 0)
    assert str(one.order_date) == "2018-01-31 22:56:00" and str(one.sales) == "10.5000" and one.customer_zipcode == "00725"
    assert one.operational_risk_segment == "Healthy" and one.load_batch_id == "DATACO_20240101_000000_000000"
    assert (two.sales, two.shipping_delay_days, two.delivery_performance, two.shipping_speed_segment) == (None, None, "Unknown", "Unknown")
    assert sorted(r.staging_row_id for r in rows.values()) == [1, 2, 3]


def test_read_back_detects_truncation(spark, ws):
    path = sinks.export(spark.createDataFrame([(1.23456, 'a "b"\nc'), (2.0, None)], "x double, y string"), ws.path(ws.fresh("out")))
    assert tuple(sinks.read_back(ws, path, 2).first()) == (2, 2, True)
    sinks.require_complete(ws, path, 2)
    with pytest.raises(ValueError):
        sinks.require_complete(ws, path, 3)
    assert {(r.x, r.y) for r in csv.read_raw_csv(spark, path).collect()} == {("1.2346", 'a "b"\nc'), ("2.0", None)}


def test_run_log_keeps_the_latest_state(spark, ws, at):
    log = sinks.RunLog(ws.spark, ws.path(ws.fresh("log")))
    done, open_run = log.start("a", "f", at), log.start("b", "f", at)
    log.finish(done, "WARNING", 5, 4, 1, at, "one lost")
    got = {r.process_name: r for r in log.runs().collect()}
    assert (got["a"].process_status, got["a"].rows_rejected, got["a"].error_message) == ("WARNING", 1, "one lost")
    assert (got["b"].process_status, got["b"].completed_at) == ("STARTED", None)
    with pytest.raises(ValueError):
        log.finish(open_run, "DONE", 0, 0, 0, at)


def test_latest_batch(warehouse, at):
    older = warehouse.stored.limit(5).withColumns({"load_batch_id": F.lit("old"), "loaded_at": F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")})
    got = latest_batch(warehouse.stored.unionByName(older)).select("load_batch_id").distinct().collect()
    assert [r[0] for r in got] == [batch_tag(at)]


def test_from_raw_file_to_star(spark, warehouse, ws):
    """The raw text, through a file, ends in the same fact as the typed items."""
    path = sinks.write_csv(warehouse.raw_text, ws.path(ws.fresh("raw")))
    own = Warehouse(spark, raw=csv.read_raw_csv(spark, path), loaded_at=warehouse.loaded_at)
    columns = [c for c in warehouse.fact.columns if c != "staging_row_id"]
    left, right = own.fact.select(*columns), warehouse.fact.select(*columns)
    assert left.count() == right.count() and left.exceptAll(right).count() == 0


def test_views_answer_sql(spark, warehouse):
    register_views(warehouse)
    row = spark.sql(
        f"""select v.total_sales, round(sum(f.sales), 2) s, count(*) n, round(sum(f.{PROFIT}), 2) p
            from vw_executive_overview v join fact_order_item f join dim_product d on d.product_key = f.product_key group by 1"""
    ).first()
    assert row.total_sales == row.s and row.n == warehouse.expected
    assert spark.sql("select count(*) from vw_tableau_order_item_detail").first()[0] == warehouse.expected


def test_csv_text_comes_back_unchanged(spark, tmp_path):
    from freightlens.sources.sinks import write_csv

    rows = [(1, "  a "), (2, " "), (3, ""), (4, None), (5, 'q"x,\ny')]
    path = write_csv(spark.createDataFrame(rows, "id int, t string"), str(tmp_path / "out"))
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    assert {int(r.id): r.t for r in reader.csv(path).collect()} == {**dict(rows), 3: None}
    lines = {r.value for r in spark.read.text(path).collect()}
    assert '3,""' in lines and "4," in lines  # a reader that tells quotes from none can tell empty from NULL


def test_large_exports_are_compressed_in_files_of_bounded_rows(spark, ws, monkeypatch):
    import gzip
    from pathlib import Path

    monkeypatch.setattr(sinks, "FILE_ROWS", 3)
    rows = [(i, 'a "b",\nc' if i % 2 else " x ") for i in range(10)]
    path = sinks.write_csv(spark.createDataFrame(rows, "k int, v string").coalesce(1), ws.path(ws.fresh("gz")))
    files = [p for p in Path(path.removeprefix("file:")).iterdir() if p.name.startswith("part-")]
    assert len(files) == 4 and all(gzip.decompress(p.read_bytes()) for p in files)
    assert sorted((int(r.k), r.v) for r in csv.read_text_csv(spark, path, ("utf-8",)).collect()) == rows
    assert sinks.count_exported(ws, path) == 10
