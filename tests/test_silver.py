import json

import pytest
from pyspark.sql import functions as F

from tillroll import vocabulary as V
from tillroll.plans import daily, silver
from tillroll.sources import landing, readers

NOW = "2024-01-31 12:00:00"


def order(order_id, **over):
    row = {
        "order_id": order_id, "customer_id": "c1", "order_status": "delivered",
        "order_date": "2024-01-05T10:00:00", "updated_at": "2024-01-06T10:00:00",
        "items": [{"product_sku": "s", "quantity": 2, "unit_price": 5.0, "total_price": 10.0}],
        "total_amount": 10.0, "discount_total": 0.0, "shipping_fee": 0.0, "tax_amount": 0.0,
    }
    return row | over


@pytest.fixture
def orders_dir(tmp_path):
    rows = [
        order("plain"),
        order("two", order_status="pending"),
        order("two", updated_at="2024-01-07T10:00:00", order_status="shipped"),
        order("vanishes"), order("vanishes", updated_at="2024-01-08", order_status="lost"),
        order("negative", total_amount=-1.0),
        order("nobody", customer_id=None),
        order("undated", order_date="soon"),
        order("empty", items=None, order_date="2024-01-06T23:00:00", discount_total=1.5),
        order("tie", order_status="pending"), order("tie", order_status="pending"),
        order(None),
        order("typed", total_amount="many"),
    ]
    lines = [json.dumps(r) for r in rows] + ['{"order_id": "cut', ]
    folder = tmp_path / "bronze" / "orders" / "date=2024-01-31"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("\n".join(lines))
    return tmp_path


def test_orders_from_file_to_silver(spark, orders_dir):
    bronze, out = str(orders_dir / "bronze"), str(orders_dir / "silver")
    counts = daily.build_silver(spark, "orders", bronze, out, NOW, "2024-01-31")
    assert counts == {"rows_in": 14, "rows_out": 4, "bad": 2}
    got = {r.order_id: r for r in spark.read.parquet(f"{out}/orders").collect()}
    assert set(got) == {"plain", "two", "empty", "tie"}
    assert got["two"].order_status == "shipped"
    assert (got["empty"].item_count, got["empty"].is_weekend, got["empty"].has_discount) == (0, True, True)
    assert (got["plain"].order_dayofweek, got["plain"].order_hour) == (6, 10)
    assert str(got["plain"].total_amount) == "10.00"
    letters = spark.read.option("columnNameOfCorruptRecord", "_x").schema(
        "_corrupt_record string").json(f"{out}/_dlq/orders").collect()
    assert len(letters) == 2 and any("many" in r[0] for r in letters)


def test_silver_rewrites_only_the_dates_it_meets(spark, orders_dir):
    bronze, out = str(orders_dir / "bronze"), str(orders_dir / "silver")
    daily.build_silver(spark, "orders", bronze, out, NOW, "2024-01-31")
    later = orders_dir / "bronze" / "orders" / "date=2024-02-01"
    later.mkdir()
    (later / "b.json").write_text(json.dumps(order("new", order_date="2024-02-01T01:00:00")))
    daily.build_silver(spark, "orders", bronze, out, NOW, "2024-02-01")
    assert spark.read.parquet(f"{out}/orders").count() == 5


def test_a_late_update_joins_the_partition_of_its_order(spark, orders_dir):
    bronze, out = str(orders_dir / "bronze"), str(orders_dir / "silver")
    daily.build_silver(spark, "orders", bronze, out, NOW, "2024-01-31")
    later = orders_dir / "bronze" / "orders" / "date=2024-02-01"
    later.mkdir()
    rows = [order("plain", order_status="refunded", updated_at="2024-02-01T00:00:00"),
            order("two", order_status="pending", updated_at="2024-01-06T00:00:00")]
    (later / "b.json").write_text("\n".join(json.dumps(r) for r in rows))
    for _ in range(2):
        counts = daily.build_silver(spark, "orders", bronze, out, "2024-02-01 12:00:00", "2024-02-01")
        assert counts == {"rows_in": 2, "rows_out": 1, "bad": 0}      # the stored "two" is newer
        got = {r.order_id: r.order_status for r in spark.read.parquet(f"{out}/orders").collect()}
        assert got == {"plain": "refunded", "two": "shipped", "empty": "delivered", "tie": "pending"}
    daily.build_silver(spark, "orders", bronze, out, "2024-02-02 12:00:00", "2024-01-31")
    again = {r.order_id: r.order_status for r in spark.read.parquet(f"{out}/orders").collect()}
    assert again == got


def test_customers(spark):
    rows = [
        {"customer_id": "a", "email": "x@y.z", "postal_code": "12345-6789", "date_of_birth": "1980-05-01",
         "registration_date": "2023-03-04", "loyalty_tier": "gold", "segment": "vip", "total_orders": 3,
         "ltv_usd": 10.5},
        {"customer_id": "a", "registration_date": "2022-01-01", "loyalty_tier": "silver"},
        {"customer_id": None, "registration_date": "2022-01-01"},
        {"customer_id": "b", "postal_code": None, "date_of_birth": None, "loyalty_tier": None,
         "segment": "new", "total_orders": 1},
    ]
    raw = spark.createDataFrame(rows, V.CUSTOMERS_DDL.strip())
    got = {r.customer_id: r for r in silver.silver_customers(raw, NOW).collect()}
    assert set(got) == {"a", "b"}
    a, b = got["a"], got["b"]
    assert (a.postal_code_prefix, a.birth_year, a.registration_year, a.loyalty_tier) == ("123**", 1980, 2023, "gold")
    assert not {"email", "first_name", "last_name", "phone", "postal_code", "date_of_birth"} & set(a.asDict())
    assert a._is_current and a._valid_to is None
    import hashlib
    assert b._record_hash == hashlib.md5(b"b|new|1").hexdigest()


def test_clickstream(spark):
    base = {"event_id": "e", "session_id": "s", "event_type": "search", "event_ts": "2024-01-02T03:04:05.5",
            "_ingestion_ts": "2024-01-02T03:05:00"}
    rows = [base, base | {"_ingestion_ts": "2024-01-02T03:04:30", "event_type": "click"},
            base | {"event_id": "bad", "event_type": "hover"},
            base | {"event_id": "lost", "session_id": None},
            base | {"event_id": None}]
    got = silver.silver_clickstream(spark.createDataFrame(rows, V.CLICKSTREAM_DDL.strip()), NOW).collect()
    assert [(r.event_id, r.event_type, r.event_hour, str(r.event_date)) for r in got] == [
        ("e", "click", 3, "2024-01-02")]


def test_inventory(spark, tmp_path):
    head = ",".join(part.split()[0] for part in V.INVENTORY_DDL.split(","))
    lines = ["2024-01-31T06:00:00,w,at,9,1,5,5,10,1.5,2024-01-01,s",
             "2024-01-31T06:00:00,w,out,9,9,0,5,10,1.5,2024-01-01,s",
             "2024-01-31T06:00:00,w,odd,9,9,many,5,10,1.5,never,s"]
    (tmp_path / "i.csv").write_text("\n".join([head, *lines]))
    got = {r.product_sku: r for r in silver.silver_inventory(
        readers.read_inventory(spark, str(tmp_path)), NOW).collect()}
    assert (got["at"].is_low_stock, got["at"].is_out_of_stock) == (True, False)
    assert (got["out"].is_low_stock, got["out"].is_out_of_stock) == (True, True)
    assert (got["odd"].is_low_stock, got["odd"].quantity_available, got["odd"].last_received_date) == (None, None, None)
    assert str(got["at"].snapshot_date) == "2024-01-31"


def test_reviews_from_xml(spark, tmp_path):
    def review(i, rating, **more):
        parts = {"review_id": i, "rating": rating, "verified_purchase": "true",
                 "review_date": "2024-01-02", "helpful_votes": "3"} | more
        return "<review>" + "".join(f"<{k}>{v}</{k}>" for k, v in parts.items() if v is not None) + "</review>"

    xml = "<reviews>" + "".join([
        review("r5", 5), review("r0", 0), review("r6", 6), review(None, 4),
        review("twice", 3, review_date="2024-01-03", verified_purchase="false"),
        review("twice", 2, review_date="2024-01-01"),
    ]) + "</reviews>"
    (tmp_path / "r.xml").write_text(xml)
    cleaned = silver.clean_reviews(readers.read_reviews(spark, str(tmp_path)), NOW)
    got = {r.review_id: r for r in cleaned.collect()}
    assert set(got) == {"r5", "twice"}
    assert (got["r5"].verified_purchase, got["r5"].helpful_votes, got["twice"].rating) == (True, 3, 2)
    assert silver.silver_reviews(cleaned).columns[0] == "review_id"
    assert dict(silver.silver_reviews(cleaned).dtypes)["review_date"] == "date"


def test_landing_report(spark, tmp_path):
    for entity, date, text in (("orders", "2024-01-30", "x" * 10), ("orders", "2024-01-31", "y"),
                               ("clickstream", "2024-01-31", "z" * 5)):
        folder = tmp_path / entity / f"date={date}"
        folder.mkdir(parents=True)
        (folder / "f.json").write_text(text)
    report = landing.landing_report(landing.landed_files(spark, str(tmp_path)))
    got = {(r.entity, str(r.date)): (r.files, r.bytes, r.has_data) for r in report.collect()}
    assert got[("orders", "2024-01-30")] == (1, 10, True) and len(got) == 3
    assert str(landing.latest_partition(report, "orders").first()[0]) == "2024-01-31"
    assert landing.latest_partition(report, "reviews").first()[0] is None
    wanted = landing.landing_report(
        landing.landed_files(spark, str(tmp_path)), ("orders", "reviews")).collect()
    assert [(r.files, r.bytes, r.has_data, r.date) for r in wanted if r.entity == "reviews"] == [
        (0, 0, False, None)]
    assert len(wanted) == 4
    assert landing.bronze_complete(report, "2024-01-31").first()[0]
    assert not landing.bronze_complete(report, "2024-01-30").first()[0]
    assert not landing.bronze_complete(report, "2024-02-01").first()[0]


def test_avro_contract_names_every_field(spark):
    contract = json.loads(readers.clickstream_contract())
    assert len(contract["fields"]) == 23
    kinds = {f["name"]: f["type"] for f in contract["fields"]}
    assert kinds["event_id"] == "string" and kinds["customer_id"] == ["null", "string"]
    assert kinds["viewport_width"] == "int" and kinds["scroll_depth_pct"] == ["null", "int"]


def test_avro_needs_its_package(spark):
    df = spark.range(1).select(F.lit(b"").alias("value"))
    with pytest.raises(RuntimeError, match="spark-avro"):
        readers.decode_avro(df, readers.clickstream_contract())


def test_frames_of_avro_messages(spark):
    uuid = "0a1b2c3d-0000-4000-8000-0123456789ab"
    head = bytes.fromhex(uuid.replace("-", ""))
    values = [b"\x03\x00" + head + b"body", b"\x03\x00" + head, b"\x03\x05" + head + b"z", b"\x00\x00\x00\x01\x00x",
              b"\x00\x00\x00\x00\x09x", b"\x03\x00" + head[:9], b"{}", b"", None]
    df = spark.createDataFrame(list(enumerate(bytearray(v) if v is not None else None for v in values)), "n int, value binary")
    good, letters = readers.unframe_avro(df, [uuid, "256"])
    assert sorted((r.n, r._schema_id, bytes(r.value)) for r in good.collect()) == [
        (0, uuid, b"body"), (1, uuid, b""), (3, "256", b"x")]
    found = {r.n: (r._error, r.value if r.value is None else bytes(r.value)) for r in letters.collect()}
    assert {n: e for n, (e, _) in found.items()} == {
        2: "compressed", 4: "unknown_schema", 5: "no_header", 6: "no_header", 7: "no_header", 8: "no_header"}
    assert all(found[n][1] == values[n] for n in found)
    with pytest.raises(RuntimeError, match="spark-avro"):
        readers.decode_framed(df, {uuid: readers.clickstream_contract()})
