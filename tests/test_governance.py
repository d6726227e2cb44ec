from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from silverlane.governance import audit, catalog, contract, security
from silverlane.schema import AUDIT
from silverlane.sources import tables
from workload.queries import COLUMN_NOTES, CONTRACT, environment_check

ROWS = [("t1", "d1", "silver"), ("t2", "d2", "bronze"), ("t3", "d3", "silver")]


@pytest.fixture
def domain(spark, where):
    name = f"payments_{uuid.uuid4().hex[:8]}"
    catalog.create_domains(spark, {name: "It's the payments domain"}, where)
    yield name
    catalog.reset(spark, [name])


@pytest.fixture
def transactions(spark, domain):
    name = f"{domain}.transactions"
    df = spark.createDataFrame(ROWS, "transaction_id string, device string, layer string")
    catalog.create_table(spark, name, df.schema, "Notes 'quoted'", {"layer": "the layer"})
    df.write.insertInto(name)
    return name


def test_domains_and_environment(spark, domain, transactions):
    names = {r["schema"]: r["description"] for r in catalog.schemas_table(spark).collect()}
    assert names[domain] == "It's the payments domain"
    checked = catalog.check_environment(spark, [domain, "nowhere"], [transactions, f"{domain}.no"])
    assert [r["present"] for r in checked.collect()] == [True, False, True, False]


def test_the_environment_has_all_four_schemas(spark, where):
    types = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    at = dt.datetime(2024, 1, 1)
    # Of five events the fourth is bronze and the fifth has no valid channel.
    kinds = {1: "view", 2: "click", 3: "signup", 4: "purchase", 5: "error"}
    events = [(n, at, n, kind, 1.0, None) for n, kind in kinds.items()]
    spark.createDataFrame(events, types).write.parquet(f"{where}/events.parquet")
    checked = {(r["kind"], r["name"]): (r["present"], r["silver_rows"]) for r in environment_check(spark, where).collect()}
    assert checked == {
        ("schema", "ledger"): (True, 0),
        ("schema", "watch"): (True, 0),
        ("schema", "people"): (True, 0),
        ("schema", "outlets"): (True, 0),
        ("table", "ledger.transactions"): (True, 3),
        ("table", "ledger.transactions_missing"): (False, 0),
    }


def test_reset_drops_only_what_was_made_here(spark, domain):
    other = f"other_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {other}")
    assert catalog.reset(spark, [domain, other, "default", "missing"]) == [domain]
    assert spark.catalog.databaseExists(other) and not spark.catalog.databaseExists(domain)
    spark.sql(f"DROP SCHEMA {other}")


def test_contract_and_comments(spark, transactions):
    notes = {"device": COLUMN_NOTES["device"], "layer": "the layer"}
    contract.register_contract(spark, transactions, CONTRACT, "A 'fine' table", notes)
    read = {r["property"]: r["value"] for r in contract.read_contract(spark, transactions).collect()}
    assert len(read) == 13 and read["sla_freshness"] == "one hour" and read["pii_columns"] == "device"
    noted = {r["column"]: r["comment"] for r in contract.column_documentation(spark, transactions).collect()}
    assert noted["device"] == COLUMN_NOTES["device"] and noted["layer"] == "the layer"
    assert catalog.describe(spark, transactions)["comment"] == "A 'fine' table"


def test_discovery(spark, domain, transactions):
    spark.sql(f"CREATE VIEW {domain}.a_view COMMENT 'seen' AS SELECT 1 AS x")
    found = catalog.discover_products(spark, [domain]).collect()
    assert [(r["data_product"], r["table_type"]) for r in found] == [("a_view", "VIEW"), ("transactions", "MANAGED")]
    assert found[0]["description"] == "seen" and found[1]["created_at"]
    everywhere = catalog.discover_products(spark)
    assert everywhere.where(F.col("domain") == domain).count() == 2


def test_the_view_follows_membership(spark, domain, transactions):
    members = f"{domain}.members"
    me = spark.range(1).select(F.current_user().alias("user_name"), F.lit("risk").alias("grp"))
    me.write.saveAsTable(members)
    view = f"{domain}.v_transactions"
    security.create_secured_view(spark, view, transactions, members)
    seen = security.check_masking(spark.table(view)).first()
    assert (seen["visible_rows"], seen["distinct_devices"], seen["sample_device"]) == (2, 1, "***")
    assert seen["user_name"] == spark.sql("SELECT current_user()").first()[0]
    me.withColumn("grp", F.lit("compliance")).write.insertInto(members)
    spark.catalog.refreshTable(members)
    seen = security.check_masking(spark.table(view)).first()
    assert (seen["visible_rows"], seen["distinct_devices"], seen["sample_device"]) == (3, 3, "d1")


@pytest.mark.parametrize("user, n, sample", [("ana", 2, "***"), ("aud", 3, "d1"), ("nobody", 2, "***")])
def test_the_same_as_a_transform(spark, transactions, user, n, sample):
    members = spark.createDataFrame([("ana", "risk"), ("aud", "admins")], "user_name string, grp string")
    seen = security.secured(spark.table(transactions), members, user=user)
    row = security.check_masking(seen, user).first()
    assert (row["user_name"], row["visible_rows"], row["sample_device"]) == (user, n, sample)
    strict = security.secured(spark.table(transactions), members, open_rows=F.lit(False), user=user)
    assert strict.count() == (0 if sample == "***" else 3)


def test_layer_tables(spark, where, domain):
    df = spark.createDataFrame(ROWS, "transaction_id string, device string, layer string")
    name = f"{domain}.layers"
    tables.overwrite_table(df.withColumn("old", F.lit(1)), name, f"{where}/layers")
    tables.overwrite_table(df, name, f"{where}/layers")  # the schema is replaced as well
    tables.append_table(df.select("layer", "device", "transaction_id"), name)
    scan = tables.layer_scan(spark, name, "silver")
    assert scan.count() == 4 and "old" not in scan.columns
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(layer" in plan
    detail = {r["layer"]: r["n_files"] for r in tables.physical_detail(spark, f"{where}/layers").collect()}
    assert set(detail) == {"silver", "bronze"}


def test_audit(spark):
    now = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)

    def entry(minutes, action="getTable", table="main.p.t", service="catalog"):
        return (now - dt.timedelta(minutes=minutes, seconds=5), ("me@x",), service, action, {"table_full_name": table})

    log = spark.createDataFrame(
        [entry(1), entry(2, "deleteTable"), entry(3, table="other.t"), entry(4, service="jobs"),
         entry(179, "alterTable"), entry(181), entry(-5)],
        AUDIT,
    )
    seen = audit.access_audit(log, "catalog", "main", as_of=F.lit(now)).collect()
    assert [(r["action_name"], r["minute"].second) for r in seen] == [("getTable", 0), ("alterTable", 0)]
    assert len(audit.access_audit(log, "catalog", "main", as_of=F.lit(now), newest=1).collect()) == 1
    assert audit.access_audit(log, "catalog", "main").count() == 0
