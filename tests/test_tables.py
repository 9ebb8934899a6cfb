"""Catalog tables: inserts, replacement of partitions, merge, and what a crash leaves."""

from __future__ import annotations

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.plans import orders
from kerbline.sources import files
from kerbline.sources.tables import CatalogTable, create_database
from tests.conftest import bag, plan_of

SCHEMA = T.StructType().add("id", "long").add("name", "string").add("day", "date")
DAYS = [date(2024, 1, d) for d in (1, 2, 3)]


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex}"
    create_database(spark, name, "it's a test")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def table(spark, database):
    table = CatalogTable(spark, f"{database}.rows").create(SCHEMA, ["day"], "Rows by day", "gold")
    rows = [(i, f"n{i}", DAYS[i % 3]) for i in range(9)] + [(90, "undated", None)]
    table.insert(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    return table


def some(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def files_by_day(table) -> dict:
    found = table.read().select("day", F.input_file_name()).distinct().collect()
    return {day: {f for d, f in found if d == day} for day, _ in found}


def test_a_table_has_comment_tier_and_partitions(spark, table, database):
    assert table.partition_columns() == ["day"]
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table.name}").collect()}
    assert told["Comment"] == "Rows by day" and "quality=gold" in told["Table Properties"]
    create_database(spark, database)  # once more does nothing
    table.create(SCHEMA, ["day"])
    assert table.read().count() == 10
    table.create(SCHEMA, ["day"], replace=True)
    assert table.read().count() == 0
    table.drop()
    assert not table.exists()
    table.drop()


def test_only_touched_partitions_are_read_and_written(spark, table):
    before = files_by_day(table)
    source = some(spark, (1, "new name", DAYS[1]), (100, "added", DAYS[1]))
    target, touched = table.in_partitions(source)
    assert [row[0] for row in touched] == [DAYS[1]]
    plan = plan_of(target)
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-02" in plan
    assert target.inputFiles() and all("day=2024-01-02" in name for name in target.inputFiles())
    assert [row[0] for row in table.merge(source, ["id", "day"])] == [DAYS[1]]
    after = files_by_day(table)
    assert {d for d in before if before[d] != after[d]} == {DAYS[1]}
    assert bag(table.read().filter(F.col("day") == DAYS[1]), "id", "name") == bag(
        some(spark, (1, "new name", None), (4, "n4", None), (7, "n7", None), (100, "added", None)), "id", "name"
    )
    assert table.read().count() == 11


def test_null_partitions_and_null_keys(spark, table):
    table.merge(some(spark, (90, "still apart", None), (91, "x", None)), ["id", "day"])
    undated = table.read().filter("day IS NULL")
    # A null key matches nothing, so the rows are added anew.
    assert bag(undated, "id", "name") == [(90, "still apart"), (90, "undated"), (91, "x")]
    assert table.read().count() == 12


def test_a_merge_without_rows_and_a_new_day(spark, table):
    before = files_by_day(table)
    assert table.merge(some(spark), ["id", "day"]) == []
    assert files_by_day(table) == before
    table.merge(some(spark, (5, "later", date(2024, 2, 1))), ["id", "day"])
    assert table.read().count() == 11


def test_refused_merges_change_nothing(spark, table):
    before = bag(table.read())
    with pytest.raises(ValueError, match="no keys"):
        table.merge(some(spark, (1, "x", DAYS[0])), ["id"])
    with pytest.raises(Exception, match="several source rows"):
        table.merge(some(spark, (1, "x", DAYS[1]), (1, "y", DAYS[1])), ["id", "day"])
    assert bag(table.read()) == before and table.recover() is False


def test_tables_without_partitions_are_merged_as_a_whole(spark, database):
    plain = CatalogTable(spark, f"{database}.plain").create(SCHEMA)
    plain.merge(some(spark, (1, "a", None), (2, "b", DAYS[0])), ["id"])
    plain.merge(some(spark, (2, "c", DAYS[1])), ["id"])
    assert bag(plain.read()) == bag(some(spark, (1, "a", None), (2, "c", DAYS[1])))
    plain.merge(some(spark), ["id"])
    assert plain.read().count() == 2


def test_several_partition_columns(spark, database):
    schema = T.StructType.fromDDL("id int, name string, city string, day date")
    table = CatalogTable(spark, f"{database}.two").create(schema, ["city", "day"])
    rows = [(i, "old", city, day) for i, (city, day) in enumerate((c, d) for c in ("A", "B", None) for d in DAYS[:2])]
    table.insert(spark.createDataFrame(rows, schema))
    table.merge(spark.createDataFrame([(0, "new", "A", DAYS[0]), (9, "new", "B", DAYS[1])], schema), ["id", "city", "day"])
    assert table.read().filter("name = 'old'").count() == 5 and table.read().count() == 7


class Died(Exception):
    pass


@pytest.mark.parametrize("when", ["copy", "exchange", "after"])
def test_a_crash_at_any_point_is_mended_by_the_next_run(spark, table, monkeypatch, when):
    source = some(spark, (1, "new name", DAYS[1]), (2, "new too", DAYS[2]))
    before = bag(table.read())
    expected = [(i, {1: "new name", 2: "new too"}.get(i, name), day) for i, name, day in before]

    with monkeypatch.context() as patch:
        if when == "copy":  # the copy is only half written
            patch.setattr(CatalogTable, "overwrite_partitions", lambda self, rows: (_ for _ in ()).throw(Died()))
            files.make_directory(spark, f"{table._copy()}/day=2024-01-02")
        else:
            remove = files.remove

            def die(spark_, path):
                if path == table._copy():
                    raise Died
                remove(spark_, path)

            patch.setattr(files, "remove", die)
        with pytest.raises(Died):
            if when == "copy":
                table.overwrite_partitions(source)
            else:
                table.merge(source, ["id", "day"])
    if when == "exchange":  # one partition was taken away and not put back yet
        remove(spark, f"{table.location()}/day=2024-01-03")
        spark.catalog.refreshTable(table.name)
        assert table.read().count() == 7
    if when == "copy":
        assert table.recover() is False and bag(table.read()) == before
    table.merge(source, ["id", "day"])  # simply run again
    assert bag(table.read()) == sorted(expected, key=repr)
    assert files.child_names(spark, table._copy()) == []


def test_the_callers_overwrite_setting_stays(spark, table):
    setting = "spark.sql.sources.partitionOverwriteMode"
    assert spark.conf.get(setting).lower() == "static"
    table.merge(some(spark, (1, "x", DAYS[1])), ["id", "day"])
    assert spark.conf.get(setting).lower() == "static"


def test_partitions_are_cleared_by_value(spark, table):
    table.clear_partitions([DAYS[0], None, date(2030, 1, 1)])
    assert sorted({r["day"] for r in table.read().collect()}) == DAYS[1:]


def test_the_demo_orders_by_sql(spark, database):
    """Golden totals of orders that come in three parts, by literal rows."""
    parts = [
        """('ORD-001', 'Electronics', 1200.0, 'delivered'), ('ORD-002', 'Clothing', 350.0, 'delivered'),
        ('ORD-003', 'Books', 89.0, 'delivered'), ('ORD-004', 'Electronics', 780.0, 'delivered'),
        ('ORD-005', 'Food', 45.0, 'cancelled'), ('ORD-006', 'Clothing', 210.0, 'delivered')""",
        """('ORD-007', 'Electronics', 2500.0, 'delivered'), ('ORD-008', 'Books', 150.0, 'delivered'),
        ('ORD-009', 'Clothing', 620.0, 'delivered')""",
    ]
    landed = CatalogTable(spark, f"{database}.orders")
    landed.create(T.StructType.fromDDL("order_id string, category string, amount double, status string"))
    totals = CatalogTable(spark, f"{database}.totals")
    seen = []
    for i, rows in enumerate(parts):
        spark.sql(f"INSERT INTO {landed.name} VALUES {rows}")
        counted = orders.revenue_by_category(orders.delivered_orders(landed.read()))
        if i == 0:
            totals.create(counted.schema)
            totals.insert(counted)
        else:
            totals.merge(counted, ["category"])
        seen.append({r[0]: tuple(r[1:]) for r in totals.read().collect()})
    assert seen[0] == {"Electronics": (2, 1980.0, 990.0), "Clothing": (2, 560.0, 280.0), "Books": (1, 89.0, 89.0)}
    assert seen[1] == {"Electronics": (3, 4480.0, 1493.33), "Clothing": (3, 1180.0, 393.33), "Books": (2, 239.0, 119.5)}
    spark.sql(f"CREATE TABLE {landed.name}_kept USING parquet AS SELECT * FROM {landed.name} WHERE category <> 'Books'")
    kept = orders.revenue_by_category(orders.delivered_orders(spark.table(f"{landed.name}_kept")))
    totals.merge(kept, ["category"])  # a merge keeps the stale key
    assert totals.read().filter("category = 'Books'").count() == 1
    totals.create(kept.schema, replace=True).insert(kept)
    assert totals.read().filter("category = 'Books'").count() == 0


def _crowd(table, spark):
    for i in range(5):
        table.insert(some(spark, (100 + i, "more", DAYS[0])))
    table.insert(some(spark, (200, "more", None)))


def test_crowded_partitions_are_written_in_few_files_and_keep_their_rows(spark, table):
    _crowd(table, spark)
    before = bag(table.read())
    counts = {r["day"]: r["files"] for r in table.file_counts().collect()}
    assert counts == {DAYS[0]: 6, DAYS[1]: 1, DAYS[2]: 1, None: 2}
    others = {f for f in table.read().filter(F.col("day") != DAYS[0]).inputFiles()}
    assert [r["day"] for r in table.compact(most_files=2)] == [DAYS[0]]
    assert {r["day"]: r["files"] for r in table.file_counts().collect()} == {**counts, DAYS[0]: 1}
    assert bag(table.read()) == before
    assert {f for f in table.read().filter(F.col("day") != DAYS[0]).inputFiles()} == others
    assert table.compact(most_files=2) == []


def test_a_partition_without_value_and_a_chosen_one_are_compacted(spark, table):
    _crowd(table, spark)
    before = bag(table.read())
    assert [r["day"] for r in table.compact(F.col("day").isNull(), most_files=1)] == [None]
    assert {r["day"]: r["files"] for r in table.file_counts().collect()}[DAYS[0]] == 6
    assert bag(table.read()) == before


def test_full_files_are_left_alone(spark, table):
    _crowd(table, spark)
    assert table.compact(most_files=1, small_bytes=1) == []


def test_a_table_without_partitions_and_an_empty_one(spark, database):
    plain = CatalogTable(spark, f"{database}.plain").create(SCHEMA)
    assert plain.compact() == [] and plain.file_counts().count() == 0
    for i in range(4):
        plain.insert(some(spark, (i, "x", None)))
    before = bag(plain.read())
    assert len(plain.compact(most_files=2)) == 1
    assert plain.file_counts().first()["files"] == 1 and bag(plain.read()) == before


def test_a_compaction_that_dies_is_ended_later(spark, table, monkeypatch):
    _crowd(table, spark)
    before = bag(table.read())
    real, calls = CatalogTable.recover, []

    def dies(self):
        calls.append(1)
        if len(calls) > 2:  # the copy is complete, nothing is exchanged yet
            raise RuntimeError("lost")
        return real(self)

    monkeypatch.setattr(CatalogTable, "recover", dies)
    with pytest.raises(RuntimeError):
        table.compact(most_files=2)
    monkeypatch.setattr(CatalogTable, "recover", real)
    assert bag(table.read()) == before
    assert table.recover() and bag(table.read()) == before
    assert {r["day"]: r["files"] for r in table.file_counts().collect()}[DAYS[0]] == 1
