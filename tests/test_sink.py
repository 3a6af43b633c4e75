"""Replacing tables: whatever fails, the old table stays and nothing is left."""

import os

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from erabridge import REPORTS, refresh_all
from erabridge.sources.sink import (
    Replacement,
    name_parts,
    quoted,
    replace_table,
    stage,
    swap_all,
)
from helpers import as_set
from workload.adapters import event_rows, history_rows


def left_over(spark, folder=None):
    """Staging and retired tables, and staging folders that no table reads."""
    names = [t.name for t in spark.catalog.listTables()]
    found = [n for n in names if "staging" in n or "retired" in n]
    if folder is not None:
        read = {f for n in names for f in folders(spark, n)}
        found += [f for f in os.listdir(folder) if f not in read]
    return found


def folders(spark, table):
    try:
        return {f.split("/")[-2] for f in spark.table(table).inputFiles()}
    except Exception:  # a table of another test, whose files are gone
        return set()


@pytest.fixture
def failing(monkeypatch):
    """Makes the n-th statement that matches fail, and later ones work."""

    def arm(text, n):
        plain, met = SparkSession.sql, []

        def sql(self, statement, *rest, **more):
            if text in statement:
                met.append(statement)
                if len(met) == n:
                    raise RuntimeError("the catalog is away")
            return plain(self, statement, *rest, **more)

        monkeypatch.setattr(SparkSession, "sql", sql)
        return met

    return arm


@pytest.mark.parametrize("n", [1, 2])
@pytest.mark.parametrize("placed", [False, True])
def test_failed_rename_keeps_the_old_table(spark, tmp_path, failing, n, placed):
    table = f"trade_{n}_{placed}".lower()
    replace_table(spark.range(5), table)
    met = failing("RENAME", n)
    location = str(tmp_path) if placed else None
    with pytest.raises(RuntimeError, match="catalog is away"):
        replace_table(spark.range(3), table, location)
    assert len(met) >= n
    assert spark.table(table).count() == 5
    assert not left_over(spark, location)
    replace_table(spark.range(3), table, location)
    assert spark.table(table).count() == 3
    assert not left_over(spark, location)


def test_first_write_that_fails_to_take_its_name_leaves_nothing(
    spark, tmp_path, failing
):
    failing("RENAME", 1)
    with pytest.raises(RuntimeError, match="catalog is away"):
        replace_table(spark.range(3), "never_there", str(tmp_path))
    assert not spark.catalog.tableExists("never_there")
    assert not left_over(spark, tmp_path)


def test_equal_layout_at_a_location_is_switched_in_one_step(spark, tmp_path, failing):
    replace_table(spark.range(5), "switched", str(tmp_path))
    renames = failing("RENAME", 99)
    moves = failing("SET LOCATION", 99)
    replace_table(spark.range(3), "switched", str(tmp_path))
    assert (len(renames), len(moves)) == (0, 1)
    assert as_set(spark.table("switched")) == {(0,), (1,), (2,)}


def test_failed_switch_keeps_the_old_files(spark, tmp_path, failing):
    replace_table(spark.range(5), "unswitched", str(tmp_path))
    failing("SET LOCATION", 1)
    with pytest.raises(RuntimeError, match="catalog is away"):
        replace_table(spark.range(3), "unswitched", str(tmp_path))
    assert spark.table("unswitched").count() == 5
    assert not left_over(spark, tmp_path)


def test_one_table_that_cannot_be_put_back_does_not_keep_the_others(spark, monkeypatch):
    """The third swap fails, and so does putting the second table back."""
    names = ["back_one", "back_two", "back_three"]
    for name in names:
        replace_table(spark.range(5), name)
    staged = [stage(spark.range(3), name) for name in names]
    monkeypatch.setattr(Replacement, "undo", refusing(staged[1], Replacement.undo))
    monkeypatch.setattr(Replacement, "swap", refusing(staged[2], Replacement.swap))
    with pytest.raises(RuntimeError, match="not this one") as failure:
        swap_all(staged)
    assert "back_two" in failure.value.__notes__[0]
    assert spark.table("back_one").count() == 5
    assert spark.table("back_three").count() == 5
    # Both versions of the stuck table are there.
    assert spark.table("back_two").count() == 3
    assert spark.table(staged[1].name("retired")).count() == 5
    assert [n for n in left_over(spark) if "back_" in n] == [f"back_two__retired_{staged[1].run}"]
    monkeypatch.undo()
    staged[1].undo()
    staged[1].finish()
    assert spark.table("back_two").count() == 5
    assert not left_over(spark)


def refusing(stuck, plain):
    def step(self):
        if self is stuck:
            raise RuntimeError("not this one")
        plain(self)

    return step


def test_other_layout_at_a_location_trades_names(spark, tmp_path):
    replace_table(spark.range(5), "relaid", str(tmp_path))
    other = spark.range(3).withColumn("more", F.lit("x"))
    replace_table(other, "relaid", str(tmp_path))
    assert spark.table("relaid").columns == ["id", "more"]
    assert spark.table("relaid").count() == 3


def test_failed_write_leaves_neither_table_nor_folder(spark, tmp_path):
    replace_table(spark.range(5), "unwritten", str(tmp_path))
    bad = spark.range(3).select(F.raise_error(F.lit("bad row")).cast("long").alias("id"))
    with pytest.raises(Exception, match="bad row"):
        replace_table(bad, "unwritten", str(tmp_path))
    assert spark.table("unwritten").count() == 5
    assert not left_over(spark, tmp_path)


def test_a_view_is_refused_before_writing(spark, failing):
    spark.sql("CREATE OR REPLACE VIEW a_view AS SELECT 1 AS id")
    spark.range(1).createOrReplaceTempView("a_temp_view")
    for name in ("a_view", "a_temp_view"):
        with pytest.raises(ValueError, match="is a view"):
            replace_table(spark.range(3), name)
    assert not left_over(spark)
    assert spark.table("a_view").collect()[0].id == 1


@pytest.mark.parametrize(
    ("name", "parts"),
    [
        ("my-table", ["my-table"]),
        ("`my-table`", ["my-table"]),
        ("cat.my-db.`a.b`", ["cat", "my-db", "a.b"]),
        ("`a``b`.c", ["a`b", "c"]),
    ],
)
def test_names_in_parts(name, parts):
    assert name_parts(name) == parts
    assert name_parts(quoted(parts)) == parts


@pytest.mark.parametrize("name", ["", ".", "a.", ".a", "a..b", "`a`b"])
def test_no_names(name):
    with pytest.raises(ValueError, match="not a table name"):
        name_parts(name)


def test_names_that_need_quotes(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS other_place")
    for name in ("`order`", "other_place.`select`"):
        replace_table(spark.range(2), name)
        replace_table(spark.range(4), name)
        assert spark.table(quoted(name_parts(name))).count() == 4


# ------------------------------------------------------------ all six reports


@pytest.fixture
def inputs(spark, sf_dir):
    history = history_rows(spark, sf_dir)
    return event_rows(spark, sf_dir), {name: history for name in REPORTS}


def tables_of(run):
    return {name: f"{name}_{run}" for name in REPORTS}


def counts(spark, run):
    return {name: spark.table(t).count() for name, t in tables_of(run).items()}


@pytest.mark.parametrize(
    ("text", "n"), [("RENAME", 1), ("RENAME", 4), ("RENAME", 12), ("SET LOCATION", 5)]
)
def test_failed_refresh_changes_no_table(spark, tmp_path, inputs, failing, text, n):
    events, histories = inputs
    run = f"half_{text[:3].lower()}{n}"
    location = str(tmp_path) if text == "SET LOCATION" else None
    none = {name: h.where(F.lit(False)) for name, h in histories.items()}
    refresh_all(spark, events, none, tables_of(run), location)
    before = counts(spark, run)
    failing(text, n)
    with pytest.raises(RuntimeError, match="catalog is away"):
        refresh_all(spark, events, histories, tables_of(run), location)
    assert counts(spark, run) == before
    assert not left_over(spark, location)
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    assert not [f for f in os.listdir(folder) if f.startswith("session-summary")]


def test_bad_last_history_changes_no_table(spark, inputs):
    events, histories = inputs
    refresh_all(spark, events, histories, tables_of("badlast"))
    before = counts(spark, "badlast")
    bad = histories["device"].withColumn("sessions", F.lit("x"))
    less = {name: h.limit(3) for name, h in histories.items()}
    with pytest.raises(Exception, match="not a valid"):
        refresh_all(spark, events, {**less, "device": bad}, tables_of("badlast"))
    assert counts(spark, "badlast") == before
    assert not left_over(spark)


def test_inputs_are_checked_before_anything_runs(spark, inputs, monkeypatch):
    events, histories = inputs
    monkeypatch.setattr(
        "erabridge.plans.reports.session_summary", lambda *a: pytest.fail("it scanned")
    )
    with pytest.raises(ValueError, match="no history for: campaign"):
        refresh_all(spark, events, {k: v for k, v in histories.items() if k != "campaign"})
    with pytest.raises(ValueError, match="no such report: other"):
        refresh_all(spark, events, histories, {"other": "x"})
    with pytest.raises(ValueError, match="same table"):
        refresh_all(spark, events, histories, {"device": "x", "traffic": "x"})
    with pytest.raises(Exception, match="bounce_rate"):
        refresh_all(spark, events, {**histories, "device": histories["device"].drop("bounce_rate")})
    with pytest.raises(Exception, match="event_name"):
        refresh_all(spark, events.drop("event_name"), histories)
    spark.sql("CREATE OR REPLACE VIEW refresh_view AS SELECT 1 AS id")
    with pytest.raises(ValueError, match="is a view"):
        refresh_all(spark, events, histories, {"device": "refresh_view"})
