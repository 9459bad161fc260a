"""Every query against its SQL in DuckDB, and the contract of the entry module."""

import glob
import os

import duckdb
import pytest
from conftest import plan

import __spark_entry__ as entry_module
from feedloom import session as folders
from feedloom.plans import oracle, queries as plans
from feedloom.schemas import EDIT_ROW

QUERIES = plans.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_all_have_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert ORACLE.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, small, name):
    result = QUERIES[name](spark, small)
    expected = duck.sql(ORACLE[name])
    assert sorted(result.columns) == sorted(expected.columns)
    got = [tuple(r[c] for c in expected.columns) for r in result.collect()]
    assert len(got) > 0
    assert sorted(got, key=repr) == sorted(expected.fetchall(), key=repr)


@pytest.mark.parametrize(
    "name", ["edits", "edit_events", "edit_flags", "edit_rejects", "replay_range", "rate_curve",
             "due_times", "due_times_stepped", "tweets", "tweet_rejects"]
)
def test_no_shuffle(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "Exchange" not in text and "Python" not in text


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == EDIT_ROW.names
    assert result.count() > 0


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, **settings):
        self.conf, self.sparkContext = settings, _Context(master)


def test_shared_folder_is_the_one_the_session_names():
    named = _Session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://host/shared/"})
    assert folders.shared_folder(named) == "hdfs://host/shared"
    first, second = folders.new_folder(named, "x"), folders.new_folder(named, "x")
    assert first != second and first.startswith("hdfs://host/shared/x-")


def test_no_folder_of_one_machine_on_a_cluster():
    with pytest.raises(ValueError):
        folders.shared_folder(_Session("spark://host:7077"))
    local = _Session("local[4]")
    assert folders.shared_folder(local) == folders.shared_folder(local) != ""
