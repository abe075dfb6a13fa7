"""JDBC options and checks, without a database: reader, writer and statements are recorded."""

from types import SimpleNamespace

import pytest

from couchlog import sources
from couchlog.sources import tables

ACCESS = {"user": "someone", "password": "secret", "driver": "org.postgresql.Driver"}


class Recorder:
    def __init__(self, stored=0):
        self.stored, self.calls = stored, {}

    def format(self, name):
        return self.option("format", name)

    def option(self, key, value):
        self.calls[key] = value
        return self

    def options(self, **values):
        self.calls.update(values)
        return self

    def mode(self, name):
        return self.option("mode", name)

    def save(self):
        self.calls["saved"] = True

    def load(self):
        return SimpleNamespace(first=lambda: (self.stored,))

    def jdbc(self, url, table, **values):
        self.calls.update(url=url, table=table, **values)


@pytest.fixture
def database(monkeypatch):
    """Writes three rows; the database then says how many it holds."""

    def make(stored):
        reader, writer, done = Recorder(stored), Recorder(), []
        monkeypatch.setattr(tables, "Observation", lambda: SimpleNamespace(get={"rows": 3}))
        monkeypatch.setattr(tables.F, "count", lambda col: SimpleNamespace(alias=lambda name: name))
        monkeypatch.setattr(tables.F, "lit", lambda value: value)
        session = SimpleNamespace(read=reader)
        df = SimpleNamespace(sparkSession=session, observe=lambda seen, *what: SimpleNamespace(write=writer))
        return df, writer, reader, done, lambda spark, url, properties, statements: done.extend(statements)

    return make


def test_write_loads_aside_checks_and_swaps(database):
    df, writer, reader, done, run = database(3)
    assert sources.write_jdbc(df, "jdbc:x", "public.stats", ACCESS, connections=4, run=run) == 3
    assert writer.calls == {
        **ACCESS,
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "public.stats_new",
        "numPartitions": 4,
        "batchsize": 10_000,
        "mode": "overwrite",
        "saved": True,
    }
    assert reader.calls["query"] == "SELECT COUNT(*) AS n FROM public.stats_new"
    assert done == [
        "DROP TABLE IF EXISTS public.stats_old",
        "ALTER TABLE IF EXISTS public.stats RENAME TO stats_old",
        "ALTER TABLE public.stats_new RENAME TO stats",
        "DROP TABLE IF EXISTS public.stats_old",
    ]


def test_repeated_rows_leave_the_table_as_it_is(database):
    df, _, _, done, run = database(4)
    with pytest.raises(RuntimeError, match="holds 4 rows, expected 3"):
        sources.write_jdbc(df, "jdbc:x", "stats", ACCESS, run=run)
    assert done == []


def test_parallel_read():
    reader = Recorder()
    sources.read_jdbc(SimpleNamespace(read=reader), "jdbc:x", "stats", ACCESS, ("id", 0, 100, 5))
    assert reader.calls["partitionColumn"] == "id" and reader.calls["numPartitions"] == 5


def test_read_by_predicates():
    reader = Recorder()
    ranges = sources.split_by_text("user_id", ["3", "o'k"])
    assert ranges == ["user_id < '3' OR user_id IS NULL", "user_id >= '3' AND user_id < 'o''k'", "user_id >= 'o''k'"]
    sources.read_jdbc(SimpleNamespace(read=reader), "jdbc:x", "stats", ACCESS, predicates=ranges)
    assert reader.calls == {"url": "jdbc:x", "table": "stats", "predicates": ranges, "properties": ACCESS}
    assert sources.split_by_text("user_id", []) == ["1 = 1"]
