"""A history kept up to date by snapshots equals the one made from all of them."""

import os

import pytest

from wardflow.operators import scd
from wardflow.plans.history import CLOSED, OPEN, History
from wardflow.sources.layers import Layers

# per snapshot: key, attribute; 3 vanishes and comes back the same, 4 comes back changed, 5 vanishes for good, 6 arrives late, 7 is null for a time
SNAPSHOTS = {
    "20260101": [(1, "a"), (2, "a"), (3, "a"), (4, "a"), (5, "a"), (7, None)],
    "20260108": [(1, "b"), (2, "a"), (5, "b"), (7, None)],
    "20260115": [(1, "b"), (2, "a"), (3, "a"), (4, "z"), (6, "n"), (7, "x")],
    "20260122": [(1, "a"), (2, "a"), (3, "a"), (6, "m"), (7, None)],
}
PICK = ("id", "job", "valid_from", "valid_to", "is_current")


def _frame(spark, batch):
    return spark.createDataFrame(SNAPSHOTS[batch], "id long, job string")


def _at_once(spark, batches, **options):
    every = [(i, job, b) for b in batches for i, job in SNAPSHOTS[b]]
    return scd.versions(spark.createDataFrame(every, "id long, job string, _batch_id string"), "id", close_missing=True, **options)


@pytest.mark.parametrize("attributes", [("job",), ()])
def test_applied_one_by_one_equals_all_at_once(spark, tmp_path, rows, attributes):
    history, done = History(Layers(spark, str(tmp_path)), "jobs", "id", attributes, buckets=4), []
    for batch in SNAPSHOTS:
        history.apply(_frame(spark, batch), batch)
        done.append(batch)
        assert rows(history.read(), *PICK) == rows(_at_once(spark, done, compress=bool(attributes), attributes=attributes), *PICK)
    history.apply(_frame(spark, done[-1]), done[-1])
    assert history.newest() == done[-1] and history.read().count() == _at_once(spark, done, compress=bool(attributes), attributes=attributes).count()
    with pytest.raises(ValueError):
        history.apply(_frame(spark, done[0]), done[0])


def _files(folder, prefix):
    return {os.path.join(at, f) for at, _, names in os.walk(folder) if f"_part={prefix}" in at for f in names if f.endswith(".parquet")}


def test_only_buckets_with_changes_are_rewritten(spark, tmp_path):
    history = History(Layers(spark, str(tmp_path)), "jobs", "id", ("job",), buckets=64)
    people = spark.range(400).selectExpr("id", "'a' AS job")
    history.apply(people, "20260101")
    first = _files(tmp_path, OPEN)
    history.apply(people.selectExpr("id", "IF(id = 17, 'b', job) AS job"), "20260108")
    second, closed = _files(tmp_path, OPEN), _files(tmp_path, CLOSED)
    assert len({os.path.dirname(f) for f in first ^ second}) == 1, "one bucket"
    history.apply(people.selectExpr("id", "IF(id = 17, 'c', job) AS job"), "20260115")
    assert closed < _files(tmp_path, CLOSED), "closed versions are left alone"


def test_a_run_that_ended_early_is_made_good(spark, tmp_path, rows, monkeypatch):
    layers = Layers(spark, str(tmp_path))
    history = History(layers, "jobs", "id", ("job",), buckets=4)
    batches = list(SNAPSHOTS)
    history.apply(_frame(spark, batches[0]), batches[0])
    real, calls = Layers.replace_partitions, []

    def half(self, table, df, partitions):
        """The closed versions are written; of the open ones a few parts, then the run ends."""
        calls.append(table)
        if len(calls) == 1:
            return real(self, table, df, partitions)
        real(self, table, df.filter("_part IN ('open-0000', 'open-0001')"), partitions)
        raise RuntimeError("ended early")

    monkeypatch.setattr(Layers, "replace_partitions", half)
    with pytest.raises(RuntimeError):
        history.apply(_frame(spark, batches[1]), batches[1])
    monkeypatch.setattr(Layers, "replace_partitions", real)
    for batch in batches[1:]:
        history.apply(_frame(spark, batch), batch)
    assert rows(history.read(), *PICK) == rows(_at_once(spark, batches, compress=True, attributes=("job",)), *PICK)
