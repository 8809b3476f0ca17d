"""Tables in versions: readers see a version once it is whole."""

from __future__ import annotations

import os

import pytest
from conftest import rows

from fleetmeter import schemas
from fleetmeter.plans.daily import update_registry
from fleetmeter.sources import tables
from fleetmeter.sources.versions import VersionConflict, Versions
from verification import queries as q
from verification import views as v


def one(spark, n: int):
    return spark.createDataFrame([(f"r{n}", f"n{n}", ["latest"])], schemas.REGISTRY)


def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    root = str(tmp_path / "registry")
    assert tables.read_registry(spark, root).count() == 0
    tables.write_registry(one(spark, 1), root)

    def half(folder: str) -> None:
        one(spark, 2).write.parquet(folder)
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        Versions(spark, root).commit(half)
    assert rows(tables.read_registry(spark, root).select("run_id")) == [("r1",)]
    tables.write_registry(one(spark, 3), root)
    assert rows(tables.read_registry(spark, root).select("run_id")) == [("r3",)]


def test_readers_of_an_earlier_version_go_on(spark, tmp_path):
    root = str(tmp_path / "registry")
    tables.write_registry(one(spark, 1), root)
    before = tables.read_registry(spark, root)
    tables.write_registry(one(spark, 2), root)
    assert rows(before.select("run_id")) == [("r1",)]


def test_one_of_two_writers_wins(spark, tmp_path):
    root = str(tmp_path / "registry")
    tables.write_registry(one(spark, 1), root)

    def overtaken(folder: str) -> None:
        one(spark, 2).write.parquet(folder)
        # Another job commits this number first, under a name that counts before ours.
        os.makedirs(f"{root}/versions/000000000002-0")
        one(spark, 9).write.mode("overwrite").parquet(f"{root}/versions/000000000002-0")
        open(f"{root}/pointers/000000000002-0", "w").close()

    with pytest.raises(VersionConflict):
        Versions(spark, root).commit(overtaken)
    assert rows(tables.read_registry(spark, root).select("run_id")) == [("r9",)]


def test_old_versions_go(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "t"))
    for n in range(5):
        versions.commit(lambda folder, n=n: one(spark, n).write.parquet(folder))
    versions.keep(2)
    assert [name[:12] for name in versions.names()] == ["000000000004", "000000000005"]
    assert len(os.listdir(tmp_path / "t" / "versions")) == 2
    versions.commit(lambda folder: one(spark, 7).write.parquet(folder))
    assert versions.names()[-1].startswith("000000000006")


def test_csv_history_has_a_version_for_each_write(spark, sf_dir, tmp_path):
    root = str(tmp_path / "csv")
    empty = tables.latest_history_csv(spark, root)
    assert empty.schema == schemas.RUN_DAYS and empty.count() == 0
    first = tables.write_history_csv(v.old_history(spark, sf_dir), root, v.TARGET)
    second = tables.write_history_csv(v.new_history(spark, sf_dir), root, v.TARGET)
    assert first != second and first.endswith(f"version={v.TARGET}") and second.endswith(f"version={v.TARGET}")
    newest = tables.latest_history_csv(spark, root)
    assert newest.schema == schemas.RUN_DAYS
    assert newest.exceptAll(v.new_history(spark, sf_dir)).count() == 0
    assert newest.count() == v.new_history(spark, sf_dir).count()


@pytest.mark.parametrize("text", ["", None, "\\", "\\n", "\n", "a\\\nb", "\\\\n", "\r\n", '"', '\\"', " x ", "\\e", "\\\\e", ",", "\\\\", "é\\r"])
def test_text_comes_back(spark, tmp_path, text):
    day = [(None if f.name != "host_name" else text) for f in schemas.RUN_DAYS.fields]
    given = spark.createDataFrame([tuple(day)], schemas.RUN_DAYS)
    path = tables.write_history_csv(given, str(tmp_path), "2024-01-01")
    assert [r.host_name for r in tables.read_history_csv(spark, path).collect()] == [text]
    files = [name for name in os.listdir(path) if name.endswith(".csv")]
    # A header in each file, and one line for the one row.
    lines = 0
    for name in files:
        with open(f"{path}/{name}", newline="") as file:
            lines += len(file.read().splitlines())
    assert lines == len(files) + 1


def test_a_repeated_publication_enters_once(spark, sf_dir, tmp_path):
    path, companies = str(tmp_path / "registry"), v.companies(spark, sf_dir)
    for end in ("2024-01-19", "2024-01-20", "2024-01-20"):
        entered = update_registry(spark, path, companies, end, v.LATEST)
    assert entered.count() == 2 * (companies.count() + 1) == entered.select("run_id").distinct().count()
    assert {r.name for r in tables.with_tag(entered, v.LATEST).collect()} == {"Tables_2024-01-20"}
    assert q.registry_update(spark, sf_dir).count() > entered.count()
