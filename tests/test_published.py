"""Stages published as a whole, content keys, profiles merged from chunks."""

import pytest
from pyspark.sql import functions as F

from ledgerlens import schema
from ledgerlens.operators import features as fe, partials, profile
from ledgerlens.plans import fixture, runner
from ledgerlens.sources import publish, stages
from ledgerlens.sources.transactions import SHARED, content_keys, read_transactions

SF = "/root/testdata/sf0.001"


def _csv(spark, path, mode="errorifexists"):
    fixture.transactions(spark, SF).select(*schema.CSV_SCHEMA.names).write.mode(mode).option("header", True).csv(path)


def test_a_step_that_dies_leaves_the_old_stage_whole(spark, tmp_path, monkeypatch):
    source, work = str(tmp_path / "csv"), str(tmp_path / "work")
    _csv(spark, source)
    assert all(runner.run_step(spark, n, source, work)["success"] for n in (1, 2))
    before = {r["name"]: r["path"] for r in publish.manifest(spark, work).collect()}
    rows = sorted(map(repr, stages.read_features(spark, work).collect()))

    def die(table):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:  # the features are written by then, their manifest is not
        broken.setattr(fe, "engineer_features", lambda loaded, stats: loaded.selectExpr("tx_id", "1 as other"))
        broken.setattr(fe, "feature_manifest", die)
        assert "lost" in runner.run_step(spark, 2, source, work)["error"]
    assert {r["name"]: r["path"] for r in publish.manifest(spark, work).collect()} == before
    assert sorted(map(repr, stages.read_features(spark, work).collect())) == rows
    assert runner.run_step(spark, 2, source, work)["success"]
    after = {r["name"]: r["path"] for r in publish.manifest(spark, work).collect()}
    assert after["features"] != before["features"] and after["loaded"] == before["loaded"]


def test_steps_with_the_same_inputs_are_not_run_again(spark, tmp_path, monkeypatch):
    source, work, ran = str(tmp_path / "csv"), str(tmp_path / "work"), []
    _csv(spark, source)
    monkeypatch.setattr(runner, "STEPS", [
        (name, lambda s, src, w, settings, name=name: (ran.append(name), stages.write_table(s.range(3), w, name)))
        for name, _ in runner.STEPS])

    def run(**how):
        ran.clear()
        log = runner.run_all(spark, source, work, **how).collect()
        assert len(log) == 5 and all(r["success"] for r in log)
        return list(ran)

    names = ["load", "features", "split", "search", "train"]
    assert run() == names and run() == [] and run(reuse=False) == names
    assert run(settings=runner.Settings(seed=7)) == names
    _csv(spark, source, "append")  # more files
    assert run(settings=runner.Settings(seed=7)) == names
    runner.run_step(spark, 4, source, work, runner.Settings(seed=7))  # a new version of the search
    assert run(settings=runner.Settings(seed=7)) == ["train"]


def test_tables_outside_a_publication_keep_plain_folders(spark, tmp_path):
    work = str(tmp_path)
    stages.write_table(spark.range(2), work, "t")
    assert publish.locate(spark, work, "t") == f"{work}/t" and publish.manifest(spark, work).count() == 0
    with publish.publication(spark, work, "empty"):
        pass
    assert publish.current(spark, work) == {}
    with publish.publication(spark, work, "s", "i"):
        stages.write_table(spark.range(5), work, "t")
        assert stages.read_table(spark, work, "t").count() == 5
    assert stages.read_table(spark, work, "t").count() == 5 and publish.current(spark, work)["s"][1] == "i"


@pytest.mark.parametrize("most", [0, 1_000])
def test_content_keys(spark, most):
    df = spark.range(1000).selectExpr("if(id < 700, 0, id) as a", "if(id % 2 = 0, null, 'x') as b")
    keyed = [content_keys(d, most=most).collect() for d in (df, df.repartition(7), df.coalesce(1))]
    assert all(sorted(map(repr, k)) == sorted(map(repr, keyed[0])) for k in keyed)
    keys = [r.tx_id for r in keyed[0]]
    assert len(set(keys)) == 1000 and min(keys) >= 0
    assert sorted(k for k in keys if k >= SHARED) == [SHARED + i for i in range(700)]
    assert {r.a for r in keyed[0] if r.tx_id >= SHARED} == {0}
    assert sorted((r.a, r.b or "") for r in keyed[0]) == sorted((r.a, r.b or "") for r in df.collect())
    assert content_keys(df.limit(0)).count() == 0


def test_content_keys_move_hashes_only(spark, tmp_path):
    _csv(spark, str(tmp_path / "csv"))
    rows = read_transactions(spark, str(tmp_path / "csv"), keys="content")
    assert rows.columns[0] == "tx_id" and rows.count() == fixture.transactions(spark, SF).count()
    alone = content_keys(spark.range(50).selectExpr("id as a", "cast(id as string) as b"))
    plan = alone._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "rightHint=(strategy=broadcast)" in plan


CHUNKS = ["a", "b", "c", "d"]


def test_merged_states_give_the_profile_of_the_whole(spark, tmp_path):
    tx, work = fixture.transactions(spark, SF), str(tmp_path)
    tx = tx.unionByName(tx.where("step % 5 = 0").withColumn("tx_id", tx.tx_id + 10 ** 9))  # repeated rows in other chunks
    for i, name in enumerate(CHUNKS):
        assert partials.store_chunk(tx.where(f"pmod(xxhash64(tx_id), 4) = {i}"), work, name)
    assert not partials.store_chunk(tx, work, "b")  # is there already
    partials.state_of(tx).rows.write.parquet(f"{work}/rows/folder=cdead")  # left by a run that died
    state = partials.merged(spark, work)
    assert partials.profile_of(state).first() == profile.dataset_profile(tx).first()
    assert sorted(partials.numeric_profile_of(state).collect()) == sorted(profile.numeric_profile(tx).collect())
    assert partials.type_counts_of(state).collect() == profile.type_counts(tx).collect()
    one, two = partials.state_of(tx.where("step < 9")), partials.state_of(tx.where("step >= 9"))
    assert partials.profile_of(partials.merge([two, one])).first() == profile.dataset_profile(tx).first()


def test_merged_states_of_no_rows(spark, tmp_path):
    tx = fixture.transactions(spark, SF).limit(0)
    with pytest.raises(ValueError, match="no chunk"):
        partials.merged(spark, str(tmp_path))
    partials.store_chunk(tx, str(tmp_path), "none")
    got = partials.profile_of(partials.merged(spark, str(tmp_path))).first()
    assert (got.total_rows, got.fraud_rate, got.amount_stats.median, got.data_quality.duplicates) == (0, None, None, 0)


def test_rows_of_few_contents_are_numbered_by_many_tasks(spark):
    rows = content_keys(spark.range(400_000).selectExpr("id % 2 as a"))
    per_task = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 400_000 and max(per_task) <= 200_000
    assert rows.agg(F.countDistinct("tx_id")).first()[0] == 400_000
