"""The run-everything job, the CLI and the session helpers."""

from __future__ import annotations

import os
import tempfile

from marquee import operators as Q
from marquee.plans.job import run_all, shared
from marquee.plans.registry import QUESTION_KEYS, REGISTRY, present
from marquee.session import apply_scale_conf, checkpoint_dir

SHARING = (
    "top_titles_by_votes",
    "top_titles_per_year",
    "titles_per_year",
    "youngest_actors",
    "worst_rated_actors",
    "most_improved_people",
    "actors_by_genre_count",
    "people_by_rating_spread",
    "longest_careers",
)


def test_shared_relations_give_equal_results(spark, small_catalog):
    with shared(small_catalog, credits=True) as cat:
        for key in SHARING:
            a = present(REGISTRY[key].build(small_catalog))
            b = present(REGISTRY[key].build(cat))
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, key


def test_shared_credits_keep_multiplicity_of_repeated_titles(spark):
    from marquee.plans.verify import _rows

    from .minicat import random_rows, to_catalog

    rows = random_rows(5)
    rows["titles"] = rows["titles"] + rows["titles"][:10]  # repeated titles must not repeat Q9's credits
    rows["ratings"] = rows["ratings"] + rows["ratings"][:5]
    plain = to_catalog(spark, rows)
    with shared(plain, credits=True) as cat:
        for fn, params in (
            (Q.worst_rated_actors, dict(min_credits=3)),
            (Q.most_improved_people, {}),
            (Q.actors_by_genre_count, {}),
            (Q.longest_careers, {}),
            (Q.people_by_rating_spread, dict(n=50)),
        ):
            a, b = present(fn(plain, **params)), present(fn(cat, **params))
            assert _rows(a.collect(), a.columns) == _rows(b.collect(), b.columns), fn.__name__


def test_shared_tables_are_dropped(spark, small_catalog):
    before = {t.name for t in spark.catalog.listTables()}
    for credits, tables in ((False, 1), (True, 2)):
        with shared(small_catalog, credits=credits):
            assert len({t.name for t in spark.catalog.listTables()} - before) == tables
    assert {t.name for t in spark.catalog.listTables()} == before


def test_building_a_question_runs_no_job_and_writes_nothing(spark, small_catalog):
    from marquee.session import SCALE_CONF

    root = checkpoint_dir(spark).removeprefix("file:")
    files = lambda: sum(len(f) for _, _, f in os.walk(root))
    tracker = spark.sparkContext.statusTracker()
    old = {k: spark.conf.get(k, None) for k in SCALE_CONF}
    try:
        for conf in ({}, SCALE_CONF):
            for k, v in conf.items():
                spark.conf.set(k, v)
            spark.sparkContext.setJobGroup("build", "building only")
            n = files()
            for key, spec in REGISTRY.items():
                if not key.startswith("tsv_"):  # these write what they read back
                    spec.build(small_catalog)
            assert list(tracker.getJobIdsForGroup("build")) == [] and files() == n
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_run_all_writes_every_question_with_its_types(spark, small_catalog):
    out = tempfile.mkdtemp(prefix="results-")
    paths = run_all(small_catalog, out, reference_params=False)
    assert list(paths) == QUESTION_KEYS
    for key, path in paths.items():
        want = REGISTRY[key].build(small_catalog)
        got = spark.read.parquet(path)
        assert got.count() == want.count(), key
        assert got.dtypes == want.dtypes, key
    assert dict(spark.read.parquet(paths["top_genre_set_per_decade"]).dtypes)["genres"] == "array<string>"


def test_printed_and_written_results_come_from_one_computation(spark, small_catalog, capsys):
    out = tempfile.mkdtemp(prefix="results-")
    path = run_all(small_catalog, out, keys=["credits_per_name_and_title"], rows=5)["credits_per_name_and_title"]
    counts = [int(line.split("|")[3]) for line in capsys.readouterr().out.splitlines() if line.startswith("|") and "Title " in line]
    best = [r["count"] for r in spark.read.parquet(path).orderBy("count", ascending=False).limit(5).collect()]
    assert counts == best  # Q4's most frequent rows, in order
    assert spark._jsc.sc().getPersistentRDDs().isEmpty()  # read from what was written, not cached


def test_cli_runs_every_question_on_tsv(spark, small_catalog, capsys):
    from marquee.__main__ import main
    from marquee.sources import save_tsv

    tmp = save_tsv(small_catalog, tempfile.mkdtemp(prefix="cli-"))
    main([tmp, "--rows", "3", "--share"])
    text = capsys.readouterr().out
    assert text.count("\nQ") + text.startswith("Q") == 25


class _StubContext:
    def __init__(self, master, configured=None):
        self.master = master
        self._dir = None
        self._configured = configured

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d

    def getConf(self):
        return {"spark.checkpoint.dir": self._configured} if self._configured else {}


class _StubConf:
    def get(self, key, default=None):
        return default


class _StubSession:
    def __init__(self, master, configured=None):
        self.sparkContext = _StubContext(master, configured)
        self.conf = _StubConf()


def test_checkpoint_dir_is_the_clusters_and_never_machine_local_there():
    import pytest

    # a cluster with a shared folder: that folder is used as is
    assert checkpoint_dir(_StubSession("yarn", "hdfs://nn/ckpt")) == "hdfs://nn/ckpt"
    # a cluster without one: an error, not a machine-local temp folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_StubSession("spark://master:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_StubSession("local-cluster[2,1,1024]"))
    # local mode (tests, bench): a fresh temp folder
    assert os.path.isdir(checkpoint_dir(_StubSession("local[2]")))


def test_scale_conf_fills_only_what_is_unset(spark):
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    mine = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(mine, "32m")
    try:
        done = apply_scale_conf(spark)
        assert mine not in done and spark.conf.get(mine) == "32m"
        assert spark.conf.get(key) == "true"
    finally:
        for k in [*done, mine]:
            spark.conf.unset(k)
