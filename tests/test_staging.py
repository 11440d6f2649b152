"""Queries over the rendered signal load, on a few events of their own."""

import pathlib
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.plans import catalog, recordings


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two users with 40 and 7 events; one error, so some chunks are in a seizure."""
    root = str(tmp_path_factory.mktemp("tables"))
    start = datetime(2024, 1, 1)
    rows = [(u * 100 + i, start + timedelta(minutes=i), u, "error" if i == 5 else "view",
             float(i + u), "{}") for u, n in ((1, 40), (2, 7)) for i in range(n)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, "
                                "event_type string, value double, props string"
                          ).write.parquet(f"{root}/events.parquet")
    return root


@pytest.mark.parametrize("name", ["signal_norm", "bad_recordings", "signal_chunks", "signal_index"])
def test_payloads_are_not_staged(spark, tables, monkeypatch, name):
    made = []

    def path(session, what):
        made.append((what, scratch_path(session, what)))
        return made[-1][1]

    scratch_path = catalog.scratch_path
    monkeypatch.setattr(catalog, "scratch_path", path)
    assert catalog.REGISTRY[name](spark, tables).count() > 0
    staged = [p for what, p in made if what == "signal-staging"]
    assert len(staged) == 1 and "data" not in spark.read.parquet(staged[0]).columns


def test_load_replace_stores_payloads_once(spark, tables, monkeypatch):
    """Payloads lie in the store's own files and nowhere else."""
    made, scratch_path = [], catalog.scratch_path

    def path(session, what):
        made.append((what, scratch_path(session, what)))
        return made[-1][1]

    monkeypatch.setattr(catalog, "scratch_path", path)
    rows = catalog.REGISTRY["load_replace"](spark, tables).collect()
    assert "signal-staging" not in {what for what, _ in made}
    # user 2 was loaded again with annotations: 7 events, one of them an error
    total = {}
    for r in rows:
        total[r.rec_id] = total.get(r.rec_id, 0) + r.n_chunks
    assert total == {100000: 40 * 3, 200000: 7 * 3}
    assert {r.seizure_state for r in rows if r.rec_id == 100000} == {0}
    assert {r.seizure_state for r in rows if r.rec_id == 200000} != {0}


def test_rendering_is_dealt_to_all_cores(spark, tables):
    dealt = recordings.dealt_events(spark, tables, 600)
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert dealt.count() == 47
    root = recordings.render_recordings(spark, tables)
    with open(f"{root.removeprefix('file:')}/inv/pat_1/adm_11/rec_100000/100000_0000.data",
              "rb") as f:
        got = np.frombuffer(f.read(), "<u2").reshape(-1, 3)
    freq = 512  # user 1, recording 0
    assert len(got) == 40 * freq
    for row in (0, 100, 39 * freq + 7):
        amp = (row // freq + 1 + 1) * 200
        for c in range(3):
            place = (row % freq * 3 * (c + 1) * (4096 // freq) + c * 512) % 4096
            assert got[row, c] == 30000 + amp * (abs(place - 2048) - 1024) // 1024


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """16 users with 7 to 9 events each, every fifth an error."""
    root = str(tmp_path_factory.mktemp("many"))
    start = datetime(2024, 1, 1)
    rows = [(u * 100 + i, start + timedelta(minutes=7 * i + u), u, "view" if i % 5 else "error",
             float(3 * i + u), "{}") for u in range(1, 17) for i in range(7 + u % 3)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, "
                                "event_type string, value double, props string"
                          ).write.parquet(f"{root}/events.parquet")
    return root


@pytest.mark.parametrize("name", ["signal_chunks", "load_replace", "signal_norm",
                                  "binary_roundtrip"])
def test_recordings_are_rendered_in_waves(spark, many, monkeypatch, name):
    """However many recordings there are, a bounded part of their samples is on disk, and
    the result is that of one tree of all."""
    def result():
        df = catalog.REGISTRY[name](spark, many)
        return sorted(map(str, df.drop("recording_id").collect()))  # it follows the path

    whole = result()
    limit, trees, held = 200_000, [], []

    def tree(session, root):
        trees.append(pathlib.Path(root.removeprefix("file:")))
        held.append(sum(f.stat().st_size for f in trees[-1].rglob("*.data")))
        return parse(session, root)

    parse = catalog._tree
    monkeypatch.setattr(catalog, "_tree", tree)
    monkeypatch.setattr(recordings, "WAVE_BYTES", limit)
    assert result() == whole
    assert len(held) > 2 and 0 < max(held) <= limit
    assert len(set(trees)) == 1 and not trees[0].exists()


def test_waves_of_a_large_user(spark, many, monkeypatch):
    """Runs of a user's recordings lie in several waves, each recording in one."""
    monkeypatch.setattr(recordings, "WAVE_BYTES", 100_000)
    monkeypatch.setattr(recordings, "TOGETHER", 1)
    monkeypatch.setattr(recordings, "_STAGED", {})
    found, root = [], catalog.scratch_path(spark, "recordings")
    for tree in recordings.rendered_waves(spark, many, root, None, 3):
        found.append({p.name for p in pathlib.Path(tree.removeprefix("file:")).rglob("*.data")})
    names = [n for f in found for n in f]
    assert len(names) == len(set(names)) == 16 * 3
    assert any(len({n for n in names if n.startswith(f"{u}0000")} & f) not in (0, 3)
               for u in range(1, 17) for f in found)
    odd = F.col("user_id") % 2 == 1
    some = [p.name for t in recordings.rendered_waves(spark, many, root, odd, 3)
            for p in pathlib.Path(t.removeprefix("file:")).rglob("*.data")]
    assert len(some) == 8 * 3
