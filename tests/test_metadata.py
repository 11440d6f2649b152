"""The stored metadata tables: loads of what is new, replaced files, resets, earlier states."""

import os
import sys
from datetime import datetime, timedelta

sys.path.insert(0, os.path.dirname(__file__))
from fixtures import recording_tree, write_annotations, write_header  # noqa: E402

from recspark.operators import metadata as M  # noqa: E402

START = datetime(2022, 1, 1)


def recs(spark, path, **options):
    return sorted((r.patient_id, r.rec_id) for r in M.read_table(
        spark, path, "recordings", **options).collect())


def test_loads_of_new_and_changed_files(spark, tmp_path):
    root, path = f"{tmp_path}/a tree", f"{tmp_path}/store"
    recording_tree(root)
    os.makedirs(f"{root}/inv/pat_9/adm_1/rec_1")
    with open(f"{root}/inv/pat_9/adm_1/rec_1/notes.txt", "w") as f:
        f.write("a patient without a header or a list")
    one = M.load_tree(spark, root, path)
    assert recs(spark, path) == [(1, 101), (1, 102), (2, 201), (2, 202)]
    ids = {r.name: r.dataset_id for r in M.datasets(spark, path).collect()}
    assert ids == {"inv": 0, "surf": 1}
    assert sorted(tuple(r) for r in M.patients(spark, path).collect()) == [(1, 0), (2, 1), (9, 0)]
    assert M.read_table(spark, path, "annotations").count() == 1
    assert M.load_tree(spark, root, path) is None  # nothing new

    # a header changes, one breaks, a list grows, a recording comes
    base = f"{root}/inv/pat_1/adm_11"
    write_header(f"{base}/rec_101/101_0000.head", START, 1024, 1024, ["GA1"], rec_id=7)
    write_header(f"{base}/rec_102/102_0000.head", START, 1024, 1024, ["GA1"], drop=("adm_id",))
    write_header(f"{base}/rec_103/103_0000.head", START, 1024, 1024, ["GA1"], rec_id=103)
    t = START + timedelta(minutes=3)
    write_annotations(f"{root}/inv/pat_1/seizure_list", [(t, t), (t, t), (START, t)])
    write_annotations(f"{root}/inv/pat_8/seizure_list", [])
    two = M.load_tree(spark, root, path)
    assert two > one
    assert recs(spark, path) == [(1, 7), (1, 103), (2, 201), (2, 202)]
    assert [r.reasons for r in M.read_table(spark, path, "rejects").collect()] == [
        ["missing adm_id"]]
    assert M.read_table(spark, path, "annotations").count() == 2
    assert {r.patient_id for r in M.patients(spark, path).collect()} == {1, 2, 8, 9}
    # the earlier state, and a reset
    assert recs(spark, path, as_of=one) == [(1, 101), (1, 102), (2, 201), (2, 202)]
    M.reset(spark, path)
    assert recs(spark, path) == [] and M.patients(spark, path).count() == 0
    assert recs(spark, path, as_of=two) == [(1, 7), (1, 103), (2, 201), (2, 202)]
    M.load_tree(spark, root, path)  # after a reset everything is new
    assert recs(spark, path) == [(1, 7), (1, 103), (2, 201), (2, 202)]


def test_a_load_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    root, path = f"{tmp_path}/tree", f"{tmp_path}/store"
    recording_tree(root)

    def broken(*args, **options):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(M, "_commit", broken)
        try:
            M.load_tree(spark, root, path)
        except OSError:
            pass
    assert recs(spark, path) == [] and M.ledger(spark, path).count() == 0
    M.load_tree(spark, root, path)
    assert len(recs(spark, path)) == 4
    assert M.ledger(spark, path).count() == 10  # 4 headers, 4 data files, 2 lists
