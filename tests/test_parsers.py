"""Header and annotation parsing with rejects."""

from recspark.sources.annotations import inline_annotations, parse_annotation_lines, text_lines
from recspark.sources.headers import parse_headers

GOOD = """start_ts=2008-11-03 20:34:03.000
num_samples=3686400
sample_freq=1024
conversion_factor=0.179000
num_channels=3
elec_names=[GA1,GA2,ECG]
pat_id=108402
adm_id=1084102
rec_id=108400102
duration_in_sec=3600
sample_bytes=2
"""


def _parse(spark, files):
    df = spark.createDataFrame(list(files.items()), "path string, text string")
    good, bad = parse_headers(df)
    return ({r["data_file"]: r for r in good.collect()},
            {r["path"]: r["reasons"] for r in bad.collect()})


def test_header_good_and_rejects(spark):
    files = {
        "/d/inv/pat_108402/adm_1/rec_1/good.head": GOOD,
        "/d/inv/pat_7/adm_1/rec_1/missing.head": GOOD.replace("num_channels=3\n", "")
        .replace("duration_in_sec=3600\n", ""),
        "/d/inv/pat_7/adm_1/rec_1/invalid.head": GOOD.replace("num_channels=3",
                                                              "num_channels=ninety-three"),
        "/d/inv/pat_7/adm_1/rec_1/empty.head": "",
        "/d/inv/pat_7/adm_1/rec_1/blank.head": GOOD.replace("sample_freq=1024\n",
                                                            "sample_freq=1024\n\n"),
        "/d/inv/pat_7/adm_1/rec_1/twoeq.head": GOOD.replace("rec_id=108400102", "rec_id=1=2"),
        "/d/inv/pat_7/adm_1/rec_1/badts.head": GOOD.replace("2008-11-03", "2008-96-03"),
        "/d/inv/pat_7/adm_1/rec_1/badcf.head": GOOD.replace("0.179000", "abc")
        + "# comment line\nsite=x\nsite=y\n",
        "/d/inv/pat_7/adm_1/rec_1/pylist.head": GOOD.replace("[GA1,GA2,ECG]",
                                                             "['GA1', 'GA2', 'ECG']"),
    }
    good, bad = _parse(spark, files)
    g = good["/d/inv/pat_108402/adm_1/rec_1/good.data"]
    assert g["patient_id"] == 108402 and g["num_samples"] == 3686400
    assert g["sample_freq"] == 1024 and g["num_channels"] == 3 and g["rec_id"] == 108400102
    assert abs(g["conversion_factor"] - 0.179) < 1e-12 and g["sample_bytes"] == 2
    assert g["elec_names"] == "GA1,GA2,ECG" and g["electrodes"] == ["GA1", "GA2", "ECG"]
    assert str(g["start_ts"]) == "2008-11-03 20:34:03" and g["dataset_name"] == "inv"
    cf = good["/d/inv/pat_7/adm_1/rec_1/badcf.data"]
    assert cf["conversion_factor"] is None and cf["extra"] == {"site": "y"}
    assert good["/d/inv/pat_7/adm_1/rec_1/pylist.data"]["electrodes"] == ["GA1", "GA2", "ECG"]
    assert set(good) == {"/d/inv/pat_108402/adm_1/rec_1/good.data",
                         "/d/inv/pat_7/adm_1/rec_1/badcf.data",
                         "/d/inv/pat_7/adm_1/rec_1/pylist.data"}
    p = "/d/inv/pat_7/adm_1/rec_1/"
    assert bad[p + "missing.head"] == ["missing num_channels", "missing duration_in_sec"]
    assert bad[p + "invalid.head"] == ["bad int num_channels"]
    assert "empty file" in bad[p + "empty.head"]
    assert bad[p + "blank.head"] == ["line 4: not key=value"]
    assert bad[p + "twoeq.head"] == ["line 9: not key=value", "missing rec_id"]
    assert bad[p + "badts.head"] == ["bad start_ts"]


def _lines(spark, text, patient=1):
    df = spark.createDataFrame([(f"/d/inv/pat_{patient}/seizure_list", text)],
                               "path string, text string")
    return parse_annotation_lines(text_lines(df))


def test_annotations_comments_blanks_and_rejects(spark):
    text = """# header
2008-11-04 10:19:42.000000 2008-11-04 10:20:10.000000 2000 3000

2008-11-04 11:00:00\t2008-11-04 11:00:30   4000 5000
2008-11-04 12:00:00.5 2008-11-04 12:00:30 4000
2008-96-04 12:00:00 2008-11-04 12:00:30 4000 5000
2008-11-04 13:00:00 2008-11-04 13:00:30 x 5000
"""
    good, bad = _lines(spark, text)
    rows = sorted(good.collect(), key=lambda r: r["onset"])
    assert len(rows) == 2 and rows[0]["onset_sample"] == 2000 and rows[0]["patient_id"] == 1
    assert str(rows[1]["onset"]) == "2008-11-04 11:00:00"
    reasons = {r["line_no"]: r["reasons"] for r in bad.collect()}
    assert reasons == {5: ["expected 6 fields, got 5"], 6: ["bad onset"],
                       7: ["bad onset_sample"]}


def test_inline_annotations(spark):
    text = "#onset offset\n\n2010-01-01 00:00:01\t2010-01-01 00:00:09\t1\t2\n"
    good, bad = parse_annotation_lines(inline_annotations(spark, text, 5), patient_col="patient_id")
    assert [r["patient_id"] for r in good.collect()] == [5] and bad.count() == 0


def test_header_values_by_last_good_line(spark):
    """Repeated keys, a later bad line of a key, CRLF, empty values, keys inside values."""
    base = ("start_ts=2022-01-01 00:00:00\nnum_samples=5\nsample_freq=512\nnum_channels=2\n"
            "elec_names=[A,B]\nadm_id=1\nrec_id=2\nduration_in_sec=3\n")
    texts = [base + "rec_id=9\nsite=a\nsite=b",
             (base + "note=\n# rec_id=7\nxrec_id=8\n").replace("\n", "\r\n"),
             base + "rec_id=4=5\n", base + "rec_id=\n", base + "\n", "\n", "", None,
             "rec_id=6\n" + base + "=x\n"]
    df = spark.createDataFrame([(f"/d/inv/pat_1/adm_1/rec_1/{i}.head", t)
                                for i, t in enumerate(texts)], "path string, text string")
    good, bad = parse_headers(df)
    rows = {r.data_file.split("/")[-1][0]: (r.rec_id, r.extra) for r in good.collect()}
    assert rows == {"0": (9, {"site": "b"}), "1": (2, {"note": "", "xrec_id": "8"}),
                    "8": (2, {"": "x"})}
    why = {r.path.split("/")[-1][0]: r.reasons for r in bad.collect()}
    assert why["2"] == ["line 9: not key=value"]
    assert why["3"] == ["bad int rec_id"]
    assert why["4"] == ["line 9: not key=value"]
    assert why["5"][0] == "line 1: not key=value" and "missing rec_id" in why["5"]
    assert why["6"][0] == why["7"][0] == "empty file"
