"""Recording headers: ``key=value`` text, one file per recording.

Rules:

* a line must split on ``=`` into exactly two fields; a blank line or a
  second ``=`` rejects the file;
* lines starting with ``#`` are comments;
* a repeated key keeps its last value;
* ``start_ts`` and the integers ``num_samples sample_freq num_channels adm_id
  rec_id duration_in_sec`` are mandatory and must parse, else reject;
* ``elec_names`` is required; its first and last character are dropped;
* ``conversion_factor`` (float) and ``sample_bytes`` (int) are optional and
  become NULL when they do not parse;
* ``pat_id`` is ignored (the patient comes from the directory);
* other keys are kept as text in ``extra``.

A rejected file becomes one ``rejects`` row listing every reason found.

Plan: the file row holds everything; a value is cut out behind the last mention of its
key. No line is exploded, grouped or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.functions.electrodes import parse_electrode_list, strip_brackets
from recspark.functions.paths import data_file_of, dataset_dir, dataset_of_dir, patient_of_path
from recspark.functions.timefmt import parse_ts
from recspark.schemas import HEADER_INT_KEYS

KNOWN_KEYS = ("start_ts", *HEADER_INT_KEYS, "elec_names", "conversion_factor",
              "sample_bytes", "pat_id")


def read_header_files(spark: SparkSession, pattern: str) -> DataFrame:
    """``(path, text)`` for every header matched by a glob such as
    ``<root>/*/pat_*/adm_*/rec_*/*.head``. One small file per row."""
    return (spark.read.option("wholetext", True).text(pattern)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def _reason(cond: Column, text: str) -> Column:
    return F.when(cond, F.lit(text))


def once(*columns: Column) -> Column:
    """A struct that is computed once per row: a one-element explode keeps the
    optimizer from copying the expressions into every place that uses them."""
    return F.explode(F.array(F.struct(*columns)))


LINE_START, LINE_END = r"(?<![^\n])", r"(?![^\n])"
# a line that is no comment and has no "=", or more than one
BAD_LINE = LINE_START + r"(?!#)(?:[^=\n]*" + LINE_END + r"|[^=\n]*=[^=\n]*=)"
# key=value with a key that is none of the known ones
OTHER_PAIR = (LINE_START + r"(?!#)(?!(?:" + "|".join(KNOWN_KEYS) + r")=)([^=\n]*=[^=\n]*)"
              + LINE_END)


def _last_value(text: Column, key: str) -> Column:
    """Value of the last line ``key=value``; NULL without one, '' for an empty value.

    The last line that begins with the key is cut out of the text; only if it holds
    a second ``=`` a pattern looks for the last good one.
    """
    mark = F.lit(f"\n{key}=")
    lines = F.concat(F.lit("\n"), text)
    value = F.substring_index(F.substring_index(lines, f"\n{key}=", -1), "\n", 1)
    earlier = F.regexp_extract(text, r"(?s)\A(?:.*\n)?" + key + r"(=[^=\n]*)" + LINE_END, 1)
    return (F.when(~F.contains(lines, mark), F.lit(None))
            .when(~F.contains(value, F.lit("=")), value)
            .when(earlier != "", F.substr(earlier, F.lit(2))))


def _file_fields(headers: DataFrame, text_col: str, path_col: str) -> DataFrame:
    """One row per file: the last value of every known key, the bad line
    numbers, the other pairs and the file's text.

    Only a file that has a bad line is cut into lines to number them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = headers.select(
        F.col(path_col).alias("_path"), F.length(text).alias("_len"),
        # a final newline does not make an extra (blank) line
        once(F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), r"\n\z", "")
              .alias("_text")).alias("_x")).select("_path", "_len", "_x._text")
    text = F.col("_text")
    numbered = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(
        (i + 1).alias("_n"), x.alias("_raw")))
    bad = F.filter(numbered, lambda e: ~e["_raw"].startswith("#") & (
        F.length(e["_raw"]) - F.length(F.replace(e["_raw"], F.lit("="), F.lit(""))) != 1))
    return df.select("_path", "_len", "_text", once(
        *[_last_value(text, k).alias(k) for k in KNOWN_KEYS],
        F.when((F.col("_len") > 0) & text.rlike(BAD_LINE), F.transform(bad, lambda e: e["_n"]))
        .otherwise(F.array().cast("array<int>")).alias("_bad_lines"),
        F.transform(F.regexp_extract_all(text, F.lit(OTHER_PAIR), 1), lambda x, i: F.struct(
            i.alias("_n"), F.substring_index(x, "=", 1).alias("_k"),
            F.substring_index(x, "=", -1).alias("_v"))).alias("_other")).alias("_x")
    ).select("_path", "_len", "_text", "_x.*")


def parse_headers(headers: DataFrame, text_col: str = "text", path_col: str = "path"
                  ) -> tuple[DataFrame, DataFrame]:
    """S3 + Q1: ``(recordings, rejects)`` from ``(path, text)`` rows."""
    df = _file_fields(headers, text_col, path_col)
    raw = {k: F.col(k) for k in KNOWN_KEYS}
    ints = {k: raw[k].try_cast("int") for k in HEADER_INT_KEYS}
    ints["num_samples"] = raw["num_samples"].try_cast("bigint")
    ints["rec_id"] = raw["rec_id"].try_cast("bigint")
    start_ts = parse_ts(F.trim(raw["start_ts"]))

    reasons = [_reason(F.col("_len") == 0, "empty file")]
    for k in ("start_ts", *HEADER_INT_KEYS, "elec_names"):
        reasons.append(_reason(raw[k].isNull(), f"missing {k}"))
    reasons.append(_reason(raw["start_ts"].isNotNull() & start_ts.isNull(), "bad start_ts"))
    for k in HEADER_INT_KEYS:
        reasons.append(_reason(raw[k].isNotNull() & ints[k].isNull(), f"bad int {k}"))
    bad_lines = F.transform("_bad_lines", lambda n: F.concat(
        F.lit("line "), n.cast("string"), F.lit(": not key=value")))
    all_reasons = F.array_compact(F.concat(bad_lines, F.array(*reasons)))

    # other keys, last value wins
    last_other = F.filter("_other", lambda e: ~F.exists(
        "_other", lambda x: (x["_k"] == e["_k"]) & (x["_n"] > e["_n"])))
    extra = F.map_from_entries(F.transform(
        last_other, lambda e: F.struct(e["_k"].alias("k"), e["_v"].alias("v"))))

    path = F.col("_path")
    data_file = data_file_of(path)
    elec = strip_brackets(raw["elec_names"])
    parsed = df.select(
        F.xxhash64(data_file).alias("recording_id"),
        patient_of_path(path).alias("patient_id"),
        dataset_of_dir(dataset_dir(path)).alias("dataset_name"),
        start_ts.alias("start_ts"),
        ints["num_samples"].alias("num_samples"),
        ints["sample_freq"].alias("sample_freq"),
        raw["conversion_factor"].try_cast("double").alias("conversion_factor"),
        ints["num_channels"].alias("num_channels"),
        elec.alias("elec_names"),
        parse_electrode_list(elec).alias("electrodes"),
        ints["adm_id"].alias("adm_id"),
        ints["rec_id"].alias("rec_id"),
        ints["duration_in_sec"].alias("duration_in_sec"),
        raw["sample_bytes"].try_cast("int").alias("sample_bytes"),
        data_file.alias("data_file"),
        extra.alias("extra"),
        path.alias("_path"), F.col("_text").alias("_raw"), all_reasons.alias("_reasons"))
    good = parsed.where(F.size("_reasons") == 0).drop("_path", "_raw", "_reasons")
    rejects = parsed.where(F.size("_reasons") > 0).select(
        F.lit("header").alias("source"), F.col("_path").alias("path"),
        F.lit(None).cast("int").alias("line_no"), F.col("_raw").alias("raw"),
        F.col("_reasons").alias("reasons"))
    return good, rejects
