"""Path-encoded keys.

Layout: ``<root>/{inv|surf30}/pat_<id>/adm_<id>/rec_<id>/<n>.head`` with the
raw samples next to the header as ``<n>.data`` and the annotation list at
``<root>/<dataset dir>/pat_<id>/seizure_list``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recspark.functions.timefmt import col_
from recspark.schemas import DATASET_DIR_SUFFIXES


def data_file_of(head_path) -> Column:
    """H9: ``x.head`` -> ``x.data``."""
    return F.regexp_replace(col_(head_path), r"\.head$", ".data")


def dataset_dir(path) -> Column:
    """The directory component directly above ``pat_*``."""
    return F.regexp_extract(col_(path), r"([^/]+)/pat_[^/]*", 1)


def dataset_of_dir(dirname) -> Column:
    """A directory ending ``inv`` is dataset ``inv``, ``surf30`` is ``surf``; else NULL."""
    d = col_(dirname)
    expr = None
    for suffix, name in DATASET_DIR_SUFFIXES:
        cond = d.endswith(suffix)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def patient_of_path(path) -> Column:
    """The trailing digits of the ``pat_*`` directory; NULL without digits."""
    digits = F.regexp_extract(col_(path), r"/pat_[^/]*?(\d+)(/|$)", 1)
    return F.nullif(digits, F.lit("")).try_cast("int")
