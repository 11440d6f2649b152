"""Small deterministic recording trees written fresh for the tests."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import numpy as np


def write_header(path: str, start: datetime, num_samples: int, freq: int, channels: list[str],
                 pat_id: int = 0, adm_id: int = 1, rec_id: int = 1, duration: int = 0,
                 extra_lines: tuple[str, ...] = (), drop: tuple[str, ...] = ()) -> None:
    fields = {
        "start_ts": start.strftime("%Y-%m-%d %H:%M:%S.000"),
        "num_samples": str(num_samples), "sample_freq": str(freq),
        "conversion_factor": "0.179000", "num_channels": str(len(channels)),
        "elec_names": "[" + ",".join(channels) + "]", "pat_id": str(pat_id),
        "adm_id": str(adm_id), "rec_id": str(rec_id),
        "duration_in_sec": str(duration or num_samples // freq), "sample_bytes": "2",
    }
    lines = [f"{k}={v}" for k, v in fields.items() if k not in drop] + list(extra_lines)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def write_matrix(path: str, x: np.ndarray, extra_values: int = 0) -> None:
    """Row-major little-endian uint16 matrix, optionally with a partial last row."""
    data = np.asarray(x, dtype="<u2").reshape(-1)
    if extra_values:
        data = np.concatenate([data, np.full(extra_values, 7, dtype="<u2")])
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data.tofile(path)


def write_annotations(path: str, intervals: list[tuple[datetime, datetime]]) -> None:
    lines = ["# onset offset onset_sample offset_sample", ""]
    for i, (a, b) in enumerate(intervals):
        lines.append(f"{a:%Y-%m-%d %H:%M:%S.%f}\t{b:%Y-%m-%d %H:%M:%S}\t{i * 10}\t{i * 10 + 5}")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def sine_matrix(n: int, freq: int, channels: int, tone_hz: float, amp: float = 1000.0,
                offset: float = 30000.0) -> np.ndarray:
    t = np.arange(n) / freq
    cols = [offset + amp * (c + 1) * np.sin(2 * np.pi * tone_hz * t + c) for c in range(channels)]
    return np.round(np.stack(cols, axis=1))


def recording_tree(root: str, start=datetime(2022, 1, 1)) -> dict:
    """Two patients: pat_1 (inv, 3 channels, 1024 Hz, 20 s + a partial row;
    512 Hz, 12 s) with an annotation; pat_2 (surf30, 2 channels, 256 Hz, 10 s)
    plus a 200 Hz recording that must be quarantined."""
    inv = os.path.join(root, "inv", "pat_1")
    r1 = os.path.join(inv, "adm_11", "rec_101", "101_0000")
    write_header(r1 + ".head", start, 20 * 1024, 1024, ["GA1", "T", "ECG"], rec_id=101)
    write_matrix(r1 + ".data", sine_matrix(20 * 1024, 1024, 3, 10.0), extra_values=2)
    r2 = os.path.join(inv, "adm_11", "rec_102", "102_0000")
    write_header(r2 + ".head", start + timedelta(seconds=20), 12 * 512, 512,
                 ["GA1", "T", "ECG"], rec_id=102)
    write_matrix(r2 + ".data", sine_matrix(12 * 512, 512, 3, 5.0))
    write_annotations(os.path.join(inv, "seizure_list"),
                      [(start + timedelta(seconds=5), start + timedelta(seconds=8))])
    surf = os.path.join(root, "surf30", "pat_2")
    r3 = os.path.join(surf, "adm_21", "rec_201", "201_0000")
    write_header(r3 + ".head", start, 10 * 256, 256, ["FP1", "EKG"], rec_id=201)
    write_matrix(r3 + ".data", sine_matrix(10 * 256, 256, 2, 3.0))
    r4 = os.path.join(surf, "adm_21", "rec_202", "202_0000")
    write_header(r4 + ".head", start + timedelta(seconds=10), 10 * 200, 200, ["FP1", "EKG"],
                 rec_id=202)
    write_matrix(r4 + ".data", sine_matrix(10 * 200, 200, 2, 3.0))
    write_annotations(os.path.join(surf, "seizure_list"), [])
    return {"r1": r1, "r2": r2, "r3": r3, "r4": r4}
