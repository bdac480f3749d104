"""Sinks. Distributed tables go through Spark's committer; small driver files are renamed into place."""

from __future__ import annotations

import csv
import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str) -> int:
    """Replace path by df as JSON lines; the number of rows, counted on the way."""
    seen = Observation("rows")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return seen.get["n"]


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def replace_sources(df: DataFrame, path: str) -> None:
    """Write records by source; only the sources in df are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path)


def atomic_write(path: str | Path, data: bytes) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    fd, name = tempfile.mkstemp(dir=path.parent)
    with os.fdopen(fd, "wb") as f:
        f.write(data)
        f.flush()
        os.fsync(f.fileno())
    os.replace(name, path)


def write_json(path: str | Path, value: object) -> None:
    atomic_write(path, json.dumps(value, ensure_ascii=False, indent=1, sort_keys=True).encode())


def read_json(path: str | Path, default: object = None) -> object:
    """The value at path; default if it is missing or broken."""
    try:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return default


def history_row(values: dict[str, object], columns: tuple[str, ...]) -> dict[str, str]:
    """Numbers with four decimals, nulls as empty strings."""
    return {c: "" if (v := values.get(c)) is None else f"{v:.4f}" if isinstance(v, float) else str(v) for c in columns}


def write_history(path: str | Path, rows: list[dict[str, str]], columns: tuple[str, ...]) -> None:
    import io

    out = io.StringIO(newline="")
    writer = csv.DictWriter(out, columns)
    writer.writeheader()
    writer.writerows(rows)
    atomic_write(path, out.getvalue().encode())


def read_history(path: str | Path) -> list[dict[str, str]]:
    try:
        with open(path, newline="", encoding="utf-8") as f:
            return list(csv.DictReader(f))
    except OSError:
        return []


def markdown(rows: list[dict], columns: list[str]) -> str:
    """A table of collected aggregates."""
    show = lambda v: "-" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v)
    return "\n".join(["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns), *("| " + " | ".join(show(r.get(c)) for c in columns) + " |" for r in rows)])


#: LaTeX's special characters.
LATEX = {"\\": r"\textbackslash{}", "&": r"\&", "%": r"\%", "$": r"\$", "#": r"\#", "_": r"\_", "{": r"\{", "}": r"\}", "~": r"\textasciitilde{}", "^": r"\textasciicircum{}"}


def latex(rows: list[dict], columns: list[str]) -> str:
    esc = lambda v: "".join(LATEX.get(c, c) for c in str("--" if v is None else f"{v:.3f}" if isinstance(v, float) else v))
    return "\n".join([f"\\begin{{tabular}}{{{'l' * len(columns)}}}", " & ".join(map(esc, columns)) + r" \\", r"\midrule", *(" & ".join(esc(r.get(c)) for c in columns) + r" \\" for r in rows), r"\end{tabular}"])
