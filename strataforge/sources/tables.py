"""Parquet tables: guarded scans, ordered sinks, reports, identities."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from dataclasses import asdict, fields, is_dataclass
from pathlib import Path
from typing import Any, TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.operators.audit import schema_differences

C = TypeVar("C")


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, rows: int | None = None, contract: dict[str, str] | None = None) -> DataFrame:
    """A Parquet scan that checks before it reads: the exact schema of ``contract``, then the number of rows; columns are pruned."""
    df = spark.read.parquet(path)
    if contract is not None and (wrong := schema_differences(df, contract)):
        raise ValueError(f"{path}: {'; '.join(wrong)}")
    if rows is not None and (n := df.count()) != rows:  # Parquet footers alone
        raise ValueError(f"{path}: {n} rows, expected {rows}")
    return df.select(*columns) if columns else df


def write_ordered(df: DataFrame, path: str, single_file: bool = False, replace: bool = False) -> None:
    """Writes zstd Parquet with rows in order of all columns by name, range-partitioned unless one file is asked for."""
    order = sorted(df.columns)
    dealt = df.repartition(1) if single_file else df.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.mode("overwrite" if replace else "errorifexists").option("compression", "zstd").parquet(path)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share; one of its own only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"file://{tempfile.mkdtemp(prefix='strataforge-')}"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def widened_union(parts: list[DataFrame]) -> DataFrame:
    """Union by name with numeric types widened; columns that a part lacks are null there, and untyped nulls become text."""
    rank = ["tinyint", "smallint", "int", "bigint", "float", "double"]
    types: dict[str, str] = {}
    for p in parts:
        for c, t in p.dtypes:
            t = "string" if t == "void" else t
            have = types.get(c)
            if have is None or have == t:
                types[c] = t
            elif have in rank and t in rank:
                types[c] = rank[max(rank.index(have), rank.index(t))]
            else:
                types[c] = "string"
    out = None
    for p in parts:
        have = set(p.columns)
        one = p.select(*((F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in types.items()))
        out = one if out is None else out.unionByName(one)
    return out


def report_json(metrics: DataFrame) -> str:
    """A metric table as a JSON document, rows in order of all columns."""
    rows = sorted((r.asDict() for r in metrics.collect()), key=lambda r: json.dumps(r, sort_keys=True, default=str))
    return json.dumps({"passed": all(r.get("passed", True) for r in rows), "metrics": rows}, indent=2, ensure_ascii=False, default=str)


def report_markdown(metrics: DataFrame, title: str) -> str:
    """A metric table as a Markdown document."""
    names = metrics.columns
    rows = sorted((tuple(r) for r in metrics.collect()), key=repr)
    line = lambda xs: "| " + " | ".join(str(x).replace("|", "\\|") for x in xs) + " |"
    return "\n".join([f"# {title}", "", line(names), line("---" for _ in names), *map(line, rows), ""])


def run_identity(**parameters: Any) -> str:
    """Identity of a run: SHA-256 of its parameters in canonical JSON, so that equal runs share a folder."""
    return hashlib.sha256(json.dumps(parameters, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def load_config(path: str, kind: type[C]) -> C:
    """A JSON document as a dataclass; unknown and missing fields are errors."""
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    if not is_dataclass(kind):
        raise TypeError("a dataclass is needed")
    known = {f.name for f in fields(kind)}
    if extra := sorted(set(data) - known):
        raise ValueError(f"unknown fields {extra}")
    return kind(**data)


def save_config(config: Any, path: str) -> None:
    Path(path).write_text(json.dumps(asdict(config), indent=2, sort_keys=True, ensure_ascii=False) + "\n", encoding="utf-8")


def share_at(document: Any, name: str) -> float | None:
    """First number under a key of this name, anywhere in a JSON document, depth first."""
    if isinstance(document, dict):
        if isinstance(document.get(name), int | float) and not isinstance(document[name], bool):
            return float(document[name])
        document = list(document.values())
    if isinstance(document, list):
        for x in document:
            if (found := share_at(x, name)) is not None:
                return found
    return None
