"""Drift profile of landed documents: what shapes arrive, and where they depart from the contract.

Each document is parsed once as VARIANT; ``schema_of_variant`` names its shape (keys and types, the elements
of an array merged).  Documents of a feed share few shapes, so they are counted by feed, day and shape, combined
map-side, before anything else happens; only the distinct shapes are taken apart into
paths and held against the contract's.  Unlike the contract check, which judges values document by document,
this tells since when and how often a path is new, missing or of another type.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfhourly.sources.contracts import CONTRACTS, Arr, Leaf, Obj

#: JSON types that a contract's leaf is sent as.
SENT_AS = {"int": {"BIGINT"}, "long": {"BIGINT"}, "number": {"BIGINT", "DECIMAL", "DOUBLE"}, "bool": {"BOOLEAN"},
           "string": {"STRING"}, "instant": {"STRING"}, "naive": {"STRING"}}
_FINDINGS = "source string, path string, finding string, type_seen string, first_day date, last_day date, documents bigint"


def contract_paths(spec, path: str = "$") -> dict[str, tuple]:
    """path -> (types, may be null, required, open) of a contract."""
    if isinstance(spec, Arr):
        return {path: ({"ARRAY"}, spec.nullable, spec.required, False), **contract_paths(spec.item, f"{path}[]")}
    if isinstance(spec, Obj):
        out = {path: ({"OBJECT"}, spec.nullable, spec.required, spec.open)}
        for name, sub in spec.fields.items():
            out |= contract_paths(sub, f"{path}.{name}")
        return out
    assert isinstance(spec, Leaf)
    return {path: (SENT_AS[spec.kind], spec.nullable, spec.required, False)}


def shape_paths(shape: str, path: str = "$") -> dict[str, str]:
    """path -> type of a shape as ``schema_of_variant`` writes it, e.g. ``OBJECT<a: BIGINT, b: ARRAY<STRING>>``."""
    kind, _, inner = shape.partition("<")
    if kind not in ("OBJECT", "ARRAY"):
        return {path: kind.partition("(")[0]}
    inner, out = inner[:-1], {path: kind}
    if kind == "ARRAY":
        return out | (shape_paths(inner, f"{path}[]") if inner else {})
    depth, start, quoted = 0, 0, False
    for i, c in enumerate(inner + ","):
        if c == "`":
            quoted = not quoted
        elif not quoted and c in "<(":
            depth += 1
        elif not quoted and c in ">)":
            depth -= 1
        elif not quoted and c == "," and depth == 0:
            name, sub = _field(inner[start:i].strip())
            if name is not None:
                out |= shape_paths(sub, f"{path}.{name}")
            start = i + 1
    return out


def _field(text: str) -> tuple[str | None, str]:
    if text.startswith("`"):
        end = text.index("`: ", 1)
        return text[1:end].replace("``", "`"), text[end + 3:]
    name, _, sub = text.partition(": ")
    return (name or None), sub


def findings(shape: str | None, expected: dict[str, tuple]) -> list[tuple[str, str, str | None]]:
    """(path, finding, type seen) where a shape departs from a contract: unknown path, missing path, other type, not json."""
    if shape is None:
        return [("$", "not json", None)]
    seen, out = shape_paths(shape), []
    for path, kind in seen.items():
        parent = path.removesuffix("[]") if path.endswith("[]") else path.rpartition(".")[0]
        if path in expected:
            types, nullable, _, _ = expected[path]
            empty = kind == "VOID" and (nullable or path.endswith("[]"))  # an array without elements has no element type
            if kind not in types and not empty:
                out.append((path, "other type", kind))
        elif parent in expected and not expected[parent][3] and seen.get(parent) in expected[parent][0]:
            out.append((path, "unknown path", kind))  # what lies below an unknown path is not reported again
    for path, (_, _, required, _) in expected.items():
        parent = path.rpartition(".")[0]
        if required and path not in seen and not path.endswith("[]") and seen.get(parent) == "OBJECT":
            out.append((path, "missing path", None))
    return out


def shapes(documents: DataFrame) -> DataFrame:
    """(source, day, shape, documents): ``documents`` has source, payload and received_at."""
    shape = F.schema_of_variant(F.try_parse_json("payload"))
    return documents.groupBy("source", F.to_date("received_at").alias("day"), shape.alias("shape")).agg(
        F.count(F.lit(1)).cast("bigint").alias("documents"))


def profile(documents: DataFrame) -> DataFrame:
    """(source, path, finding, type_seen, first_day, last_day, documents) of every departure from the feeds' contracts."""
    counted = shapes(documents)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        expected = {source: contract_paths(spec) for source, spec in CONTRACTS.items()}
        for pdf in it:
            rows = [(r.source, *f, r.first_day, r.last_day, r.documents) for r in pdf.itertuples()
                    for f in findings(r.shape, expected[r.source])]
            yield pd.DataFrame(rows, columns=["source", "path", "finding", "type_seen", "first_day", "last_day", "documents"])
    found = counted.groupBy("source", "shape").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"),
                                                   F.sum("documents").alias("documents"))
    return found.mapInPandas(run, _FINDINGS).groupBy("source", "path", "finding", "type_seen").agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.sum("documents").cast("bigint").alias("documents"))
