"""Column tags, masks by persona, row policies and the tag audit.

A secured view decides what its readers see. It is no security boundary: whoever can open the files
can read them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.functions import masks

TAG_KEY = "pii_classification"
GLOBAL_ROLES = ("GLOBAL_AUDITOR", "EXECUTIVE_ADMIN")

MASKS = {
    "SHA256": lambda c, t: masks.sha256_hex(c),
    "SHA256_BASE64": lambda c, t: masks.sha256_base64(c),
    "LAST_FOUR": lambda c, t: masks.last_four(c),
    "DEFAULT": masks.default_value,
    "ALWAYS_NULL": lambda c, t: masks.always_null(t),
    "EMAIL": lambda c, t: masks.email(c),
}


def tag_columns(df: DataFrame, tags: Mapping[str, str], key: str = TAG_KEY) -> DataFrame:
    """Attach a tag to columns; it travels in the schema's metadata."""
    for name, value in tags.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, key: value})
    return df


def column_tag(df: DataFrame, name: str, key: str = TAG_KEY) -> str | None:
    return df.schema[name].metadata.get(key)


@dataclass(frozen=True)
class TagPolicy:
    """Who reads a tag's columns as they are, and who reads them through which mask."""

    raw: frozenset[str] = frozenset()
    masked: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class RowGrant:
    personas: frozenset[str]
    predicate: Column


def visible_rows(persona: str, grants: Sequence[RowGrant]) -> Column:
    """Any of the persona's grants lets a row through; without one there are no rows."""
    mine = [g.predicate for g in grants if persona in g.personas]
    return reduce(lambda a, b: a | b, mine) if mine else F.lit(False)


def own_store_or_global(store: Column, caller_store: str, caller_role: str) -> Column:
    return (store == caller_store) | F.lit(caller_role).isin(*GLOBAL_ROLES)


def secured_view(
    df: DataFrame,
    persona: str,
    policies: Mapping[str, TagPolicy],
    grants: Sequence[RowGrant] | None = None,
    columns: Iterable[str] | None = None,
    key: str = TAG_KEY,
) -> DataFrame:
    """The table as one persona may read it. Rows are filtered on true values, then columns masked.

    Asking for a protected column without a grant raises ``PermissionError``.
    """
    wanted = list(columns or df.columns)
    denied, shown = [], []
    for name in wanted:
        policy = policies.get(column_tag(df, name, key))
        if policy is None or persona in policy.raw:
            shown.append(F.col(name))
        elif persona in policy.masked:
            shown.append(MASKS[policy.masked[persona]](F.col(name), df.schema[name].dataType).alias(name))
        else:
            denied.append(name)
    if denied:
        raise PermissionError(f"{persona} may not read {', '.join(denied)}")
    rows = df if grants is None else df.filter(visible_rows(persona, grants))
    return rows.select(*shown)


def field_rows(schema: T.StructType, prefix: str = "") -> list[tuple[str, str, bool, dict]]:
    """Every field of a schema, nested ones under dotted paths: path, type, nullable, metadata."""
    rows = []
    for f in schema.fields:
        path = prefix + f.name
        rows.append((path, f.dataType.simpleString(), f.nullable, f.metadata))
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if isinstance(inner, T.StructType):
            rows += field_rows(inner, path + ".")
    return rows


def tag_audit(spark: SparkSession, tables: Mapping[str, DataFrame], dataset: str = "gold", key: str = TAG_KEY) -> DataFrame:
    """Every tagged column of the given tables. Reads schemas only."""
    rows = [
        (dataset, name, path, dtype, key, meta[key])
        for name, df in tables.items()
        for path, dtype, _, meta in field_rows(df.schema)
        if key in meta
    ]
    schema = "dataset_id string, table_name string, column_name string, data_type string, tag_key string, tag_value string"
    return spark.createDataFrame(rows, schema).orderBy("table_name", "column_name")


def dataset_facts(tables: Mapping[str, tuple[DataFrame, str, str]], key: str = TAG_KEY) -> DataFrame:
    """Table type, owner, whether personal data is tagged, and rows; filter it like any table."""
    parts = []
    for name, (df, table_type, owner) in tables.items():
        tagged = [f for f in field_rows(df.schema) if key in f[3]]
        parts.append(
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                F.lit(table_type).alias("table_type"),
                F.lit(owner).alias("owner"),
                F.lit(bool(tagged)).alias("contains_pii"),
                F.lit(len(tagged)).alias("tagged_columns"),
                "row_count",
            )
        )
    return reduce(DataFrame.unionByName, parts)
