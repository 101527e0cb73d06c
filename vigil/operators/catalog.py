"""Registered tables and their audit against the session's catalog (SRC-08, FLT-13, AUD-01).

A dataset's records are registered as an external table.  What must hold of them beyond
types (not-null columns, the unique key) stands in the table's properties, since
files carry no constraints.  Columns stand there by their place in the schema: Spark hides property
values that look like the name of a secret.  The audit asks the catalog alone: no data is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vigil.operators.protect import PROTECTED_SCHEMA, RECORD_KEY

NOT_NULL, UNIQUE = "vigil.not_null", "vigil.unique"


def constraints(schema: T.StructType = PROTECTED_SCHEMA, key: Sequence[str] = RECORD_KEY) -> dict[str, str]:
    """The table properties that stand for the constraints of a table of records."""
    place = {f.name: str(k) for k, f in enumerate(schema.fields, 1)}
    return {NOT_NULL: ",".join(place[f.name] for f in schema.fields if not f.nullable), UNIQUE: ",".join(place[c] for c in key)}


def register(records: DataFrame, name: str, path: str, properties: dict[str, str] | None = None) -> None:
    """Write ``records`` under ``path``, by ``p2`` if they have it, as the external table ``name``."""
    spark = records.sparkSession
    w = records.write.mode("errorifexists").option("path", path)
    (w.partitionBy("p2") if "p2" in records.columns else w).saveAsTable(name)
    said = constraints() if properties is None else properties
    if said:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in said.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def catalog_audit(
    spark: SparkSession, names: Sequence[str], schema: T.StructType = PROTECTED_SCHEMA, key: Sequence[str] = RECORD_KEY
) -> DataFrame:
    """Per table, expected or found column and constraint: ``table_name, item, expected, actual, status``.

    ``status`` is ``ok``, ``missing_table`` (one row for the table), ``missing``,
    ``unexpected`` or ``mismatch``.  Column names compare as Spark compares them, without case.
    """
    rows: list[tuple] = []
    wanted = {f.name.lower(): f.dataType.simpleString() for f in schema.fields}
    for name in names:
        if not spark.catalog.tableExists(name):
            rows.append((name, "table", "present", None, "missing_table"))
            continue
        found = {c.name.lower(): c.dataType for c in spark.catalog.listColumns(name)}
        said = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        pairs = [(f"column {c}", wanted.get(c), found.get(c)) for c in sorted({*wanted, *found})]
        pairs += [(f"constraint {k}", v, said.get(k)) for k, v in sorted(constraints(schema, key).items())]
        for item, expected, actual in pairs:
            status = "missing" if actual is None else "unexpected" if expected is None else "ok" if expected == actual else "mismatch"
            rows.append((name, item, expected, actual, status))
    return spark.createDataFrame(rows, "table_name string, item string, expected string, actual string, status string")
