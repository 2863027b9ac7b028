"""Rows that are fit for use and rows that are not, told apart in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkit.session import fresh_path

REASONS, SOURCE = "_reasons", "_source"


@dataclass(frozen=True)
class Sorted:
    """Rows of the schema that break no rule, and the others as they were read, with their reasons."""

    good: DataFrame
    rejected: DataFrame

    def counts(self) -> DataFrame:
        """One row for each reason: how many rows were rejected for it. A row counts for each of its reasons."""
        each = self.rejected.select(F.explode(REASONS).alias("reason"))
        return each.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected_rows"))


def quarantine(
    raw: DataFrame, schema: T.StructType | str, rules: Mapping[str, Column] | None = None, date_formats: Mapping[str, str] | None = None
) -> Sorted:
    """Sorts rows of texts by whether they fit ``schema`` and keep the ``rules`` (name -> condition of a bad row, on the typed columns).

    Reasons are an array: ``missing COLUMN`` where a column that may not be null is null or empty, ``not a TYPE: COLUMN`` where a text does not fit its type,
    and the names of broken rules; a condition that is null is not broken. Every row is in exactly one of the two outputs. The rows are written once, by
    outcome, so that reading one output does not touch the other. Columns of ``raw`` that the schema does not name are kept with rejected rows only.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    formats = date_formats or {}
    typed = {f.name: _typed(F.col(f.name), f, formats.get(f.name)) for f in schema}
    given = {f.name: F.col(f.name).isNotNull() & (F.trim(F.col(f.name).cast("string")) != "") for f in schema}
    df = raw.withColumns({f"_typed_{name}": value for name, value in typed.items()})
    reasons = []
    for f in schema:
        fits = F.col(f"_typed_{f.name}").isNotNull()
        reasons.append(F.when(given[f.name] & ~fits, F.lit(f"not a {f.dataType.simpleString()}: {f.name}")))
        if not f.nullable:
            reasons.append(F.when(~given[f.name], F.lit(f"missing {f.name}")))
    named = df.select(*[F.col(f"_typed_{f.name}").alias(f.name) for f in schema], F.struct(*raw.columns).alias(SOURCE), F.array_compact(F.array(*reasons)).alias(REASONS))
    broken = [F.when(bad, F.lit(name)) for name, bad in (rules or {}).items()]
    judged = named.withColumn(REASONS, F.concat(REASONS, F.array_compact(F.array(*broken)))) if broken else named
    path = fresh_path(raw.sparkSession, "sorted")
    judged.withColumn("_bad", F.size(REASONS) > 0).write.partitionBy("_bad").parquet(path)
    whole = raw.sparkSession.read.schema(judged.withColumn("_bad", F.lit(True)).schema).parquet(path)
    good = whole.where("NOT _bad").select(*[f.name for f in schema])
    rejected = whole.where("_bad").select(f"{SOURCE}.*", REASONS)
    return Sorted(good, rejected)


def _typed(value: Column, field: T.StructField, pattern: str | None) -> Column:
    text = F.trim(value.cast("string"))
    if pattern:
        return F.try_to_date(text, pattern)
    return value.cast("string") if isinstance(field.dataType, T.StringType) else F.when(text != "", text.try_cast(field.dataType))


def read_by_header(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """CSV files as texts, by the names in each file's header, whatever the order of columns there.

    A column that a file does not have is null in its rows; further columns of a file are left out. A header that repeats one of ``columns`` is refused. Files are
    grouped by their headers, and each group is read once.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        first = spark.read.csv(path).limit(1).collect()
        names = tuple("" if cell is None else cell for cell in first[0]) if first else ()
        if not names:
            continue  # an empty file
        repeated = {name for name in names if name in columns and names.count(name) > 1}
        if repeated:
            raise ValueError(f"{path} has more than one column {sorted(repeated)}")
        groups.setdefault(names, []).append(path)
    parts = []
    for names, files in groups.items():
        schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))])
        read = spark.read.option("header", True).option("enforceSchema", True).schema(schema).csv(files)
        place = {name: i for i, name in enumerate(names)}
        parts.append(read.select(*[(F.col(f"_{place[c]}") if c in place else F.lit(None).cast("string")).alias(c) for c in columns]))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found
