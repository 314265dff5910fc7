"""Cells and column rules from XML files, errors back to XML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELL_LENGTH, NAME_LENGTH = 300, 10  # fixed values: stored length of a cell and of its name in reference mode

ROW_SCHEMA = "_i int, Cell array<struct<_i: int, _n: string, _VALUE: string>>"
RULES_SCHEMA = "Column array<struct<_i: int, _type: string, _nullable: string>>"
NAMES_SCHEMA = "Table array<struct<_Name: string>>"


def read_cells(spark: SparkSession, path: str, row_xsd: str | None = None, mode: str = "whole") -> DataFrame:
    """(source, RN, CN, CNN, CV) from workbooks of Sheet / Row / Cell elements.

    Texts are whole; mode "reference" cuts cells and names to the lengths its tables store.

    The schema is stated: inference would read a column of digits as numbers. ``row_xsd``
    names a schema file every row must fit; a row that does not stops the read.
    """
    reader = spark.read.format("xml").option("rowTag", "Row").schema(ROW_SCHEMA)
    if row_xsd is not None:
        reader = reader.option("rowValidationXSDPath", row_xsd).option("mode", "FAILFAST")
    if mode not in ("whole", "reference"):
        raise ValueError(f"mode: {mode}")
    rows = reader.load(path)
    cells = rows.select(F.col("_metadata.file_path").alias("source"), F.col("_i").alias("RN"), F.explode("Cell").alias("c"))
    name, value = F.col("c._n"), F.coalesce("c._VALUE", F.lit(""))
    if mode == "reference":
        name, value = F.substring(name, 1, NAME_LENGTH), F.substring(value, 1, CELL_LENGTH)
    return cells.select("source", "RN", F.col("c._i").alias("CN"), name.alias("CNN"), value.alias("CV"))


FAULT = "_fault"


def faulty_rows(spark: SparkSession, path: str, row_xsd: str) -> DataFrame:
    """(source, RN, fault): number and text of every Row element that does not fit the schema file ``row_xsd``.

    RN is null where the row has no number.
    """
    options = {"rowTag": "Row", "rowValidationXSDPath": row_xsd, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": FAULT}
    rows = spark.read.format("xml").options(**options).schema(f"{ROW_SCHEMA}, {FAULT} string").load(path)
    stated = F.regexp_extract(FAULT, r'^<Row\s(?:[^>]*\s)?i\s*=\s*["\'](-?[0-9]+)', 1).try_cast("int")
    return rows.select(F.col("_metadata.file_path").alias("source"), F.coalesce("_i", stated).alias("RN"), F.col(FAULT).alias("fault")).where("fault IS NOT NULL")


def schema_faults(df: DataFrame, column: str, xsd: str) -> DataFrame:
    """``df`` with ``fits``: whether the XML text in ``column`` is well formed and fits the schema file ``xsd``; null for null.

    The schema file is read in every task, so it must lie where all executors see it.
    """
    options = {"rowValidationXSDPath": xsd, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": FAULT}
    parsed = F.from_xml(F.col(column), f"_any string, {FAULT} string", options)
    return df.withColumn("fits", F.when(F.col(column).isNotNull(), parsed[FAULT].isNull()))


def write_sheets(cells: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Cells (keys, RN, CN, CNN, CV) as XML files of Row and Cell elements, a folder ``key=value`` per workbook.

    A row's cells are gathered, a workbook's rows are not: a large one goes out in several files.
    """
    cell = F.struct(F.col("CN").alias("_i"), F.col("CNN").alias("_n"), F.col("CV").alias("_VALUE"))
    rows = cells.groupBy(*keys, F.col("RN").alias("_i")).agg(F.array_sort(F.collect_list(cell)).alias("Cell"))
    rows.write.format("xml").option("rowTag", "Row").option("rootTag", "Sheet").partitionBy(*keys).save(path)


def rules_from_xml(df: DataFrame, column: str) -> DataFrame:
    """(Num, TypeFName, Nullable) from texts like ``<Types><Column i= type= nullable=/></Types>``."""
    parsed = df.select(F.explode(F.from_xml(F.col(column), RULES_SCHEMA)["Column"]).alias("c"))
    nullable = F.lower("c._nullable")
    flag = F.when(nullable.isin("1", "true"), True).when(nullable.isin("0", "false"), False)
    return parsed.select(F.col("c._i").alias("Num"), F.lower("c._type").alias("TypeFName"), flag.alias("Nullable"))


def names_from_xml(df: DataFrame, column: str) -> DataFrame:
    """(TableName) from texts like ``<TableList><Table Name=/></TableList>``."""
    parsed = df.select(F.explode(F.from_xml(F.col(column), NAMES_SCHEMA)["Table"]).alias("t"))
    return parsed.select(F.col("t._Name").alias("TableName"))


ERROR_ATTRIBUTES = ["ErrorCode", "RowNum", "CellNum", "CellName", "CellValue", "ErrorRus", "ErrorMessage"]


def errors_to_xml(errors: DataFrame, block_rows: int | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """(keys, block, xml): ``<Errors ErrorCount=..><Error .../>...</Errors>``, one document per workbook.

    ``keys`` name the workbook; by default the column ``source``, if there is one. ErrorCount is the
    workbook's number of errors. A workbook too large for one document can go out in blocks of
    ``block_rows`` row numbers; ErrorCount is then still the whole number, and HeldCount the block's own.
    """
    if keys is None:
        keys = [c for c in ("source",) if c in errors.columns]
    item = F.struct(*[F.col(c).cast("string").alias(f"_{c}") for c in ERROR_ATTRIBUTES])
    block = F.floor(F.col("RowNum") / block_rows).cast("bigint") if block_rows else F.lit(0).cast("bigint")
    blocks = errors.groupBy(*keys, block.alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("RowNum", "CellNum", item.alias("item")))).alias("items")
    )
    if not block_rows:
        counted = blocks.withColumn("total", F.size("items").cast("bigint"))
    else:
        # counted without the texts, so that no task gathers those of a whole workbook; empty keys are a workbook too
        totals = errors.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.count("*").alias("total"))
        if keys:
            same = [blocks[k].eqNullSafe(totals[f"_of_{k}"]) for k in keys]
            counted = blocks.join(totals, same)
        else:
            counted = blocks.crossJoin(F.broadcast(totals))  # one row
    held = [F.size("items").alias("_HeldCount")] if block_rows else []
    root = F.struct(F.col("total").alias("_ErrorCount"), *held, F.transform("items", lambda e: e["item"]).alias("Error"))
    return counted.select(*keys, "block", F.to_xml(root, {"rowTag": "Errors"}).alias("xml"))


def write_errors(errors: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Error rows as XML files of Error elements, a folder ``key=value`` per workbook.

    The sink of ``errors_to_xml``'s content for workbooks of any size: no workbook is gathered in one row, so the
    number of errors is not in the file; ``error_count`` has it.
    """
    rows = errors.select(*keys, *[F.col(c).cast("string").alias(f"_{c}") for c in ERROR_ATTRIBUTES])
    rows.write.format("xml").option("rowTag", "Error").option("rootTag", "Errors").partitionBy(*keys).save(path)


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_errors`` wrote, with the workbook's keys."""
    schema = ", ".join(f"_{c} string" for c in ERROR_ATTRIBUTES)
    rows = spark.read.format("xml").option("rowTag", "Error").schema(schema).load(path)
    return rows.withColumnsRenamed({f"_{c}": c for c in ERROR_ATTRIBUTES})
