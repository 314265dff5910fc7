"""Registered queries over imported cells and compared documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from setforge.plans.diff import diff_attributes
from setforge.plans.validate import UNKNOWN_TYPE, ColumnRule, error_count, pivot_cells, unknown_types, validate_cells
from setforge.queries.core import derived, plain
from setforge.queries.registry import Registry
from setforge.session import new_folder
from setforge.sources.tables import write_text
from setforge.sources.workbook import ROW_SCHEMA, errors_to_xml, faulty_rows, names_from_xml, read_cells, read_errors, rules_from_xml, schema_faults, write_errors, write_sheets

registry = Registry()

# one sheet row per order; some values are spoiled by key, some cells are missing
_CELL = "SELECT o_orderkey + 2 AS RN, {n} AS CN, '{letter}' || CAST(o_orderkey + 2 AS STRING) AS CNN, {value} AS CV FROM {{orders}}{where}"
_MONEY = "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING)"
CELLS = " UNION ALL ".join(
    _CELL.format(n=n, letter=letter, value=value, where=where)
    for n, letter, value, where in (
        (1, "A", "CASE o_orderkey % 13 WHEN 0 THEN '' WHEN 1 THEN '   ' ELSE o_orderpriority || '  ' END", " WHERE o_orderkey % 11 > 0"),
        (2, "B", f"CASE o_orderkey % 7 WHEN 0 THEN {_MONEY} || '34' WHEN 1 THEN {_MONEY} || 'x' ELSE {_MONEY} END", ""),
        (3, "C", "CASE o_orderkey % 5 WHEN 0 THEN '00' || CAST(o_custkey AS STRING) WHEN 1 THEN '99999999999' WHEN 2 THEN '' ELSE CAST(o_custkey AS STRING) END", ""),
        (4, "D", "CASE o_orderkey % 9 WHEN 0 THEN '2013-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T00:00:00' END", ""),
        (5, "E", "CASE o_orderkey % 4 WHEN 0 THEN '12.345' WHEN 1 THEN '123.4' WHEN 2 THEN '' ELSE '1.25' END", ""),
        (9, "I", "'no rule'", ""),
    )
)
RULES = [
    ColumnRule(1, "varchar(8)", False),
    ColumnRule(2, "money", False),
    ColumnRule(3, "int", None),
    ColumnRule(4, "smalldatetime", False),
    ColumnRule(5, "decimal(4,2)", True),
]
_CODES = f"""WITH cells AS ({plain(CELLS, "orders")}), rows AS (SELECT DISTINCT RN FROM cells),
    wide AS (SELECT r.RN, k.n, max(c.CV) AS v, max(c.CNN) AS nm FROM rows r CROSS JOIN (VALUES (1), (2), (3), (4), (5)) k(n)
             LEFT JOIN cells c ON c.RN = r.RN AND c.CN = k.n GROUP BY 1, 2),
    coded AS (SELECT *, CASE n
        WHEN 1 THEN CASE WHEN length(rtrim(coalesce(v, ''))) = 0 THEN 2 WHEN length(rtrim(v)) > length(rtrim(left(v, 8))) THEN 4 ELSE 0 END
        WHEN 2 THEN CASE WHEN v = '' THEN 2 WHEN TRY_CAST(v AS DECIMAL(19,4)) IS NULL THEN 3
                         WHEN length(v) > length(CAST(CAST(CAST(v AS DECIMAL(19,4)) AS DECIMAL(17,2)) AS VARCHAR)) THEN 4 ELSE 0 END
        WHEN 3 THEN CASE WHEN v = '' THEN 0 WHEN TRY_CAST(v AS INTEGER) IS NULL THEN 3
                         WHEN length(v) > length(CAST(CAST(v AS INTEGER) AS VARCHAR)) THEN 4 ELSE 0 END
        WHEN 4 THEN CASE WHEN TRY_CAST(v AS TIMESTAMP) IS NULL THEN 3 ELSE 0 END
        WHEN 5 THEN CASE WHEN v = '' THEN 0 WHEN TRY_CAST(v AS DECIMAL(4,2)) IS NULL THEN 3
                         WHEN length(v) > length(CAST(CAST(v AS DECIMAL(4,2)) AS VARCHAR)) THEN 4 ELSE 0 END END AS code FROM wide)"""
_TYPES = """CASE n WHEN 1 THEN 'строка\\текст (или символ) [varchar(8)]' WHEN 2 THEN 'вещественное число [money]' WHEN 3 THEN 'целый тип [int]'
    WHEN 4 THEN 'дата [smalldatetime]' ELSE 'вещественное число [decimal(4,2)]' END"""
_HEADS = """CASE code WHEN 2 THEN 'Пустое значение не допустимо. Ожидается тип - ' WHEN 3 THEN 'Ошибочный тип данных, ожидается тип - '
    WHEN 4 THEN 'Превышение размерности (' || CASE n WHEN 1 THEN '8' WHEN 5 THEN '4' ELSE '0' END || ' символов), ожидается тип - ' END"""


def q_validate(spark, sf_dir):
    errors = validate_cells(derived(spark, sf_dir, CELLS, "orders"), RULES)
    return errors.select(
        F.col("ErrorCode").cast("bigint").alias("ErrorCode"), F.col("RowNum").alias("RowNum"),
        F.col("CellNum").cast("bigint").alias("CellNum"), "CellName", "CellValue", "ErrorRus",
    )


registry.add("validate_cells", q_validate, f"""
    {_CODES} SELECT CAST(code AS BIGINT) AS ErrorCode, RN AS RowNum, CAST(n AS BIGINT) AS CellNum, nm AS CellName, v AS CellValue,
    {_HEADS} || {_TYPES} AS ErrorRus FROM coded WHERE code <> 0""")


def q_error_count(spark, sf_dir):
    return error_count(validate_cells(derived(spark, sf_dir, CELLS, "orders"), RULES))


registry.add("validation_error_count", q_error_count, f"{_CODES} SELECT count(*) AS errors FROM coded WHERE code <> 0")


def q_pivot(spark, sf_dir):
    return pivot_cells(derived(spark, sf_dir, CELLS, "orders"), [1, 3, 9])


registry.add("pivot_cells", q_pivot, f"""
    SELECT RN, max(CASE WHEN CN = 1 THEN CV END) AS CV_1, max(CASE WHEN CN = 1 THEN CNN END) AS CNN_1,
           max(CASE WHEN CN = 3 THEN CV END) AS CV_3, max(CASE WHEN CN = 3 THEN CNN END) AS CNN_3,
           max(CASE WHEN CN = 9 THEN CV END) AS CV_9, max(CASE WHEN CN = 9 THEN CNN END) AS CNN_9
    FROM ({plain(CELLS, "orders")}) GROUP BY RN""")


def q_cells_xml(spark, sf_dir):
    """Parts as sheet rows in XML, shredded back to cells."""
    cell = "named_struct('_i', {}, '_n', concat('{}', p_partkey), '_VALUE', {})"
    cells = ", ".join(cell.format(i, n, v) for i, n, v in ((1, "A", "p_name"), (2, "B", "p_brand"), (3, "C", "CAST(p_size AS STRING)")))
    rows = derived(
        spark, sf_dir,
        f"SELECT to_xml(named_struct('_i', CAST(p_partkey AS INT), 'Cell', array({cells})), map('rowTag', 'Row')) AS x FROM {{part}}", "part",
    )
    parsed = rows.select(F.from_xml("x", ROW_SCHEMA).alias("r"))
    flat = parsed.select(F.col("r._i").cast("bigint").alias("RN"), F.explode("r.Cell").alias("c"))
    return flat.select("RN", F.col("c._i").cast("bigint").alias("CN"), F.col("c._n").alias("CNN"), F.col("c._VALUE").alias("CV"))


registry.add("cells_through_xml", q_cells_xml, """
    SELECT p_partkey AS RN, CAST(1 AS BIGINT) AS CN, 'A' || p_partkey AS CNN, p_name AS CV FROM part
    UNION ALL SELECT p_partkey, 2, 'B' || p_partkey, p_brand FROM part
    UNION ALL SELECT p_partkey, 3, 'C' || p_partkey, CAST(p_size AS VARCHAR) FROM part""")


def q_sheet_files(spark, sf_dir):
    """Three workbooks written as XML files, read, checked, and their errors written and read back."""
    folder = new_folder(spark, "sheets")
    cells = derived(spark, sf_dir, CELLS, "orders").withColumn("book", F.col("RN") % 3)
    write_sheets(cells, f"{folder}/sheets", ["book"])
    found = read_cells(spark, f"{folder}/sheets").withColumn("book", F.regexp_extract("source", "book=([0-9]+)", 1).cast("bigint"))
    write_errors(validate_cells(found, RULES, ["book", "RN"]), f"{folder}/errors", ["book"])
    numbers = [F.col(c).cast("bigint").alias(c) for c in ("book", "ErrorCode", "RowNum", "CellNum")]
    return read_errors(spark, f"{folder}/errors").select(*numbers, "CellName", F.rtrim(F.coalesce("CellValue", F.lit(""))).alias("CellValue"), "ErrorRus")


registry.add("sheet_files", q_sheet_files, f"""
    {_CODES} SELECT RN % 3 AS book, CAST(code AS BIGINT) AS ErrorCode, RN AS RowNum, CAST(n AS BIGINT) AS CellNum, nm AS CellName,
    rtrim(coalesce(v, '')) AS CellValue, {_HEADS} || {_TYPES} AS ErrorRus FROM coded WHERE code <> 0""")

# a schema of orders' rows and texts that break it by key: a word for a price, no key, a foreign element, a wrong order, no end
_TYPE = '<xs:complexType><xs:sequence><xs:element name="Price" type="xs:decimal"/><xs:element name="Day" type="xs:date"/></xs:sequence><xs:attribute name="id" type="xs:long" use="required"/></xs:complexType>'
ORDER_XSD = f'<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="Order">{_TYPE}</xs:element></xs:schema>'
_PRICE, _DAY = "'<Price>' || CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) || '</Price>'", "'<Day>' || CAST(CAST(o_orderdate AS DATE) AS STRING) || '</Day>'"
ORDER_TEXTS = f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 8 < 7 THEN '<Order' || CASE WHEN o_orderkey % 8 = 2 THEN '' ELSE ' id="' || CAST(o_orderkey AS STRING) || '"' END || '>'
    || CASE o_orderkey % 8 WHEN 1 THEN '<Price>dear</Price>' || {_DAY} WHEN 4 THEN {_DAY} || {_PRICE} ELSE {_PRICE} || {_DAY} END
    || CASE o_orderkey % 8 WHEN 3 THEN '<Note/>' ELSE '' END || CASE o_orderkey % 8 WHEN 5 THEN '' ELSE '</Order>' END END AS x FROM {{orders}}"""


def q_schema_faults(spark, sf_dir):
    xsd = write_text(spark, ORDER_XSD, new_folder(spark, "schema"))
    return schema_faults(derived(spark, sf_dir, ORDER_TEXTS, "orders"), "x", xsd).select("id", "fits")


registry.add("schema_faults", q_schema_faults, "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 8 < 7 THEN o_orderkey % 8 IN (0, 6) END AS fits FROM orders")

_CELL_TYPE = '<xs:simpleContent><xs:extension base="xs:string"><xs:attribute name="i" type="xs:int" use="required"/><xs:attribute name="n" type="xs:string"/></xs:extension></xs:simpleContent>'
_CELLS = f'<xs:sequence><xs:element name="Cell" minOccurs="6" maxOccurs="6"><xs:complexType>{_CELL_TYPE}</xs:complexType></xs:element></xs:sequence>'
ROW_XSD = f'<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="Row"><xs:complexType>{_CELLS}<xs:attribute name="i" type="xs:long"/></xs:complexType></xs:element></xs:schema>'


def q_row_faults(spark, sf_dir):
    """Workbooks whose rows must have six cells; every eleventh order has five."""
    folder = new_folder(spark, "sheets")
    write_sheets(derived(spark, sf_dir, CELLS, "orders").withColumn("book", F.col("RN") % 3), f"{folder}/sheets", ["book"])
    rows = faulty_rows(spark, f"{folder}/sheets", write_text(spark, ROW_XSD, f"{folder}/schema"))
    return rows.select(F.regexp_extract("source", "book=([0-9]+)", 1).cast("bigint").alias("book"), F.col("RN").cast("bigint").alias("RN"))


registry.add("row_faults", q_row_faults, "SELECT (o_orderkey + 2) % 3 AS book, o_orderkey + 2 AS RN FROM orders WHERE o_orderkey % 11 = 0")

_DECLARED = "element_at(array('VARCHAR(16)', 'money', 'blob', 'int', 'geo point(1)', 'decimal(4, 2)', 'decimal(4; 2)'), CAST(p_partkey % 7 + 1 AS INT))"


def q_unknown_types(spark, sf_dir):
    """Rules in one XML text per brand, and those of a type that is not known."""
    texts = derived(
        spark, sf_dir,
        f"""SELECT '<Types>' || listagg('<Column i="' || p_partkey || '" type="' || {_DECLARED} || '" nullable="' || (p_size % 2) || '"/>') || '</Types>' AS x
            FROM {{part}} GROUP BY p_brand""", "part",
    )
    return unknown_types(rules_from_xml(texts, "x")).select(F.col("Num").cast("bigint").alias("Num"), "TypeFName", F.col("ErrorCode").cast("bigint").alias("ErrorCode"))


registry.add("unknown_types", q_unknown_types, f"""
    SELECT p_partkey AS Num, CASE p_partkey % 7 WHEN 2 THEN 'blob' WHEN 4 THEN 'geo point(1)' ELSE 'decimal(4; 2)' END AS TypeFName, CAST({UNKNOWN_TYPE} AS BIGINT) AS ErrorCode
    FROM part WHERE p_partkey % 7 IN (2, 4, 6)""")


def q_table_names(spark, sf_dir):
    """Nations as table lists in XML, one text per region."""
    texts = derived(
        spark, sf_dir,
        """SELECT '<TableList>' || listagg('<Table Name="' || n_name || ' &amp; co"/>') || '</TableList>' AS x FROM {nation} GROUP BY n_regionkey""", "nation",
    )
    return names_from_xml(texts, "x")


registry.add("table_names", q_table_names, "SELECT n_name || ' & co' AS TableName FROM nation")


def q_errors_xml(spark, sf_dir):
    """The error document, its counts and some attributes read back from the text."""
    documents = errors_to_xml(validate_cells(derived(spark, sf_dir, CELLS, "orders"), RULES), block_rows=10_000)
    item = "struct<_ErrorCode: bigint, _RowNum: bigint, _CellNum: bigint, _CellName: string, _CellValue: string, _ErrorRus: string>"
    read = documents.select("block", F.from_xml("xml", f"_ErrorCount bigint, _HeldCount bigint, Error array<{item}>").alias("e"))
    rows = read.select("block", F.col("e._ErrorCount").alias("stated"), F.col("e._HeldCount").alias("held"), F.explode("e.Error").alias("x"))
    named = {"ErrorCode": "_ErrorCode", "RowNum": "_RowNum", "CellNum": "_CellNum", "CellName": "_CellName", "ErrorRus": "_ErrorRus"}
    return rows.select("block", "stated", "held", *[F.col(f"x.{c}").alias(n) for n, c in named.items()])


registry.add("errors_to_xml", q_errors_xml, f"""
    {_CODES} SELECT CAST(floor(RN / 10000) AS BIGINT) AS block, count(*) OVER () AS stated,
           count(*) OVER (PARTITION BY floor(RN / 10000)) AS held, CAST(code AS BIGINT) AS ErrorCode, RN AS RowNum,
           CAST(n AS BIGINT) AS CellNum, nm AS CellName, {_HEADS} || {_TYPES} AS ErrorRus FROM coded WHERE code <> 0""")

# two snapshots of every customer; the second drifts by key
PAIRS = """SELECT c_custkey AS pair_id,
    '<c><Adress Nation="' || CAST(c_nationkey AS STRING) || '" ClientID="' || CAST(c_custkey AS STRING) || '"/><Segment Name="' || c_mktsegment || '"/><Note/><Note/></c>' AS xml,
    CASE WHEN c_custkey % 9 = 8 THEN NULL ELSE
    '<c><Adress Nation="' || CAST(CASE WHEN c_custkey % 5 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS STRING) || '" ClientID="' || CAST(c_custkey AS STRING)
    || CASE WHEN c_custkey % 7 = 0 THEN '" Extra="1' ELSE '' END || '"/><Segment Name="' || CASE WHEN c_custkey % 4 = 0 THEN 'NONE' ELSE c_mktsegment END || '"/>'
    || CASE c_custkey % 6 WHEN 0 THEN '<Note/><Other/>' WHEN 1 THEN '<Note/>' ELSE '<Note/><Note/>' END
    || CASE WHEN c_custkey % 97 = 5 THEN '' ELSE '</c>' END END AS xml2 FROM {customer}"""


def _diff(mode):
    def query(spark, sf_dir):
        found = diff_attributes(derived(spark, sf_dir, PAIRS, "customer"), mode)
        return found.select("pair_id", F.col("result").cast("bigint").alias("result"), "changed", F.col("error").isNotNull().alias("broken"))

    return query


def _diff_oracle(mode: str) -> str:
    moved, extra = "c_custkey % 5 = 0", "c_custkey % 7 = 0"
    nation = f"{moved} AND NOT ({extra})" if mode == "simple" else moved
    added = "FALSE" if mode == "simple" else extra
    broken = "c_custkey % 9 <> 8 AND c_custkey % 97 = 5"
    gone = f"c_custkey % 9 = 8 OR c_custkey % 6 = 1 OR {broken}"
    return f"""SELECT c_custkey AS pair_id,
        CAST(CASE WHEN {gone} OR {moved} OR {extra} OR c_custkey % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS result,
        CASE WHEN {gone} THEN '' ELSE concat_ws(', ', CASE WHEN {added} THEN 'Extra' END,
            CASE WHEN c_custkey % 4 = 0 THEN 'Name' END, CASE WHEN {nation} THEN 'Nation' END) END AS changed,
        {broken} AS broken FROM customer"""


registry.add("diff_attributes_simple", _diff("simple"), _diff_oracle("simple"))
registry.add("diff_attributes_full", _diff("full"), _diff_oracle("full"))
