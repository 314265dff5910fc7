import pytest
from pyspark.sql import functions as F

from setforge.functions.tsql_types import DeclaredType, converted_text
from setforge.plans.validate import ColumnRule, UnknownTypes, error_code, rules_from, unknown_types, validate_cells
from setforge.queries.documents import ROW_XSD
from setforge.sources.workbook import errors_to_xml, faulty_rows, names_from_xml, read_cells, rules_from_xml, schema_faults


def book(*rows):
    """A workbook of the given rows, numbered from 2; cells are named A, B, ..."""
    cells = lambda r, row: "".join(f'<Cell i="{i}" n="{chr(64 + i)}{r}">{v}</Cell>' if v else f'<Cell i="{i}" n="{chr(64 + i)}{r}"/>' for i, v in enumerate(row, 1))
    return "<Workbook><Sheet i='1'>" + "".join(f'<Row i="{r}">{cells(r, row)}</Row>' for r, row in enumerate(rows, 2)) + "</Sheet></Workbook>"


GOOD = book(("north", "120.50", "", "2021-03-04T00:00:00", "7"), ("south", "0", "1.25", "1999-12-31", "-4"))
LONG = book(("a long name", "2021-03-04", "3", "1"), ("short", "2021-03-05", "4", "2"), ("longer", "2021-03-06", "5", "3"))


def rules(*items):
    return [ColumnRule(i, name, nullable) for i, (name, nullable) in enumerate(items, 1)]


def cells_of(spark, tmp_path, text):
    (tmp_path / "book.xml").write_text(text)
    return read_cells(spark, str(tmp_path / "book.xml"))


def test_good_sheet(spark, tmp_path):
    wanted = rules(("varchar(5)", False), ("money", False), ("decimal(3,2)", True), ("datetime", False), ("smallint", False))
    assert validate_cells(cells_of(spark, tmp_path, GOOD), wanted).count() == 0


def test_too_long_text(spark, tmp_path):
    wanted = rules(("varchar(5)", False), ("date", False), ("int", False), ("tinyint", True))
    found = validate_cells(cells_of(spark, tmp_path, LONG), wanted)
    assert sorted((r.ErrorCode, r.CellName, r.CellValue) for r in found.collect()) == [(4, "A2", "a long name"), (4, "A4", "longer")]
    text = errors_to_xml(found).first().xml
    assert 'ErrorCount="2"' in text and 'CellName="A4"' in text


@pytest.mark.parametrize(
    "value, kind, code",
    [
        ("007", "int", 4), ("12.5", "int", 3), ("256", "tinyint", 3), ("99999999999", "int", 3), ("", "int", 0), (None, "int", 3),
        ("12.345", "decimal(4,2)", 4), ("100", "decimal(4,2)", 3), ("", "decimal(5,2)", 3), ("999.995", "decimal(5,2)", 3),
        ("25.1234", "money", 4), ("25.1", "money", 0), ("1e3", "float", 0), ("abc", "float", 3), ("0.1", "float", 0),
        ("2013-02-30", "date", 3), ("2013-02-28", "date", 0), ("2013-07-12T00:00:00", "datetime", 0), ("1700-01-01", "datetime", 3),
        ("83214", "varchar(3)", 4), ("abc  ", "varchar(3)", 0), ("true", "bit", 4), ("1", "bit", 0),
        ("01234567-89ab-cdef-0123-456789abcdef", "uniqueidentifier", 0), ("01234567", "uniqueidentifier", 3),
        ("1234567890123456789012345", "decimal(38,0)", 0), ("0.1234567890123456789012", "decimal(38,22)", 0), ("1" * 39, "decimal(38,0)", 3),
    ],
)
def test_codes(spark, value, kind, code):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(error_code(F.col("v"), ColumnRule(1, kind), DeclaredType.parse(kind))).first()[0] == code


def test_float_texts(spark):
    df = spark.createDataFrame([("1234567",), ("123456",), ("0.1",), ("0.00001",), ("100000",)], "v string")
    texts = [r[0] for r in df.select(converted_text(F.col("v"), DeclaredType.parse("float"))).collect()]
    assert texts == ["1.23457e+006", "123456", "0.1", "1e-005", "100000"]


def test_blank_missing_and_ignored_cells(spark):
    cells = spark.createDataFrame(
        [(2, 1, "A2", "  "), (2, 9, "I2", "x"), (3, 2, "B3", "1"), (3, 2, "B3", "2")], "RN int, CN int, CNN string, CV string"
    )
    found = validate_cells(cells, [ColumnRule(1, "int", False), ColumnRule(2, "int", True)])
    assert sorted((r.RowNum, r.CellNum, r.ErrorCode) for r in found.collect()) == [(2, 1, 2), (3, 1, 2)]


def test_refusals(spark):
    cells = spark.createDataFrame([(2, 1, "A2", "1")], "RN int, CN int, CNN string, CV string")
    with pytest.raises(ValueError):
        validate_cells(cells, [])
    strange = [ColumnRule(1, "money", True), ColumnRule(2, "nosuch(3)", True)]
    with pytest.raises(UnknownTypes) as caught:
        validate_cells(cells, strange)
    assert caught.value.rules == strange[1:] and "column 2: nosuch(3)" in str(caught.value)
    assert validate_cells(cells.limit(0), strange[:1]).count() == 0
    table = spark.createDataFrame([(r.num, r.type_name) for r in strange], "Num int, TypeFName string")
    assert [tuple(r) for r in unknown_types(table).collect()] == [(2, "nosuch(3)", -1)]


def test_workbooks_do_not_mix(spark, tmp_path):
    for name, value in (("a", "zz"), ("b", "5"), ("c", "400 characters" * 30)):
        (tmp_path / f"{name}.xml").write_text(book((value,)))
    cells = read_cells(spark, str(tmp_path))
    found = validate_cells(cells, [ColumnRule(1, "int", False)])
    assert sorted((r.source[-5:], r.ErrorCode) for r in found.collect()) == [("a.xml", 3), ("c.xml", 3)]
    assert max(len(r.CV) for r in cells.collect()) == 420
    assert max(len(r.CV) for r in read_cells(spark, str(tmp_path), mode="reference").collect()) == 300
    documents = errors_to_xml(found).collect()
    assert sorted(r.source[-5:] for r in documents) == ["a.xml", "c.xml"]


def test_blocks_state_the_whole_count(spark):
    cells = spark.createDataFrame([(r, 1, f"A{r}", "x") for r in range(10)], "RN int, CN int, CNN string, CV string")
    texts = [r.xml for r in errors_to_xml(validate_cells(cells, [ColumnRule(1, "int")]), block_rows=4).collect()]
    assert len(texts) == 3 and all('ErrorCount="10"' in t for t in texts) and sum('HeldCount="4"' in t for t in texts) == 2


def test_unparenthesised_type_after_a_sized_one(spark):
    cells = spark.createDataFrame([(2, 1, "A2", "x"), (2, 2, "B2", "y")], "RN int, CN int, CNN string, CV string")
    found = validate_cells(cells, rules(("varchar(16)", False), ("int", False))).collect()
    assert [(r.CellNum, r.TypeName, r.ErrorCode) for r in found] == [(2, "int", 3)]


def test_rules_and_names_from_xml(spark):
    df = spark.createDataFrame(
        [('<Types><Column i="2" type="INT"/><Column i="1" type="varchar(3)" nullable="0"/></Types>', '<TableList><Table Name="a"/><Table Name="b"/></TableList>')],
        "t string, n string",
    )
    assert rules_from(rules_from_xml(df, "t")) == [ColumnRule(1, "varchar(3)", False), ColumnRule(2, "int", None)]
    assert [r.TableName for r in names_from_xml(df, "n").collect()] == ["a", "b"]


def test_totals_of_blocks_gather_no_texts(spark):
    rows = [(s, r, 1, "A", "x", "e", None, None) for s, n in (("a", 7), (None, 5), ("b", 1)) for r in range(1, n + 1)]
    errors = spark.createDataFrame(rows, "source string, RowNum int, CellNum int, CellName string, CellValue string, ErrorCode string, ErrorRus string, ErrorMessage string")
    for keys, totals in ((None, {"a": 7, None: 5, "b": 1}), ([], {None: 13})):
        out = errors_to_xml(errors, block_rows=3, keys=keys)
        assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = out.collect()
        held = {}
        for r in got:
            key = r.source if keys is None else None
            assert f'ErrorCount="{totals[key]}"' in r.xml
            held[key] = held.get(key, 0) + int(r.xml.split('HeldCount="')[1].split('"')[0])
        assert held == totals


def test_schema_of_rows_and_messages(spark, tmp_path):
    (tmp_path / "m.xsd").write_text(
        """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" targetNamespace="urn:example:m" elementFormDefault="qualified">
        <xs:element name="m"><xs:complexType><xs:sequence><xs:element name="n" type="xs:int" maxOccurs="2"/></xs:sequence></xs:complexType></xs:element></xs:schema>"""
    )
    own = '<a:m xmlns:a="urn:example:m">{}</a:m>'
    texts = [own.format("<a:n>1</a:n><a:n>2</a:n>"), own.format("<a:n>x</a:n>"), own.format(""), own.format("<n>1</n>"), "<m><n>1</n></m>", "<a:m", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = {r.i: r.fits for r in schema_faults(rows, "x", str(tmp_path / "m.xsd")).collect()}
    assert got == {0: True, 1: False, 2: False, 3: False, 4: False, 5: False, 6: False, 7: None}
    assert schema_faults(rows.limit(0), "x", str(tmp_path / "m.xsd")).count() == 0


def test_broken_rows_of_a_workbook(spark, tmp_path):
    (tmp_path / "row.xsd").write_text(ROW_XSD.replace('minOccurs="6" maxOccurs="6"', 'minOccurs="5" maxOccurs="5"'))
    (tmp_path / "books").mkdir()
    (tmp_path / "books" / "good.xml").write_text(GOOD)
    (tmp_path / "books" / "long.xml").write_text(LONG)
    rows = faulty_rows(spark, str(tmp_path / "books"), str(tmp_path / "row.xsd")).collect()
    assert sorted(r.RN for r in rows) == [2, 3, 4] and all(r.source.endswith("long.xml") and r.fault.startswith("<Row ") for r in rows)
