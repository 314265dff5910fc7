"""Business tables of the price run, derived in full from the given tables.

The text is plain SQL that Spark and DuckDB read alike: ``{name}`` is another table. Price
lists are nations, products are parts, product-level settings are orders, histories are
line items. Ids and dates come from key arithmetic, so sizes follow the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CALC = "DATE '1998-06-15'"
BLOCK_FORMULA = 3
LEGAL_ENTITY = 1
SYSTEM = 9
BASE_LAYER = 4
FIX_LAYER = 5
PRECISION = 1

TABLES: dict[str, str] = {
    "price_lists": f"""
        SELECT CAST(n_nationkey AS BIGINT) AS PricePolID,
               CASE n_nationkey % 7 WHEN 6 THEN NULL WHEN 5 THEN {CALC} + 3 ELSE DATE '1997-01-01' END AS NTLStartDate,
               2 + n_nationkey % 2 AS BasePriceTypeID,
               CASE WHEN n_nationkey % 9 = 8 THEN 128 ELSE 0 END + CASE WHEN n_nationkey % 3 = 0 THEN 256 ELSE 0 END AS Status,
               CASE WHEN n_nationkey % 5 = 0 THEN 20 END AS NDS,
               CASE WHEN n_nationkey % 5 = 0 THEN 3 END AS NDSID,
               CASE WHEN n_nationkey % 8 = 0 THEN 1 ELSE 0 END AS CurrID
        FROM {{nation}}""",
    "products": """
        SELECT p_partkey AS ID,
               CASE WHEN p_partkey % 11 = 5 THEN p_partkey - 1 ELSE p_partkey END AS ProdID,
               CASE WHEN p_partkey % 12 < 9 THEN CAST(floor(p_partkey / 3) AS BIGINT) END AS AGID,
               CASE WHEN p_partkey % 13 = 0 THEN 512 ELSE 0 END + p_size % 8 AS Status,
               CASE WHEN p_partkey % 17 = 0 THEN 1 ELSE 0 END AS Tara,
               p_name AS PrNomer, p_size AS PrSubNomer
        FROM {part}""",
    "c_products": """
        SELECT p_partkey AS ProductID,
               CAST(replace(p_brand, 'Brand#', '') AS INT) AS BrandID,
               p_partkey % 97 AS UnsecuredProductID,
               CASE WHEN p_partkey % 29 = 0 THEN 1 + p_partkey % 5 END AS ExceptionMGPID,
               CASE WHEN p_partkey % 17 = 0 THEN 1 ELSE 0 END AS Tara,
               CASE WHEN p_partkey % 19 = 0 THEN 0 ELSE 1 END AS State,
               CAST(p_retailprice AS DECIMAL(12,2)) AS PreciseWeight
        FROM {part}""",
    "unsecured": """
        SELECT DISTINCT p_partkey % 97 AS UnsecuredProductID, 100 + p_partkey % 97 % 40 AS CategoryID FROM {part}""",
    "categories": """
        SELECT DISTINCT 100 + p_partkey % 40 AS CategoryID, 50 + p_partkey % 40 % 12 AS ParentID, 4 AS Level,
               CASE WHEN p_partkey % 40 % 13 = 7 THEN 0 ELSE 1 END AS State,
               CASE WHEN p_partkey % 40 % 6 = 1 THEN 1 + p_partkey % 40 % 5 END AS MGPID FROM {part}
        UNION ALL
        SELECT DISTINCT 50 + p_partkey % 12, 10 + p_partkey % 12 % 4, 3, CASE WHEN p_partkey % 12 = 11 THEN 0 ELSE 1 END,
               CAST(NULL AS BIGINT) FROM {part}
        UNION ALL
        SELECT DISTINCT 10 + p_partkey % 4, CAST(NULL AS BIGINT), 2, 1, CAST(NULL AS BIGINT) FROM {part}""",
    "brands": """
        SELECT DISTINCT BrandID, 1000 + BrandID % 5 AS ParentID, 2 AS Level, CASE WHEN BrandID % 12 = 7 THEN 0 ELSE 1 END AS State,
               CASE WHEN BrandID % 6 = 0 THEN 1 + BrandID % 4 END AS MGPID FROM {c_products}
        UNION ALL
        SELECT DISTINCT 1000 + BrandID % 5, CAST(NULL AS INT), 1, 1, CAST(NULL AS INT) FROM {c_products}""",
    "market_groups": """
        SELECT DISTINCT 1 + p_partkey % 5 AS MGPID, CASE WHEN p_partkey % 5 = 4 THEN 0 ELSE 1 END AS Status FROM {part}""",
    "group_settings": f"""
        SELECT CAST(1 + n_nationkey % 3 AS BIGINT) AS MGID, CAST(1 + n_nationkey % 2 AS BIGINT) AS MGPID,
               CASE WHEN n_nationkey % 4 = 0 THEN 1 + n_nationkey END AS BrandID,
               CASE WHEN n_nationkey % 4 = 1 THEN CAST(100 + n_nationkey AS BIGINT) END AS CategoryID,
               CASE WHEN n_nationkey % 4 < 2 AND n_nationkey >= 6 THEN 2 ELSE 1 END AS RowType,
               {CALC} - n_nationkey AS DateStart,
               CASE WHEN n_nationkey % 2 = 0 THEN {CALC} + n_nationkey END AS DateEnd
        FROM {{nation}}""",
    "settings": f"""
        SELECT o_orderkey * 2 + 2 AS DSettingID, o_custkey % 25 AS PricePolID, o_custkey AS ProductID,
               CAST(NULL AS INT) AS BrandID, CAST(NULL AS BIGINT) AS CategoryID, CAST(NULL AS BIGINT) AS MGID,
               {CALC} - CAST(o_orderkey % 40 AS INT) AS DateBegin,
               CASE WHEN o_orderkey % 7 > 0 THEN {CALC} + CAST(o_custkey % 45 - o_orderkey % 40 AS INT) END AS DateEnd,
               CASE o_orderkey % 10 WHEN 0 THEN CAST(0 AS DECIMAL(12,2)) WHEN 1 THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS FixPrice
        FROM {{orders}}
        UNION ALL
        SELECT CAST((n_nationkey * 8 + k) * 1371 + 1 AS BIGINT) * 2 + 1, CAST(n_nationkey AS BIGINT), CAST(NULL AS BIGINT),
               CASE k % 4 WHEN 0 THEN 1 + (n_nationkey * 3 + k) % 25 WHEN 2 THEN 1000 + n_nationkey % 5 END,
               CASE WHEN k % 4 IN (1, 2) THEN CAST(CASE WHEN k < 4 THEN 10 + n_nationkey % 4 WHEN n_nationkey % 2 = 0 THEN 50 + n_nationkey % 12
                                                        ELSE 100 + n_nationkey % 40 END AS BIGINT) END,
               CASE WHEN k % 4 = 3 THEN CAST(1 + (n_nationkey + k) % 6 AS BIGINT) END,
               {CALC} - (n_nationkey * 5 + k) % 9, {CALC} + (n_nationkey + k) % 8 - 1, CAST(NULL AS DECIMAL(12,2))
        FROM {{nation}}, (VALUES (0), (1), (2), (3), (4), (5), (6), (7)) AS t(k)""",
    "layer_settings": """
        SELECT DSettingID, l AS DLayerID, CAST((DSettingID + l * 7) % 30 AS DECIMAL(8,4)) AS DiscountPercent
        FROM {settings}, (VALUES (1), (2), (3), (4)) AS t(l)
        WHERE (DSettingID + l) % 3 > 0 AND DSettingID % 5 < 4""",
    "layers": """
        SELECT DISTINCT CAST(1 + n_nationkey % 5 AS INT) AS DLayerID, CASE WHEN n_nationkey % 5 < 3 THEN 1 + n_nationkey % 5 ELSE 1 END AS DLayerGroupID,
               CASE n_nationkey % 5 WHEN 3 THEN 1 WHEN 4 THEN 2 ELSE 0 END AS DLayerStatus, 1 AS RowState FROM {nation}""",
    "layer_groups": "SELECT DISTINCT 1 + n_nationkey % 3 AS DLayerGroupID, 1 AS RowState FROM {nation}",
    "exceptions": f"""
        SELECT CAST(c_nationkey AS BIGINT) AS PricePolID, c_custkey AS ProductID, {CALC} - CAST(c_custkey % 20 AS INT) AS DateBegin,
               CASE WHEN c_custkey % 3 > 0 THEN {CALC} + CAST(c_custkey % 25 - c_custkey % 20 AS INT) END AS DateEnd,
               abs(CAST(c_acctbal AS DECIMAL(12,2))) AS BasePrice, CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE 1 END AS RowState
        FROM {{customer}}""",
    "base_prices": f"""
        SELECT l_partkey AS ProductID, 1 + l_linenumber % 3 AS BasePriceTypeID, CASE WHEN l_suppkey % 10 = 0 THEN 2 ELSE 1 END AS LegalEntityID,
               {CALC} - CAST(l_orderkey % 50 - 5 AS INT) AS DatePrice, max(CAST(l_extendedprice AS DECIMAL(12,2))) AS BasePrice
        FROM {{lineitem}} GROUP BY 1, 2, 3, 4""",
    "statuses": f"""
        SELECT l_partkey AS ProdID, {CALC} - CAST(l_orderkey % 60 - 5 AS INT) AS Data, max(l_linenumber) AS Status
        FROM {{lineitem}} GROUP BY 1, 2""",
    "bindings": f"""
        SELECT l_partkey AS ProductID, l_suppkey % 25 AS PolType, {CALC} - CAST(l_orderkey % 45 - 5 AS INT) AS Data,
               CASE WHEN l_linenumber % 5 = 4 THEN 1 ELSE 0 END AS FormulaType, max(l_linenumber) AS PLFormula
        FROM {{lineitem}} GROUP BY 1, 2, 3, 4""",
    "archive": f"""
        SELECT l_partkey AS ProductID, {CALC} - CAST(l_orderkey % 12 AS INT) AS Data, l_suppkey * 3 % 25 AS PolType,
               max(CAST(l_extendedprice AS DECIMAL(19,4))) AS Price, 10 AS NDS, 0 AS CurrID, max(4 + l_linenumber % 3 * 16) AS Status,
               2 AS BasePriceTypeID, 10 AS NDSID, max(CAST(l_extendedprice AS DECIMAL(19,4))) AS BasePrice,
               CAST(0 AS DECIMAL(19,4)) AS Price1, CAST(0 AS DECIMAL(19,4)) AS Price2, 0 AS PriceType
        FROM {{lineitem}} GROUP BY 1, 2, 3""",
    "new_prices": f"""
        SELECT l_partkey AS ProductID, {CALC} - CAST(l_orderkey % 2 AS INT) AS Data, l_suppkey * 7 % 25 AS PolType,
               max(CAST(l_extendedprice AS DECIMAL(19,4))) AS Price, max(l_linenumber % 4 * 12) AS Status
        FROM {{lineitem}} GROUP BY 1, 2, 3""",
    "analogs": """
        SELECT a.ID AS ProductID, b.ID AS AnalogID, CASE WHEN a.ID = b.ID THEN 0 ELSE 1 END AS IsAnalog,
               CASE WHEN b.ID % 31 = 0 THEN 1 ELSE 0 END AS Discont
        FROM {products} a JOIN {products} b ON a.AGID = b.AGID
        UNION ALL
        SELECT ID, ID, 0, CASE WHEN ID % 31 = 0 THEN 1 ELSE 0 END FROM {products} WHERE AGID IS NULL""",
    "params": "SELECT DISTINCT 1 + r_regionkey AS ParamID, CASE WHEN r_regionkey = 0 THEN 'FormulaNTL' ELSE r_name END AS ParamName FROM {region}",
    "param_values": f"SELECT 1 + r_regionkey % 3 AS ParamID, {CALC} + r_regionkey AS DateFrom, {SYSTEM} + r_regionkey % 2 AS SystemID FROM {{region}}",
}

SOURCES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def price_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    frames = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in SOURCES}
    out: dict[str, DataFrame] = {}
    for name, text in TABLES.items():
        known = {**frames, **out}
        out[name] = spark.sql(text, **{k: v for k, v in known.items() if "{" + k + "}" in text})
    return out


def table_ctes() -> list[tuple[str, str]]:
    """The same tables as (name, SQL) common table expressions for the oracle."""
    plain = {**{n: n for n in SOURCES}, **{n: n for n in TABLES}}
    return [(name, text.format(**plain)) for name, text in TABLES.items()]
