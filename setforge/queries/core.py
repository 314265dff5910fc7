"""Registered queries over the single operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setforge.functions.scalars import (
    concat_skip_null, concat_strict, end_to_zero, nullif0, seconds_crossed, split_list, styled,
)
from setforge.operators.asof import as_of_join
from setforge.operators.intervals import interval_overlap
from setforge.operators.merge import change_summary, delete_where, merge_snapshot, merged_rows
from setforge.operators.ordered import Order, prefix_sum, rank_global, with_row_id
from setforge.operators.rules import (
    has_flag, join_any, match_rules, pick_by_priority, wildcard_semi,
)
from setforge.operators.temporal import active_on, latest_as_of, latest_one, opt_eq, started
from setforge.plans.allocate import allocate
from setforge.plans.cycles import ancestor_counts, closure, closure_bounded, cycle_members, find_cycles
from setforge.plans.layout import classify_action, command_text, compact, compaction_plan, file_list, layout_compare, layout_report, layout_stats, over_threshold
from setforge.plans.pricing.formulas import by_formula
from setforge.queries.price_tables import CALC, TABLES as PRICE_TABLES
from setforge.queries.registry import Registry
from setforge.session import cut_lineage, new_folder

registry = Registry()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})


def plain(text: str, *names: str) -> str:
    return text.format(**{n: n for n in names})


# --- allocation and running totals -------------------------------------------------------------

SUPPLY = "SELECT l_partkey AS boxid, CAST(sum(l_quantity) AS BIGINT) AS qty FROM {lineitem} GROUP BY l_partkey"
DEMAND = "SELECT o_orderkey AS pid, o_custkey % 40 AS qty FROM {orders}"


def q_allocate(spark, sf_dir):
    return allocate(derived(spark, sf_dir, SUPPLY, "lineitem"), derived(spark, sf_dir, DEMAND, "orders"))


registry.add("allocate", q_allocate, f"""
    WITH boxes AS (SELECT boxid, qty, sum(qty) OVER (ORDER BY boxid) AS total FROM ({plain(SUPPLY, "lineitem")})),
    buyers AS (SELECT pid, qty, sum(qty) OVER (ORDER BY pid) AS total FROM ({plain(DEMAND, "orders")})),
    spans AS (
        SELECT boxid, pid, CAST(boxes.total - boxes.qty AS BIGINT) AS b_bef, CAST(boxes.total AS BIGINT) AS b_aft,
               CAST(buyers.total - buyers.qty AS BIGINT) AS p_bef, CAST(buyers.total AS BIGINT) AS p_aft, buyers.qty AS pqty, boxes.qty AS bqty
        FROM boxes CROSS JOIN buyers)
    SELECT boxid, pid, b_bef, b_aft, p_bef, p_aft, pqty, bqty, least(b_aft, p_aft) - greatest(b_bef, p_bef) AS "get" FROM spans
    WHERE CASE WHEN bqty > 0 AND pqty > 0 THEN greatest(b_bef, p_bef) < least(b_aft, p_aft)
               WHEN bqty = 0 AND pqty = 0 THEN FALSE
               WHEN bqty = 0 THEN p_bef < b_aft AND b_aft <= p_aft
               ELSE b_bef < p_aft AND p_aft <= b_aft END""")


def q_prefix_inclusive(spark, sf_dir):
    return prefix_sum(derived(spark, sf_dir, SUPPLY, "lineitem"), "qty", "boxid", out="total")


registry.add("prefix_sum_inclusive", q_prefix_inclusive, f"""
    SELECT *, CAST(sum(qty) OVER (ORDER BY boxid ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM ({plain(SUPPLY, "lineitem")})""")


def q_prefix_exclusive(spark, sf_dir):
    return prefix_sum(derived(spark, sf_dir, DEMAND, "orders"), "qty", "pid", inclusive=False, out="total")


registry.add("prefix_sum_exclusive", q_prefix_exclusive, f"""
    SELECT *, CAST(coalesce(sum(qty) OVER (ORDER BY pid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS total
    FROM ({plain(DEMAND, "orders")})""")


def q_rank(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return rank_global(parts, [Order("p_size", descending=True), Order("p_partkey")]).withColumn(
        "p_size", F.col("p_size").cast("bigint")
    )


registry.add("rank_global", q_rank, """
    SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS row_id FROM part""")


def q_rank_hot(spark, sf_dir):
    """A leading key where a few values hold almost all rows."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.least(F.col("o_custkey") % 9, F.lit(3)).alias("k"))
    return rank_global(orders, [Order("k", descending=True), Order("o_orderkey", descending=True)])


registry.add("rank_hot_keys", q_rank_hot, """
    SELECT o_orderkey, least(o_custkey % 9, 3) AS k,
           row_number() OVER (ORDER BY least(o_custkey % 9, 3) DESC, o_orderkey DESC) AS row_id FROM orders""")


def q_row_id(spark, sf_dir):
    return with_row_id(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "row_id")


registry.add("row_ids", q_row_id, "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS row_id FROM events")

# --- as-of and validity ------------------------------------------------------------------------

HISTORY = "SELECT l_partkey, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS shipped, l_extendedprice FROM {lineitem}"


def q_latest(spark, sf_dir):
    rows = latest_as_of(derived(spark, sf_dir, HISTORY, "lineitem"), ["l_partkey"], "shipped", F.expr(CALC))
    return rows.select(
        "l_partkey", "l_orderkey", F.col("l_linenumber").cast("bigint").alias("line"), F.col("shipped").cast("string").alias("shipped"),
        "l_extendedprice",
    )


registry.add("latest_as_of", q_latest, f"""
    SELECT l_partkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS line, CAST(shipped AS VARCHAR) AS shipped, l_extendedprice
    FROM ({plain(HISTORY, "lineitem")}) WHERE shipped <= {CALC}
    QUALIFY rank() OVER (PARTITION BY l_partkey ORDER BY shipped DESC) = 1""")


def q_latest_one(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return latest_one(orders, ["o_custkey"], "o_orderkey")


registry.add("latest_one", q_latest_one, """
    SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""")

PERIODS = f"""SELECT o_orderkey AS id, {CALC} - CAST(o_orderkey % 40 AS INT) AS b,
    CASE WHEN o_orderkey % 7 > 0 THEN {CALC} + CAST(o_custkey % 45 - o_orderkey % 40 AS INT) END AS e FROM {{orders}}"""


def q_active(spark, sf_dir):
    rows, date = derived(spark, sf_dir, PERIODS, "orders"), F.expr(CALC)
    found = [
        active_on(rows, date, "b", "e", grace_days=grace, null_end=rule).select("id", F.lit(rule).alias("rule"))
        for rule, grace in (("never", 1), ("open", 0), ("sentinel", 0))
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


registry.add("active_on_date", q_active, f"""
    WITH r AS ({plain(PERIODS, "orders")})
    SELECT id, 'never' AS rule FROM r WHERE {CALC} BETWEEN b AND e + 1
    UNION ALL SELECT id, 'open' FROM r WHERE {CALC} BETWEEN b AND coalesce(e, {CALC})
    UNION ALL SELECT id, 'sentinel' FROM r WHERE {CALC} BETWEEN b AND coalesce(e, DATE '2079-06-06')""")

LISTS = PRICE_TABLES["price_lists"]


def q_started(spark, sf_dir):
    lists = started(derived(spark, sf_dir, LISTS, "nation"), "NTLStartDate", F.expr(CALC))
    return opt_eq(opt_eq(lists, "BasePriceTypeID", 2), "CurrID").select("PricePolID")


registry.add("started_lists", q_started, f"""
    SELECT PricePolID FROM ({plain(LISTS, "nation")}) WHERE NTLStartDate <= {CALC} AND BasePriceTypeID = 2""")

# --- scalars -----------------------------------------------------------------------------------


def q_scalars(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") != "click", F.col("event_type"))
    until = F.expr("ts + make_dt_interval(0, 0, 0, 1.5)")
    return e.select(
        "event_id",
        nullif0(F.col("user_id") % 3).alias("user_or_null"),
        end_to_zero(F.col("user_id"), F.col("event_id") % 4 == 0).alias("live_user"),
        concat_skip_null(kind, F.lit(":"), F.col("user_id").cast("string")).alias("loose"),
        concat_strict(kind, F.lit(":"), F.col("user_id").cast("string")).alias("strict"),
        styled(F.col("ts"), 104).alias("day"),
        styled(F.col("ts"), 108).alias("clock"),
        seconds_crossed(F.col("ts"), until).alias("seconds"),
    )


registry.add("scalar_rules", q_scalars, """
    SELECT event_id, nullif(user_id % 3, 0) AS user_or_null, CASE WHEN event_id % 4 = 0 THEN 0 ELSE user_id END AS live_user,
           concat(nullif(event_type, 'click'), ':', user_id) AS loose, nullif(event_type, 'click') || ':' || user_id AS strict,
           strftime(ts, '%d.%m.%Y') AS day, strftime(ts, '%H:%M:%S') AS clock,
           date_diff('second', ts, ts + INTERVAL '1500 milliseconds') AS seconds FROM events""")


def q_split(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", split_list(F.col("p_name"), " ").alias("word"))
    return parts.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


registry.add("split_list", q_split, "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1")

# --- rules and priorities ----------------------------------------------------------------------


def q_flags(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumn("status", F.col("l_linenumber") * 4 + F.col("l_quantity").cast("int"))
    return items.groupBy("l_partkey").agg(
        *[F.count_if(has_flag("status", m)).alias(f"n{m}") for m in (4, 16, 20, 32)]
    )


registry.add("flag_counts", q_flags, """
    WITH s AS (SELECT l_partkey, l_linenumber * 4 + CAST(l_quantity AS INT) AS status FROM lineitem)
    SELECT l_partkey, count(*) FILTER (status & 4 = 4) AS n4, count(*) FILTER (status & 16 = 16) AS n16,
           count(*) FILTER (status & 20 = 20) AS n20, count(*) FILTER (status & 32 = 32) AS n32 FROM s GROUP BY 1""")


def q_priority(spark, sf_dir):
    """The newest order with a price of a customer decides; a newest price of 0 leaves none."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey",
        F.when(F.col("o_orderkey") % 5 == 0, 0.0).when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("fix"),
    )
    return pick_by_priority(orders.filter(F.col("fix") >= 0), ["o_custkey"], "o_orderkey", keep=F.col("fix") > 0)


registry.add("pick_by_priority", q_priority, """
    SELECT o_custkey, o_orderkey, fix FROM (
        SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 0.0::DOUBLE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS fix FROM orders)
    WHERE fix >= 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1 AND fix > 0""")

PAIRS = "SELECT DISTINCT l_suppkey % 25 AS lst, l_partkey AS prod, l_orderkey % 50 AS setting FROM {lineitem}"
CHANGES = """SELECT o_custkey % 25 AS lst, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS prod,
    CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 50 END AS setting FROM {orders}"""


def q_wildcard(spark, sf_dir):
    rows, rules = derived(spark, sf_dir, PAIRS, "lineitem"), derived(spark, sf_dir, CHANGES, "orders")
    return wildcard_semi(rows, rules, ["lst"], ["prod", "setting"]).distinct()


registry.add("wildcard_match", q_wildcard, f"""
    WITH r AS ({plain(PAIRS, "lineitem")}), e AS ({plain(CHANGES, "orders")})
    SELECT * FROM r WHERE EXISTS (SELECT 1 FROM e WHERE e.lst = r.lst AND r.prod = coalesce(e.prod, r.prod)
                                  AND r.setting = coalesce(e.setting, r.setting))""")

GROUPS = """SELECT DISTINCT p_size AS grp, 'Brand#' || CAST(1 + p_size % 25 AS STRING) AS brand, p_partkey % 500 AS own FROM {part}"""


def q_join_any(spark, sf_dir):
    groups = derived(spark, sf_dir, GROUPS, "part")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"), (F.col("p_partkey") % 500).alias("own"))
    arms = [(["own"], None), (["brand"], F.col("own") % 2 == 0)]
    return join_any(groups, parts, arms, ["grp"], ["p_partkey"]).select(F.col("grp").cast("bigint").alias("grp"), "p_partkey")


registry.add("join_on_any_key", q_join_any, f"""
    WITH g AS ({plain(GROUPS, "part")})
    SELECT DISTINCT CAST(grp AS BIGINT) AS grp, p_partkey FROM g JOIN part p
    ON p.p_partkey % 500 = g.own OR (p.p_brand = g.brand AND p.p_partkey % 500 % 2 = 0)""")

SIZE_RULES = """SELECT n_nationkey AS rule, n_nationkey % 6 + 1 AS size_step, CASE WHEN n_nationkey % 2 = 0 THEN 'Brand#' || CAST(1 + n_nationkey AS STRING) END AS rule_brand,
    CASE WHEN n_nationkey % 3 = 0 THEN 1 + n_nationkey END AS rule_size FROM {nation}"""


def q_null_or_equal(spark, sf_dir):
    rules = derived(spark, sf_dir, SIZE_RULES, "nation").withColumnsRenamed({"rule_brand": "p_brand", "rule_size": "p_size"})
    parts = table(spark, sf_dir, "part").withColumn("size_step", F.col("p_size") % 6 + 1)
    named = match_rules(parts, rules, ["size_step"], ["p_brand", "p_size"], ["rule"], ["p_partkey"])
    return named.groupBy("rule").agg(F.count(F.lit(1)).alias("n")).select(F.col("rule").cast("bigint").alias("rule"), "n")


registry.add("null_or_equal_rules", q_null_or_equal, f"""
    SELECT CAST(rule AS BIGINT) AS rule, count(*) AS n FROM ({plain(SIZE_RULES, "nation")}) r JOIN part p ON p.p_size % 6 + 1 = r.size_step
    AND (rule_brand IS NULL OR rule_brand = p_brand) AND (rule_size IS NULL OR rule_size = p_size) GROUP BY 1""")

# --- parent links ------------------------------------------------------------------------------


def _ring(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey")
    size = parts.agg(F.count(F.lit(1)).alias("n"))
    return parts.crossJoin(F.broadcast(size)).select(  # one row: the size of the table
        F.col("p_partkey").alias("id"), ((F.col("p_partkey") * F.col("p_partkey") + 1) % F.col("n")).alias("parent_id")
    )


RING = "SELECT p_partkey AS id, (p_partkey * p_partkey + 1) % (SELECT count(*) FROM part) AS parent_id FROM part"
# a part lies on a cycle when it is among the parts it reaches; those parts are then its cycle
ON_CYCLE = f"""WITH RECURSIVE links AS ({RING}),
    reach AS (SELECT id AS start_id, parent_id AS met FROM links
              UNION SELECT reach.start_id, links.parent_id FROM reach JOIN links ON links.id = reach.met),
    named AS (SELECT start_id AS id, min(met) AS cycle_id, count(*) AS size FROM reach GROUP BY start_id HAVING bool_or(met = start_id)),
    climb AS (SELECT id, cycle_id, size, id AS here, CAST(0 AS BIGINT) AS pos FROM named
              UNION ALL SELECT climb.id, cycle_id, size, links.parent_id, pos + 1 FROM climb JOIN links ON links.id = climb.here WHERE climb.here <> cycle_id),
    members AS (SELECT id, cycle_id, size, pos FROM climb WHERE here = cycle_id)"""


def q_cycles(spark, sf_dir):
    return find_cycles(_ring(spark, sf_dir), limit=100)


registry.add("find_cycles", q_cycles, f"""
    {ON_CYCLE} SELECT s.id AS start_id, string_agg(CAST(m.id AS VARCHAR), ' -> ' ORDER BY (m.pos - s.pos - 1 + s.size) % s.size) AS path
    FROM members s JOIN members m ON m.cycle_id = s.cycle_id GROUP BY s.id ORDER BY s.id DESC LIMIT 100""")


def q_cycle_members(spark, sf_dir):
    return cycle_members(_ring(spark, sf_dir)).select("id", "cycle_id", "pos")


registry.add("cycle_members", q_cycle_members, f"{ON_CYCLE} SELECT id, cycle_id, pos FROM members")

TREE = "SELECT p_partkey AS id, CASE WHEN p_partkey > 1 THEN CAST(floor(p_partkey / 2) AS BIGINT) END AS parent_id FROM {part}"


def q_closure(spark, sf_dir):
    return closure(derived(spark, sf_dir, TREE, "part"))


# halving a number down to 1 takes as many steps as it has binary digits
DEPTHS = f"SELECT *, CASE WHEN id > 1 THEN CAST(length(ltrim(bin(id), '0')) AS BIGINT) ELSE 1 END AS depth FROM ({plain(TREE, 'part')})"
registry.add("closure", q_closure, f"SELECT id, parent_id FROM (SELECT id, parent_id, unnest(range(0, depth)) FROM ({DEPTHS}))")


def q_depth(spark, sf_dir):
    return ancestor_counts(derived(spark, sf_dir, TREE, "part")).select("id", "depth")


registry.add("ancestor_counts", q_depth, f"SELECT id, depth FROM ({DEPTHS})")


def q_closure_bounded(spark, sf_dir):
    """Up to five steps on the ring table, of which every seventh row is missing."""
    return closure_bounded(_ring(spark, sf_dir).where("id % 7 <> 3"), max_depth=5)


registry.add("closure_bounded", q_closure_bounded, f"""
    WITH n AS (SELECT count(*) AS n FROM part), r AS ({RING}),
    a AS (SELECT id, parent_id, n, (parent_id * parent_id + 1) % n AS b FROM r, n WHERE id % 7 <> 3),
    c AS (SELECT *, (b * b + 1) % n AS c FROM a), d AS (SELECT *, (c * c + 1) % n AS d FROM c), e AS (SELECT *, (d * d + 1) % n AS e FROM d),
    f AS (SELECT *, CASE WHEN parent_id % 7 = 3 THEN 0 WHEN b % 7 = 3 THEN 1 WHEN c % 7 = 3 THEN 2 WHEN d % 7 = 3 THEN 3 WHEN e % 7 = 3 THEN 4 ELSE 5 END AS far FROM e)
    SELECT id, parent_id, CAST(unnest(range(0, far + 1)) AS INT) AS level FROM f""")

# --- merge and delete --------------------------------------------------------------------------

STORED = "SELECT o_orderkey AS id, CAST(o_custkey AS BIGINT) AS cust, o_totalprice AS price, o_orderkey % 64 AS flags FROM {orders}"
FRESH = """SELECT CASE WHEN o_orderkey % 6 = 0 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS id, CAST(o_custkey AS BIGINT) AS cust,
    CASE o_orderkey % 5 WHEN 0 THEN o_totalprice + 1 WHEN 1 THEN NULL ELSE o_totalprice END AS price, o_orderkey % 64 AS flags FROM {orders}"""
MERGE_ORACLE = f"""WITH t AS ({plain(STORED, "orders")}), s AS ({plain(FRESH, "orders")}), m AS (
    SELECT coalesce(t.id, s.id) AS id, CASE WHEN t.id IS NULL THEN 'INSERT'
        WHEN s.id IS NULL THEN CASE WHEN t.flags & 16 = 16 THEN 'DELETE' ELSE 'KEEP' END
        WHEN t.price <> s.price OR t.flags <> s.flags THEN 'UPDATE' ELSE 'KEEP' END AS action,
        t.price AS old_price, s.price AS new_price FROM t FULL JOIN s ON t.id = s.id)"""


def _merged(spark, sf_dir):
    return merge_snapshot(
        derived(spark, sf_dir, STORED, "orders"), derived(spark, sf_dir, FRESH, "orders"), ["id"], ["price", "flags"], has_flag("flags", 16)
    )


def q_merge(spark, sf_dir):
    return _merged(spark, sf_dir).select("id", "action", "price")


registry.add("merge_snapshot", q_merge, f"""
    {MERGE_ORACLE} SELECT id, action, CASE WHEN action IN ('INSERT', 'UPDATE') THEN new_price ELSE old_price END AS price FROM m""")


def q_merge_rows(spark, sf_dir):
    return merged_rows(_merged(spark, sf_dir)).select("id", "price")


registry.add("merged_rows", q_merge_rows, f"""
    {MERGE_ORACLE} SELECT id, CASE WHEN action IN ('INSERT', 'UPDATE') THEN new_price ELSE old_price END AS price FROM m WHERE action <> 'DELETE'""")


def q_merge_summary(spark, sf_dir):
    return change_summary(_merged(spark, sf_dir), "action")


# every seventh order comes under the key of the one before it as well
TWICE = """SELECT CASE WHEN o_orderkey % 7 = 1 THEN o_orderkey - 1 WHEN o_orderkey % 7 = 4 THEN o_orderkey + 1000000000 - o_orderkey % 2 ELSE o_orderkey END AS id,
    CAST(o_custkey AS BIGINT) AS cust, o_totalprice AS price, o_orderkey % 64 AS flags FROM {orders} WHERE o_orderkey % 11 <> 5"""


def _merged_twice(spark, sf_dir, **settings):
    stored, fresh = derived(spark, sf_dir, STORED, "orders"), derived(spark, sf_dir, TWICE, "orders")
    return merge_snapshot(stored, fresh, ["id"], ["price", "flags"], has_flag("flags", 16), **settings)


def q_merge_duplicates(spark, sf_dir):
    """A source with repeated keys, which are refused."""
    return _merged_twice(spark, sf_dir).select("id", "action", "price")


def q_merge_settled(spark, sf_dir):
    """The same source, where the highest price counts."""
    return merged_rows(_merged_twice(spark, sf_dir, settle=[-F.col("price")])).select("id", "cust", "price", "flags")


registry.add("merge_duplicates", q_merge_duplicates, f"""
    WITH t AS ({plain(STORED, "orders")}), s AS ({plain(TWICE, "orders")}),
    n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
    one AS (SELECT s.* FROM s JOIN n ON n.id = s.id AND n.n = 1)
    SELECT t.id, CASE WHEN n.n > 1 THEN 'REFUSE_UPDATE' WHEN n.n IS NULL AND t.flags & 16 = 16 THEN 'DELETE'
            WHEN one.price <> t.price OR one.flags <> t.flags THEN 'UPDATE' ELSE 'KEEP' END AS action,
        CASE WHEN one.price <> t.price OR one.flags <> t.flags THEN one.price ELSE t.price END AS price
    FROM t LEFT JOIN n ON n.id = t.id LEFT JOIN one ON one.id = t.id
    UNION ALL SELECT n.id, CASE WHEN n.n > 1 THEN 'REFUSE_INSERT' ELSE 'INSERT' END, one.price
    FROM n LEFT JOIN one ON one.id = n.id WHERE n.id NOT IN (SELECT id FROM t)""")
registry.add("merge_settled", q_merge_settled, f"""
    WITH t AS ({plain(STORED, "orders")}),
    s AS (SELECT * FROM ({plain(TWICE, "orders")}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY price DESC, cust, price, flags) = 1)
    SELECT t.id, CASE WHEN s.price <> t.price OR s.flags <> t.flags THEN s.cust ELSE t.cust END AS cust,
        CASE WHEN s.price <> t.price OR s.flags <> t.flags THEN s.price ELSE t.price END AS price,
        CASE WHEN s.price <> t.price OR s.flags <> t.flags THEN s.flags ELSE t.flags END AS flags
    FROM t LEFT JOIN s ON s.id = t.id WHERE s.id IS NOT NULL OR t.flags & 16 <> 16
    UNION ALL SELECT s.* FROM s WHERE s.id NOT IN (SELECT id FROM t)""")
registry.add("merge_summary", q_merge_summary, f"{MERGE_ORACLE} SELECT action, count(*) AS n FROM m GROUP BY 1")


def q_delete(spark, sf_dir):
    stored, fresh = derived(spark, sf_dir, STORED, "orders"), derived(spark, sf_dir, FRESH, "orders")
    return delete_where(stored, fresh, ["id"], F.col("cust") % 2 == 0, has_flag("flags", 32)).select("id", "cust")


registry.add("delete_where", q_delete, f"""
    SELECT id, cust FROM ({plain(STORED, "orders")}) t WHERE NOT (cust % 2 = 0
        AND (flags & 32 = 32 OR id IN (SELECT id FROM ({plain(FRESH, "orders")}))))""")

# --- layout ------------------------------------------------------------------------------------

METRICS = """SELECT l_suppkey AS part_id, count(*) AS files, count(*) FILTER (WHERE l_quantity < 12) AS small_files,
    sum(CAST(l_quantity AS BIGINT)) AS bytes FROM {lineitem} GROUP BY l_suppkey"""
SHARE = "CAST(small_files AS DOUBLE) * 100 / CAST(files AS DOUBLE)"


def q_actions(spark, sf_dir):
    """Both rule sets for actions, over one row per supplier."""
    stats = derived(spark, sf_dir, METRICS, "lineitem").withColumn("small_percent", F.expr(SHARE))
    report = stats.withColumn("report", classify_action(F.col("small_percent"), 30, True, 5)).withColumn(
        "job", classify_action(F.col("small_percent"), 40, False)
    )
    kept = over_threshold(report, min_percent=15, min_count=5)
    text = command_text(F.col("report"), F.col("part_id").cast("string"), F.lit("p"))
    return kept.select("part_id", "report", "job", text.alias("command"))


registry.add("layout_actions", q_actions, f"""
    WITH s AS (SELECT *, {SHARE} AS pct FROM ({plain(METRICS, "lineitem")})), a AS (
        SELECT part_id, files, pct, CASE WHEN pct <= 5 THEN 'SKIP' WHEN pct >= 30 THEN 'REBUILD' ELSE 'REORGANIZE' END AS report,
               CASE WHEN pct > 40 THEN 'REBUILD' ELSE 'REORGANIZE' END AS job FROM s)
    SELECT part_id, report, job, 'COMPACT [p] ON ''' || part_id || ''' ' || report || ';' || chr(13) || chr(10) AS command
    FROM a WHERE pct >= 15 AND files > 5""")


# files of data sets, one per line item; their sizes follow its price
FILES = """SELECT '/data/set' || CAST(l_linenumber AS STRING) AS dataset, '/s=' || CAST(l_suppkey % 40 AS STRING) AS partition,
    CAST(l_orderkey AS STRING) AS path, CAST(floor(l_extendedprice * {factor}) AS BIGINT) AS bytes FROM {{lineitem}}"""
BEFORE, AFTER = FILES.format(factor=1000), FILES.format(factor=2000)
BIG = 50_000_000


def _stats(spark, sf_dir, files):
    return layout_stats(derived(spark, sf_dir, files, "lineitem"), BIG)


def _stats_sql(files: str) -> str:
    return f"""SELECT dataset, partition, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) FILTER (bytes < {BIG}) AS small_files,
        max(bytes) AS largest, avg(bytes) AS mean, round(count(*) FILTER (bytes < {BIG}) * 100.0::DOUBLE / count(*), 4) AS small_percent
        FROM ({plain(files, "lineitem")}) GROUP BY dataset, partition"""


def q_layout_stats(spark, sf_dir):
    return _stats(spark, sf_dir, BEFORE)


registry.add("layout_stats", q_layout_stats, _stats_sql(BEFORE))

_ACTION = "CASE WHEN small_percent <= 5 THEN 'SKIP' WHEN small_percent >= 30 THEN 'REBUILD' ELSE 'REORGANIZE' END"


def q_layout(spark, sf_dir):
    return layout_report(_stats(spark, sf_dir, BEFORE), min_percent=3).select("dataset", "partition", "files", "rank", "action", "command")


registry.add("layout_report", q_layout, f"""
    SELECT dataset, partition, files, row_number() OVER (ORDER BY small_percent DESC, dataset, partition) AS rank, {_ACTION} AS action,
           CASE WHEN small_percent > 5 THEN 'COMPACT [' || partition || '] ON ' || chr(39) || dataset || chr(39) || ' ' || {_ACTION} || ';' || chr(13) || chr(10) END AS command
    FROM ({_stats_sql(BEFORE)}) WHERE small_percent >= 3""")


def q_layout_whole(spark, sf_dir):
    whole = layout_report(_stats(spark, sf_dir, BEFORE), whole_dataset=True)
    return whole.select("dataset", "files", "bytes", "small_files", "largest", "small_percent", "rank", "action")


registry.add("layout_report_whole", q_layout_whole, f"""
    WITH w AS (SELECT dataset, CAST(sum(files) AS BIGINT) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(small_files) AS BIGINT) AS small_files,
                      max(largest) AS largest, max(small_percent) AS small_percent FROM ({_stats_sql(BEFORE)}) GROUP BY dataset)
    SELECT *, row_number() OVER (ORDER BY small_percent DESC, dataset) AS rank, {_ACTION} AS action FROM w""")


def _plan(spark, sf_dir):
    return compaction_plan(_stats(spark, sf_dir, BEFORE), min_percent=15, rebuild=40, min_files=3)


def q_layout_plan(spark, sf_dir):
    return _plan(spark, sf_dir).select("dataset", "partition", "action")


_PLAN = f"""SELECT *, CASE WHEN small_percent > 40 THEN 'REBUILD' ELSE 'REORGANIZE' END AS action
    FROM ({_stats_sql(BEFORE)}) WHERE small_percent >= 15 AND files > 3"""
registry.add("layout_plan", q_layout_plan, f"SELECT dataset, partition, action FROM ({_PLAN})")


def q_layout_compare(spark, sf_dir):
    return layout_compare(_plan(spark, sf_dir), _stats(spark, sf_dir, AFTER))


_SIDES = [f"{side}.{c} AS {c}_{name}" for side, name in (("b", "before"), ("a", "after")) for c in ("small_percent", "files", "bytes", "largest", "mean")]
registry.add("layout_compare", q_layout_compare, f"""
    SELECT dataset, partition, b.action, {", ".join(_SIDES)} FROM ({_PLAN}) b JOIN ({_stats_sql(AFTER)}) a USING (dataset, partition)""")

# --- as-of with a date in every row ------------------------------------------------------------

# a third of both sides share one key; shipments start a year after the orders
STAMPS = """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_suppkey % 100 END AS k, l_shipdate AS shipped, l_partkey AS part, l_quantity AS qty
    FROM {lineitem} WHERE l_shipdate >= TIMESTAMP '1996-01-01'"""
ASKED = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey % 120 END AS k, o_orderdate FROM {orders}"


def q_as_of_join(spark, sf_dir):
    """The latest shipment before every order."""
    return as_of_join(derived(spark, sf_dir, ASKED, "orders"), derived(spark, sf_dir, STAMPS, "lineitem"), ["k"], "o_orderdate", "shipped", ["part", "qty"])


registry.add("as_of_join", q_as_of_join, f"""
    WITH l AS ({plain(ASKED, "orders")}), r AS ({plain(STAMPS, "lineitem")}),
    one AS (SELECT k, shipped, max(struct_pack(part := part, qty := qty)) AS best FROM r GROUP BY ALL)
    SELECT l.*, best.part AS part, best.qty AS qty FROM l ASOF LEFT JOIN one ON one.k = l.k AND one.shipped <= l.o_orderdate""")

# --- overlapping spans -------------------------------------------------------------------------

ORDER_SPANS = """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey % 60 END AS k, CAST(o_orderdate AS DATE) AS ordered,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 - 2 AS INT) AS closed FROM {orders} WHERE o_orderkey % 4 = 1 OR o_orderkey % 9 = 0"""
LINE_SPANS = """SELECT l_orderkey, l_partkey, CASE WHEN l_partkey % 3 = 0 THEN 7 ELSE l_suppkey % 50 END AS k, CAST(l_shipdate AS DATE) AS sent,
    CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) AS arrived FROM {lineitem} WHERE l_orderkey % 50 = 3"""


def q_interval_overlap(spark, sf_dir):
    """Orders that are open while a shipment of their key is under way."""
    a, b = derived(spark, sf_dir, ORDER_SPANS, "orders"), derived(spark, sf_dir, LINE_SPANS, "lineitem")
    found = interval_overlap(a, b, ["k"], ("ordered", "closed"), ("sent", "arrived"))
    return found.groupBy("a.o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("b.l_partkey").alias("parts"))


registry.add("interval_overlap", q_interval_overlap, f"""
    SELECT a.o_orderkey, count(*) AS n, CAST(sum(b.l_partkey) AS BIGINT) AS parts FROM ({plain(ORDER_SPANS, "orders")}) a
    JOIN ({plain(LINE_SPANS, "lineitem")}) b ON a.k = b.k AND a.ordered <= b.arrived AND b.sent <= a.closed
    WHERE a.ordered <= a.closed GROUP BY 1""")

# --- formulas in rows --------------------------------------------------------------------------

# six kinds of formula over the suppliers' nations: plain, with later parts, dividing by what may be 0, negated, and two faulty ones
FORMULA_PARTS = """SELECT n_nationkey AS lst, num AS Num,
    CASE WHEN num > 1 THEN 'base' ELSE element_at(array('base', 'base - d1 * qty', 'base / (qty - 10)', '-base + -(d1 - d2) * 3 - 1', 'base', '(base'), CAST(n_nationkey % 6 + 1 AS INT)) END AS Part,
    CASE WHEN num = 1 THEN element_at(array('(100-d1)/100', '1', '2-1.5', '-(1)', '1-nosuch', '2'), CAST(n_nationkey % 6 + 1 AS INT))
         WHEN num = 2 THEN '(100-d2)/100' ELSE '(100 - ' || CAST(n_nationkey AS STRING) || '/4/2)/100' END AS Gr
    FROM (SELECT n_nationkey, explode(array(1, 2, 4)) AS num FROM {nation}) WHERE n_nationkey <> 24 AND (num = 1 OR n_nationkey % 6 <> 2)"""


def q_formula_rows(spark, sf_dir):
    """A formula per price list, all of them in one plan."""
    parts = derived(spark, sf_dir, FORMULA_PARTS, "nation")
    line = table(spark, sf_dir, "lineitem")
    rows = line.select(
        "l_orderkey", "l_partkey", (F.col("l_suppkey") % 25).cast("int").alias("lst"), F.col("l_extendedprice").alias("base"),
        (F.col("l_discount") * 100).alias("d1"), (F.col("l_tax") * 100).alias("d2"), F.col("l_quantity").alias("qty"),
    )
    priced = by_formula(rows, parts, ["lst"], ["base", "d1", "d2", "qty"])
    return priced.select("l_orderkey", "l_partkey", "qty", "formula_price", "formula_fault")


registry.add("formula_rows", q_formula_rows, """
    WITH r AS (SELECT l_orderkey, l_partkey, l_suppkey % 25 AS lst, l_extendedprice AS base, l_discount * 100 AS d1, l_tax * 100 AS d2, l_quantity AS qty FROM lineitem),
    p AS (SELECT *, CAST(100 AS DOUBLE) AS c, CAST(lst AS DOUBLE) AS f FROM r)
    SELECT l_orderkey, l_partkey, qty,
        CASE WHEN lst = 24 THEN NULL
             WHEN lst % 6 = 0 THEN base * ((c - d1) / c) * ((c - d2) / c) * ((c - f / 4 / 2) / c)
             WHEN lst % 6 = 1 THEN (base - d1 * qty) * 1 * ((c - d2) / c) * ((c - f / 4 / 2) / c)
             WHEN lst % 6 = 2 AND qty <> 10 THEN base / (qty - 10) * CAST(0.5 AS DOUBLE)
             WHEN lst % 6 = 3 THEN (-base + -(d1 - d2) * 3 - 1) * -1 * ((c - d2) / c) * ((c - f / 4 / 2) / c) END AS formula_price,
        CASE WHEN lst = 24 THEN 'no formula' WHEN lst % 6 = 4 THEN 'unknown names: nosuch' WHEN lst % 6 = 5 THEN 'brackets do not match' END AS formula_fault
    FROM p""")

# --- real files --------------------------------------------------------------------------------


def flagged_files(rows: DataFrame, flag: str, files: int, path: str) -> None:
    """Add ``files`` files to the folder of each flag. A write to several folders at once would sort the rows of each task by folder."""
    name = rows.sparkSession.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for row in rows.select(flag).distinct().collect():  # a handful of flags
        rows.where(F.col(flag) == row[0]).drop(flag).repartition(files).write.mode("append").parquet(f"{path}/{name(flag, row[0])}")


def q_compact_files(spark, sf_dir):
    """A partitioned copy of the line items is compacted; rows and files per partition before and after.

    N and R have one large file and six small ones, A has twelve small ones and is rebuilt.
    """
    folder = new_folder(spark, "lineitem")
    path = f"{folder}/data"
    line = table(spark, sf_dir, "lineitem")
    large = (F.col("l_returnflag") != "A") & (F.col("l_orderkey") % 10 < 8)
    flagged_files(line.where(large), "l_returnflag", 1, path)
    flagged_files(line.where(~large & (F.col("l_returnflag") != "A")), "l_returnflag", 6, path)
    flagged_files(line.where("l_returnflag = 'A'"), "l_returnflag", 12, path)
    before = cut_lineage(file_list(spark, path))
    # the target is the smaller of the two large files
    largest = before.where("partition <> '/l_returnflag=A'").groupBy("partition").agg(F.max("bytes").alias("b")).agg(F.min("b")).first()[0]
    counted = spark.read.parquet(path).groupBy("l_returnflag").agg(F.count("*").alias("rows_before"))
    counted = cut_lineage(counted)
    plan = compaction_plan(layout_stats(before, largest), min_files=3, rebuild=90)
    compact(spark, path, plan, ["l_returnflag"], f"{folder}/staging", ["l_orderkey"], largest, dry_run=False)
    after = file_list(spark, path)
    kept = before.where(F.col("bytes") >= largest).join(after.select("path"), "path", "left_semi").groupBy("partition").agg(F.count("*").alias("large_kept"))
    files = after.groupBy("partition").agg(F.count("*").alias("now")).join(before.groupBy("partition").agg(F.count("*").alias("files_before")), "partition")
    flag = F.substring_index("partition", "=", -1)
    files = files.join(kept, "partition", "left").select(
        flag.alias("l_returnflag"), "files_before", (F.col("now") < F.col("files_before")).alias("fewer_files"), F.coalesce("large_kept", F.lit(0)).alias("large_kept")
    )
    now = spark.read.parquet(path).groupBy("l_returnflag").agg(F.count("*").alias("rows_after"), F.sum("l_quantity").alias("quantity"))
    return files.join(counted, "l_returnflag").join(now, "l_returnflag")


registry.add("compact_files", q_compact_files, """
    SELECT l_returnflag, CAST(CASE WHEN l_returnflag = 'A' THEN 12 ELSE 7 END AS BIGINT) AS files_before, true AS fewer_files,
        CAST(CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS BIGINT) AS large_kept, count(*) AS rows_before, count(*) AS rows_after, sum(l_quantity) AS quantity
    FROM lineitem GROUP BY 1""")
