"""Projections, filters, scalar rules, joins, aggregates, unions and sorts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelkit import functions as pf
from panelkit import operators as op

from .common import CODED_ORDERS, CODES, Query, country_codes, money, register
from .common import summarise_orders, table, year_of

QUERIES: dict[str, Query] = {}

# The name dictionary, patterns and override of the part-name queries.
PART_NAMES = {"Red Bolt": "BOL", "small  ring": "RIN", "hot gear": "GEA"}
PART_PATTERNS = [("bolt|ring", "MET"), ("gear$", "MCH"), ("^blue", "BLU"), ("widget", "WID")]
PART_OVERRIDE = {"old bolt": "OLD"}


@register(
    QUERIES,
    """SELECT p_partkey, p_size + 1 AS size, (p_size + 1) * 2 AS twice,
      CASE WHEN (p_size + 1) * 2 > 50 THEN 'large' ELSE 'small' END AS kind FROM part""",
)
def prj_staged_transmute(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumnRenamed("p_size", "size")
    return op.transmute(
        part,
        {"size": F.col("size") + 1},
        {"twice": F.col("size") * 2},
        {"kind": pf.if_else(F.col("twice") > 50, F.lit("large"), F.lit("small"))},
        keep=["p_partkey"],
    )


@register(
    QUERIES,
    """SELECT o_orderkey AS order_id, coalesce(o_orderstatus = 'F', false) AS hrp,
      CASE WHEN o_orderstatus = 'P' THEN false ELSE o_orderpriority = '1-URGENT' END AS rrp,
      'PSE' AS iso3 FROM orders""",
)
def prj_drop_suffix_range(spark, sf_dir):
    """Rename, add a constant, drop by suffix, and give a range of flags a default."""
    priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority") == "1-URGENT")
    df = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("price_pse"),
        F.col("o_custkey").alias("customer_PSE"),
        (F.col("o_orderstatus") == "F").alias("hrp"),
        priority.alias("rrp"),
        F.lit("PSE").alias("iso3"),
    )
    df = op.drop_suffix(df, "pse")
    return op.replace_missing(df, op.col_range(df, "hrp", "rrp"), False)


@register(
    QUERIES,
    f"""WITH {CODED_ORDERS}
    SELECT code, count(*) AS n FROM coded WHERE NOT coalesce(code IN ('N03', 'N07'), false)
    GROUP BY code""",
)
def flt_not_in_keep_null(spark, sf_dir):
    """Two codes left out, orders without a code kept."""
    counts = summarise_orders(spark, sf_dir, ["code"], {"n": op.measure_rows()})
    return counts.where(pf.not_in(F.col("code"), ["N03", "N07"]))


@register(
    QUERIES,
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, o_orderpriority AS priority
    FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000 AND o_totalprice >= 100000
      AND nullif(o_orderpriority, '5-LOW') IS NOT NULL AND o_orderstatus = 'F'""",
)
def flt_range_not_null(spark, sf_dir):
    """Range, threshold, equality and presence; the first three reach the file reader."""
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return (
        table(spark, sf_dir, "orders")
        .where(
            pf.year_between(F.col("o_orderdate"), 1996, 2000)
            & (F.col("o_totalprice") >= 100000)
            & (F.col("o_orderstatus") == "F")
        )
        .select(
            "o_orderkey", year_of("o_orderdate").alias("year"), priority.alias("priority")
        )
        .where(pf.is_present(F.col("priority")))
    )


@register(
    QUERIES,
    f"""WITH {CODES}
    SELECT c_custkey, CASE WHEN c_nationkey = 7 THEN 'OVR' ELSE code END AS iso3
    FROM customer LEFT JOIN codes ON c_nationkey = n_nationkey""",
)
def scl_recode_override(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    coded = op.recode(customers, "c_nationkey", country_codes(spark, sf_dir), "iso3", {7: "OVR"})
    return coded.drop("c_nationkey")


@register(
    QUERIES,
    """WITH named AS (
      SELECT p_partkey, nullif(p_name, 'cold gizmo') AS name FROM part),
    hits AS (SELECT *, list_distinct(list_filter([
        CASE WHEN regexp_matches(name, 'bolt|ring') THEN 'MET' END,
        CASE WHEN regexp_matches(name, 'gear$') THEN 'MCH' END,
        CASE WHEN regexp_matches(name, '^blue') THEN 'BLU' END,
        CASE WHEN regexp_matches(name, 'widget') THEN 'WID' END],
        lambda v: v IS NOT NULL)) AS found FROM named)
    SELECT p_partkey, name, CASE
      WHEN name IS NULL THEN NULL WHEN name = 'old bolt' THEN 'OLD'
      WHEN name = 'red bolt' THEN 'BOL' WHEN name = 'small ring' THEN 'RIN'
      WHEN name = 'hot gear' THEN 'GEA'
      WHEN len(found) = 1 THEN found[1] END AS code FROM hits""",
)
def scl_name_lookup_regex(spark, sf_dir):
    """Exact names, then patterns; several codes for one name give none; one fixed override."""
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.nullif("p_name", F.lit("cold gizmo")).alias("name")
    )
    names = op.lookup_table(spark, PART_NAMES, "name", "code")
    return op.recode_names(parts, "name", "code", names, PART_PATTERNS, PART_OVERRIDE)


@register(
    QUERIES,
    """WITH hits AS (SELECT c_custkey, c_name AS name, c_custkey // 10 AS ten,
        c_custkey // 10 < 400 AND c_custkey // 10 % 40 <> 7 AS known,
        regexp_matches(lower(c_name), '1[0-9]7$') AS odd FROM customer)
    SELECT c_custkey, name, CASE WHEN known AND odd THEN NULL WHEN odd THEN 'ODD'
      WHEN known THEN 'T' || ten END AS code FROM hits""",
)
def scl_name_lookup_many(spark, sf_dir):
    """Hundreds of patterns, most found by a piece of the name; one has no such piece."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))
    patterns = [(f"#0000{n:04}[0-9]$", f"T{n}") for n in range(400) if n % 40 != 7]
    return op.recode_names(customers, "name", "code", patterns=[*patterns, ("1[0-9]7$", "ODD")])


@register(
    QUERIES,
    """WITH flags AS (SELECT doc_id, regexp_matches(text, 'thatin|hehely') AS conflict,
        regexp_matches(text, 'orantion|licen[cs]e|@') AS other
      FROM (SELECT doc_id, CASE WHEN lang <> 'de' THEN text END AS text FROM documents))
    SELECT doc_id, conflict, other, conflict AND other AS complex, conflict OR other AS any_shock,
      CASE WHEN conflict AND other THEN 'Complex' WHEN conflict THEN 'Conflict'
           WHEN other THEN 'Other' END AS class FROM flags""",
)
def scl_classify_3vl(spark, sf_dir):
    """Two term lists over whole texts, three-valued flags, first true class."""
    text = F.when(F.col("lang") != "de", F.col("text"))
    return op.transmute(
        table(spark, sf_dir, "documents"),
        {
            "conflict": pf.matches_any(text, ["thatin", "hehely"]),
            "other": pf.matches_any(text, ["orantion", "licen[cs]e", "@"]),
        },
        {
            "complex": F.col("conflict") & F.col("other"),
            "any_shock": F.col("conflict") | F.col("other"),
            "class": pf.first_case(
                [
                    (F.col("conflict") & F.col("other"), "Complex"),
                    (F.col("conflict"), "Conflict"),
                    (F.col("other"), "Other"),
                ]
            ),
        },
        keep=["doc_id"],
    )


@register(
    QUERIES,
    """WITH found AS (SELECT user_id, event_type, CAST(sum(
        CASE WHEN value > 60 THEN 1 ELSE 0 END) AS BIGINT) AS n FROM events GROUP BY ALL)
    SELECT user_id, event_type, n, CASE WHEN n = 0 THEN CAST('-inf' AS DOUBLE)
      ELSE round(log10(n), 9) END AS n_log10 FROM found""",
)
def scl_log10_neg_inf(spark, sf_dir):
    high = F.when(F.col("value") > 60, 1).otherwise(0)
    counts = table(spark, sf_dir, "events").select("user_id", "event_type", high.alias("high"))
    totals = op.summarise(counts, ["user_id", "event_type"], {"n": op.lenient_sum("high")})
    return totals.withColumn("n_log10", F.round(pf.log10(F.col("n")), 9))


@register(
    QUERIES,
    """WITH sums AS (SELECT CAST(year(o_orderdate) AS INT) AS year,
        sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS total, count(*) AS n
      FROM orders GROUP BY 1)
    SELECT year, make_date(year, 6, 1) AS middle, '$' || format('{:,.0f}', total / 1e6) || 'M'
      AS money_label, format('{:,}', n) AS count_label FROM sums""",
)
def scl_labels_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        year_of("o_orderdate").alias("year"), money("o_totalprice").alias("price")
    )
    sums = op.summarise(
        orders, ["year"], {"total": op.lenient_sum("price"), "n": op.measure_rows()}
    )
    return sums.select(
        "year",
        pf.day_in_year(F.col("year")).alias("middle"),
        pf.number_label(F.col("total"), 1e-6, "$", "M").alias("money_label"),
        pf.comma_label(F.col("n")).alias("count_label"),
    )


@register(
    QUERIES,
    f"""WITH {CODED_ORDERS}, totals AS (
      SELECT code, sum(price)::DOUBLE AS total FROM coded GROUP BY code)
    SELECT s_suppkey, c.code, total FROM supplier JOIN codes c ON s_nationkey = n_nationkey
    LEFT JOIN totals t ON c.code IS NOT DISTINCT FROM t.code""",
)
def join_left_null_safe(spark, sf_dir):
    """Suppliers without a code meet the total of the orders without a code."""
    totals = summarise_orders(spark, sf_dir, ["code"], {"total": op.lenient_sum("price")})
    totals = totals.withColumn("total", F.col("total").cast("double"))
    codes = country_codes(spark, sf_dir)
    suppliers = op.recode(table(spark, sf_dir, "supplier"), "s_nationkey", codes, "code")
    return op.left_join(suppliers.select("s_suppkey", "code"), totals, "code")


@register(
    QUERIES,
    """WITH keyed AS (SELECT CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS supplier,
        CAST(l_quantity AS DECIMAL(18,2)) AS quantity FROM lineitem),
    named AS (SELECT s_suppkey AS supplier, s_name AS name FROM supplier WHERE s_nationkey <> 3
      UNION ALL SELECT NULL, 'nobody')
    SELECT name, count(*) AS n, CAST(sum(quantity) AS DOUBLE) AS quantity FROM keyed k
    LEFT JOIN named s ON k.supplier IS NOT DISTINCT FROM s.supplier GROUP BY name""",
)
def join_left_spread(spark, sf_dir):
    """Raw rows joined by a key that half of them lack; the frequent keys are dealt out."""
    named = table(spark, sf_dir, "supplier").where("s_nationkey <> 3").select(
        F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("name")
    )
    nobody = spark.createDataFrame([(None, "nobody")], "supplier long, name string")
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")).alias("supplier"),
        money("l_quantity").alias("quantity"),
    )
    joined = op.left_join(rows, named.unionByName(nobody), "supplier", spread=True)
    return joined.groupBy("name").agg(
        pf.n_rows().alias("n"), F.sum("quantity").cast("double").alias("quantity")
    )


@register(
    QUERIES,
    f"""WITH {CODED_ORDERS}, spine AS (
      SELECT code, year, count(*) AS n FROM coded GROUP BY ALL),
    people AS (SELECT code, count(*) AS customers FROM customer
      LEFT JOIN codes ON c_nationkey = n_nationkey GROUP BY code),
    shops AS (SELECT code, count(*) AS suppliers FROM supplier
      LEFT JOIN codes ON s_nationkey = n_nationkey GROUP BY code),
    world AS (SELECT CAST(year(l_shipdate) AS INT) AS year, count(*) AS lines
      FROM lineitem GROUP BY 1)
    SELECT s.code, s.year, n, customers, suppliers, lines FROM spine s
    LEFT JOIN people p ON s.code IS NOT DISTINCT FROM p.code
    LEFT JOIN shops h ON s.code IS NOT DISTINCT FROM h.code
    LEFT JOIN world w ON s.year = w.year""",
)
def join_spine_chain(spark, sf_dir):
    """Three dimensions joined to a spine, which keeps its rows."""
    codes = country_codes(spark, sf_dir)

    def by_nation(partial):
        return op.recode(partial, "nation", codes, "code")

    spine = summarise_orders(spark, sf_dir, ["code", "year"], {"n": op.measure_rows()})
    people = op.summarise_through(
        table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nation"),
        ["nation"], by_nation, ["code"], {"customers": op.measure_rows()},
    )
    shops = op.summarise_through(
        table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nation"),
        ["nation"], by_nation, ["code"], {"suppliers": op.measure_rows()},
    )
    world = op.summarise(
        table(spark, sf_dir, "lineitem").select(year_of("l_shipdate").alias("year")),
        ["year"], {"lines": op.measure_rows()},
    )
    df = op.left_join(spine, people, "code")
    df = op.left_join(df, shops, "code")
    return op.left_join(df, world, "year")


@register(
    QUERIES,
    """WITH v AS (SELECT user_id, event_type, CASE WHEN value <= 120
        THEN CAST(value AS DECIMAL(18,2)) END AS best FROM events)
    SELECT user_id, event_type, count(*) AS events, count(best) AS known,
      CASE WHEN count(best) = count(*) THEN sum(best) END::DOUBLE AS strict,
      coalesce(sum(best), 0)::DOUBLE AS lenient FROM v GROUP BY ALL""",
)
def agg_strict_lenient_sum(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type",
        F.when(F.col("value") <= 120, money("value")).alias("best"),
    )
    sums = op.summarise(
        events,
        ["user_id", "event_type"],
        {"events": op.measure_rows(), "known": op.measure_present("best"),
         "strict": op.complete_sum("best"), "lenient": op.lenient_sum("best")},
    )
    return sums.withColumns({c: F.col(c).cast("double") for c in ("strict", "lenient")})


@register(
    QUERIES,
    """WITH f AS (SELECT user_id, CAST(ts AS DATE) AS day,
        CASE WHEN event_type <> 'view' THEN value > 40 END AS high,
        CASE WHEN event_type <> 'signup' THEN event_type = 'error' END AS failed FROM events)
    SELECT user_id, day,
      CASE WHEN bool_or(high) THEN true WHEN count(high) < count(*) THEN NULL
           ELSE false END AS high,
      CASE WHEN bool_or(failed) THEN true WHEN count(failed) < count(*) THEN NULL
           ELSE false END AS failed FROM f GROUP BY ALL""",
)
def agg_any_3vl(spark, sf_dir):
    kind = F.col("event_type")
    flags = table(spark, sf_dir, "events").select(
        "user_id",
        F.to_date("ts").alias("day"),
        F.when(kind != "view", F.col("value") > 40).alias("high"),
        F.when(kind != "signup", kind == "error").alias("failed"),
    )
    keys = ["user_id", "day"]
    return flags.groupBy(*keys).agg(
        *[pf.any3(F.col(c)).alias(c) for c in flags.columns if c not in keys]
    )


@register(
    QUERIES,
    """WITH c AS (SELECT c_nationkey AS nation, nullif(c_mktsegment, 'FURNITURE') AS segment,
        CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer),
    totals AS (SELECT nation, count(*) AS customers, sum(balance)::DOUBLE AS balance
      FROM c GROUP BY nation)
    SELECT t.nation, customers, balance, segment
    FROM totals t JOIN (SELECT DISTINCT nation, segment FROM c) s ON t.nation = s.nation""",
)
def agg_group_constant(spark, sf_dir):
    """One row per value of a column, each with the totals of the whole group."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"),
        F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment"),
        money("c_acctbal").alias("amount"),
    )
    return op.group_constant(
        customers, ["nation"], ["segment"],
        {"customers": op.measure_rows(), "balance": op.lenient_sum("amount")}, "expand",
    ).withColumn("balance", F.col("balance").cast("double"))


@register(
    QUERIES,
    """SELECT c.n_nationkey AS nation, n_name AS name, count(*) AS customers
    FROM customer JOIN nation c ON c_nationkey = c.n_nationkey GROUP BY ALL""",
)
def agg_group_constant_checked(spark, sf_dir):
    """The name of a nation is checked to be the same on all of its customers."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customers = op.recode(
        table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")),
        "nation", nations, "name",
    )
    return op.group_constant(
        customers, ["nation"], ["name"], {"customers": op.measure_rows()}
    )


@register(
    QUERIES,
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment
    FROM customer UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier""",
)
def set_bind_rows(spark, sf_dir):
    """By name, in different column order, one column absent."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("id"),
    )
    return op.bind_rows(customers, suppliers)


@register(
    QUERIES,
    f"""WITH {CODED_ORDERS}
    SELECT code, year, count(*) AS n, row_number() OVER (
      PARTITION BY year ORDER BY code ASC NULLS LAST)::INT AS place
    FROM coded GROUP BY code, year""",
)
def ord_arrange(spark, sf_dir):
    """Sorted panel; the place within the year shows that the missing code comes last."""
    panel = summarise_orders(spark, sf_dir, ["code", "year"], {"n": op.measure_rows()})
    # a year has one row per code here, so the window is small
    in_year = Window.partitionBy("year").orderBy(F.col("code").asc_nulls_last())
    return op.arrange(panel.withColumn("place", F.row_number().over(in_year)), "year", "code")
