"""The composed jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit import functions as pf
from panelkit import operators as op
from panelkit import sources as src
from panelkit import plans

from .common import CODED_ORDERS, CODES, Query, country_codes, money, orders_by_nation, register
from .common import summarise_orders, table, year_of
from .geo import AREAS, INCIDENTS, covered, line_incidents, nation_areas
from .windows import RATES, rounded, yearly_rates

QUERIES: dict[str, Query] = {}


# ---- funding -------------------------------------------------------------------------------


def funding_files(spark, sf_dir):
    """Line items as funding files: overlapping, and with a drifting or absent typeName."""
    flag = F.col("l_returnflag")
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(
            F.col("l_linenumber") != 4,
            F.concat(F.lit("N0"), F.col("l_linenumber").cast("string")),
        ).alias("countryCode"),
        year_of("l_shipdate").alias("year"),
        F.col("l_extendedprice").alias("requirements"),
        F.when(flag != "A", F.col("l_extendedprice")).alias("funding"),
        "l_orderkey",
        "l_partkey",
        flag.alias("flag"),
    )
    return [
        lines.where(flag.isin("A", "R")).withColumn("typeName", F.lit("t")),
        lines.where(flag == "R").withColumn("typeName", F.lit("t")),
        None,
        lines.where(flag == "N").withColumn("typeName", F.lit(7)),
        lines.where(flag == "A"),
    ]


FUNDING = """lines AS (
    SELECT CASE WHEN l_linenumber <> 4 THEN 'N0' || CAST(l_linenumber AS VARCHAR) END AS iso3,
      CAST(year(l_shipdate) AS INT) AS year, l_extendedprice AS requirements,
      CASE WHEN l_returnflag <> 'A' THEN l_extendedprice END AS funding,
      l_orderkey, l_partkey, l_returnflag AS flag FROM lineitem),
  files AS (
    SELECT *, 't' AS kind FROM lines WHERE flag IN ('A', 'R')
    UNION SELECT *, 't' FROM lines WHERE flag = 'R'
    UNION SELECT *, '7' FROM lines WHERE flag = 'N'
    UNION SELECT *, NULL FROM lines WHERE flag = 'A'),
  sums AS (SELECT iso3, year,
      coalesce(sum(CAST(requirements AS DECIMAL(18,2))), 0)::DOUBLE AS requirements,
      coalesce(sum(CAST(funding AS DECIMAL(18,2))), 0)::DOUBLE AS funding
    FROM files GROUP BY iso3, year),
  funding AS (
    SELECT coalesce(g.iso3, s.iso3) AS iso3, coalesce(g.year, s.year) AS year,
      coalesce(requirements, 0) AS requirements, coalesce(funding, 0) AS funding
    FROM (SELECT iso3, y.year FROM (SELECT DISTINCT iso3 FROM sums) k CROSS JOIN
      (SELECT CAST(unnest(range(1996, 2004)) AS INT) AS year) y) g
    FULL JOIN sums s ON g.iso3 IS NOT DISTINCT FROM s.iso3 AND g.year = s.year)"""


@register(QUERIES, f"WITH {FUNDING} SELECT * FROM funding")
def cmp_funding_panel(spark, sf_dir):
    return plans.funding_panel(funding_files(spark, sf_dir), 1996, 2003)


# ---- conflict ------------------------------------------------------------------------------


@register(
    QUERIES,
    f"""WITH {CODES}, raw AS (
      SELECT CASE WHEN c_nationkey = 7 THEN 'OVR' ELSE code END AS iso3,
        CAST(year(o_orderdate) AS INT) AS year,
        CASE WHEN o_orderstatus <> 'P' OR year(o_orderdate) <> 1998
          THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS best
      FROM orders JOIN customer ON o_custkey = c_custkey
      LEFT JOIN codes ON c_nationkey = n_nationkey),
    agg AS (SELECT iso3, year, count(*) AS events,
        CASE WHEN count(best) = count(*) THEN sum(best) END::DOUBLE AS fatalities
      FROM raw WHERE iso3 IS NOT NULL GROUP BY iso3, year),
    keys AS (SELECT iso3 FROM agg UNION SELECT s_name FROM supplier),
    grid AS (SELECT iso3, y.year FROM keys CROSS JOIN
      (SELECT CAST(unnest(range(1996, 2004)) AS INT) AS year) y)
    SELECT coalesce(g.iso3, a.iso3) AS iso3, coalesce(g.year, a.year) AS year,
      coalesce(events, 0) AS events, coalesce(fatalities, 0) AS fatalities
    FROM grid g FULL JOIN agg a ON g.iso3 = a.iso3 AND g.year = a.year""",
)
def cmp_conflict_panel(spark, sf_dir):
    """Orders as incidents of the customer's nation, on the keys of two tables."""
    known = (F.col("o_orderstatus") != "P") | (year_of("o_orderdate") != 1998)
    incidents = orders_by_nation(
        spark, sf_dir, {"best": F.when(known, money("o_totalprice"))}
    )
    panel = plans.conflict_panel(
        incidents.withColumnRenamed("nation", "country_id"),
        country_codes(spark, sf_dir),
        {7: "OVR"},
        1996,
        2003,
        keys=table(spark, sf_dir, "supplier").select(F.col("s_name").alias("iso3")),
    )
    return panel.withColumn("fatalities", F.col("fatalities").cast("double"))


def line_conflict(spark, sf_dir, keys=None):
    """Conflict panel of the line items, whose line number is the country."""
    return plans.conflict_panel(
        line_incidents(spark, sf_dir), country_codes(spark, sf_dir), {2: "YEM"}, 1994, 2003, keys
    )


OWN_KEYS = "SELECT DISTINCT iso3 FROM incident_sums WHERE iso3 IS NOT NULL"


def line_conflict_sql(keys: str) -> str:
    """SQL of the same; it follows ``codes`` in a WITH list. ``keys`` selects the entities."""
    return f"""{INCIDENTS}, incident_sums AS (
    SELECT CASE WHEN country_id = 2 THEN 'YEM' ELSE code END AS iso3, year, count(*) AS events,
      CASE WHEN count(best) = count(*) THEN sum(best) END AS fatalities
    FROM incidents LEFT JOIN codes ON country_id = n_nationkey GROUP BY 1, 2),
  conflict AS (
    SELECT coalesce(g.iso3, s.iso3) AS iso3, coalesce(g.year, s.year) AS year,
      coalesce(events, 0) AS events, coalesce(fatalities, 0) AS fatalities
    FROM (SELECT iso3, y.year FROM ({keys}) k CROSS JOIN
      (SELECT CAST(unnest(range(1994, 2004)) AS INT) AS year) y) g
    FULL JOIN (SELECT * FROM incident_sums WHERE iso3 IS NOT NULL) s
      ON g.iso3 IS NOT DISTINCT FROM s.iso3 AND g.year = s.year)"""


def _carve_sql(gap_entity: str) -> str:
    return f"""WITH {AREAS}, {line_conflict_sql(OWN_KEYS)},
  parent_points AS (SELECT * FROM incidents WHERE country_id = 6),
  hits AS ({covered("parent_points", "edges", "area_id")}),
  inside AS (SELECT * FROM parent_points p WHERE EXISTS (
    SELECT 1 FROM hits h WHERE h.x = p.x AND h.y = p.y)),
  child_sums AS (SELECT year, count(*) AS events,
      CASE WHEN count(best) = count(*) THEN sum(best) END AS fatalities
    FROM inside GROUP BY year),
  child AS (SELECT CASE WHEN s.year IS NOT NULL THEN 'N99' ELSE {gap_entity} END AS iso3,
      coalesce(g.year, s.year) AS year,
      coalesce(events, 0) AS events, coalesce(fatalities, 0) AS fatalities
    FROM (SELECT CAST(unnest(range(1994, 2004)) AS INT) AS year) g
    FULL JOIN child_sums s ON g.year = s.year)
  SELECT iso3, year, events, fatalities::DOUBLE AS fatalities FROM child
  UNION ALL
  SELECT c.iso3, c.year, CASE WHEN c.iso3 = 'N06' THEN c.events - t.events ELSE c.events END,
    CASE WHEN c.iso3 = 'N06' THEN c.fatalities - t.fatalities ELSE c.fatalities END::DOUBLE
  FROM conflict c LEFT JOIN child t ON c.iso3 = 'N06' AND c.year = t.year
  WHERE c.iso3 IS DISTINCT FROM 'N99'"""


def _carve(spark, sf_dir, strict_gaps):
    carved = plans.carve_out(
        line_conflict(spark, sf_dir),
        line_incidents(spark, sf_dir),
        F.col("country_id") == 6,
        nation_areas(spark, sf_dir),
        "area_id",
        "N06",
        "N99",
        1994,
        2003,
        strict_gaps,
        cell=2.0,
    )
    return op.arrange(
        carved.withColumn("fatalities", F.col("fatalities").cast("double")), "iso3", "year"
    )


@register(QUERIES, _carve_sql("'N99'"))
def cmp_carve_out(spark, sf_dir):
    """The incidents of country 6 inside any nation area move to a new country."""
    return _carve(spark, sf_dir, False)


@register(QUERIES, _carve_sql("NULL"))
def cmp_carve_out_strict_gaps(spark, sf_dir):
    """The same, with gap years that have no country."""
    return _carve(spark, sf_dir, True)


# ---- severity and plans --------------------------------------------------------------------


@register(
    QUERIES,
    """WITH f AS (SELECT doc_id, regexp_matches(text, 'thatin|hehely') AS conflict_crisis,
        regexp_matches(text, 'ononst|inoran|licen[cs]e') AS other_crisis,
        TRY_CAST(CASE WHEN lang = 'fr' THEN 'x' ELSE CAST(n_chars AS VARCHAR) END AS DOUBLE)
          AS inform_severity FROM documents)
    SELECT CAST(doc_id AS VARCHAR) AS iso3, conflict_crisis, other_crisis,
      conflict_crisis AND other_crisis AS complex_crisis,
      CASE WHEN conflict_crisis AND other_crisis THEN 'Complex' WHEN conflict_crisis THEN 'Conflict'
           WHEN other_crisis THEN 'Other' END AS inform_class,
      inform_severity, CAST(NULL AS DOUBLE) AS inform_pin FROM f""",
)
def cmp_crisis_classes(spark, sf_dir):
    """Whole documents as the free text of an entity."""
    chars = F.col("n_chars").cast("string")
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("ISO3"),
        F.col("text").alias("DRIVERS"),
        F.when(F.col("lang") == "fr", "x").otherwise(chars).alias("INFORM Severity Index"),
        F.concat(F.lit("n/a "), chars).alias("People in need"),
    )
    return plans.crisis_classes(
        documents,
        conflict_terms=["thatin", "hehely"],
        other_terms=["ononst", "inoran", "licen[cs]e"],
    )


def nation_severity(spark, sf_dir):
    """One row per line-item country: drivers by region, figures as text."""
    codes = country_codes(spark, sf_dir)
    nation = op.recode(
        table(spark, sf_dir, "nation"), "n_nationkey", codes, "code"
    ).where(F.col("code").isNotNull())
    region = F.col("n_regionkey")
    drivers = (
        F.when(region == 0, "Floods, Conflict")
        .when(region == 1, "Violence against civilians")
        .when(region == 2, "Drought")
        .when(region == 3, "Tecnological Disaster and Conflict")
    )
    sheet = nation.select(
        F.col("code").alias("ISO3"),
        drivers.alias("DRIVERS"),
        F.when(region != 2, (F.col("n_nationkey") / 10).cast("string"))
        .otherwise("x")
        .alias("INFORM Severity Index"),
        F.concat(F.lit(" "), (F.col("n_nationkey") * 1000).cast("string")).alias("People in need"),
    )
    return plans.crisis_classes(sheet)


SEVERITY = """severity AS (SELECT code AS iso3, n_regionkey IN (0, 1, 3) AS conflict_crisis,
      n_regionkey IN (0, 2, 3) AS other_crisis, n_regionkey IN (0, 3) AS complex_crisis,
      CASE n_regionkey WHEN 0 THEN 'Complex' WHEN 1 THEN 'Conflict' WHEN 2 THEN 'Other'
        ELSE 'Complex' END AS inform_class,
      CASE WHEN n_regionkey <> 2 THEN n.n_nationkey / 10::DOUBLE END AS inform_severity,
      (n.n_nationkey * 1000)::DOUBLE AS inform_pin
    FROM nation n JOIN codes c ON n.n_nationkey = c.n_nationkey WHERE code IS NOT NULL)"""


def supplier_plans(spark, sf_dir):
    """Suppliers as response plans of their nation, flags three-valued."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    named = op.recode(suppliers, "s_nationkey", nations, "name")
    kind = (
        F.when(F.col("s_acctbal") > 7000, "HRP")
        .when(F.col("s_acctbal") > 4000, "RRP")
        .when(F.col("s_acctbal") > 1000, "Other")
    )
    sheet = named.select(
        F.when(F.col("s_nationkey") != 9, F.col("name")).alias("Plans"), kind.alias("Plan type")
    )
    codes = country_codes(spark, sf_dir)
    names = op.recode(nations, "n_nationkey", codes, "code").select("n_name", "code")
    return plans.plan_flags(
        sheet,
        names,
        [("nation_4$", "N04"), ("nation_14", "N14"), ("_14", "X14")],
        {"NATION_3": "BGD"},
    )


PLANS = """plan_rows AS (SELECT CASE s_nationkey WHEN 9 THEN NULL WHEN 3 THEN 'BGD'
        WHEN 4 THEN 'N04' ELSE code END AS iso3,
      CASE WHEN s_acctbal > 1000 THEN s_acctbal > 7000 END AS h,
      CASE WHEN s_acctbal > 1000 THEN s_acctbal > 4000 AND s_acctbal <= 7000 END AS r
    FROM supplier LEFT JOIN codes ON s_nationkey = n_nationkey),
  plans AS (SELECT iso3,
      CASE WHEN bool_or(h) THEN true WHEN count(h) < count(*) THEN NULL ELSE false END AS hrp,
      CASE WHEN bool_or(r) THEN true WHEN count(r) < count(*) THEN NULL ELSE false END AS rrp,
      CASE WHEN bool_or(h OR r) THEN true WHEN count(h OR r) < count(*) THEN NULL
           ELSE false END AS hrp_rrp, true AS plan
    FROM plan_rows GROUP BY iso3)"""


@register(QUERIES, f"WITH {CODES}, {PLANS} SELECT * FROM plans")
def cmp_plan_flags(spark, sf_dir):
    return supplier_plans(spark, sf_dir)


# ---- one common panel and what is read from it ----------------------------------------------


def common_panel(spark, sf_dir):
    # the funding panel is the spine and gives keys to the conflict panel: compute it once
    funding = op.settle(plans.funding_panel(funding_files(spark, sf_dir), 1996, 2003))
    conflict = line_conflict(spark, sf_dir, keys=funding.select("iso3"))
    conflict = conflict.withColumn("fatalities", F.col("fatalities").cast("double"))
    return plans.combined_panel(
        funding, nation_severity(spark, sf_dir), conflict, supplier_plans(spark, sf_dir)
    )


_BOTH_KEYS = f"{OWN_KEYS} UNION SELECT iso3 FROM funding"
COMMON = f"""{CODES}, {FUNDING}, {line_conflict_sql(_BOTH_KEYS)}, {SEVERITY}, {PLANS},
  common AS (SELECT f.iso3, f.year, requirements, funding, conflict_crisis, other_crisis,
      complex_crisis, inform_class, inform_severity, inform_pin, events,
      fatalities::DOUBLE AS fatalities, coalesce(hrp, false) AS hrp, coalesce(rrp, false) AS rrp,
      coalesce(hrp_rrp, false) AS hrp_rrp, coalesce(plan, false) AS plan
    FROM funding f LEFT JOIN severity s ON f.iso3 IS NOT DISTINCT FROM s.iso3
    LEFT JOIN conflict c ON f.iso3 IS NOT DISTINCT FROM c.iso3 AND f.year = c.year
    LEFT JOIN plans p ON f.iso3 IS NOT DISTINCT FROM p.iso3)"""


@register(QUERIES, f"WITH {COMMON} SELECT * FROM common")
def cmp_common_panel(spark, sf_dir):
    return common_panel(spark, sf_dir)


@register(
    QUERIES,
    f"""WITH {COMMON}, {RATES}, totals AS (
      SELECT year, inform_class, sum(CAST(funding AS DECIMAL(18,2))) AS funding,
        sum(CAST(requirements AS DECIMAL(18,2))) AS requirements
      FROM common WHERE year BETWEEN 1997 AND 2002 AND inform_class IS NOT NULL GROUP BY ALL),
    worth AS (SELECT t.year, inform_class, funding::DOUBLE AS funding,
        requirements::DOUBLE AS requirements,
        funding::DOUBLE / nullif(sum(funding) OVER (PARTITION BY t.year)::DOUBLE, 0) AS funding_pct,
        requirements::DOUBLE / nullif(sum(requirements) OVER (PARTITION BY t.year)::DOUBLE, 0)
          AS requirements_pct,
        funding::DOUBLE * (b.level / l.level) AS funding_real,
        requirements::DOUBLE * (b.level / l.level) AS requirements_real
      FROM totals t LEFT JOIN levels l ON t.year = l.year
      CROSS JOIN (SELECT level FROM levels WHERE year = 2000) b)
    SELECT year, inform_class, funding, requirements, round(funding_pct, 9) AS funding_pct,
      round(requirements_pct, 9) AS requirements_pct, round(funding_real, 2) AS funding_real,
      round(requirements_real, 2) AS requirements_real,
      round(coalesce(sum(funding_real) OVER (below ROWS BETWEEN UNBOUNDED PRECEDING
        AND 1 PRECEDING), 0), 2) AS ymin,
      round(sum(funding_real) OVER (below ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2)
        AS ymax,
      '$' || format('{{:,.0f}}', funding_real * 1e-9) || 'B' AS label
    FROM worth WINDOW below AS (PARTITION BY year ORDER BY inform_class DESC)""",
)
def cmp_fin_flows(spark, sf_dir):
    flows = plans.financial_flows(
        common_panel(spark, sf_dir), yearly_rates(spark, sf_dir), 1997, 2002, 2000
    )
    flows = rounded(flows, 9, "funding_pct", "requirements_pct")
    return rounded(flows, 2, "funding_real", "requirements_real", "ymin", "ymax")


@register(
    QUERIES,
    f"""WITH {COMMON}, totals AS (
      SELECT iso3, coalesce(sum(fatalities), 0) AS fatalities FROM common
      WHERE year >= 1998 AND year <= 2002 GROUP BY iso3)
    SELECT iso3, fatalities, CASE WHEN fatalities = 0 THEN CAST('-inf' AS DOUBLE)
        ELSE round(log10(fatalities), 9) END AS fatalities_log10, inform_severity, hrp_rrp
    FROM totals t JOIN (SELECT DISTINCT iso3 AS k, inform_severity, hrp_rrp FROM common
      WHERE year >= 1998) c ON t.iso3 IS NOT DISTINCT FROM k
    WHERE inform_severity IS NOT NULL""",
)
def cmp_severity(spark, sf_dir):
    panel = common_panel(spark, sf_dir)
    table_ = plans.severity_against_fatalities(panel, since=1998, to_year=2002)
    return rounded(table_, 9, "fatalities_log10")


@register(
    QUERIES,
    f"""WITH {COMMON} SELECT iso3, CAST(coalesce(sum(events), 0) AS BIGINT) AS events,
      inform_severity, inform_severity * 2 AS inform_displacement
    FROM common WHERE inform_severity IS NOT NULL GROUP BY iso3, inform_severity""",
)
def cmp_events_by_severity(spark, sf_dir):
    """Events per country next to its severity and a second severity."""
    panel = common_panel(spark, sf_dir).withColumn(
        "inform_displacement", F.col("inform_severity") * 2
    )
    return plans.severity_against_events(panel).select(
        "iso3", "events", "inform_severity", "inform_displacement"
    )


# ---- polygons ------------------------------------------------------------------------------


@register(
    QUERIES,
    f"""WITH {AREAS}, {INCIDENTS}, {SEVERITY}, of_year AS (
      SELECT * FROM incidents WHERE year = 1999),
    hits AS ({covered("of_year", "edges", "area_id")}),
    counts AS (SELECT area_id, count(best) AS conflict_events,
        coalesce(sum(best), 0)::DOUBLE AS best, sum(deaths)::DOUBLE AS deaths_civilians
      FROM of_year i JOIN hits h ON h.x = i.x AND h.y = i.y GROUP BY area_id)
    SELECT a.area_id, a.iso3, a.region, inform_class, inform_severity,
      coalesce(conflict_events, 0) AS conflict_events, coalesce(best, 0) AS best,
      coalesce(deaths_civilians, 0) AS deaths_civilians
    FROM areas a LEFT JOIN severity s ON a.iso3 IS NOT DISTINCT FROM s.iso3
    LEFT JOIN counts c ON a.area_id = c.area_id""",
)
def cmp_polygon_enrich(spark, sf_dir):
    enriched = plans.enrich_polygons(
        nation_areas(spark, sf_dir),
        nation_severity(spark, sf_dir),
        line_incidents(spark, sf_dir),
        "area_id",
        year=1999,
        cell=2.0,
    )
    return enriched.select(
        "area_id", "iso3", "region", "inform_class", "inform_severity", "conflict_events",
        F.col("best").cast("double").alias("best"),
        F.col("deaths_civilians").cast("double").alias("deaths_civilians"),
    )


@register(
    QUERIES,
    f"""WITH {AREAS}, {INCIDENTS}, {SEVERITY}, of_year AS (
      SELECT * FROM incidents WHERE year = 1999),
    hits AS ({covered("of_year", "edges", "area_id")}),
    counts AS (SELECT area_id, count(best) AS conflict_events
      FROM of_year i JOIN hits h ON h.x = i.x AND h.y = i.y GROUP BY area_id)
    SELECT a.area_id, inform_class, coalesce(conflict_events, 0) AS conflict_events,
      e.x1, e.y1, e.x2, e.y2, 'MULTIPOLYGON (((' || a.x || ' 0.0, ' || (a.x + 6) || ' 0.0, '
        || (a.x + 6) || ' 40.0, ' || (a.x + 3) || ' 20.0, ' || a.x || ' 40.0, ' || a.x
        || ' 0.0)))' AS wkt
    FROM areas a JOIN edges e ON a.area_id = e.area_id
    LEFT JOIN severity s ON a.iso3 IS NOT DISTINCT FROM s.iso3
    LEFT JOIN counts c ON a.area_id = c.area_id""",
)
def geo_polygons_carry_shape(spark, sf_dir):
    """Enriched polygons with their shape, written for other tools and read back."""
    enriched = plans.enrich_polygons(
        nation_areas(spark, sf_dir),
        nation_severity(spark, sf_dir),
        line_incidents(spark, sf_dir),
        "area_id",
        year=1999,
        cell=2.0,
    )
    path = op.scratch_path(spark)
    src.write_polygons(enriched, path)
    return spark.read.parquet(path).select(
        "area_id", "inform_class", "conflict_events", "wkt", F.inline("edges")
    )


def _adm_keys(spark, sf_dir):
    """Area id to administrative code; the nations of region 4 are not in the key file."""
    nation = table(spark, sf_dir, "nation").where(F.col("n_regionkey") != 4)
    code = F.concat(F.lit("AF"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return nation.select(F.col("n_nationkey").alias("area_id"), code.alias("adm1_Pcode"))


_LINKED = f"""{AREAS}, {INCIDENTS}, hits AS ({covered("incidents", "edges", "area_id")}),
  linked AS (SELECT a.area_id, CASE WHEN region <> 4
      THEN 'AF' || lpad(CAST(a.area_id AS VARCHAR), 2, '0') END AS "adm1_Pcode",
      count(i.x) AS events
    FROM areas a LEFT JOIN hits h ON h.area_id = a.area_id
    LEFT JOIN incidents i ON h.x = i.x AND h.y = i.y GROUP BY ALL)"""


def _linked(spark, sf_dir):
    return plans.events_by_area(
        nation_areas(spark, sf_dir), line_incidents(spark, sf_dir), _adm_keys(spark, sf_dir),
        "area_id", cell=2.0,
    )


@register(QUERIES, f"WITH {_LINKED} SELECT * FROM linked")
def cmp_area_linkage(spark, sf_dir):
    """Incidents to areas to administrative codes."""
    return _linked(spark, sf_dir)


@register(
    QUERIES,
    f"""WITH {CODED_ORDERS}, need AS (
      SELECT code, coalesce(sum(CAST(c_acctbal AS DECIMAL(18,2))), 0) AS pin
      FROM customer LEFT JOIN codes ON c_nationkey = n_nationkey GROUP BY code),
    people AS (SELECT code, sum(price) AS population FROM coded
      WHERE code IS DISTINCT FROM 'N05' GROUP BY code)
    SELECT n.code, pin::DOUBLE AS pin, population::DOUBLE AS population,
      round(100 * (pin::DOUBLE / population::DOUBLE), 9) AS pin_pct
    FROM need n LEFT JOIN people p ON n.code IS NOT DISTINCT FROM p.code""",
)
def cmp_percent_in_need(spark, sf_dir):
    """Need and population per country; one country without a population has no percentage."""
    codes = country_codes(spark, sf_dir)
    need = op.summarise_through(
        table(spark, sf_dir, "customer").select(
            F.col("c_nationkey").alias("nation"), money("c_acctbal").alias("amount")
        ),
        ["nation"],
        lambda partial: op.recode(partial, "nation", codes, "code"),
        ["code"],
        {"pin": op.lenient_sum("amount")},
    )
    population = summarise_orders(
        spark, sf_dir, ["code"], {"population": op.lenient_sum("price")}
    ).where(pf.not_in(F.col("code"), ["N05"]))
    out = plans.percent_in_need(need, population, "code")
    out = out.withColumns({c: F.col(c).cast("double") for c in ("pin", "population")})
    return rounded(out, 9, "pin_pct")


@register(
    QUERIES,
    f"""WITH {_LINKED}, need AS (
      SELECT 'AF' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS "adm1_Pcode",
        sum(CAST(abs(c_acctbal) AS DECIMAL(18,2)))::DOUBLE AS pin, count(*) AS population
      FROM customer GROUP BY 1)
    SELECT area_id, l."adm1_Pcode", events, pin, population,
      round(100 * (pin / population), 9) AS pin_pct
    FROM linked l LEFT JOIN need n ON l."adm1_Pcode" IS NOT DISTINCT FROM n."adm1_Pcode" """,
)
def cmp_area_need(spark, sf_dir):
    """Incidents and percentage in need of the same area, through the key file."""
    area = F.concat(F.lit("AF"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"))
    customers = table(spark, sf_dir, "customer").select(
        area.alias("adm1_Pcode"), money(F.abs("c_acctbal")).alias("pin"),
        F.lit(1).cast("bigint").alias("population"),
    )
    need = plans.percent_in_need(
        customers.select("adm1_Pcode", "pin"),
        customers.select("adm1_Pcode", "population"),
        "adm1_Pcode",
    ).withColumn("pin", F.col("pin").cast("double"))
    return rounded(plans.area_need(_linked(spark, sf_dir), need), 9, "pin_pct")
