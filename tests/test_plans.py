"""The composed jobs on small tables worked out by hand."""

import json
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelkit import operators as op
from panelkit import plans
from panelkit import sources as src


@pytest.fixture(scope="module")
def square(spark):
    text = json.dumps({"properties": {"id": "west", "iso3": "PSE"}, "geometry": {
        "type": "Polygon", "coordinates": [[[34, 31], [35, 31], [35, 32], [34, 32], [34, 31]]]}})
    return src.parse_features(
        spark.createDataFrame([(text,)], "f string"), "f", {"id": "string", "iso3": "string"}
    )


@pytest.fixture(scope="module")
def incidents(spark):
    return spark.createDataFrame(
        [
            (666, 1999, 34.5, 31.5, 3, 1),  # inside
            (666, 1999, 35.0, 31.2, 2, 0),  # on the edge
            (666, 1999, 35.5, 31.5, 10, 9),  # outside
            (666, 2000, 36.0, 30.0, 4, 4),  # outside, the child has nothing in 2000
            (666, 1990, 34.1, 31.1, 1, 1),  # inside, before the grid
            (678, 2000, 44.0, 15.0, 7, 0),
            (678, 2000, 44.0, 15.0, None, 0),
            (2, 2001, -77.0, 38.9, 5, 5),
            (99999, 2001, 0.0, 0.0, 5, 5),  # unknown country
        ],
        "country_id int, year int, longitude double, latitude double, best int, "
        "deaths_civilians int",
    )


@pytest.fixture(scope="module")
def panel(spark, incidents):
    codes = op.lookup_table(spark, {666: "ISR", 678: "YAR", 2: "USA"}, "gwn", "iso3c")
    keys = spark.createDataFrame([("TCD",), ("USA",), (None,)], "iso3 string")
    return plans.conflict_panel(incidents, codes, {678: "YEM"}, 1999, 2001, keys)


def test_small_and_large_amounts_are_summed_exactly(spark, rows):
    df = spark.createDataFrame(
        [("AFG", 2000, 0.004, 1e17, "a"), ("AFG", 2000, 0.004, 1e17, "b")],
        "countryCode string, year int, requirements double, funding double, typeName string",
    )
    assert rows(plans.funding_panel(df, 2000, 2000)) == [("AFG", 2000, 0.008, 2e17)]


def test_funding_panel(spark, rows):
    one = spark.createDataFrame(
        [("AFG", 1999, 10.0, 1.0), ("AFG", 2001, None, 0.1), ("AFG", 2001, 5.0, 0.2),
         (None, 2000, 1.0, None)],
        "countryCode string, year int, requirements double, funding double",
    )
    two = one.where("year = 2001").withColumn("typeName", F.lit(3))
    three = one.where("year = 2001").withColumn("typeName", F.lit("3"))
    out = plans.funding_panel([one, None, two, three], 2000, 2001)
    # the typed copies are equal to each other, but not to the untyped rows
    assert rows(out) == [
        ("AFG", 1999, 10.0, 1.0), ("AFG", 2000, 0.0, 0.0), ("AFG", 2001, 10.0, 0.6),
        (None, 2000, 1.0, 0.0), (None, 2001, 0.0, 0.0),
    ]


def test_conflict_panel(rows, panel):
    assert rows(panel) == [
        ("ISR", 1990, 1, 1), ("ISR", 1999, 3, 15), ("ISR", 2000, 1, 4), ("ISR", 2001, 0, 0),
        ("TCD", 1999, 0, 0), ("TCD", 2000, 0, 0), ("TCD", 2001, 0, 0),
        ("USA", 1999, 0, 0), ("USA", 2000, 0, 0), ("USA", 2001, 1, 5),
        # one of two estimates is missing, so the sum is, and the gap default fills it
        ("YEM", 1999, 0, 0), ("YEM", 2000, 2, 0), ("YEM", 2001, 0, 0),
        (None, 1999, 0, 0), (None, 2000, 0, 0), (None, 2001, 0, 0),
    ]


def test_carve_out(rows, panel, incidents, square):
    args = (panel, incidents, F.col("country_id") == 666, square, "id", "ISR", "PSE", 1999, 2001)
    out = plans.carve_out(*args)
    found = [r for r in rows(out) if r[0] in ("ISR", "PSE")]
    assert found == [
        ("ISR", 1990, 0, 0), ("ISR", 1999, 1, 10), ("ISR", 2000, 1, 4), ("ISR", 2001, 0, 0),
        ("PSE", 1990, 1, 1), ("PSE", 1999, 2, 5), ("PSE", 2000, 0, 0), ("PSE", 2001, 0, 0),
    ]
    # nothing is lost or made up, and the other countries are as they were
    total = lambda df: df.agg(F.sum("events"), F.sum("fatalities")).first()
    assert tuple(total(out)) == tuple(total(panel))
    others = "coalesce(iso3, '') not in ('ISR', 'PSE')"
    assert rows(out.where(others)) == rows(panel.where(others))

    strict = plans.carve_out(*args, strict_gaps=True)
    gaps = [r for r in rows(strict) if r[0] is None]
    assert gaps == [(None, 1999, 0, 0), (None, 2000, 0, 0), (None, 2000, 0, 0),
                    (None, 2001, 0, 0), (None, 2001, 0, 0)]


def test_carve_out_years_without_the_child(rows, spark, panel, incidents, square):
    none_inside = incidents.where("longitude > 35 or country_id <> 666")
    out = plans.carve_out(
        panel, none_inside, F.col("country_id") == 666, square, "id", "ISR", "PSE", 1999, 2001
    )
    # 1990 is out of the grid and not among the child's years
    assert [r for r in rows(out) if r[0] == "ISR"][0] == ("ISR", 1990, None, None)


def severity_table(spark, rows_):
    texts = ("ISO3", "DRIVERS", "INFORM Severity Index", "People in need")
    schema = ", ".join(f"`{name}` string" for name in texts)
    return plans.crisis_classes(spark.createDataFrame(rows_, schema))


def test_crisis_classes(spark, rows):
    out = severity_table(spark, [
        ("A", "Conflict", "3.5", "100"), ("B", "Drought, Epidemic", "x", None),
        ("C", "Violence; Tecnological Disaster", " 2 ", "1e3"), ("D", "Politics", "1", ""),
        ("E", None, None, "5"),
    ])
    assert rows(out) == [
        ("A", True, False, False, "Conflict", 3.5, 100.0),
        ("B", False, True, False, "Other", None, None),
        ("C", True, True, True, "Complex", 2.0, 1000.0),
        ("D", False, False, False, None, 1.0, None),
        ("E", None, None, None, None, None, 5.0),
    ]


def plan_table(spark):
    sheet = spark.createDataFrame(
        [("Afghanistan", "HRP"), ("Afghanistan regional", "RRP"), ("Chad", None), ("Chad", "Other"),
         ("Rohingya (JRP)", "Other"), (None, "HRP"), ("Mali", "Other")],
        "`Plans` string, `Plan type` string",
    )
    names = op.lookup_table(spark, {"chad": "TCD", "Mali": "MLI"}, "name", "iso3")
    return plans.plan_flags(sheet, names, [("afghan", "AFG")], {"Rohingya (JRP)": "BGD"})


def test_plan_flags(spark, rows):
    assert rows(plan_table(spark)) == [
        ("AFG", True, True, True, True),
        ("BGD", False, False, False, True),
        ("MLI", False, False, False, True),
        ("TCD", None, None, None, True),
        (None, True, False, True, True),
    ]


def combined(spark, severity_rows=None):
    funding = spark.createDataFrame(
        [("AFG", 2015, 10.0, 4.0), ("AFG", 2016, 20.0, 5.0), ("TCD", 2015, 1.0, 1.0),
         ("TCD", 2016, 0.0, 0.0), ("FRA", 2015, 7.0, 7.0), (None, 2015, 2.0, 2.0)],
        "iso3 string, year int, requirements double, funding double",
    )
    severity = severity_table(spark, severity_rows or [
        ("AFG", "Conflict and Drought", "4.5", "9"), ("TCD", "Floods", "3.1", "8"),
        (None, "Epidemic", "1", "1")])
    conflict = spark.createDataFrame(
        [("AFG", 2015, 3, 100.0), ("AFG", 2016, 0, 0.0), ("TCD", 2015, 0, 0.0),
         (None, 2015, 5, 6.0), ("USA", 2015, 1, 1.0)],
        "iso3 string, year int, events long, fatalities double",
    )
    return plans.combined_panel(funding, severity, conflict, plan_table(spark))


def test_combined_panel(spark, rows):
    out = combined(spark)
    assert out.columns == [
        "iso3", "year", "requirements", "funding", "conflict_crisis", "other_crisis",
        "complex_crisis", "inform_class", "inform_severity", "inform_pin", "events", "fatalities",
        "hrp", "rrp", "hrp_rrp", "plan",
    ]
    assert out.count() == 6
    picked = rows(out, "iso3", "year", "inform_class", "events", "hrp", "plan")
    assert picked == [
        ("AFG", 2015, "Complex", 3, True, True), ("AFG", 2016, "Complex", 0, True, True),
        ("FRA", 2015, None, None, False, False),
        ("TCD", 2015, "Other", 0, False, True), ("TCD", 2016, "Other", None, False, True),
        (None, 2015, "Other", 5, True, True),
    ]
    with pytest.raises(PySparkException, match="duplicate key"):
        combined(spark, [("AFG", "Floods", "1", "1"), ("AFG", "Floods", "1", "1")]).collect()


def test_financial_flows(spark):
    rates = spark.createDataFrame([(2015, 1.0), (2016, 10.0)], "year int, rate double")
    out = plans.financial_flows(combined(spark), rates, 2015, 2016, 2016)
    got = {(r["year"], r["inform_class"]): r for r in out.collect()}
    assert set(got) == {(2015, "Complex"), (2015, "Other"), (2016, "Complex"), (2016, "Other")}
    first = got[2015, "Complex"]
    assert first["funding"] == 4.0 and first["funding_pct"] == pytest.approx(4 / 7)
    assert first["requirements_pct"] == pytest.approx(10 / 13)
    assert first["funding_real"] == pytest.approx(4.4) and first["label"] == "$0B"
    # the last class is at the bottom
    assert got[2015, "Other"]["ymin"] == 0 and first["ymin"] == pytest.approx(3.3)
    assert first["ymax"] == pytest.approx(7.7)
    shares = {}
    for (year, _), r in got.items():
        shares[year] = shares.get(year, 0) + r["funding_pct"]
    assert shares == {2015: pytest.approx(1), 2016: pytest.approx(1)}


def test_severity_against_fatalities(spark):
    out = plans.severity_against_fatalities(combined(spark), since=2015)
    got = {r["iso3"]: r for r in out.collect()}
    assert set(got) == {"AFG", "TCD", None}
    assert got["AFG"]["fatalities"] == 100.0 and got["AFG"]["fatalities_log10"] == 2.0
    assert got["AFG"]["hrp_rrp"] is True and got["AFG"]["inform_severity"] == 4.5
    assert got["TCD"]["fatalities_log10"] == -math.inf
    later = plans.severity_against_fatalities(combined(spark), since=2015, to_year=2015)
    assert {r["iso3"]: r["fatalities"] for r in later.collect()}["AFG"] == 100.0


def test_severity_against_events(spark, rows):
    panel = combined(spark).withColumn("inform_displacement", F.col("inform_severity") + 1)
    out = plans.severity_against_events(panel)
    assert rows(out, "iso3", "events", "inform_severity", "inform_displacement") == [
        ("AFG", 3, 4.5, 5.5), ("TCD", 0, 3.1, 4.1), (None, 5, 1.0, 2.0),
    ]


def test_enrich_polygons(spark, rows, incidents, square):
    far = square.select(
        F.lit("far").alias("id"), F.lit(None).cast("string").alias("iso3"), "parts",
        F.transform("edges", lambda e: F.struct(
            (e.x1 + 50).alias("x1"), e.y1.alias("y1"), (e.x2 + 50).alias("x2"), e.y2.alias("y2"),
        )).alias("edges"), "xmin", "ymin", "xmax", "ymax",
    )
    polygons = square.unionByName(far)
    severity = severity_table(spark, [("PSE", "Conflict", "4", "2"), (None, "Floods", "1", "1")])
    out = plans.enrich_polygons(polygons, severity, incidents, "id", year=1999)
    assert rows(out, "id", "inform_class", "conflict_events", "best", "deaths_civilians") == [
        ("far", "Other", 0, 0, 0), ("west", "Conflict", 2, 5, 1),
    ]
    everything = plans.enrich_polygons(polygons, severity, incidents, "id", year=None)
    assert rows(everything, "id", "conflict_events", "best") == [("far", 0, 0), ("west", 3, 6)]


def test_areas_and_need(spark, rows, incidents, square):
    keys = spark.createDataFrame([("west", "PS01")], "id string, adm1_Pcode string")
    events = plans.events_by_area(square, incidents, keys, "id")
    assert rows(events) == [("west", "PS01", 3)]
    need = spark.createDataFrame(
        [("PS01", 10.0), ("PS01", 15.0), ("PS02", 1.0), ("PS03", None)],
        "adm1_Pcode string, pin double",
    )
    people = spark.createDataFrame(
        [("PS01", 100), ("PS02", 0)], "adm1_Pcode string, population int"
    )
    share = plans.percent_in_need(need, people, "adm1_Pcode")
    assert rows(share) == [
        ("PS01", 25.0, 100, 25.0), ("PS02", 1.0, 0, None), ("PS03", 0.0, None, None),
    ]
    both = plans.area_need(events, share)
    assert rows(both, "id", "events", "pin_pct") == [("west", 3, 25.0)]
