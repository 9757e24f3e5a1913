import pytest

from terramatch.operators import permanence as p
from terramatch.plans import stages


def series(spark, values, first=2012):
    return spark.createDataFrame([(first + i, float(v)) for i, v in enumerate(values)], "year int, value double")


def as_dict(df, key="year", value=None):
    return {r[key]: r[value] for r in df.collect()}


ADD, LEAK = [2.0, 9.5, 13.0, 30.0, 31.5, 52.0, 60.25, 88.0, 91.0], [0.5, 1.0, 4.0, 4.5, 9.0, 9.5, 16.0, 21.0, 40.0]
FIRST = 1995
NET = {FIRST + i: (ADD[i] - LEAK[i]) - (ADD[i - 1] - LEAK[i - 1]) for i in range(1, len(ADD))}


@pytest.fixture
def both(spark):
    return series(spark, ADD, FIRST), series(spark, LEAK, FIRST)


def test_a_schedule_may_end_before_all_is_released(spark):
    """0.5 a year from 2003 on: 2 are released by 2006, 99 never are, and nothing takes no time."""
    schedule = spark.createDataFrame([(y, f, 0.5 if f > 2002 else 0.0) for y in (2000, 2001, 2002) for f in range(2000, 2012)], "est_year int, for_year int, release double")
    adjusted = spark.createDataFrame([(2000, 2.0), (2001, 99.0), (2002, -1.0)], "year int, adjusted double")
    assert as_dict(p.release_year(adjusted, schedule), value="released_by") == {2000: 2006, 2001: None, 2002: 2002}


def test_schedules_by_the_rule(spark, both):
    net = p.net_sequestration(*both)
    rate = {y: (NET[y] - NET[y - 5]) / 5 for y in NET if y - 5 in NET}
    last, end, horizon = FIRST + len(ADD) - 1, FIRST + 4, FIRST + 20
    got = {(r.est_year, r.for_year): r.release for r in p.release_schedule(net, "high", FIRST, last, end, horizon).collect()}
    want = {(e, f): 0.0 if f <= end or e < FIRST + 6 else rate[e] for e in range(FIRST, last + 1) for f in range(FIRST, horizon + 1)}
    assert len(rate) == 3 and got == pytest.approx(want)
    owed = {y: sum(v for (e, f), v in want.items() if f == y and e < y) for y in NET}
    adjusted = as_dict(p.adjusted_net(net, p.release_schedule(net, "high", FIRST, last, end, horizon)), value="adjusted")
    assert adjusted == pytest.approx({y: NET[y] - owed[y] for y in NET}) and any(owed.values())
    low = {(r.est_year, r.for_year): r.release for r in p.release_schedule(net, "low", last - 2, last, end, horizon).collect()}
    assert low == pytest.approx({(e, f): rate[e] for e in range(last - 2, last + 1) for f in range(last - 2, horizon + 1)})
    with pytest.raises(Exception, match="too short"):
        p.release_schedule(net, "low", FIRST, last, end, horizon).collect()
    with pytest.raises(ValueError):
        p.release_schedule(net, "medium", FIRST, last, end, horizon)


def test_net_and_rates(spark, both):
    net = p.net_sequestration(*both)
    assert as_dict(net, value="net") == pytest.approx(NET)
    assert p.at_year(net, FIRST + 3, "net").first()[0] == pytest.approx(NET[FIRST + 3])
    with pytest.raises(Exception, match="out of bounds"):
        p.at_year(net, FIRST, "net").collect()
    for years in (1, 4, len(ADD)):
        assert as_dict(p.release_rate(net, years), value="release") == pytest.approx({y: (NET[y] - NET[y - years]) / years for y in NET if y - years in NET})


def test_series_of_other_years_are_an_error(spark, both):
    with pytest.raises(Exception, match="not of the same years"):
        p.net_sequestration(both[0], series(spark, LEAK[1:], FIRST + 1)).collect()


def test_interpolation_runs_on_at_both_ends(spark):
    got = as_dict(p.interpolate_cost(spark.createDataFrame([(2010, 10.0), (2020, 20.0), (2030, 50.0)], "year int, value double"), 2005, 2035), value="value")
    assert [got[y] for y in (2005, 2010, 2015, 2020, 2025, 2035)] == pytest.approx([5, 10, 15, 20, 35, 65])


def test_interpolation_loses_no_segment(spark):
    series = lambda n: spark.range(n).selectExpr("cast(id AS int) AS year", "cast(id AS double) AS value")
    assert p.interpolate_cost(series(p.HORIZON + 1), 0, 4100).count() == 4101
    with pytest.raises(Exception, match="segments"):
        p.interpolate_cost(series(p.HORIZON + 2), 0, 4100).collect()
    again = series(2000).unionByName(series(2000)).unionByName(series(2000))
    assert p.interpolate_cost(again, 0, 2100).filter("value = year").count() == 2101


def plain_ep(add, leak, cost, current, project_end, horizon, first=2012):
    """The same by loops."""
    d = [a - b for a, b in zip(add, leak, strict=True)]
    net = {first + i: d[i] - d[i - 1] for i in range(1, len(d))}

    def sched(est, year):
        return 0.0 if year <= project_end or est < first + 6 else (net[est] - net[est - 5]) / 5

    adj = net[current] - sum(sched(e, current) for e in range(first, current))
    by, released = current, 0.0
    while adj - released > 0:
        by += 1
        released += abs(sched(current, by))
    years = sorted(cost)

    def price(y):
        i = max(0, min(len(years) - 2, sum(1 for x in years if x <= y) - 1))
        a, b = years[i], years[i + 1]
        return cost[a] + (cost[b] - cost[a]) * (y - a) / (b - a)

    damage = sum(abs(sched(current, current + k)) * price(current + k) / 1.03**k for k in range(by - current))
    return (adj * price(current) - damage) / (adj * price(current))


def test_equivalent_permanence(spark):
    add, leak = [0, 10, 22, 36, 52, 70, 90, 113, 140], [0, 1, 2, 3, 4, 5, 6, 7, 8]
    cost = {2010: 50.0, 2020: 62.0, 2050: 120.0}
    given = spark.createDataFrame([(y, v) for y, v in cost.items()], "year int, value double")
    got = stages.project_permanence(series(spark, add), series(spark, leak), given, 2019, project_end=2025, horizon=2200).first()
    assert got.status == "ok" and got.ep == pytest.approx(plain_ep(add, leak, cost, 2019, 2025, 2200))


def test_nothing_sequestered_has_no_permanence(spark):
    given = spark.createDataFrame([(2010, 50.0), (2050, 120.0)], "year int, value double")
    got = stages.project_permanence(series(spark, [9, 8, 7, 6, 5, 4, 3, 2, 1]), series(spark, [0] * 9), given, 2019, project_end=2025, horizon=2100).first()
    assert got.ep is None and got.status == "nothing_sequestered"
