"""Edge semantics on a few rows; expected results worked by hand."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from knowntime.functions import scalars as S
from knowntime.operators import asof, backtest, fundamentals, indicators, pit, portfolio, windows
from knowntime.operators import quality as Q
from knowntime.sources import parsers, store

D = dt.date


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_asof_takes_the_row_and_equal_times(spark):
    left = frame(spark, [(1, 3), (1, 2), (1, 0)], "k int, t int")
    right = frame(spark, [(1, 1, 1, 2), (1, 2, None, 5)], "k int, r int, x int, y int")
    out = asof.asof_join(left, right, ["k"], "t", "r", ["x", "y"]).orderBy("t").collect()
    assert [(r.t, r.x, r.y) for r in out] == [(0, None, None), (2, None, 5), (3, None, 5)]
    out = asof.asof_join(left, right, ["k"], "t", "r", ["x", "y"], "forward").orderBy("t").collect()
    assert [(r.t, r.x, r.y) for r in out] == [(0, 1, 2), (2, None, 5), (3, None, None)]


@pytest.mark.parametrize("as_of, want", [("2023-02-15", 10.0), ("2023-03-01", 12.0), ("2023-01-31", None)])
def test_latest_revision(spark, as_of, want):
    df = frame(spark, [("A", D(2023, 1, 1), 0, D(2023, 2, 1), 10.0), ("A", D(2023, 1, 1), 1, D(2023, 3, 1), 12.0)], "code string, event date, revision int, known date, value double")
    got = pit.latest_revision(df, as_of, ["code", "event"]).collect()
    assert [r.value for r in got] == ([] if want is None else [want])


FILINGS = "ticker string, period_end date, known date, form string, eps double, revenue double"


def year(eps, quarters, filed=D(2023, 2, 1), q3=D(2022, 11, 10)):
    ends = [D(2022, 3, 31), D(2022, 6, 30), D(2022, 9, 30)]
    rows = [("T", e, D(e.year, e.month, 28) + dt.timedelta(40), "10-Q", q, q) for e, q in zip(ends, quarters)]
    if len(rows) == 3:
        rows[2] = ("T", ends[2], q3, "10-Q", quarters[2], quarters[2])
    return [*rows, ("T", D(2022, 12, 31), filed, "10-K", eps, eps)]


def test_implied_q4(spark):
    one = fundamentals.implied_q4_eps(frame(spark, year(4.0, [0.9, 1.0, 1.1]), FILINGS)).collect()
    assert [(round(r.eps, 9), r.form, r.known) for r in one] == [(1.0, "10-Q", D(2023, 2, 1))]
    assert fundamentals.implied_q4_eps(frame(spark, year(20.0, [1.0, 1.0, 1.0]), FILINGS)).count() == 0
    assert fundamentals.implied_q4_eps(frame(spark, year(4.0, [1.0, 1.0]), FILINGS)).count() == 0


def test_ttm_flow_needs_exactly_three_and_waits_for_the_last(spark):
    late = frame(spark, year(10.0, [2.0, 2.0, 2.0], q3=D(2023, 2, 10)), FILINGS)
    got = fundamentals.ttm_flow(late, "revenue").collect()
    assert [(r.known, r.ttm_revenue) for r in got] == [(D(2023, 2, 10), 10.0)]
    four = year(10.0, [2.0, 2.0, 2.0]) + [("T", D(2021, 12, 31), D(2022, 1, 20), "10-Q", 1.0, 1.0)]
    assert [r.period_end for r in fundamentals.ttm_flow(frame(spark, four, FILINGS), "revenue").collect()] == [D(2022, 9, 30)]


def test_streak_drawdown_and_growth(spark):
    df = frame(spark, [("a", i, float(v)) for i, v in enumerate([1, 2, 3, 3, 4])], "k string, t int, v double")
    assert [r.streak for r in windows.growth_streak(df, "v", "k", "t").orderBy("t").collect()] == [0, 1, 2, 0, 1]
    r = frame(spark, [("a", 0, 0.1), ("a", 1, -0.5), ("a", 2, 0.2)], "k string, t int, r double")
    assert round(windows.max_drawdown(r, "r", "k", "t").first()[1], 9) == -0.5
    m = frame(spark, [("a", i, 100.0 + 5 * (i == 12)) for i in range(13)], "k string, t int, v double")
    assert [r[0] for r in m.select(windows.yoy_change(F.col("v"), "k", "t").alias("y"), "t").orderBy("t").collect()] == [None] * 12 + [5.0]


def test_position_changes_and_holding_quarters(spark):
    q = [D(2020, 3, 31), D(2020, 6, 30), D(2020, 9, 30), D(2020, 12, 31)]
    rows = [("m", p, 9, 10.0, 10.0) for p in q] + [("m", q[0], 1, 100.0, 1.0), ("m", q[1], 1, 106.0, 1.0), ("m", q[3], 1, 50.0, 1.0)]
    rows += [("m", q[0], c, 100.0, 1.0) for c in (2, 3, 4)] + [("m", q[1], 2, 105.0, 1.0), ("m", q[1], 3, 95.0, 1.0), ("m", q[1], 4, 94.0, 1.0)]
    h = portfolio.portfolio_history(frame(spark, rows, "manager string, period date, cusip int, shares double, value double"))
    got = {(r.cusip, r.period): (r.change, r.quarters_held) for r in h.collect()}
    assert [got[1, p] for p in q] == [("new", 1), ("increased", 2), ("closed", 0), ("new", 1)]
    assert [got[c, q[1]][0] for c in (2, 3, 4)] == ["held", "held", "decreased"]
    total = h.where("change <> 'closed'").groupBy("manager", "period").agg(F.sum("weight").alias("w")).collect()
    assert all(abs(r.w - 1) < 1e-12 for r in total)
    runs = {(r.start, r.exit, r.quarters) for r in portfolio.holding_runs(h, "2021-06-30").where("cusip = 1").collect()}
    assert runs == {(q[0], q[2], 2), (q[3], D(2021, 6, 30), 1)}


def test_scalars(spark):
    df = frame(spark, [(1.0, 0.0), (None, 2.0), (600.0, 1.0), (-1.0, 1.0), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(S.safe_div(F.col("a"), F.col("b"), 0, 500)).collect()] == [None, None, None, None, 1.5]
    rows = [(D(2023, 1, 1), D(2023, 4, 2), "10-Q", True), (D(2023, 1, 1), D(2023, 10, 1), "10-Q", False), (None, D(2023, 4, 1), "10-Q", False), (D(2022, 1, 1), D(2023, 1, 1), "10-K", True), (D(2022, 7, 1), D(2022, 12, 28), "10-K", False), (None, D(2022, 12, 28), "10-K", True)]
    df = frame(spark, rows, "s date, e date, f string, want boolean")
    assert all(r[0] == r[1] for r in df.select(S.is_period_length(F.col("s"), F.col("e"), F.col("f")), "want").collect())
    df = frame(spark, [(D(2023, 1, 3),), (D(2023, 6, 30),)], "d date")
    assert [r[0].hour for r in df.select(S.market_close_utc(F.col("d"))).collect()] == [21, 20]
    df = frame(spark, [("$1,234",), ("1.5K",), ("+2M",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(S.parse_amount(F.col("t"))).collect()] == [1234.0, 1500.0, 2e6, None, None]
    df = frame(spark, [("10-K/A",), ("10-Q",), ("8-K",)], "f string")
    assert [r[0] for r in df.select(S.base_form(F.col("f"))).collect()] == ["10-K", "10-Q", None]
    df = frame(spark, [(" 2.02, 9.01",), (None,)], "i string").select(*S.item_flags(F.col("i")))
    assert [(r.has_earnings, r.has_ma) for r in df.collect()] == [(1, 0), (0, 0)]
    assert S.clean_columns(frame(spark, [(1,)], "`Trade Date ` int")).columns == ["trade_date"]
    assert frame(spark, [("January 30-31", 2023)], "t string, y int").select(S.meeting_date(F.col("t"), F.col("y"))).first()[0] == D(2023, 1, 31)


def test_coalesce_by_priority(spark):
    rows = [("T", "revenue", 0, D(2023, 1, 1), 5.0), ("T", "revenue", 1, D(2023, 3, 1), 7.0), ("T", "revenue", 0, D(2023, 2, 1), 6.0)]
    out = fundamentals.coalesce_by_priority(frame(spark, rows, "ticker string, metric string, priority int, filed date, value double"), ["ticker"], ["revenue"]).first()
    assert (out.revenue, out.knowledge) == (6.0, D(2023, 2, 1))


def test_membership(spark):
    ev = [("i", "t", "added", D(2010, 1, 1)), ("i", "t", "removed", D(2020, 1, 1)), ("i", "t", "added", D(2022, 1, 1)), ("i", "u", "removed", D(2012, 1, 1))]
    iv = pit.membership_intervals(frame(spark, ev, "i string, t string, action string, at date"), ["i", "t"], "action", "at")
    assert [pit.members_at(iv, d).count() for d in ("2015-01-01", "2021-01-01", "2023-01-01", "2020-01-01")] == [1, 0, 1, 0]


def test_trades(spark):
    bars = frame(spark, [("T", D(2023, 1, 2), 100.0, dt.datetime(2023, 1, 2, 0)), ("T", D(2023, 1, 9), 110.0, dt.datetime(2023, 1, 9, 16))], "ticker string, event date, close double, known timestamp_ntz")
    t = frame(spark, [("T", s, D(2023, 1, 3), D(2023, 1, 10)) for s in ("LONG", "SHORT")] + [("Z", "LONG", D(2023, 1, 3), D(2023, 1, 10))], "ticker string, direction string, entry_date date, exit_date date")
    got = {(r.ticker, r.direction): (r.pnl_pct and round(r.pnl_pct, 9), r.outcome) for r in asof.evaluate_trades(t, bars).collect()}
    assert got == {("T", "LONG"): (10.0, "GAIN"), ("T", "SHORT"): (-10.0, "LOSS"), ("Z", "LONG"): (None, "ERROR")}
    strict = frame(spark, [("T", "LONG", D(2023, 1, 2), D(2023, 1, 9))], t.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", "))
    r = asof.evaluate_trades(strict, bars, "strict").first()
    assert (r.entry_price, r.exit_price) == (100.0, None)


def test_momentum_and_flips(spark):
    p = frame(spark, [(D(2023, 1, 1), f"t{i:02d}", float(i)) for i in range(25)], "as_of date, ticker string, momentum double")
    n = {r.signal: r["count"] for r in backtest.momentum_signal(p).groupBy("signal").count().collect()}
    assert n == {"LONG": 2, "SHORT": 2, "FLAT": 21}
    days = [D(2023, 1, i) for i in range(1, 7)]
    s = frame(spark, [(d, "T", x) for d, x in zip(days, ["FLAT", "LONG", "LONG", "SHORT", "FLAT"])], "as_of date, ticker string, signal string")
    got = backtest.signal_flips(s, frame(spark, [(d,) for d in days], "as_of date")).orderBy("entry_date").collect()
    assert [(r.direction, r.entry_date) for r in got] == [("LONG", days[1]), ("SHORT", days[3])]


def test_upsert(spark, tmp_path):
    spec, root = store.TableSpec("t", ("k",), ("year",), "d", ("v",)), f"file://{tmp_path}"
    new = frame(spark, [(1, D(2020, 1, 1), 1), (1, D(2020, 1, 1), 2), (None, D(2021, 1, 1), 5)], "k int, d date, v int")
    assert store.upsert(new, root, spec) == 2
    assert store.upsert(frame(spark, [(1, D(2020, 1, 1), 1)], "k int, d date, v int"), root, spec) == 0
    assert sorted((r.k or 0, r.v) for r in store.read_table(spark, root, "t").collect()) == [(0, 5), (1, 1)]
    before = sorted(map(tuple, store.read_table(spark, root, "t").collect()), key=str)
    assert store.upsert(frame(spark, [(1, D(2020, 1, 1), 1)], "k int, d date, v int"), root, spec) == 0
    assert sorted(map(tuple, store.read_table(spark, root, "t").collect()), key=str) == before


def test_panel_is_snapshot_and_leaks_nothing(spark):
    facts = frame(spark, [(i % 5, dt.datetime(2023, 1, 1) + dt.timedelta(hours=7 * i), dt.datetime(2023, 1, 1) + dt.timedelta(hours=7 * i + i % 90)) for i in range(200)], "k int, event timestamp_ntz, known timestamp_ntz")
    days = pit.calendar(spark, "2023-01-05", "2023-03-01", "5 DAY")
    panel = pit.pit_panel(facts, days, "k", "event", "known", 20)
    assert pit.leaks(panel, "known").count() == 0
    for d in ("2023-01-15", "2023-02-14"):
        snap = pit.in_lookback(pit.known_at(facts, d), d, 20)
        assert sorted(map(tuple, panel.where(F.col("as_of") == d).drop("as_of").collect())) == sorted(map(tuple, snap.collect()))


def test_recurrences_against_a_loop(spark):
    v = [100 + (i * 37 % 19) - 0.3 * i for i in range(300)]
    df = frame(spark, [("a", i, float(x)) for i, x in enumerate(v)], "k string, t int, close double")
    got = [r.e for r in indicators.ema(df, "close", "k", "t", 9, "e").orderBy("t").collect()]
    want, e = [None] * 8, sum(v[:9]) / 9
    want.append(e)
    for x in v[9:]:
        e = e * 0.8 + x * 0.2
        want.append(e)
    assert all((a is None) == (b is None) and (a is None or abs(a - b) < 1e-9) for a, b in zip(got, want))
    up = [max(b - a, 0) for a, b in zip(v, v[1:])]
    down = [max(a - b, 0) for a, b in zip(v, v[1:])]
    u, d, want = sum(up[:14]) / 14, sum(down[:14]) / 14, [None] * 14
    want.append(100 * u / (u + d))
    for x, y in zip(up[14:], down[14:]):
        u, d = u * 13 / 14 + x / 14, d * 13 / 14 + y / 14
        want.append(100 * u / (u + d))
    got = [r.rsi for r in indicators.rsi(df, "close", "k", "t").orderBy("t").collect()]
    assert all((a is None) == (b is None) and (a is None or abs(a - b) < 1e-9) for a, b in zip(got, want))


def test_parsers(spark, tmp_path):
    for name, ns in (("a", ""), ("b", ' xmlns="http://example.org/x"')):
        (tmp_path / f"{name}.xml").write_text(f"""<informationTable{ns}><infoTable><nameOfIssuer>X</nameOfIssuer><cusip>1</cusip><value>1,000</value><shrsOrPrnAmt><sshPrnamt>5</sshPrnamt><sshPrnamtType>SH</sshPrnamtType></shrsOrPrnAmt><investmentDiscretion>SOLE</investmentDiscretion></infoTable><infoTable><nameOfIssuer>Y</nameOfIssuer><cusip></cusip><value>2</value></infoTable></informationTable>""")
    a, b = ([tuple(r) for r in parsers.parse_infotable(spark, f"{tmp_path}/{n}.xml").collect()] for n in "ab")
    assert a == b == [("X", "1", 1000, 5, "SH", "SOLE", None)]
    (tmp_path / "s.csv").write_text("DATE,V\n2020-01-01,1.5\n2020-02-01,.\n1980-01-01,3\n")
    got = parsers.load_series_csv(spark, f"{tmp_path}/s.csv", "X", {"X": 10}, "2020-01-05").collect()
    assert [(r.event, r.value, r.known) for r in got] == [(D(2020, 1, 1), 1.5, D(2020, 1, 5))]
    raw = frame(spark, [('{"observations":[{"date":"2020-01-01","value":"2","realtime_start":"2020-02-01"},{"date":"2020-02-01","value":"."}]}',)], "json string")
    assert [(r.event, r.value, r.known) for r in parsers.load_series_json(raw).collect()] == [(D(2020, 1, 1), 2.0, D(2020, 2, 1))]
    html = "<table id='x'><tr><th>Symbol</th><th>Company Name</th></tr><tr><td>BRK.B</td><td> Big&nbsp;Co </td></tr><tr><td>-</td></tr></table>"
    rows = parsers.parse_html_table(frame(spark, [(1, html), (2, None)], "page_id int, html string"), "x")
    out = parsers.table_columns(rows, {"ticker": ["symbol"], "name": ["company"]}).orderBy("row").collect()
    assert [(r.ticker, r.name) for r in out] == [("BRK.B", "Big Co"), (None, None)]
    links = frame(spark, [('<a href="xslF/p.xml"><a href="primary_doc.xml"><a href="t.xml">',)], "h string").select(*[c.alias(n) for n, c in zip("ab", parsers.discover_links(F.col("h")))]).first()
    assert (len(links.a), links.b) == (3, "t.xml")
    facts = frame(spark, [("T", '{"facts":{"us":{"Rev":{"units":{"USD":[{"start":"2022-01-01","end":"2022-12-31","form":"10-K/A","filed":"2023-02-01","val":5,"accn":"x"}]}}}}}')], "ticker string, json string")
    obs = parsers.explode_company_facts(facts)
    assert [(r.metric, r.form, r.value) for r in parsers.facts_of_metrics(obs, {"revenue": ["Sales", "Rev"]}).collect()] == [("revenue", "10-K", 5.0)]
    assert parsers.facts_by_accession(obs, {"revenue": ["Rev"]}, ["ticker"]).first().metrics == {"revenue": 5.0}
    sub = frame(spark, [("T", '{"filings":{"recent":{"form":["8-K","10-K"],"filingDate":["2023-01-02","2023-01-03"],"accessionNumber":["a","b"],"items":["2.02"]}}}')], "ticker string, json string")
    assert [(r.accessionNumber, r["items"]) for r in parsers.explode_submissions(sub, ["8-K"]).collect()] == [("a", "2.02")]
    tr = frame(spark, [('{"symbol":"abc","senator":"S","transactionDate":"2023-01-01","disclosure_date":"2023-01-11"}',), ('{"ticker":"--","disclosure_date":"2023-01-11"}',)], "json string")
    assert [(r.ticker, r.delay_days) for r in parsers.load_disclosed_trades(tr, "2023-01-01", "2023-12-31").collect()] == [("ABC", 10)]


def test_quality_summary(spark):
    df = frame(spark, [(1, 5.0), (1, -1.0), (2, None)], "k int, v double")
    out = Q.check(df, [Q.rule("positive", F.col("v") <= 0), Q.rule("warned", F.col("v") < 0, warn=True), Q.at_least("rows", F.count(F.lit(1)), 3), Q.in_range("in_range", "v", -5, 5)])
    assert {r.rule: r.status for r in out.collect()} == {"positive": "FAIL", "warned": "WARN", "rows": "PASS", "in_range": "PASS"}
    assert Q.unique_key("k", df, ["k"]).first().status == "FAIL"
    assert {r.status: r.rules for r in Q.summary([out]).collect()} == {"FAIL": 1, "WARN": 1, "PASS": 2}


def test_asof_in_buckets_is_the_plain_one(spark):
    rng = random.Random(3)
    left = frame(spark, [(k, i, D(2020, 1, 1) + dt.timedelta(rng.randrange(400))) for i, k in enumerate(rng.choices([1, 2, None], k=200))], "k int, i int, t date")
    a = frame(spark, [(rng.choice([1, 2]), D(2020, 1, 1) + dt.timedelta(rng.randrange(400)), rng.choice([None, j])) for j in range(60)], "k int, r date, x int")
    b = frame(spark, [(rng.choice([1, 2]), D(2020, 1, 1) + dt.timedelta(rng.randrange(400)), j) for j in range(9)], "k int, s date, y int")
    sources = [asof.Source(a, "r", ("x",), ("x",)), asof.Source(b, "s", ("y",), ("y",))]
    for direction in ("backward", "forward"):
        want = asof.asof_many(left, sources, ["k"], "t", direction).where("k is not null")
        got = asof.asof_many(left, sources, ["k"], "t", direction, bucket_days=20)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_upsert_moves_keys_and_drops_empty_partitions(spark, tmp_path):
    root, spec = f"file://{tmp_path}", store.TableSpec("t", ("k",), ("year",), "day", ("day",))
    rows = [(1, D(2020, 5, 1), "a"), (2, D(2020, 6, 1), "b"), (None, D(2021, 1, 1), "c"), (3, D(2022, 1, 1), "d")]
    assert store.upsert(frame(spark, rows, "k int, day date, v string"), root, spec) == 4
    assert store.upsert(frame(spark, [(3, D(2021, 2, 1), "moved"), (None, D(2021, 3, 1), "null"), (4, D(2023, 1, 1), "new")], "k int, day date, v string"), root, spec) == 1
    got = {(r.k, r.v, r.year) for r in store.read_table(spark, root, "t").collect()}
    assert got == {(1, "a", 2020), (2, "b", 2020), (None, "null", 2021), (3, "moved", 2021), (4, "new", 2023)}
    assert not (tmp_path / "t" / "year=2022").exists() and not [p for p in tmp_path.iterdir() if p.name.startswith(".t-") and not p.name.endswith(".crc")]


def test_averages_across_blocks(spark):
    values = [100 + 7 * ((i * 37) % 11) for i in range(1200)]
    df = frame(spark, [("a", i, float(v) if i % 50 else None) for i, v in enumerate(values)], "k string, t int, v double")
    for n, alpha in ((9, 0.2), (14, 1 / 14), (26, 2 / 27)):
        state, seen, want = None, [], []
        for i, v in enumerate(values):
            if i % 50 == 0:
                want.append(None)
                continue
            seen.append(v)
            state = sum(seen) / n if len(seen) == n else state * (1 - alpha) + v * alpha if state is not None else None
            want.append(state)
        got = [r.e for r in indicators.exponentials(df, "k", "t", {"e": ("v", n, alpha)}).orderBy("t").collect()]
        assert all((a is None and b is None) or abs(a - b) < 1e-9 * abs(b) for a, b in zip(got, want))


def test_large_tables_are_dealt_over_more_tasks(spark, monkeypatch):
    from knowntime.operators import windows
    from knowntime.plans import proxies, registry

    df, parts = spark.range(100), int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert windows.dealt(df, "id", 2_500_001).rdd.getNumPartitions() == 11
    assert windows.dealt(df, ["id"], parts * windows.ROWS_OF_A_TASK) is df and windows.dealt(df, "id", None) is df
    for name in ("e30_e34_averages", "k_rules"):
        def rows():
            return sorted(map(str, registry.queries()[name](spark, "/root/testdata/sf0.001").collect()))

        plain = rows()
        with monkeypatch.context() as m:
            m.setattr(proxies, "dealt", lambda rows, by, n: windows.dealt(rows, by, n, most=500))
            assert rows() == plain
