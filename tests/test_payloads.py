"""Payload normalisers on documents of each vendor's format."""

import datetime
import json
import math

import pytest

from tidelake.sources import payloads as P

DAY = 86_400
CLOSES = [17.25, 16.5]


def chart(symbol, start, closes):
    """A chart of daily bars around the given closes, 41 shares traded on the first day and one more each day."""
    quote = {"open": [c - 0.5 for c in closes], "high": [c + 1 for c in closes], "low": [c - 1 for c in closes],
             "close": closes, "volume": [41 + i for i in range(len(closes))]}
    result = {"meta": {"symbol": symbol}, "timestamp": [start + DAY * i for i in range(len(closes))],
              "indicators": {"quote": [quote], "adjclose": [{"adjclose": [c / 2 for c in closes]}]}}
    return json.dumps({"chart": {"result": [result]}})


def point(country, name, iso, value, year="2019"):
    return {"indicator": {"id": "LAKES", "value": "Lakes, number of"}, "country": {"id": country, "value": name},
            "countryiso3code": iso, "date": year, "value": value, "unit": "n", "obs_status": "E", "decimal": 0}


def page(number, stamp, *points):
    return json.dumps([{"page": number, "pages": 2, "per_page": 2, "total": 2, "sourceid": "7", "lastupdated": stamp}, list(points)])


START = 1_600_000_000  # 13 September 2020, 12:26 UTC
CHART = chart("OAK", START, CLOSES)
POINTS = (point("FI", "Finland", "FIN", 168000), point("SE", "Sweden", "SWE", 97500.5))
PAGE = page(1, "2020-02-29", *POINTS)


def rows(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def raw(spark, *documents, **keys):
    names = list(keys)
    data = [tuple(keys[n][i] for n in names) + (d,) for i, d in enumerate(documents)]
    return spark.createDataFrame(data, [*names, "raw"])


def test_chart_bars(spark):
    first, second = rows(P.chart_bars(raw(spark, CHART)), "epoch")
    assert first == {"symbol": "OAK", "date": datetime.date(2020, 9, 13), "epoch": START, "open": 16.75,
                     "high": 18.25, "low": 16.25, "close": 17.25, "adj_close": 8.625, "volume": 41}
    assert second["date"] == datetime.date(2020, 9, 14) and second["close"] == 16.5


def test_chart_uses_the_requested_symbol(spark):
    assert {r["symbol"] for r in rows(P.chart_bars(raw(spark, CHART, symbol=["ELM"])), "epoch")} == {"ELM"}


def test_chart_gaps(spark):
    document = ('{"chart":{"result":[{"meta":{"symbol":"X"},"timestamp":[1,2,3],"indicators":{"quote":[{'
                '"open":[1.0,null,null],"high":[2.0,2.5,9.0],"low":[0.5,null,null],"close":[null,1.5,null],'
                '"volume":[null,7,8]}]}}]}}')
    one, two = rows(P.chart_bars(raw(spark, document)), "epoch")
    assert (one["close"], one["adj_close"], one["volume"]) == (None, None, 0)
    assert (two["open"], two["adj_close"], two["volume"]) == (None, 1.5, 7)
    nan = rows(P.chart_bars(raw(spark, document), missing_as_nan=True), "epoch")
    assert len(nan) == 2 and math.isnan(nan[0]["close"]) and math.isnan(nan[0]["adj_close"])


def test_exchange_date_follows_daylight_saving(spark):
    # 04:30 UTC is the evening before in winter and the same day in summer
    document = ('{"chart":{"result":[{"meta":{"symbol":"X"},"timestamp":[1704688200,1720413000],"indicators":'
                '{"quote":[{"open":[1,1],"high":[1,1],"low":[1,1],"close":[1,1],"volume":[1,1]}]}}]}}')
    winter, summer = rows(P.chart_bars(raw(spark, document)), "epoch")
    assert winter["date"] == datetime.date(2024, 1, 7) and summer["date"] == datetime.date(2024, 7, 8)


@pytest.mark.parametrize("document", ['{"chart":{"result":[]}}', '{"chart":{"result":null}}', "not json"])
def test_chart_rejects(spark, document):
    payloads = raw(spark, document, CHART, symbol=["BAD", "OAK"])
    assert [r["symbol"] for r in rows(P.chart_rejects(payloads), "symbol")] == ["BAD"]
    assert {r["symbol"] for r in rows(P.chart_bars(payloads), "epoch")} == {"OAK"}


def test_observation_points(spark):
    points = P.observation_points(raw(spark, PAGE, batch=["b"]))
    silver = rows(P.observations(points), "country_iso3")
    assert [r["value"] for r in silver] == [168000.0, 97500.5]
    assert silver[0] == {
        "indicator_id": "LAKES", "indicator_name": "Lakes, number of", "country_id": "FI", "country_name": "Finland",
        "country_iso3": "FIN", "date": "2019", "year": "2019", "period_type": "Y", "value": 168000.0, "unit": "n",
        "obs_status": "E", "decimal": "0", "source_id": "7", "lastupdated": "2020-02-29"}


def test_points_carry_the_first_page_stamp(spark):
    second = page(2, "2021-05-05", point("NO", "Norway", "NOR", 1, "2018"))
    points = P.observation_points(raw(spark, second, PAGE, batch=["b", "b"]))
    assert {(r["date"], r["_lastupdated"]) for r in rows(points, "date")} == {("2018", "2020-02-29"), ("2019", "2020-02-29")}


def test_page_without_records(spark):
    only_meta = '[{"page":1,"pages":1,"total":0,"lastupdated":"2026-01-01"}]'
    assert P.observation_points(raw(spark, only_meta, batch=["b"])).count() == 0
    assert rows(P.page_metadata(raw(spark, only_meta, batch=["b"])), "batch") == [
        {"batch": "b", "pages": 1, "total": 0, "lastupdated": "2026-01-01"}]


def test_indicator_list_over_pages(spark):
    one = '[{"page":1,"pages":2,"per_page":2,"total":3},[{"id":"A","name":"GDP","topics":[{"id":"3","value":"Economy "}]},{"id":"B","name":"Pop"}]]'
    two = '[{"page":2,"pages":2,"per_page":2,"total":3},[{"id":"C","name":"CO2","source":{"id":"2","value":"WDI"}}]]'
    listed = P.indicator_list(raw(spark, one, two))
    assert [r["indicator_id"] for r in rows(listed, "indicator_id")] == ["A", "B", "C"]
    assert rows(P.indicator_topics(listed), "indicator_id")[0] == {
        "indicator_id": "A", "topic_id": "3", "topic_name": "Economy"}
    assert P.indicator_topics(listed).count() == 3


def test_kline_bars(spark):
    document = json.dumps([[START * 1000, "3.5", "4.25", "3.125", "4.0", "77", START * 1000 + DAY * 1000, "288.75", 12, "40", "150", 0]])
    [bar] = rows(P.kline_bars(raw(spark, document, "[]", symbol=["PINE", "NONE"])), "symbol")
    assert bar["date"] == datetime.date(2020, 9, 13) and bar["trades"] == 12 and bar["low"] == 3.125 and bar["quote_volume"] == 288.75


def test_series_observations(spark):
    document = json.dumps({"count": 2, "observations": [{"date": "2021-03-01", "value": "0.75"}, {"date": "2021-03-02", "value": "."}]})
    broken = document.replace(': "0.75"', ': 0.75"')
    result = rows(P.series_observations(raw(spark, document, broken, series=["MOSS", "BAD"])), "date")
    assert [(r["indicator_id"], r["value"]) for r in result] == [("MOSS", 0.75), ("MOSS", None)]


def test_yield_curve(spark):
    wide = spark.createDataFrame([("01/02/2024", "5.55", "N/A"), ("2024-01-03", "5.5", "4.1")],
                                 ["Date", "1 Mo", "10 Yr"])
    result = rows(P.yield_curve_rates(wide), "date", "indicator_id")
    assert [(r["indicator_id"], r["date"].day, r["value"]) for r in result] == [
        ("1 Mo", 2, 5.55), ("1 Mo", 3, 5.5), ("10 Yr", 3, 4.1)]


def test_filings(spark):
    recent = {"accessionNumber": ["0000000042-20-000007"], "filingDate": ["2020-06-30"], "form": ["8-K"], "primaryDocument": ["oak.htm"]}
    document = json.dumps({"cik": "0000000042", "name": "Oak & Sons", "filings": {"recent": recent}})
    [filing] = rows(P.filings(raw(spark, document, symbol=["OAK"])), "symbol")
    assert filing["url"].endswith("/42/000000004220000007/oak.htm") and filing["form_type"] == "8-K"


def test_spot_quotes(spark):
    [quote] = rows(P.spot_quotes(raw(spark, '{"data":{"amount":"64000.125","base":"BTC","currency":"USD"}}')), "base")
    assert float(quote["amount"]) == 64000.125


def test_quote_lines(spark):
    result = rows(P.quote_lines(raw(spark, 'v_sh600000="51~600000~8.1";\nv_sz1="1~x";',
                                    'var hq_str_sh600001="name,8.20,8.21";')), "symbol")
    assert [(r["symbol"], r["fields"][1]) for r in result] == [
        ("sh600000", "600000"), ("sh600001", "8.20"), ("sz1", "x")]


def test_distinct_payloads(spark):
    assert P.distinct_payloads(raw(spark, "a", "a", "b", symbol=["x", "y", "z"])).count() == 2
