"""Source and sink helpers that need no outside system."""

import pytest

from tidemark.sources import jdbc, messages


def test_reader_options():
    plain = jdbc.read_options("jdbc:x", "t", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "t", "user": "u"}
    split = jdbc.read_options("jdbc:x", "t", split_on="id", bounds=(0, 100), parts=8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "100", "8")


def test_batch_statements():
    assert jdbc.update_statement("t", "s", ["k"], ["a"]) == (
        "UPDATE t SET a = (SELECT s.a FROM s WHERE t.k = s.k) WHERE EXISTS (SELECT 1 FROM s WHERE t.k = s.k)"
    )
    assert jdbc.delete_statement("t", "s", ["k", "j"]) == (
        "DELETE FROM t WHERE EXISTS (SELECT 1 FROM s WHERE t.k = s.k AND t.j = s.j)"
    )


def test_lookup_is_loaded_again_when_stale():
    now, loads = [0.0], []

    def load():
        loads.append(now[0])
        if now[0] == 1800.0:
            raise OSError("no connection")
        return f"frame {len(loads)}"

    lookup = jdbc.Reloading(load, clock=lambda: now[0])
    assert lookup.get() == "frame 1"
    now[0] = 1799.0
    assert lookup.get() == "frame 1"
    now[0] = 1800.0
    assert lookup.get() == "frame 1"
    now[0] = 2000.0
    assert lookup.get() == "frame 1"
    now[0] = 2100.0
    assert lookup.get() == "frame 3" and loads == [0.0, 1800.0, 2100.0]


def test_first_failed_load_is_an_error():
    def load():
        raise OSError("no connection")

    with pytest.raises(OSError):
        jdbc.Reloading(load).get()


def test_mobile_documents_are_read_once(spark):
    texts = [
        "<feed path='/a' type='add'><segment><imsi>91</imsi><apn> w &amp; x </apn><ipAddress>10.0.0.1</ipAddress><rat/></segment></feed>",
        "<feed path='/b' type='add'><hnb><hnbid>c1</hnbid><location>room <b>1</b></location><location>2</location></hnb></feed>",
        "<notify path='/c' type='add'><imsi>92</imsi></notify>",
        "<feed path='/d' type='add'><segment><ipAddress></ipAddress><msisdn>5</msisdn></segment></feed>",
        "<feed path='/e' type='add'><segment><imsi>93</imsi></segment></feed>",
        "<feed path='/f' type='remove'><segment><ipAddress>10.0.0.1</ipAddress></segment></feed>",
        "<feed path='x' type='add'><segment>",
        "",
        None,
    ]
    out = messages.parse_mobile(spark.createDataFrame(list(enumerate(texts)), "id int, value string"))
    got = {r["id"]: tuple(r)[1:] for r in out.collect()}
    assert got == {
        0: ("10.0.0.1", "91", " w & x ", "", None, None, None, None, None),
        1: ("/b", None, None, None, None, "c1", "room 1", None, None),
        2: ("92", None, None, None, None, None, None, None, "/c"),
        3: ("", None, None, None, "5", None, None, None, None),
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("XPath") == 1 and plan.count("from_xml") <= 1
