from hypothesis import given, settings
from hypothesis import strategies as st

from veilwork.operators.parsing import NOTE_TYPES, failed_records, load_valid


def automaton(raw: str) -> list[str] | None:
    """Cells by a character automaton; None for broken quoting."""
    cells, cell, state = [], "", "start"
    for ch in raw:
        if state == "start":
            if ch == '"':
                state = "quoted"
            elif ch == ",":
                cells.append("")
            else:
                cell, state = ch, "plain"
        elif state == "plain":
            if ch == '"':
                return None
            if ch == ",":
                cells.append(cell)
                cell, state = "", "start"
            else:
                cell += ch
        elif state == "quoted":
            if ch == '"':
                state = "closed"
            else:
                cell += ch
        elif ch == '"':
            cell, state = cell + '"', "quoted"
        elif ch == ",":
            cells.append(cell)
            cell, state = "", "start"
        else:
            return None
    return None if state == "quoted" else [*cells, cell]


OK = "7,note,F01,triage,40,2024-02-29T23:59:59"
CASES = {
    OK: None,
    '7,"a ""b"", c\nd",F01,triage,,2024-01-01T00:00:00': None,
    '"7","x","","triage","0120","2024-01-01T00:00:00"': None,
    "9223372036854775807,x,,triage,0,2024-01-01T00:00:00": None,
    "\x01\x02 7,x": "column_count",
    "7,\x01a\x02b\x011,F,triage,1,2024-01-01T00:00:00": None,
    "": "column_count",
    None: "column_count",
    '7,"open,F01,triage,40,2024-01-01T00:00:00': "quoting",
    '7,a "b" c,F01,triage,40,2024-01-01T00:00:00': "quoting",
    '7,"a"b,F01,triage,40,2024-01-01T00:00:00': "quoting",
    "7,a,F01,triage,40": "column_count",
    OK + ",x": "column_count",
    "0,x,F,triage,40,2024-01-01T00:00:00": "bad_value",
    "9223372036854775808,x,F,triage,40,2024-01-01T00:00:00": "bad_value",
    "٣,x,F,triage,40,2024-01-01T00:00:00": "bad_value",
    "7,  ,F,triage,40,2024-01-01T00:00:00": "bad_value",
    "7,x,F,Triage,40,2024-01-01T00:00:00": "bad_value",
    "7,x,F,triage,121,2024-01-01T00:00:00": "bad_value",
    "7,x,F,triage,-1,2024-01-01T00:00:00": "bad_value",
    "7,x,F,triage,4,2023-02-29T00:00:00": "bad_value",
    "7,x,F,triage,4,2024-01-01 00:00:00": "bad_value",
    "7,x,F,triage,4,2024-01-01T24:00:00": "bad_value",
    "7,x,F,triage,4,2024-01-01T00:00:00\n": "bad_value",
}


def test_cases_with_clashing_and_repeated_columns(spark):
    rows = [(n, raw, "b", "x", 1) for n, raw in enumerate(CASES)] * 2
    df = spark.createDataFrame(rows, "raw_id long, raw string, key string, text string, value int")
    got = {r.raw_id: r.reason for r in failed_records(df).collect()}
    want = {n: reason for n, reason in enumerate(CASES.values()) if reason}
    assert got == want
    loaded = load_valid(df).collect()
    assert {r.raw_id for r in loaded} == set(range(len(CASES))) - set(want)
    texts = {r.raw_id: (r.text, r.age) for r in loaded}
    assert texts[1] == ('a "b", c\nd', None) and texts[2] == ("x", 120) and texts[5][0] == "\x01a\x02b\x011"


def test_empty_table_and_null_key(spark):
    empty = spark.createDataFrame([], "raw_id long, raw string")
    assert failed_records(empty).collect() == [] and load_valid(empty).collect() == []
    df = spark.createDataFrame([(None, "x"), (None, OK)], "raw_id long, raw string")
    assert [tuple(r) for r in failed_records(df).collect()] == [(None, "column_count")]
    assert [r.id for r in load_valid(df).collect()] == [7]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet='a," \n', max_size=14), min_size=1, max_size=60))
def test_quoting_against_the_automaton(spark, records):
    from veilwork.operators.parsing import parse_records

    df = spark.createDataFrame(list(enumerate(records)), "raw_id long, raw string")
    for r in parse_records(df).collect():
        assert r.cells == automaton(records[r.key])


def test_long_record(spark):
    raw = '7,"' + 'x "" ' * 100_000 + '",F,triage,4,2024-01-01T00:00:00'
    df = spark.createDataFrame([(1, raw)], "raw_id long, raw string")
    assert failed_records(df).collect() == []
    assert NOTE_TYPES[0] == "progress"
