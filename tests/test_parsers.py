from datetime import datetime

from pyspark.sql import functions as F

from opsledger.functions import alerts as a, cleaning, device_log as dl, predicates as p
from opsledger.plans import access_logs, device_logs
from opsledger.sources import dimensions


def test_device_lines(lines):
    rows = lines([
        "03-04 05:06:07.123456 111 22 E svc: error 42 in unit 7",
        "03-04 05:06:07.123 111 22 W svc: warning",
        "03-04 05:06:07. 111 22 I svc: zero fraction",
        "no date 111 22 E svc: error",
        "03-04 05:06:07.1 111 22 E svc without colon",
        "02-31 05:06:07.1 111 22 E svc: impossible day",
        "03-04 05:06:07.5 111 22 D a::b: id::5 rest",
        "",
    ])
    parsed = device_logs.parse(rows, 2023).orderBy("position").collect()
    assert [r.parse_error for r in parsed] == [
        None, None, None, "no timestamp", "no message", "no timestamp", None, "no timestamp"]
    assert parsed[0].ts == datetime(2023, 3, 4, 5, 6, 7, 123456)
    assert parsed[1].ts == datetime(2023, 3, 4, 5, 6, 7, 123000)
    assert parsed[2].ts == datetime(2023, 3, 4, 5, 6, 7)
    assert parsed[0].message == "error  in unit"
    assert parsed[0].char_count == 14
    assert parsed[6].message == ":b: id:: rest"
    frame = device_logs.parse(rows, 2023)
    assert device_logs.accepted(frame).count() + device_logs.rejected(frame).count() == 8


def test_message_forms_and_fraction_bounds(lines):
    row = lines(["03-04 05:06:07.12 9 9 W tag: x 1"]).select(
        dl.message(F.col("value"), "letter").alias("letter"),
        dl.message(F.col("value"), "word").alias("word"),
        dl.event_time(F.col("value"), 2023, 3, 3).alias("milli"),
        dl.event_time(F.col("value"), 2023, 1, 6).alias("any"),
    ).first()
    assert row.letter is None and row.word == " x 1" and row.milli is None
    assert row.any == datetime(2023, 3, 4, 5, 6, 7, 120000)


def test_token_helpers(lines):
    value = F.col("value")
    rows = lines(["a  12:30:45 c d e f g ", "a b c", "error and warning", "Warning only", "plain", "x 12:30 y"]).select(
        "position", dl.stamped_tail(value, 5, "> ").alias("tail"), dl.level_label(value).alias("label"),
        dl.clock(value).alias("clock"), dl.drop_tokens(value, 2).alias("dropped"),
    ).orderBy("position").collect()
    assert rows[0].tail == "12:30:45> f g" and rows[0].clock == "12:30:45"
    assert rows[1].tail == "> " and rows[1].dropped == "c" and rows[1].clock == "0"
    assert [r.label for r in rows] == ["", "", "ERROR ", "WARNING ", "", ""]
    assert rows[5].clock == "12:30"


def test_word_filter_counts_whole_words(lines):
    rows = lines(["an ERROR: x", "terror", "error info", "error_code", "x" * 210 + " error", "[warning]"])
    kept = rows.where(p.has_words(F.col("value"), p.ALERT_WORDS)).select("position").collect()
    assert sorted(r.position for r in kept) == [0, 5]


def test_ordered_fragments_escape_wildcards(lines):
    rows = lines(["a%b then c_d", "aXb then c_d", "c_d then a%b", "a%b then cXd"])
    kept = rows.where(p.contains_in_order(F.col("value"), ("a%b", "c_d"))).select("position").collect()
    assert [r.position for r in kept] == [0]


def brute_normalise(text):
    text = "".join(c for c in text if c not in "0123456789")
    out, i = [], 0
    while i < len(text):                      # up to two colons after a blank become a blank
        out.append(text[i])
        if text[i].isspace():
            out.append(" ")
            skip = 0
            while skip < 2 and i + 1 < len(text) and text[i + 1] == ":":
                i, skip = i + 1, skip + 1
        i += 1
    text = "".join(out)
    text = "".join(                           # colons after a non-word character disappear
        c for i, c in enumerate(text) if not (c == ":" and i and not (text[i - 1].isalnum() or text[i - 1] == "_")))
    out = []
    for run in __import__("itertools").groupby(text, str.isspace):
        chunk = "".join(run[1])
        out.append(" " if run[0] and len(chunk) > 1 else chunk)
    return "".join(out)


def test_normaliser_against_brute_force(lines):
    import random
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab1:: [_.\t") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    rows = lines(texts).select("position", cleaning.normalised_message(F.col("value")).alias("m")).collect()
    for r in rows:
        assert r.m == brute_normalise(texts[r.position]), texts[r.position]


def test_id_phrases(lines):
    row = lines(["go session_id: abc now pair id: p9 end action_queue: qq"]).select(
        F.trim(cleaning.normalised_message(F.col("value"), drop_ids=True)).alias("m")).first()
    assert row.m == "go  now endq"  # the last phrase takes one character only


def test_case_reason_and_report_text(lines):
    rows = lines(["CASE123456 - Bad cable, dead-on [arrival]", "CASE12 x", ""]).select(
        cleaning.case_reason(F.col("value")).alias("reason"), cleaning.report_text(F.col("value")).alias("text"),
    ).collect()
    assert rows[0].reason == "Bad cable dead on arrival"
    assert rows[0].text == "Bad cable, deadon arrival"
    assert rows[1].reason == "x" and rows[2].reason == ""


ACCESS = [
    '10.0.0.1 - bob [05/Jan/2024:10:11:12 +0000] "GET /a?x=1 HTTP/1.1" 200 123 "-" "agent one"',
    ' - bob [05/Jan/2024:10:11:12 +0000] "GET /b HTTP/1.1" 500 - "ref" ""',
    '10.0.0.1 - bob [bad date] "GET /c HTTP/1.1" 200 1 "-" "x"',
    '10.0.0.1 - bob "GET /d HTTP/1.1" 200 1 "-" "x"',
    '10.0.0.1 - bob [05/Jan/2024:10:11:12 +0000] "GET" 302 1 "-" "x"',
    '10.0.0.1 - bob [05/Jan/2024:10:11:12 +0000] "GET /e HTTP/1.1" abc 1 "-" "x"',
    '10.0.0.1 - bob [31/Feb/2024:10:11:12 +0000] "GET /f HTTP/1.1" 200 1 "-" "x"',
    '10.0.0.1 - bob [05/Foo/2024:10:11:12 +0000] "GET /g HTTP/1.1" 200 1 "-" "x"',
    'noise',
]


def test_access_lines(lines):
    parsed = access_logs.parse(lines(ACCESS)).orderBy("position").collect()
    assert [r.parse_error for r in parsed] == [
        None, None, "bad date", "bad line", None, "bad line", "bad date", "bad date", "bad line"]
    first, second = parsed[0], parsed[1]
    assert (first.ip, first.url, first.status, first.bytes, first.agent) == ("10.0.0.1", "/a?x=1", 200, 123, "agent one")
    assert first.ts == datetime(2024, 1, 5, 10, 11, 12)
    assert second.ip == "" and second.bytes is None and second.agent == "" and second.referer == "ref"
    assert parsed[4].url is None and parsed[4].status == 302


def test_sentences(lines):
    rows = device_logs.coded_sentences(lines([
        "<2024-01-02 03:04:05.000006> 17 Hello there.", "2024-01-02 17 nothing", "<2024-13-02 03:04:05.000006> 1 x"]))
    row = rows.collect()
    assert len(row) == 1
    assert (row[0].ts, row[0].code, row[0].text) == (datetime(2024, 1, 2, 3, 4, 5, 6), 17, "Hello there.")


def test_error_codes_last_line_wins(lines):
    codes = dimensions.error_codes(lines(["m 12, 1, x", "other, 2", "m 99 , 3", "bad", "worse, none"]))
    assert {(r.message, r.code) for r in codes.collect()} == {("m", 3), ("other", 2)}


def test_devices_names_and_alerts(lines):
    devices = dimensions.devices(lines(["lab, 10.0.0.1, north , m1", "short, 1"])).collect()
    assert [(r.topic, r.ip, r.realm, r.model) for r in devices] == [("lab", "10.0.0.1", "north", "m1")]
    names = dimensions.quoted_names(lines(['7 "SEVEN"', "8", 'x "NO ID"', '7 "AGAIN"'])).collect()
    assert [(r.node, r.name) for r in names] == [(7, "AGAIN")]
    alerts = dimensions.alerts(lines([
        '0,0X01AB,F,N,f.cpp,Error,TRUE,FALSE,TRUE,eff,"text, with comma",TRUE,"look, then act"',
        '1,0x02,F,N,f.cpp,Error,TRUE,FALSE,TRUE,eff,text,TRUE,',
        '2,0x03,F,N,f.cpp,Error,MAYBE,FALSE,TRUE,eff,text,TRUE,x',
        '3,0x04,short',
    ])).collect()
    assert {r.error: r.message for r in alerts} == {
        "0x01ab": "look, then act", "0x02": "No Eng Message", "0x03": "Did Not match Regex", "0x04": "Did Not match Regex"}


def test_alert_payload(lines):
    rows = lines(["12 temp | 0X01AB ", "x temp|0x1", "5 temp"]).select(
        a.occurrence(F.col("value")).alias("n"), a.code(F.col("value")).alias("c")).collect()
    assert [(r.n, r.c) for r in rows] == [(12, "0x01ab"), (None, "0x1"), (5, None)]


def test_control_characters_do_not_move_fields(lines):
    good = '1.2.3.4 - u\u0001v [01/Jan/2024:10:11:12 +0000] "GET /x HTTP/1.1" 200 5 "-" "agent\u0001b"'
    bad = "\u0001".join(["1.2.3.4", "-", "u", "[01/Jan/2024:10:11:12 +0000]", "GET /x HTTP/1.1", "200", "5", "-", "agent"])
    rows = access_logs.parse(lines([good, bad])).orderBy("position").collect()
    assert rows[0].parse_error is None and (rows[0].url, rows[0].status, rows[0].agent) == ("/x", 200, "agent\u0001b")
    assert rows[1].parse_error is not None
