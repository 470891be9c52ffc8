import json

import pytest
from pyspark.errors import PySparkException

from quillstone.sources import register
from quillstone.sources.fetch import Policy, get

COLUMNS = ["joint Q&A ID", "Receiving ESA ", "Q&A ID at the ESA that received it", "Date of submission", "Date of publication", "Status", "Legal act", "Article", "Topic", "Link to the answer", "Answered by"]
DAY = 86_400_000
WORDS = {"D0": ["EBA", "ESMA"], "D1": ["Final", "Rejected"], "D2": ["DORA"]}
DICTS = [None, "D0", None, None, None, "D1", "D2", None, None, None, None]
DESC = [{"N": f"G{k}"} | ({"DN": d} if d else {}) for k, d in enumerate(DICTS)]


def answer(rows, words=WORDS, desc=DESC):
    rows = [dict(rows[0], S=desc), *rows[1:]] if rows and desc else rows
    return json.dumps({"results": [{"result": {"data": {"dsr": {"DS": [{"ValueDicts": words, "PH": [{"DM0": rows}]}]}}}}]})


def test_an_answer_as_rows(spark):
    rows = [
        {"C": ["DORA1", 0, 17, 19_000 * DAY, None, 0, 0, " 3(60) ", "t", "http://x", "EC"], "Ø": 0},
        {"C": ["DORA2", 1, "18", 19_001.0 * DAY, 1, "odd status"], "R": 0b01111000000 & ~0b00001100000, "Ø": 0b10000000000 | 0b00001000000},
        {"C": ["DORA3"], "R": 0b11111111110},
    ]
    rows[1] = {"C": ["DORA2", 1, "18", 19_001.5 * DAY, 1], "R": (1 << 6) | (1 << 7) | (1 << 8) | (1 << 9), "Ø": (1 << 4) | (1 << 10)}
    raw = spark.createDataFrame([("a", answer(rows)), ("b", answer([{"C": ["X"], "Ø": 0b11111111110}], words={}))], "result string, body string")
    found, bad = register.read_answers(raw, COLUMNS)
    got = {(r["result"], r["i"]): tuple(r)[2:] for r in found.collect()}
    assert bad.count() == 0
    assert got["a", 0] == ("DORA1", "eba", "17", "http://x", "Final", "DORA", "3(60)", "t", "EC", "2022-01-08", "", [])
    assert got["a", 1] == ("DORA2", "esma", "18", "http://x", "Rejected", "DORA", "3(60)", "t", "", "2022-01-09", "", [])
    assert got["a", 2] == ("DORA3", *got["a", 1][1:])
    assert got["b", 0] == ("X", *[""] * 10, [])


def test_a_repeat_in_the_first_row_and_text_in_a_column_of_words(spark):
    rows = [{"C": ["A", "eba as it stands"], "R": 0b11111111100}]
    found, _ = register.read_answers(spark.createDataFrame([(1, answer(rows))], "result int, body string"), COLUMNS)
    assert tuple(found.first())[2:4] == ("A", "eba as it stands")


def test_answers_that_cannot_be_read(spark):
    raw = [("json", "{"), ("null", None), ("shape", '{"results": []}'), ("rows", answer([])), ("desc", answer([{"C": [1]}], desc=None)), ("fine", answer([{"C": [], "Ø": 2047}]))]
    found, bad = register.read_answers(spark.createDataFrame(raw, "result string, body string"), COLUMNS)
    assert {r["result"]: r["error"] for r in bad.collect()} == {"json": "no JSON", "null": "no JSON", "shape": "no result set", "rows": "no descriptor", "desc": "no descriptor"}
    assert [r["result"] for r in found.collect()] == ["fine"]
    lost = spark.createDataFrame([("x", answer([{"C": ["A", 7], "Ø": 0b11111111100}]))], "result string, body string")
    with pytest.raises(PySparkException, match="no word 7"):
        register.read_answers(lost, COLUMNS)[0].collect()


def test_answers_stay_rows_and_are_shuffled_once(spark):
    """A row a cell, through two windows, a join and a pivot, took eleven rows and three shuffles for each row of an answer."""
    rows = [{"C": ["A", 1, 1e15, 19_000 * DAY, 1.5, "1", 0, "1.5E3", "", None, True]}, {"C": [-7, 0], "R": 0b11111111100}, {"C": [], "R": 0b01111111111, "Ø": 0b10000000000}, {"C": ["B"], "R": 0b11111111110}]
    raw = spark.createDataFrame([(k, answer(rows, words=WORDS | {"D0": [f"W{k}", f"V{k}"]})) for k in range(3)], "result int, body string")
    found, _ = register.read_answers(raw, COLUMNS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Window [") == 1 and "Join" not in plan and "Aggregate" not in plan
    first = lambda joint, said: (joint, said, "1000000000000000", "", "1", "DORA", "1.5E3", "")
    want = {(k, i): (*first(joint, f"{said}{k}"), by, "2022-01-08", "1.5") for k in range(3) for i, joint, said, by in ((0, "A", "v", "true"), (1, "-7", "w", "true"), (2, "-7", "w", ""), (3, "B", "w", ""))}
    assert {(r["result"], r["i"]): tuple(r)[2:-1] for r in found.collect()} == want


def test_a_number_without_a_word_is_an_error_in_a_column_that_is_not_read(spark):
    raw = spark.createDataFrame([("x", answer([{"C": ["A", 0, 7], "Ø": 0b111111111000}], desc=[*DESC, {"N": "G11", "DN": "D1"}])), ("y", answer([{"C": ["A", 7], "Ø": 0b011111111110}], desc=[*DESC, {"N": "G11", "DN": "D1"}]))], "result string, body string")
    with pytest.raises(PySparkException, match="no word 7"):
        register.read_answers(raw.where("result = 'y'"), [*COLUMNS, "Other"])[0].drop("result", "i").collect()


def test_what_is_asked_of_the_service(spark):
    asked = []

    def ask(url, body, headers):
        asked.append((url, json.loads(body) if body else None, headers))
        if "modelsAndExploration" in url:
            return '{"models": [{"id": 5, "dbName": "db"}], "exploration": {"report": {"objectId": "rep"}}}'
        if "conceptualschema" in url:
            return json.dumps({"schemas": [{"schema": {"Entities": [{"Name": "Days"}, {"Name": "Q&A", "Properties": [{"Name": c} for c in COLUMNS]}, {"Name": "Twin", "Properties": [{"Name": c} for c in COLUMNS]}]}}]})
        return answer([{"C": ["J"], "Ø": 2046}])

    model, body = register.ask_register("http://s", "k", ask)
    assert (model.number, model.data_set, model.report, model.table, list(model.columns)) == (5, "db", "rep", "Q&A", COLUMNS)
    assert [u for u, _, _ in asked] == ["http://s/public/reports/k/modelsAndExploration?preferReadOnlySession=true", "http://s/public/reports/conceptualschema", "http://s/public/reports/querydata?synchronous=true"]
    assert all(h == {"X-PowerBI-ResourceKey": "k"} for _, _, h in asked) and asked[1][1]["modelIds"] == asked[1][1]["models"] == [5]
    query = asked[2][1]["queries"][0]
    command = query["Query"]["Commands"][0]["SemanticQueryDataShapeCommand"]
    assert [s["Column"]["Property"] for s in command["Query"]["Select"]] == COLUMNS and command["Query"]["From"] == [{"Name": "t", "Entity": "Q&A", "Type": 0}]
    assert command["Binding"]["DataReduction"]["Primary"]["Window"]["Count"] == 30_000 and query["ApplicationContext"]["DatasetId"] == "db" and asked[2][1]["modelId"] == 5
    found, _ = register.read_answers(spark.createDataFrame([(1, body)], "result int, body string"), list(model.columns))
    assert found.first()["joint_id"] == "J"


def test_the_services_address_is_asked_with_its_policy():
    waits = []
    status, body, error = get("http://127.0.0.1:9/x", "{}", {}, Policy(tries=2, first_wait=1.0), waits.append)
    assert (status, body) == (None, None) and error and waits == [1.0, 2.0]
