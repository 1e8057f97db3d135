import pytest

from quarryline.operators import rewrite

VALID = [
    '{"refined_query":"a","filters":{"p":"x"},"must_not":[]}',
    '{"refined_query":"a"}',
    '{"refined_query":"a","confidence":"0.5"}',
    '{"refined_query":"a","confidence":null}',
    ' {"refined_query":"a","confidence":1} \n',
]
INVALID = [
    '{"refined_query":"a","filters":{"p":["x","y"]}}',
    '{"refined_query":"a","filters":null}',
    '{"refined_query":"a","filters":["x"]}',
    '{"refined_query":"a","must_not":[1]}',
    '{"refined_query":"a","must_not":"x"}',
    '{"refined_query":"a","confidence":"high"}',
    '{"refined_query":"a","confidence":[1]}',
    '{"refined_query":5}',
    '{"filters":{}}',
    '{"refined_query":null}',
    '{"refined_query":"a"} tail',
    'prose {"refined_query":"a"}',
    "{'refined_query':'a'}",
    "",
    "null",
    '"a"',
    '{"refined_query":"a"},{"b":1}',
    '[{"refined_query":"a"}]',
    None,
]


def test_validation(spark):
    df = spark.createDataFrame([(t,) for t in VALID + INVALID], "raw string")
    found = {r["raw"]: r["valid"] for r in rewrite.validate_output(df).collect()}
    assert found == {**dict.fromkeys(VALID, True), **dict.fromkeys(INVALID, False)}


def test_parsed_fields(spark):
    raw = '{"refined_query":"a \\"b\\"","filters":{"p":"x"},"must_not":["y","z"],"confidence":"0.5"}'
    parsed = rewrite.validate_output(spark.createDataFrame([(raw,)], "raw string")).first()["parsed"]
    assert parsed.asDict() == {"refined_query": 'a "b"', "filters": {"p": "x"}, "must_not": ["y", "z"], "confidence": 0.5}


@pytest.mark.parametrize(
    "raw1, raw2, attempt, text",
    [(VALID[1], None, 1, "a"), ("no", VALID[1], 2, "a"), ("no", "no", 0, "old"), (None, None, 0, "old")],
)
def test_attempts(spark, raw1, raw2, attempt, text):
    df = spark.createDataFrame([("old", raw1, raw2)], "query_text string, raw1 string, raw2 string")
    chosen = rewrite.choose_attempt(df)
    assert chosen.first()["attempt"] == attempt
    assert rewrite.substitute(chosen).first()["query_text"] == text


def test_prompts_never_scan_inserted_text(spark):
    queries = spark.createDataFrame([("q", "{retrieved_chunks} {x}"), ("p", "plain"), ("e", "empty")], "query_id string, query_text string")
    context = spark.createDataFrame([("q", "{user_query} }}"), ("e", "")], "query_id string, context string")
    rows = rewrite.render_prompts(queries, "{{a}} {retrieved_chunks}|{user_query}", context).collect()
    found = {r["query_id"]: r["prompt"] for r in rows}
    assert found == {"q": "{a} {user_query} }}|{retrieved_chunks} {x}", "p": "{a} (none)|plain", "e": "{a} (none)|empty"}
    assert rows[0]["repair_prompt"].endswith(rows[0]["prompt"]) and rows[0]["repair_prompt"].startswith("Return ONLY valid JSON.")
    assert rewrite.render_prompts(queries, "{user_query}").where("query_id = 'p'").first()["prompt"] == "plain"
