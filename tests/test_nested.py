import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from flashmill.operators import nested

values = st.recursive(st.none() | st.booleans() | st.integers(-5, 5) | st.text('ab"\\{}[]:,é\n', max_size=5), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from(["events", "commodities", "summary", "dominant_types", "event_type", "x"]), c, max_size=4), max_leaves=12)


def rows(doc):
    return [r[1:5] for r in nested.extract([doc.encode()])]


def test_kinds_of_payload():
    e = {"events": [{"event_type": "a"}, None, {"direction": "up"}], "commodities": "gold", "summary": {"dominant_types": ["a", None, "b"]}}
    want = {(0, "event", 0, "a"), (0, "event", 2, ""), (0, "commodity", 0, "gold"), (0, "dominant_type", 0, "a"), (0, "dominant_type", 2, "b")}
    assert set(rows(json.dumps(e))) == want
    assert set(rows(json.dumps({"id": 1, "extraction": e, "events": [{"event_type": "no"}]}))) == want
    assert set(rows(json.dumps({"extraction": json.dumps(e)}))) == want
    two = rows(json.dumps({"items": [e, json.dumps(e)]}))
    assert set(two) == want | {(1, *w[1:]) for w in want}


def test_invalid_gives_nothing():
    for x in ["", " ", "null", "{", '{"events":[1}', '{"events":[{"event_type":"a"}]', '{"events":["a",]}', '{"commodities":["\\x"]}', "[1] 2", '{"commodities":["a"]} x', '{"a":01,"commodities":["a"]}', '{"commodities":["a\nb"]}']:
        assert rows(x) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(values, min_size=1, max_size=5), st.integers(0, 10**6))
def test_validity_is_that_of_json(vs, seed):
    rnd = random.Random(seed)
    docs = []
    for v in vs:
        s = list(json.dumps(v, ensure_ascii=rnd.random() < 0.5))
        if s and rnd.random() < 0.7:
            i = rnd.randrange(len(s))
            s[i : i + rnd.randint(0, 1)] = rnd.choice(['"', "{", "]", ",", ":", "\\", "1", ""])
        docs.append("".join(s))
    ix = nested.Index([d.encode() for d in docs])
    for d, ok in zip(docs, ix.ok):
        try:
            json.loads(d)
            want = True
        except ValueError:
            want = False
        assert bool(ok) == want, d


def test_table_with_clashing_names_and_nulls(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, '{"commodities":["gold"]}', "y")], "extraction_id long, payload string, child string")
    assert [tuple(r) for r in nested.flatten_extractions(df, "extraction_id", "payload").collect()] == [(2, 0, "commodity", 0, "gold")]
    assert nested.flatten_extractions(df.limit(0), "extraction_id", "payload").count() == 0
    assert nested.flatten_events(df, "extraction_id", "payload").count() == 0


def test_json_text_nested_deeply():
    x = json.dumps({"events": [{"event_type": "a"}]})
    for _ in range(18):
        x = json.dumps({"extraction": x})
    assert [r[:5] for r in nested.extract([x.encode()])] == [(0, 0, "event", 0, "a")]
