import json
import random

from pyspark.sql import functions as F

from cartwheel.llm import queries
from cartwheel.llm.chat import call_steps, link_tool_calls

SCHEMAS = {"get": {"id": ("integer", True), "tags": ("array", False), "opt": ("object", False)}, "put": {"x": ("number", True), "on": ("boolean", True)}}
CALLS = "call_id string, position long, after_id string, tool string, arguments string, json string, n_calls long"
RESULTS = "call_id string, position long, content string, status string"


def link(spark, calls, results):
    calls = spark.createDataFrame([(*c, "x", 1) for c in calls], CALLS).repartition(3)
    results = spark.createDataFrame([(*r, "x") for r in results], RESULTS).repartition(3)
    return {r.call_id: r for r in link_tool_calls(calls, results, SCHEMAS).collect()}


def test_links_steps_and_statuses(spark):
    calls = [("a", 0, None, "get", '{"id": 1}'), ("b", 1, "a", "put", '{"on": true, "x": 1.5}'), ("c", 2, "b", "get", '{"id":2}'), ("d", 3, "gone", "get", '{"id":3}'), ("e", 4, "f", "get", '{"id":3}'), ("f", 5, "e", "get", '{"id":3}'), ("g", 6, "e", "get", '{"id":3}')]
    got = link(spark, calls, [("a", 9, "ra"), ("c", 9, None), ("z", 9, "rz")])
    assert {k: (r.status, r.step) for k, r in got.items()} == {"a": ("linked", 0), "b": ("pending", 1), "c": ("linked", 2), "d": ("pending", 0), "e": ("pending/cycle", None), "f": ("pending/cycle", None), "g": ("pending/cycle", None), "z": ("orphan", None)}
    assert got["z"].errors == [] and json.loads(got["z"].json)["result"] == "rz"


def test_arguments_against_schemas(spark):
    cases = {
        '{"id": 1, "tags": [], "opt": {}}': [],
        '{"id": "1"}': ["id: not of type integer"],
        '{"id": 1.5, "more": 1}': ["id: not of type integer", "more: not in the schema"],
        '{"id": null}': ["id: missing"],
        "{}": ["id: missing"],
        '{"id": 1, "tags": "x", "opt": []}': ["opt: not of type object", "tags: not of type array"],
        "[1]": ["arguments are no JSON object"],
        "{bad": ["arguments are no JSON object"],
        "": ["arguments are no JSON object"],
        None: ["arguments are no JSON object"],
    }
    calls = [(f"c{n}", n, None, "get", a) for n, a in enumerate(cases)] + [("u", 99, None, "none", "{}"), ("v", 99, None, None, "{}")]
    got = link(spark, calls, [])
    for n, want in enumerate(cases.values()):
        assert got[f"c{n}"].errors == want
    assert got["u"].errors == got["v"].errors == ["unknown tool"]


def test_json_is_canonical(spark):
    texts = ['{"tags":["é","\\n"], "id" : 1, "opt":{"b":2,"a":{"d":1,"c":null}}}', '{"opt":{"a":{"c":null,"d":1},"b":2},"id":1,"tags":["é","\\n"]}']
    got = link(spark, [(f"c{n}", 0, None, "get", t) for n, t in enumerate(texts)], [("c0", 1, 'say "hi"\n'), ("c1", 1, 'say "hi"\n')])
    one, two = (got[f"c{n}"].json.replace(f"c{n}", "c") for n in (0, 1))
    assert one == two
    assert one == json.dumps(json.loads(one), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_repeated_and_null_identifiers_and_empty_tables(spark):
    calls = [("a", 5, None, "get", '{"id":5}'), ("a", 2, None, "get", '{"id":2}'), ("a", 2, None, "get", '{"id":2}'), (None, 1, "a", "get", '{"id":1}'), (None, 2, "a", "get", '{"id":1}')]
    results = [("a", 7, "later"), ("a", 6, "first"), (None, 1, "x")]
    rows = link_tool_calls(spark.createDataFrame([(*c, "x", 1) for c in calls], CALLS), spark.createDataFrame([(*r, "x") for r in results], RESULTS), SCHEMAS).collect()
    a = next(r for r in rows if r.call_id == "a")
    assert (a.n_calls, a.n_results, a.status) == (3, 2, "linked")
    assert json.loads(a.json)["arguments"] == {"id": 2} and json.loads(a.json)["result"] == "first"
    assert sorted((r.status, r.n_calls, r.n_results) for r in rows if r.call_id is None) == [("orphan", 0, 1), ("pending", 2, 0)]
    assert link(spark, [], []) == {}
    assert {k: r.status for k, r in link(spark, [], [("a", 1, "x")]).items()} == {"a": "orphan"}


def test_a_long_chain_takes_few_rounds(spark):
    n = 500
    calls = spark.range(n).select(F.col("id").cast("string").alias("call_id"), F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("after_id"))
    assert {int(r.call_id): r.step for r in call_steps(calls).collect()} == {i: i for i in range(n)}


def test_a_very_long_text(spark):
    text = "word " * 400_000
    got = link(spark, [("a", 0, None, "get", json.dumps({"id": 1, "opt": {"t": text}}))], [("a", 1, text)])
    assert got["a"].errors == [] and json.loads(got["a"].json)["result"] == text


def test_every_row_of_a_repeated_identifier_comes_out(spark):
    calls = [("a", n % 7, None, "get", json.dumps({"id": n})) for n in range(300)] + [("b", 1, "a", "get", '{"id":-1}'), ("b", 2, "b", "get", '{"id":-2}'), ("b", 3, "gone", "get", '{"id":-3}')]
    results = [("a", n, f"r{n}") for n in range(200)] + [("b", n, f"s{n}") for n in range(5)]
    rows = link_tool_calls(spark.createDataFrame([(*c, "x", 1) for c in calls], CALLS).repartition(3), spark.createDataFrame([(*r, "x") for r in results], RESULTS).repartition(3), SCHEMAS).collect()
    parsed = [json.loads(r.json) for r in rows]
    assert sorted(p["arguments"]["id"] for p in parsed if p["arguments"]) == sorted(json.loads(c[4])["id"] for c in calls)
    assert sorted(p["result"] for p in parsed if p["result"]) == sorted(r[2] for r in results)
    ordered = {json.loads(c[4])["id"]: n for n, c in enumerate(sorted((c for c in calls if c[0] == "a"), key=lambda c: (c[1], c[4])))}
    for p in parsed:
        if p["call_id"] == "a":
            n = ordered[p["arguments"]["id"]]
            assert (p["result"], p["status"]) == ((f"r{n}", "linked") if n < 200 else (None, "pending"))
    assert {p["arguments"]["id"]: (p["step"], p["result"]) for p in parsed if p["call_id"] == "b" and p["arguments"]} == {-1: (1, "s0"), -2: (2, "s1"), -3: (0, "s2")}
    assert sorted(p["result"] for p in parsed if p["status"] == "orphan") == ["s3", "s4"]
    assert {(r.n_calls, r.n_results) for r in rows if r.call_id == "b"} == {(3, 5)}


def test_turns_without_a_conversation_or_number_stay_apart(spark):
    turns = [(None, 0, "user", "one"), (None, 0, "user", "other"), (None, 1, "assistant", "answer"), (1, None, "user", "x"), (2, 0, "user", "y"), (2, 1, "assistant", "z")]
    frame = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    calls, results, _ = queries.conversation_calls(frame)
    rows = link_tool_calls(calls, results, queries.TOOLS, each_null=True).collect()
    assert sorted((r.call_id or "", r.status, r.n_calls, r.n_results) for r in rows) == [("", "orphan", 0, 1)] + [("", "pending", 1, 0)] * 3 + [("2-0", "linked", 1, 1)]


def test_arguments_that_do_not_parse_keep_their_text(spark):
    texts = ['{"q": "lost text', '{"k": 1, "k": 2}', 'a "quoted"\n\\ é', "", None, '{"id": 1}']
    got = link(spark, [(f"c{n}", n, None, "get", a) for n, a in enumerate(texts)], [])
    assert [json.loads(got[f"c{n}"].json)["arguments"] for n in range(6)] == [*texts[:5], {"id": 1}]


def levels(nodes, edges):
    """Longest way to each node, by settling one node after the other; None in and behind cycles."""
    waits = {n: {a for c, a in edges if c == n and a in nodes} for n in nodes}
    found = {}
    while ready := [n for n in nodes if n not in found and all(a in found for a in waits[n])]:
        found |= {n: max((found[a] + 1 for a in waits[n]), default=0) for n in ready}
    return {n: found.get(n) for n in nodes}


def random_graph(seed):
    rng = random.Random(seed)
    nodes = [f"c{n}" for n in range(60)]
    chain = [(nodes[n], nodes[n - 1] if n % 11 and rng.random() < 0.8 else None) for n in range(60)]
    more = [(nodes[b], nodes[a]) for a, b in (sorted(rng.sample(range(60), 2)) for _ in range(25))]
    if seed % 2:
        more += [("c20", "c40"), ("c40", "c20"), ("c55", "c40"), ("c50", "c50")]
    return chain, more + [more[0], ("gone", "c1"), ("c1", "gone"), (None, "c2"), ("c2", None)]


def test_steps_of_a_graph_equal_its_levels(spark):
    for seed in (1, 2):
        chain, more = random_graph(seed)
        schema = "call_id string, after_id string"
        got = {r.call_id: r.step for r in call_steps(spark.createDataFrame(chain, schema), spark.createDataFrame(more, schema)).collect()}
        want = levels([c for c, _ in chain], set(chain + more))
        assert got == want and len(set(want.values())) > 5
        assert (None in want.values()) == bool(seed % 2)


def test_calls_that_wait_for_several_come_after_all_of_them(spark):
    chain, more = random_graph(1)
    calls = spark.createDataFrame([(c, n, a, "get", '{"id":1}', "x", 1) for n, (c, a) in enumerate(chain)] + [("c7", 99, "c9", "get", "{}", "x", 1)], CALLS)
    rows = link_tool_calls(calls, spark.createDataFrame([], RESULTS), SCHEMAS, dependencies=spark.createDataFrame(more, "call_id string, after_id string")).collect()
    want = levels([c for c, _ in chain], set(chain + more))
    first = {r.call_id: (r.step, r.status) for r in rows if r.call_id != "c7"}
    assert first == {c: (n, "pending/cycle" if n is None else "pending") for c, n in want.items() if c != "c7"}
    assert [r.step for r in link_tool_calls(calls, spark.createDataFrame([], RESULTS), SCHEMAS, dependencies=spark.createDataFrame([], "call_id string, after_id string")).filter("call_id = 'c1'").collect()] == [levels([c for c, _ in chain], chain)["c1"]]


def test_turns_of_other_roles_are_messages(spark):
    turns = [(1, 0, "system", "rules"), (1, 1, "user", "x"), (1, 2, "assistant", "y"), (None, 0, "system", None), (2, None, None, "odd"), (1, 1, "system", "x")]
    calls, results, messages = queries.conversation_calls(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    rows = link_tool_calls(calls, results, queries.TOOLS, each_null=True, messages=messages).collect()
    assert sorted((r.status, r.call_id or "", json.loads(r.json)["result"] or "") for r in rows) == [("linked", "1-1", "y"), ("message", "", ""), ("message", "", "odd"), ("message", "1-0", "rules"), ("message", "1-1", "x")]
    assert all((r.tool, r.step, r.n_calls, r.n_results, list(r.errors)) == (None, 0, 0, 0, []) for r in rows if r.status == "message")
