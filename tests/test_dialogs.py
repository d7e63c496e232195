"""Canonical messages, adapters, parsers, checks and rendering, on small literals."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lodeweave import schema as S
from lodeweave.functions import messages as M
from lodeweave.functions import parsing as P
from lodeweave.operators import generation as G
from lodeweave.operators import verification as V
from lodeweave.sources import adapters as A
from lodeweave.sources import sinks as K


def msg(role, text=None, calls=None, call_id=None, parts=None):
    parts = parts if parts is not None else [("text", text, None)]
    return (role, parts, [(i, "function", n, a) for i, n, a in calls] if calls else None, call_id, False)


def dialogs(spark, *rows):
    full = [(f"r{k}", "coding", "prebuilt", ("s", None, k, None), m, tools, [], 5, None, "{}", k) for k, (m, tools) in enumerate(rows)]
    return spark.createDataFrame(full, S.CANONICAL)


def one(spark, column, messages, tools=None):
    return dialogs(spark, (messages, tools)).select(column.alias("x")).first()[0]


TOOL = json.dumps({"type": "function", "function": {"name": "get", "parameters": {"type": "dict"}}})
GOOD = [msg("user", "weather?"), msg("assistant", "", [("c1", "get", '{"city": "Paris", "n": 2, "deep": {"a": [1]}, "on": true}')]), msg("tool", "sunny", call_id="c1"), msg("assistant", "It is sunny there today.")]


def test_strip_to_prompt(spark):
    strip = lambda m: [(x.role, x.parts[0].text) for x in one(spark, M.strip_to_prompt(F.col("messages")), m) or []]
    assert strip([msg("user", "q"), msg("assistant", "a")]) == [("user", "q")]
    assert strip([msg("system", "s"), msg("user", "Hi!"), msg("assistant", "hello"), msg("user", "Hey."), msg("user", "q"), msg("assistant", "a")]) == [("system", "s"), ("user", "q")]
    assert strip([msg("user", "hi"), msg("assistant", "a")]) == [("user", "hi")]
    assert strip([msg("assistant", "a"), msg("user", "q")]) == []
    assert strip([msg("system", "s"), msg("system", "t"), msg("user", "q")]) == []
    picture = msg("user", parts=[("text", "hi", None), ("image", None, "ab")])
    assert len(one(spark, M.strip_to_prompt(F.col("messages")), [picture, msg("user", "q")])[0].parts) == 2


def test_texts(spark):
    m = [msg("user", parts=[("text", "a", None), ("text", "b", None), ("image", None, "s1")]), msg("assistant", "x  y"), msg("user", "c"), msg("assistant", "z")]
    assert one(spark, M.prompt_text(F.col("messages")), m) == "a b"
    assert one(spark, M.user_text(F.col("messages")), m) == "abc"
    assert one(spark, M.final_assistant_text(F.col("messages")), m) == "z"
    assert one(spark, M.all_assistant_text(F.col("messages")), m) == "x y z"
    assert one(spark, M.image_shas(F.col("messages")), m) == ["s1"]
    assert one(spark, M.last_index(F.col("messages"), "user"), m) == 2
    assert one(spark, F.size(M.tool_run(F.col("messages"), F.lit(1))), GOOD) == 1


def test_truncated(spark):
    long = [msg("user", "q"), msg("assistant", "a")] * 9 + [msg("user", "q")]
    assert one(spark, F.size(M.truncated(F.col("messages"))), long) == 16
    assert one(spark, F.size(M.truncated(F.col("messages"))), [msg("user", "q")]) == 0


def test_validation(spark):
    assert one(spark, M.validate_trajectory(), GOOD, [TOOL]) == []
    bad = [msg("user", "q"), msg("assistant", "", [("c1", "get", "{bad"), ("", "get", "{}")]), msg("tool", "r", call_id="c9"), msg("tool", "r"), msg("boss", "x")]
    assert one(spark, M.validate_trajectory(), bad, [TOOL]) == [
        "bad role: 'boss'", "last message is not assistant", "tool_call arguments are not JSON at message 1", "bad tool_call at message 1",
        "tool result 'c9' has no preceding call", "tool message without tool_call_id at message 3", "call 'c1' at message 1 has no tool result",
    ]
    assert one(spark, M.validate_prompt(), [msg("user", "q")]) == []
    assert one(spark, M.validate_prompt(), GOOD) == ["last message is not user", "prebuilt assistant turn was not stripped"]
    assert one(spark, M.validate_example(), [msg("user", "q"), msg("system", "s"), msg("assistant", parts=[("image", None, "zz"), ("sound", None, None)])]) == [
        "system message is not first", "image part 'zz' has no ImageRef", "bad part type: 'sound'",
    ]
    assert one(spark, M.validate_example(), []) == ["no messages"]


def test_turn_checks(spark):
    check = M.check_turns(F.col("messages"), F.col("tools"))
    assert one(spark, check, GOOD, [TOOL]) == []
    bad = [msg("user", "q"), msg("assistant", "<think>x</think>"), msg("assistant", "", [("c1", "put", "{}")]), msg("tool", "Error: no", call_id="c1"), msg("tool", "x", call_id="c2"), msg("assistant", "a", [("c3", "get", "{}")])]
    assert one(spark, check, bad, [TOOL]) == ["empty assistant turn at 1", "undeclared tool 'put' at 2", "error-laden tool result at 3", "tool result without a preceding call at 4", "call 'c3' at 5 has no tool result"]


def test_rendering(spark):
    shown = one(spark, M.rendered(F.col("messages"), F.col("tools")), [msg("system", " be brief "), *GOOD], [TOOL])
    assert shown.startswith("<|im_start|>system\n# Tools\n\nYou have access to the following functions:\n\n<tools>\n" + TOOL + "\n</tools>") and "</IMPORTANT>\n\nbe brief<|im_end|>\n" in shown
    assert (
        "<|im_start|>user\nweather?<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\n<tool_call>\n<function=get>\n<parameter=city>\nParis\n</parameter>\n<parameter=n>\n2\n</parameter>\n"
        "<parameter=deep>\n{\"a\":[1]}\n</parameter>\n<parameter=on>\nTrue\n</parameter>\n</function>\n</tool_call><|im_end|>\n<|im_start|>user\n<tool_response>\nsunny\n</tool_response><|im_end|>\n"
    ) in shown
    old = [msg("user", "a"), msg("assistant", "<think>\nhidden\n</think>\n\nold"), msg("user", "b"), msg("assistant", "<think>\nseen\n</think>\n\nnew")]
    assert one(spark, M.rendered(F.col("messages"), None, True), old) == (
        "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nold<|im_end|>\n<|im_start|>user\nb<|im_end|>\n<|im_start|>assistant\n<think>\nseen\n</think>\n\nnew<|im_end|>\n<|im_start|>assistant\n<think>\n"
    )
    assert one(spark, M.rendered(F.col("messages")), [msg("assistant", "x")]) is None
    assert one(spark, M.render_problems(F.col("messages"), F.col("tools")), GOOD, [TOOL]) == []
    assert one(spark, M.packed_text(F.col("messages")), [msg("assistant", "x  y")]) == "x y"


def test_response_reasons(spark):
    assert one(spark, M.example_reject_reason(F.col("messages"), F.lit(99)), GOOD) is None
    assert one(spark, M.example_reject_reason(F.col("messages"), F.lit(9)), GOOD) == "too_short"
    assert one(spark, M.trajectory_reject_reason(F.col("messages")), [msg("user", "q"), msg("assistant", "short")]) == "turn 1: too_short"


def rows(spark, schema, *values):
    return spark.createDataFrame([(*v, k) for k, v in enumerate(values, 1)], schema + ", _seq bigint")


CTX = A.Context("org/set", None, "coding", "mit")


def test_pair_adapters(spark):
    math = rows(spark, "problem string, solution string, problem_is_valid string, solution_is_valid string, problem_type string, synthetic boolean", ("p ", "\\boxed{1} then \\boxed{2}", "Yes", "Yes", "algebra", False), ("p", "s", "No", "Yes", None, None), ("", "s", "Yes", "Yes", None, None))
    got = A.adapter("numina")(math, CTX).collect()
    assert [(r.id, r.verify.gold, r.messages[0].parts[0].text, json.loads(r.meta)["problem_type"]) for r in got] == [("numina-1", "2", "p", "algebra")]
    school = rows(spark, "question string, answer string", ("q", "x\n#### 7"), ("q", "none"), (None, "x"))
    assert [(r.id, r.verify and r.verify.gold) for r in A.adapter("gsm8k")(school, CTX).collect()] == [("gsm8k-1", "7"), ("gsm8k-2", None)]
    code = rows(spark, "query string, answer string, lang string, resource string", ("q", "a", "py", "r"), ("q", None, None, None))
    assert [r.id for r in A.adapter("codefeedback")(code, CTX).collect()] == ["codefeedback-1"]
    with pytest.raises(KeyError):
        A.adapter("other")


def test_dialog_adapters(spark):
    turns = "array<struct<`from`: string, value: string>>"
    ok, open_end = [("human", "Hello<|im_end|>"), ("gpt", "Hi.")], [("human", "hi")]
    share = rows(spark, f"category string, system_prompt string, conversations {turns}", ("roleplay", " Ada ", ok), ("coding", None, ok), ("roleplay", None, open_end), ("roleplay", None, [("ghost", "x"), ("gpt", "y")]))
    got = A.adapter("sharegpt_openhermes")(share, CTX).collect()
    assert [(r.id, [(m.role, m.parts[0].text) for m in r.messages]) for r in got] == [("openhermes-roleplay-1", [("system", "Ada"), ("user", "Hello"), ("assistant", "Hi.")])]
    calls = rows(spark, f"conversations {turns}, tools string, category string, task string", (ok, f"[{TOOL}]", "c", "t"), (ok, "not-a-list", "c", "t"), (ok, " ", "c", "t"), (ok, '[{"function": {}}]', "c", "t"), (ok, "[]", "c", "t"))
    assert [(r.id, r.tools and len(r.tools)) for r in A.adapter("toolcalls")(calls, CTX).collect()] == [("hermesfc-1", 1), ("hermesfc-3", None), ("hermesfc-5", None)]
    chat = rows(spark, "messages array<struct<role: string, content: string>>, quality string, reward_model_score double", ([("user", "q"), ("assistant", "a")], "good", 0.2), ([("user", "q"), ("assistant", "a")], "poor", 0.9), ([("user", "q")], "good", 0.9), ([("user", "q"), ("assistant", "a")], "good", 0.1))
    assert [r.id for r in A.adapter("smoltalk")(chat, A.Context("s", "smol-magpie-ultra", "roleplay")).collect()] == ["smoltalk-smol-magpie-ultra-1"]


def test_image_adapter_and_store(spark):
    png = b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + (32).to_bytes(4, "big") + (16).to_bytes(4, "big")
    data = rows(spark, "images array<struct<bytes: binary>>, texts array<struct<user: string, assistant: string>>", ([(bytearray(png),)], [("see", "it")]), ([(None,)], [("see", "it")]), ([], [("", "x")]))
    got = A.adapter("cauldron")(data, A.Context("c", "chart2text", "reasoning")).collect()
    assert [(r.id, [p.type for p in r.messages[0].parts], len(r.images)) for r in got] == [("cauldron-chart2text-1", ["text", "image"], 1)]
    assert A.image_rows(data, A.Context("c", "chartqa", "reasoning")).count() == 0
    assert A.image_rows(data, A.Context("c", "chartqa", "x"), holdout=True).first().domain == "reasoning"
    store = K.image_store(spark.createDataFrame([(bytearray(png),), (bytearray(png),)], "content binary"))
    (row,) = store.collect()
    assert (row.path, row.w, row.h) == (f"{row.sha256[:2]}/{row.sha256}.png", 32, 16)
    assert K.unresolved_images(spark.createDataFrame([([row.sha256, "no"],)], "shas array<string>"), store, "shas").count() == 1


def test_seed_adapters(spark):
    tests = rows(spark, "task_id int, prompt string, code string, test_imports array<string>, test_list array<string>", (3, "Do it", "def f(a):\n  return a", ["import math"], ["assert f(1) == 1"]), (4, "Do", "x", [], []))
    (r,) = A.unit_test_rows(tests, CTX).collect()
    assert r.id == "mbpp-3" and r.verify.name == "f" and r.messages[0].parts[0].text.endswith("`def f(a):`")
    io = rows(spark, "problem_id int, question string, input_output string", (1, "q", json.dumps({"inputs": ["1", 2, "3"], "outputs": ["a", "b", "c", "d"]})), (2, "q", "{"), (3, "q", json.dumps({"inputs": [1], "outputs": ["x"]})))
    (r,) = A.stdin_rows(io, CTX).collect()
    assert r.id == "apps-1" and r.verify.pairs == [["1", "a"], ["3", "c"]]
    (r,) = A.seed_rows(rows(spark, "id string, source string, config string, text string", ("s1", "n", None, "t"))).collect()
    assert r.source.name == "n" and r.messages[0].role == "user"


def test_tagged_dialogs(spark):
    turns = "array<struct<`from`: string, value: string>>"
    call = '<tool_call>\n{"name": "get", "arguments": {"a": 1}}\n</tool_call>'
    good = [("system", "Use. <tools>[]</tools>"), ("human", "q"), ("gpt", f"Let me see.\n{call}\n{call}"), ("tool", "<tool_response>\nr1\n</tool_response>"), ("tool", "r2"), ("gpt", "done")]
    data = rows(spark, f"conversations {turns}, tools string, category string, task string", (good, f"[{TOOL}]", "c", "t"), (good, '[{"function": {"name": "put"}}]', "c", "t"), ([("human", "q"), ("tool", "r"), ("gpt", "a")], None, "c", "t"), ([("human", "q"), ("gpt", "<tool_call>{</tool_call>")], None, "c", "t"))
    (r,) = A.tagged_dialogs(data, CTX).collect()
    assert [m.role for m in r.messages] == ["system", "user", "assistant", "tool", "tool", "assistant"]
    assert r.messages[0].parts[0].text == "Use." and r.messages[2].parts[0].text == "Let me see." and r.messages[2].scaffold
    assert [(c.id, c.name, c.arguments) for c in r.messages[2].tool_calls] == [("call_0", "get", '{"a": 1}'), ("call_1", "get", '{"a": 1}')]
    assert [(m.parts[0].text, m.tool_call_id) for m in r.messages[3:5]] == [("r1", "call_0"), ("r2", "call_1")]


def test_notation_dialogs(spark):
    turns = "array<struct<`from`: string, value: string>>"
    system = 'You are apt. Here: [{"name": "User Feed (V2)", "parameters": {"type": "dict", "properties": {"k": {"type": "list"}}}}] and [more]'
    good = [("user", "q"), ("assistant", '[User Feed (V2)(a="x, y", n=3), Other(b=True)]'), ("tool", "r1"), ("tool", "r2"), ("assistant", "done")]
    (r,) = A.notation_dialogs(rows(spark, f"system string, conversations {turns}", (system, good), (system, [("user", "q"), ("tool", "r"), ("assistant", "a")])), CTX).collect()
    assert [m.role for m in r.messages] == ["system", "user", "assistant", "tool", "tool", "assistant"] and r.messages[0].parts[0].text == "You are apt. Here:"
    assert [(c.name, json.loads(c.arguments)) for c in r.messages[2].tool_calls] == [("User Feed (V2)", {"a": "x, y", "n": 3}), ("Other", {"b": "True"})]
    schema = json.loads(r.tools[0])["function"]["parameters"]
    assert schema["type"] == "object" and schema["properties"]["k"] == {"type": "array", "items": {}}
    assert P.notation_calls("[broken(") is None and P.notation_calls("text") is None


def test_chat_dialogs(spark):
    data = rows(spark, "messages array<struct<role: string, content: string>>", ([("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")],), ([("user", "a"), ("assistant", "b")],))
    (r,) = A.chat_dialogs(data, CTX).collect()
    assert r.id == "chat-set-default-1" and [m.parts[0].text for m in r.messages] == ["a", "", "c", ""] and r.messages[1].scaffold


def test_repair(spark):
    bad = json.dumps({"type": "function", "function": {"name": "f", "parameters": {"type": "dict", "properties": {"x": {"type": "list"}, "y": {"type": "string"}}}}})
    fixed = K.repair_tools(dialogs(spark, (GOOD, [bad]), (GOOD, None)))
    got = {r.id: r for r in fixed.collect()}
    assert got["r0"].fixed and not got["r1"].fixed
    assert json.loads(got["r0"].tools[0])["function"]["parameters"] == {"type": "object", "properties": {"x": {"type": "array", "items": {}}, "y": {"type": "string"}}}
    assert {r["type"]: r.n for r in K.alias_counts(dialogs(spark, (GOOD, [bad]))).collect()} == {"dict": 1, "list": 1}


def test_code_checks(spark):
    spec = "struct<type: string, setup: string, tests: array<string>, name: string, pairs: array<array<string>>, gold: string>"
    block = "```python\n{}\n```"
    data = [
        (1, ("python_tests", "", ["assert f(2) == 4"], "f", None, None), block.format("def f(x):\n    return 2 * x")), (2, ("python_tests", "", ["assert f(2) == 5"], "f", None, None), block.format("def f(x):\n    return 2 * x")),
        (3, ("python_io", None, None, None, [["3", "6"]], None), block.format("print(2 * int(input()))")), (4, ("answer_match", None, None, None, None, "6"), "so 6"), (5, None, "x"), (6, ("odd", None, None, None, None, None), "x"),
    ]
    df = spark.createDataFrame(data, f"i int, verify {spec}, c string")
    got = {r.i: r.v for r in df.select("i", V.check_record(F.col("verify"), F.col("c"), run_code=True).alias("v")).collect()}
    assert [got[i].passed for i in range(1, 7)] == [True, False, True, True, True, False]
    assert "AssertionError" in got[2].why and got[6].why == "unknown verify type 'odd'"
    assert not {r.i: r.v for r in df.select("i", V.check_record(F.col("verify"), F.col("c")).alias("v")).collect()}[1].passed


def test_generation(spark):
    prompts = dialogs(spark, ([msg("user", "what is 2+2?")], None), ([msg("user", "say more")], None))
    prompts = prompts.withColumn("verify", F.when(F.col("id") == "r0", A.verify("answer_match", gold=F.lit("4"))))
    none = spark.createDataFrame([], f"key string, completion {G.COMPLETION}")
    got, new = G.run_pool(prompts, none, G.Echo({"what is 2+2?": "Two and two make the number four, which is written as 4"}))
    rows_ = {r.id: r for r in got.collect()}
    assert rows_["r0"].reason is None or rows_["r0"].reason == "too_short"
    assert rows_["r1"].reason == "too_short" and rows_["r1"].messages[-1].role == "assistant" and new.count() == 2
    again, more = G.run_pool(prompts, new, None)
    assert more.count() == 0 and {r.id: r.reason for r in again.collect()} == {r.id: r.reason for r in rows_.values()}
    assert {r.reason for r in G.run_pool(prompts, none, None)[0].collect()} == {"teacher_error"}
    assert G.run_pool(prompts, none, None, limit=0)[0].count() == 0
    assert G.rollouts(prompts, 3).select("key").distinct().count() == 3
    assert {r.reason for r in G.rejects(again, "seeded").collect()} == {r.reason for r in rows_.values() if r.reason}


class Caller:
    """Calls once, then answers."""

    def __call__(self, messages, tools, seed):
        if tools and not any(m["role"] == "tool" for m in messages):
            return {"content": "", "tool_calls": [{"id": "x", "name": "get", "arguments": "{}"}, {"id": "y", "name": "get", "arguments": "{}"}]}
        return {"content": "a final answer in words", "tool_calls": []}


def test_trajectories(spark):
    (r,) = G.regenerate(dialogs(spark, (GOOD, [TOOL])), Caller()).collect()
    assert [m.role for m in r.messages] == ["user", "assistant", "tool", "assistant"] and [c.id for c in r.messages[1].tool_calls] == ["r0-call-0"] and r.messages[2].tool_call_id == "r0-call-0"
    assert G.regenerate(dialogs(spark, ([msg("user", "q"), msg("assistant", "a")], [TOOL])), Caller()).count() == 0
    seeds = spark.createDataFrame([("s", "coding", "q", [TOOL]), ("t", "coding", " ", [TOOL])], "id string, domain string, first_user string, tools array<string>")
    (r,) = G.simulate(seeds, Caller()).collect()
    assert [m.role for m in r.messages] == ["user", "assistant", "tool", "tool", "assistant"]
    assert G.tool_seeds(dialogs(spark, (GOOD, [TOOL]), (GOOD, None))).count() == 1
