"""Column functions on canonical messages: texts, prompts, cuts, problem lists and rendering, as array expressions within a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave import schema as S
from lodeweave.functions import text as T



def text_part(x: Column) -> Column:
    return F.struct(F.lit("text").alias("type"), x.alias("text"), F.lit(None).cast("string").alias("sha256"))


def image_part(sha: Column) -> Column:
    return F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"), sha.alias("sha256"))


def message(role, parts: Column, calls: Column | None = None, call_id: Column | None = None, scaffold: bool = False) -> Column:
    return F.struct(
        (F.lit(role) if isinstance(role, str) else role).alias("role"), parts.alias("parts"),
        (F.lit(None).cast(f"array<{S.CALL}>") if calls is None else calls).alias("tool_calls"),
        (F.lit(None).cast("string") if call_id is None else call_id).alias("tool_call_id"), F.lit(scaffold).alias("scaffold"),
    )


def text_message(role, x: Column) -> Column:
    return message(role, F.array(text_part(x)))


def message_text(m: Column, joined: str = "") -> Column:
    texts = F.filter(F.coalesce(m["parts"], F.array()), lambda p: p["type"] == "text")
    return F.array_join(F.transform(texts, lambda p: F.coalesce(p["text"], F.lit(""))), joined)


def by_role(messages: Column, role: str) -> Column:
    return F.filter(messages, lambda m: m["role"] == role)


def first_of(messages: Column, role: str) -> Column:
    return F.try_element_at(by_role(messages, role), F.lit(1))


def last_of(messages: Column, role: str) -> Column:
    return F.try_element_at(by_role(messages, role), F.lit(-1))


def prompt_text(messages: Column) -> Column:
    """Of the first user turn, its parts joined by a space."""
    return F.coalesce(message_text(first_of(messages, "user"), " "), F.lit(""))


def user_text(messages: Column) -> Column:
    """Of all user turns, with nothing between."""
    return F.array_join(F.transform(by_role(messages, "user"), lambda m: message_text(m)), "")


def final_assistant_text(messages: Column) -> Column:
    return F.coalesce(message_text(last_of(messages, "assistant")), F.lit(""))


def all_assistant_text(messages: Column) -> Column:
    return F.array_join(F.transform(by_role(messages, "assistant"), lambda m: T.strip(F.regexp_replace(message_text(m), r"(?U)\s+", " "))), " ")


def image_shas(messages: Column) -> Column:
    return F.flatten(F.transform(messages, lambda m: F.transform(F.filter(F.coalesce(m["parts"], F.array()), lambda p: (p["type"] == "image") & p["sha256"].isNotNull()), lambda p: p["sha256"])))


def tool_calls_in(messages: Column) -> Column:
    return F.flatten(F.transform(by_role(messages, "assistant"), lambda m: F.coalesce(m["tool_calls"], F.array())))


def declared_tools(tools: Column) -> Column:
    names = F.transform(F.coalesce(tools, F.array().cast("array<string>")), lambda t: F.get_json_object(t, "$.function.name"))
    return F.array_distinct(F.filter(names, lambda n: n.isNotNull()))


def response_text(m: Column) -> Column:
    """An assistant turn's text, or its calls as JSON where it has no text."""
    calls = F.coalesce(m["tool_calls"], F.array())
    return F.when(T.is_blank(message_text(m)) & (F.size(calls) > 0), F.to_json(calls)).otherwise(message_text(m))


def example_reject_reason(messages: Column, tokens: Column) -> Column:
    last = last_of(messages, "assistant")
    return F.when(last.isNull(), "empty_assistant").otherwise(T.response_reject_reason(response_text(last), tokens))


def trajectory_reject_reason(messages: Column) -> Column:
    """'turn i: reason' of the first assistant turn that fails."""
    def judged(m: Column, i: Column) -> Column:
        x = response_text(m)
        reason = T.response_reject_reason(x, T.count_tokens(x), S.TURN_TOKENS)
        return F.when(m["role"] == "assistant", F.concat(F.lit("turn "), i.cast("string"), F.lit(": "), reason))

    return F.try_element_at(F.filter(F.transform(messages, judged), lambda x: x.isNotNull()), F.lit(1))


def strip_to_prompt(messages: Column) -> Column:
    """A leading system turn and the first user turn, behind greetings that a later user turn follows; null if there is no such turn."""
    n = F.size(messages)
    at = lambda i: F.try_element_at(messages, i + 1)
    start = F.struct(F.lit(0).alias("p"), F.lit(None).cast("int").alias("s"))

    def step(state: Column, _: Column) -> Column:
        heads = state["s"].isNull() & (at(state["p"])["role"] == "system")
        p = F.when(heads, state["p"] + 1).otherwise(state["p"])
        s = F.when(heads, state["p"]).otherwise(state["s"])
        m = at(p)
        only_text = ~F.exists(F.coalesce(m["parts"], F.array()), lambda x: x["type"] != "text") & m["parts"].isNotNull()
        later = F.exists(F.slice(messages, p + 2, F.greatest(n - p - 1, F.lit(0))), lambda x: x["role"] == "user")
        greets = F.coalesce((m["role"] == "user") & only_text & T.is_greeting(message_text(m)) & later, F.lit(False))
        q = F.when(greets, p + 1 + F.when(at(p + 1)["role"] == "assistant", 1).otherwise(0)).otherwise(p)
        return F.struct(q.cast("int").alias("p"), s.cast("int").alias("s"))

    state = F.aggregate(F.sequence(F.lit(0), n), start, step)
    first = at(state["p"])
    return F.when((n > 0) & (first["role"] == "user"), F.concat(F.when(state["s"].isNotNull(), F.array(at(state["s"]))).otherwise(F.slice(messages, 1, 0)), F.array(first)))


def truncated(messages: Column, users: int = S.MAX_TURNS, tools: int = S.MAX_TURNS) -> Column:
    """Up to the first turn beyond a bound, then back to an assistant turn."""
    start = F.struct(F.lit(0).alias("u"), F.lit(0).alias("t"), F.lit(0).alias("n"), F.lit(0).alias("last"), F.lit(False).alias("over"))

    def step(s: Column, m: Column) -> Column:
        u = s["u"] + F.when(m["role"] == "user", 1).otherwise(0)
        t = s["t"] + F.when(m["role"] == "tool", 1).otherwise(0)
        over = s["over"] | (u > users) | (t > tools)
        last = F.when(~over & (m["role"] == "assistant"), s["n"] + 1).otherwise(s["last"])
        return F.struct(u.alias("u"), t.alias("t"), (s["n"] + 1).alias("n"), last.alias("last"), over.alias("over"))

    return F.slice(messages, 1, F.aggregate(messages, start, step)["last"])


def tool_run(messages: Column, i: Column) -> Column:
    """The tool turns that follow turn i (from 0) without a gap."""
    rest = F.slice(messages, i + 2, F.greatest(F.size(messages) - i - 1, F.lit(0)))
    other = F.filter(F.transform(rest, lambda m, k: F.when(m["role"] != "tool", k)), lambda k: k.isNotNull())
    return F.slice(rest, 1, F.coalesce(F.try_element_at(other, F.lit(1)), F.size(rest)))


def last_index(messages: Column, role: str) -> Column:
    """From 0; -1 if there is none."""
    return F.coalesce(F.array_max(F.filter(F.transform(messages, lambda m, i: F.when(m["role"] == role, i)), lambda i: i.isNotNull())), F.lit(-1))


def expected_think_blocks(messages: Column) -> Column:
    last = last_index(messages, "user")
    return F.size(F.filter(F.transform(messages, lambda m, i: (m["role"] == "assistant") & (i > last)), lambda x: x))


def _said(x: Column) -> Column:
    return F.coalesce(F.concat(F.lit("'"), x, F.lit("'")), F.lit("None"))


def _problems(*items: Column) -> Column:
    return F.array_compact(F.array(*items))


def _shared_problems(row) -> tuple[Column, Column]:
    """What all kinds of rows are checked for: before and behind the role checks."""
    c = lambda k: row(k)
    head = _problems(
        F.when(F.coalesce(c("id"), F.lit("")) == "", F.lit("empty id")),
        F.when(~F.coalesce(c("domain").isin(*S.DOMAINS), F.lit(False)), F.concat(F.lit("bad domain: "), _said(c("domain")))),
        F.when(~F.coalesce(c("origin").isin(*S.ORIGINS), F.lit(False)), F.concat(F.lit("bad origin: "), _said(c("origin")))),
        F.when(c("source").isNull() | c("source")["name"].isNull(), F.lit("source missing name")),
    )
    refs = F.transform(F.coalesce(c("images"), F.array().cast(f"array<{S.IMAGE}>")), lambda i: i["sha256"])
    parts = F.flatten(F.transform(c("messages"), lambda m: F.when(m["parts"].isNull(), F.array(F.lit("content is neither str nor list"))).otherwise(F.flatten(F.transform(m["parts"], lambda p: _problems(
        F.when(~F.coalesce(p["type"].isin(*S.PART_TYPES), F.lit(False)), F.concat(F.lit("bad part type: "), _said(p["type"]))),
        F.when((p["type"] == "image") & ~F.coalesce(F.array_contains(refs, p["sha256"]), F.lit(False)), F.concat(F.lit("image part "), _said(p["sha256"]), F.lit(" has no ImageRef"))),
    ))))))
    tail = F.concat(parts, _problems(F.when(c("tokens") < 0, F.lit("negative token count"))))
    return head, tail


def _role_problems(messages: Column, last: str) -> Column:
    roles = F.transform(messages, lambda m: m["role"])
    bad = F.transform(F.filter(roles, lambda r: ~F.coalesce(r.isin(*S.ROLES), F.lit(False))), lambda r: F.concat(F.lit("bad role: "), _said(r)))
    return F.concat(bad, _problems(
        F.when(~F.coalesce(F.element_at(roles, -1) == last, F.lit(False)), F.lit(f"last message is not {last}")),
        F.when(F.array_contains(roles, "system") & (F.element_at(roles, 1) != "system"), F.lit("system message is not first")),
    ))


def _listed(head: Column, messages: Column, *rest: Column) -> Column:
    empty = F.coalesce(F.size(messages), F.lit(0)) <= 0
    return F.when(empty, F.concat(head, F.array(F.lit("no messages")))).otherwise(F.concat(head, *rest))


def validate_example(row=F.col) -> Column:
    head, tail = _shared_problems(row)
    return _listed(head, row("messages"), _role_problems(row("messages"), "assistant"), tail)


def validate_prompt(row=F.col) -> Column:
    head, tail = _shared_problems(row)
    stripped = _problems(F.when(F.exists(row("messages"), lambda m: m["role"] == "assistant"), F.lit("prebuilt assistant turn was not stripped")))
    return _listed(head, row("messages"), _role_problems(row("messages"), "user"), stripped, tail)


def _bad_json(x: Column) -> Column:
    return x.isNotNull() & F.try_parse_json(x).isNull()


def _calls(messages: Column, typed: bool) -> Column:
    """(id, i) of each call that can be answered."""
    sound = lambda c: (F.coalesce(c["id"], F.lit("")) != "") & ((F.coalesce(c["type"], F.lit("")) == "function") if typed else F.lit(True))
    return F.flatten(F.transform(messages, lambda m, i: F.when(m["role"] == "assistant", F.transform(F.filter(F.coalesce(m["tool_calls"], F.array()), sound), lambda c: F.struct(c["id"].alias("id"), i.alias("i")))).otherwise(F.array().cast("array<struct<id: string, i: int>>"))))


def _unanswered(messages: Column, calls: Column, at: str) -> Column:
    """One problem for each call without a result, by its first place."""
    answers = F.filter(F.transform(messages, lambda m, j: F.struct(F.when(m["role"] == "tool", m["tool_call_id"]).alias("id"), j.alias("i"))), lambda r: r["id"].isNotNull())
    ids = F.array_distinct(F.transform(calls, lambda c: c["id"]))
    left = F.filter(ids, lambda k: ~F.exists(answers, lambda r: (r["id"] == k) & F.exists(calls, lambda c: (c["id"] == k) & (c["i"] < r["i"]))))
    place = lambda k: F.array_max(F.transform(F.filter(calls, lambda c: c["id"] == k), lambda c: c["i"])).cast("string")
    return F.transform(left, lambda k: F.concat(F.lit("call "), _said(k), F.lit(f" at {at}"), place(k), F.lit(" has no tool result")))


def _preceded(calls: Column, m: Column, i: Column) -> Column:
    return F.exists(calls, lambda c: (c["id"] == m["tool_call_id"]) & (c["i"] < i))


def validate_trajectory(row=F.col) -> Column:
    messages = row("messages")
    head, tail = _shared_problems(row)
    calls = _calls(messages, True)
    at = lambda what, i: F.concat(F.lit(what + " at message "), i.cast("string"))

    def of_call(c: Column, i: Column) -> Column:
        unsound = (F.coalesce(c["id"], F.lit("")) == "") | (F.coalesce(c["type"], F.lit("")) != "function")
        return F.when(unsound, F.array(at("bad tool_call", i))).otherwise(_problems(F.when(c["name"].isNull(), at("tool_call without function name", i)), F.when(_bad_json(c["arguments"]), at("tool_call arguments are not JSON", i))))

    def of_message(m: Column, i: Column) -> Column:
        no_id = F.coalesce(m["tool_call_id"], F.lit("")) == ""
        return F.when(m["role"] == "assistant", F.flatten(F.transform(F.coalesce(m["tool_calls"], F.array()), lambda c: of_call(c, i)))).when(
            m["role"] == "tool", _problems(F.when(no_id, at("tool message without tool_call_id", i)).when(~_preceded(calls, m, i), F.concat(F.lit("tool result "), _said(m["tool_call_id"]), F.lit(" has no preceding call"))))
        ).otherwise(F.array().cast("array<string>"))

    return _listed(head, messages, _role_problems(messages, "assistant"), F.flatten(F.transform(messages, of_message)), _unanswered(messages, calls, "message "), tail)


def check_turns(messages: Column, tools: Column) -> Column:
    """Problems of a dialog's turns."""
    calls, names = _calls(messages, False), declared_tools(tools)
    at = lambda what, i: F.concat(F.lit(what + " at "), i.cast("string"))

    def of_call(c: Column, i: Column) -> Column:
        undeclared = (F.coalesce(F.size(tools), F.lit(0)) > 0) & ~F.coalesce(F.array_contains(names, c["name"]), F.lit(False))
        return F.when(F.coalesce(c["id"], F.lit("")) == "", F.array(at("tool_call without id", i))).otherwise(
            _problems(F.when(undeclared, F.concat(F.lit("undeclared tool "), _said(c["name"]), F.lit(" at "), i.cast("string"))), F.when(_bad_json(c["arguments"]), at("tool_call arguments not JSON", i)))
        )

    def of_message(m: Column, i: Column) -> Column:
        x, own = message_text(m), F.coalesce(m["tool_calls"], F.array())
        error = F.startswith(F.lower(T.strip(x)), F.lit("error:")) | F.regexp_like(x, F.lit(r'"error"\s*:'))
        return F.when(m["role"] == "assistant", F.concat(_problems(F.when((T.strip_think(x) == "") & (F.size(own) == 0), at("empty assistant turn", i))), F.flatten(F.transform(own, lambda c: of_call(c, i))))).when(
            m["role"] == "tool", _problems(F.when(~F.coalesce(_preceded(calls, m, i), F.lit(False)), at("tool result without a preceding call", i)), F.when(error, at("error-laden tool result", i)))
        ).otherwise(F.array().cast("array<string>"))

    return F.concat(F.flatten(F.transform(messages, of_message)), _unanswered(messages, calls, ""))


def only_unanswered(problems: Column, messages: Column, tools: Column) -> Column:
    """True for a dialog whose only fault is calls without results, and that can serve as a seed."""
    return (F.size(problems) > 0) & F.forall(problems, lambda p: F.contains(p, F.lit("has no tool result"))) & (F.coalesce(F.size(tools), F.lit(0)) > 0) & F.exists(messages, lambda m: m["role"] == "user")


def remapped(calls: Column, row_id: Column, start: Column) -> Column:
    """Calls with ids of the row's own."""
    return F.transform(calls, lambda c, k: F.struct(F.concat(row_id, F.lit("-call-"), (start + k).cast("string")).alias("id"), F.lit("function").alias("type"), F.coalesce(c["name"], F.lit("")).alias("name"), F.coalesce(c["arguments"], F.lit("{}")).alias("arguments")))


def without_images(messages: Column) -> Column:
    def plain(m: Column) -> Column:
        kept = F.filter(m["parts"], lambda p: p["type"] == "text")
        return m.withField("parts", F.when(F.size(kept) == 0, F.array(text_part(F.lit("")))).otherwise(kept))

    return F.transform(messages, plain)


_RULES = (
    "\n\nIf you choose to call a function ONLY reply in the following format with NO suffix:\n\n<tool_call>\n<function=example_function_name>\n<parameter=example_parameter_1>\nvalue_1\n</parameter>\n"
    "<parameter=example_parameter_2>\nThis is the value for the second parameter\nthat can span\nmultiple lines\n</parameter>\n</function>\n</tool_call>\n\n<IMPORTANT>\nReminder:\n"
    "- Function calls MUST follow the specified format: an inner <function=...></function> block must be nested within <tool_call></tool_call> XML tags\n- Required parameters MUST be specified\n"
    "- You may provide optional reasoning for your function call in natural language BEFORE the function call, but NOT after\n"
    "- If there is no function call available, answer the question like normal with your current knowledge and do not tell the user about function calls\n</IMPORTANT>"
)  # a fixed value: the format that the student model expects


def _rendered_call(c: Column, k: Column, content: Column) -> Column:
    lead = F.when((k == 0) & (content == ""), F.lit("")).when(k == 0, F.lit("\n\n")).otherwise(F.lit("\n"))
    value = lambda v: F.when(F.schema_of_variant(v) == "BOOLEAN", F.initcap(v.cast("string"))).otherwise(F.coalesce(v.cast("string"), F.lit("None")))
    given = F.map_entries(F.from_json(c["arguments"], "map<string, variant>"))
    lines = F.transform(F.coalesce(given, F.array().cast("array<struct<key: string, value: variant>>")), lambda e: F.concat(F.lit("<parameter="), e["key"], F.lit(">\n"), value(e["value"]), F.lit("\n</parameter>\n")))
    return F.concat(lead, F.lit("<tool_call>\n<function="), c["name"], F.lit(">\n"), F.array_join(lines, ""), F.lit("</function>\n</tool_call>"))


def rendered(messages: Column, tools: Column | None = None, generation_prompt: bool = False) -> Column:
    """A dialog in the student's chat format; null where it has no user turn that is a query, or a system turn that is not first.

    Values of call arguments that are objects or lists are shown as JSON without spaces.
    """
    tools = F.array().cast("array<string>") if tools is None else F.coalesce(tools, F.array().cast("array<string>"))
    image = F.lit("<|vision_start|><|image_pad|><|vision_end|>")
    content_of = lambda m: T.strip(F.array_join(F.transform(F.coalesce(m["parts"], F.array()), lambda p: F.when(p["type"] == "image", image).otherwise(F.coalesce(p["text"], F.lit("")))), ""))
    plain = F.transform(messages, lambda m: F.struct(m["role"].alias("role"), content_of(m).alias("content"), F.coalesce(m["tool_calls"], F.array()).alias("calls")))
    some = F.coalesce(F.size(messages), F.lit(0)) > 0
    return F.when(some, T.let(plain, lambda p: T.let(_last_query(p), lambda last: _rendered(p, last, tools, generation_prompt))))


def _last_query(plain: Column) -> Column:
    is_query = lambda m: (m["role"] == "user") & ~(F.startswith(m["content"], F.lit("<tool_response>")) & F.endswith(m["content"], F.lit("</tool_response>")))
    return F.coalesce(F.array_max(F.filter(F.transform(plain, lambda m, i: F.when(is_query(m), i)), lambda i: i.isNotNull())), F.lit(-1))


def _rendered(plain: Column, last: Column, tools: Column, generation_prompt: bool) -> Column:
    role = lambda i: F.try_element_at(plain, i + 1)["role"]
    first = F.element_at(plain, 1)
    system = F.when(first["role"] == "system", first["content"])
    with_tools = F.concat(
        F.lit("<|im_start|>system\n# Tools\n\nYou have access to the following functions:\n\n<tools>"), F.array_join(F.transform(tools, lambda t: F.concat(F.lit("\n"), t)), ""), F.lit("\n</tools>" + _RULES),
        F.when(F.coalesce(system, F.lit("")) != "", F.concat(F.lit("\n\n"), system)).otherwise(F.lit("")), F.lit("<|im_end|>\n"),
    )
    head = F.when(F.size(tools) > 0, with_tools).when(system.isNotNull(), F.concat(F.lit("<|im_start|>system\n"), system, F.lit("<|im_end|>\n"))).otherwise(F.lit(""))

    def turn(m: Column, i: Column) -> Column:
        x = m["content"]
        ended = F.contains(x, F.lit("</think>"))
        parts = F.split(x, "</think>")
        thought = F.regexp_replace(F.element_at(F.split(F.regexp_replace(F.element_at(parts, 1), r"\n+$", ""), "<think>"), -1), r"^\n+", "")
        thought = T.strip(F.when(ended, thought).otherwise(F.lit("")))
        said = F.when(ended, F.regexp_replace(F.element_at(parts, -1), r"^\n+", "")).otherwise(x)
        body = F.when(i > last, F.concat(F.lit("<think>\n"), thought, F.lit("\n</think>\n\n"), said)).otherwise(said)
        calls = F.array_join(F.transform(m["calls"], lambda c, k: _rendered_call(c, k, T.strip(said))), "")
        tool = F.concat(
            F.when((i > 0) & (role(i - 1) != "tool"), F.lit("<|im_start|>user")).otherwise(F.lit("")), F.lit("\n<tool_response>\n"), x, F.lit("\n</tool_response>"),
            F.when(role(i + 1).isNull() | (role(i + 1) != "tool"), F.lit("<|im_end|>\n")).otherwise(F.lit("")),
        )
        return (
            F.when(m["role"] == "user", F.concat(F.lit("<|im_start|>user\n"), x, F.lit("<|im_end|>\n")))
            .when(m["role"] == "assistant", F.concat(F.lit("<|im_start|>assistant\n"), body, calls, F.lit("<|im_end|>\n")))
            .when(m["role"] == "tool", tool).otherwise(F.lit(""))
        )

    out = F.concat(head, F.array_join(F.transform(plain, turn), ""), F.lit("<|im_start|>assistant\n<think>\n" if generation_prompt else ""))
    misplaced = F.exists(F.transform(plain, lambda m, i: (m["role"] == "system") & (i > 0)), lambda x: x)
    return F.when((last >= 0) & ~misplaced, out)


def render_problems(messages: Column, tools: Column) -> Column:
    """What the render gate finds in a dialog: lost turns, too many think blocks, calls that do not show."""
    shown = rendered(without_images(messages), tools)
    kept = F.regexp_count(shown, F.lit(r"(?s)<think>.*?</think>"))
    calls = tool_calls_in(messages)
    lost_names = F.transform(F.filter(calls, lambda c: ~F.contains(shown, F.concat(F.lit("<function="), c["name"], F.lit(">")))), lambda c: F.concat(F.lit("tool name "), _said(c["name"]), F.lit(" did not render")))
    return F.when(shown.isNull(), F.array(F.lit("does not render"))).otherwise(
        F.concat(_problems(F.when(kept > expected_think_blocks(messages), F.lit("too many think blocks"))), lost_names)
    )


def render_report(rows: DataFrame) -> DataFrame:
    """The render gate over rows (messages, tools), one row: rows, failures, think tags opened and closed and whether they are balanced,
    whether a stored thought survives (probe), and whether a generation prompt opens one (opens)."""
    shown = rows.select(rendered(without_images(F.col("messages")), F.col("tools")).alias("shown"))
    ask = text_message("user", F.lit("What is 1+1?"))
    answer = text_message("assistant", F.lit("<think>\nOne plus one is two.\n</think>\n\nTwo."))
    probe, opened = rendered(F.array(ask, answer)), rendered(F.array(ask), None, True)
    by = shown.agg(
        F.count("*").alias("rows"), F.count_if(F.col("shown").isNull()).alias("failures"),
        *(F.coalesce(F.sum(F.regexp_count("shown", F.lit(tag))), F.lit(0)).cast("long").alias(name) for tag, name in (("<think>", "opened"), ("</think>", "closed"))),
    )
    return by.withColumns({
        "balanced": F.col("opened") == F.col("closed"),
        "probe": F.contains(probe, F.lit("<think>")) & F.contains(probe, F.lit("</think>")) & F.contains(probe, F.lit("One plus one is two.")),
        "opens": F.contains(opened, F.lit("<think>")),
    })


def packed_text(messages: Column, tools: Column | None = None) -> Column:
    """A row as the student sees it, with white space collapsed; its assistant turns where it does not render."""
    return F.coalesce(T.strip(F.regexp_replace(rendered(without_images(messages), tools), r"(?U)\s+", " ")), all_assistant_text(messages))
