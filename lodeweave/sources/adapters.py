"""Adapters: source shapes to canonical rows, as projections and filters.

Each takes a DataFrame with `_seq` (the row's place in its source) and a Context, and returns canonical rows; a row that
does not fit is dropped. Whole texts stay in the JVM; only open JSON is parsed in Arrow-batched UDFs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave import schema as S
from lodeweave.functions import messages as M
from lodeweave.functions import parsing as P
from lodeweave.functions import text as T

# Fixed values of the sources' own columns.
GENERATION_CONFIGS = ("chart2text", "diagram_image_to_text", "tabmwp", "screen2words")
VQA_CONFIGS = ("chartqa", "ai2d", "tqa", "scienceqa")
MAGPIE_QUALITIES, MAGPIE_LEAST_SCORE = ("excellent", "good"), 0.15


@dataclass(frozen=True)
class Context:
    name: str
    config: str | None
    domain: str
    license: str | None = None

    def source(self, row: Column) -> Column:
        return F.struct(F.lit(self.name).cast("string").alias("name"), F.lit(self.config).cast("string").alias("config"), row.cast("long").alias("row"), F.lit(self.license).cast("string").alias("license"))


def _has(x: str) -> Column:
    return F.coalesce(F.col(x), F.lit("")) != ""


def verify(kind: str, setup: Column | None = None, tests: Column | None = None, name: Column | None = None, pairs: Column | None = None, gold: Column | None = None) -> Column:
    null = lambda x, t: (F.lit(None) if x is None else x).cast(t)
    return F.struct(F.lit(kind).alias("type"), null(setup, "string").alias("setup"), null(tests, "array<string>").alias("tests"), null(name, "string").alias("name"), null(pairs, "array<array<string>>").alias("pairs"), null(gold, "string").alias("gold"))


def canonical(rows: DataFrame, ctx: Context, row_id: Column, messages: Column, tools: Column | None = None, verify_spec: Column | None = None, meta: Column | None = None, images: Column | None = None, domain: str | None = None) -> DataFrame:
    """Canonical rows; those without messages are dropped."""
    null = lambda x, t: (F.lit(None) if x is None else x).cast(t)
    return rows.select(
        row_id.alias("id"), F.lit(domain or ctx.domain).alias("domain"), F.lit("prebuilt").alias("origin"), ctx.source(F.col("_seq")).alias("source"), messages.alias("messages"), null(tools, "array<string>").alias("tools"),
        F.coalesce(null(images, f"array<{S.IMAGE}>"), F.array().cast(f"array<{S.IMAGE}>")).alias("images"), F.lit(0).cast("long").alias("tokens"), null(verify_spec, S.VERIFY).alias("verify"), (F.lit("{}") if meta is None else F.to_json(meta)).alias("meta"), F.col("_seq").cast("long").alias("_seq"),
    ).filter(F.col("messages").isNotNull())


def _numbered(prefix: str) -> Column:
    return F.concat(F.lit(prefix + "-"), F.col("_seq").cast("string"))


def ends_on_assistant(messages: Column) -> Column:
    return F.coalesce(F.try_element_at(messages, F.lit(-1))["role"] == "assistant", F.lit(False))


def _turn(t: Column, *names: str) -> Column:
    fields = [t[n] for n in names]
    return F.coalesce(*fields)


def dialog(turns: Column, role: Callable, said: Callable, system: Column | None = None) -> Column:
    """Canonical messages of ShareGPT-like turns; null if a role is unknown, a text is missing, or the last is no assistant's."""
    names = F.create_map(*[F.lit(x) for kv in {"human": "user", "gpt": "assistant", "system": "system", "user": "user", "assistant": "assistant"}.items() for x in kv])
    known = F.transform(F.coalesce(turns, F.array()), lambda t: F.struct(names[role(t)].alias("role"), said(t).alias("text")))
    fits = F.forall(known, lambda t: t["role"].isNotNull() & t["text"].isNotNull())
    made = F.transform(known, lambda t: M.text_message(t["role"], T.clean_markup(t["text"])))
    if system is not None:
        made = F.concat(F.when(~T.is_blank(system), F.array(M.text_message("system", T.strip(system)))).otherwise(F.slice(made, 1, 0)), made)
    return F.when(fits & ends_on_assistant(made), made)


def _sharegpt(turns: str = "conversations", system: Column | None = None) -> Column:
    return dialog(F.col(turns), lambda t: t["from"], lambda t: t["value"], system)


def _column(rows: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in rows.columns else F.lit(None).cast("string")


def chat_rows(rows: DataFrame, ctx: Context) -> DataFrame:
    """`messages` of role and content; one configuration keeps rows of a quality only."""
    if ctx.config == "smol-magpie-ultra":
        rows = rows.filter(F.col("quality").isin(*MAGPIE_QUALITIES) & (F.col("reward_model_score") >= MAGPIE_LEAST_SCORE))
    turns = F.coalesce(F.col("messages"), F.array())
    fits = F.forall(turns, lambda m: F.coalesce(m["role"].isin("system", "user", "assistant"), F.lit(False)) & m["content"].isNotNull())
    made = F.transform(turns, lambda m: M.text_message(m["role"], m["content"]))
    return canonical(rows, ctx, _numbered(f"smoltalk-{ctx.config or 'default'}"), F.when(fits & ends_on_assistant(made), made))


def roleplay_rows(rows: DataFrame, ctx: Context) -> DataFrame:
    return canonical(rows.filter("category = 'roleplay'"), ctx, _numbered("openhermes-roleplay"), _sharegpt(system=_column(rows, "system_prompt")))


def tool_prose_rows(rows: DataFrame, ctx: Context) -> DataFrame:
    return canonical(rows, ctx, _numbered("toolace"), _sharegpt(system=_column(rows, "system")))


def _pair(question: str, answer: str) -> Column:
    return F.array(M.text_message("user", T.strip(question)), M.text_message("assistant", T.strip(answer)))


def _gold(x: Column) -> Column:
    return F.when(F.coalesce(x, F.lit("")) != "", verify("answer_match", gold=x))


def competition_rows(rows: DataFrame, ctx: Context) -> DataFrame:
    rows = rows.filter("problem_is_valid = 'Yes' AND solution_is_valid = 'Yes'").filter(_has("problem") & _has("solution"))
    return canonical(rows, ctx, _numbered("numina"), _pair("problem", "solution"), verify_spec=_gold(T.gold_boxed("solution")), meta=F.struct("problem_type", "synthetic"))


def school_rows(rows: DataFrame, ctx: Context) -> DataFrame:
    return canonical(rows.filter(_has("question") & _has("answer")), ctx, _numbered("gsm8k"), _pair("question", "answer"), verify_spec=_gold(T.gold_hashes("answer")))


def code_rows(rows: DataFrame, ctx: Context) -> DataFrame:
    return canonical(rows.filter(_has("query") & _has("answer")), ctx, _numbered("codefeedback"), _pair("query", "answer"), meta=F.struct("lang", "resource"))


def json_entries(x: Column) -> Column:
    """The entries of a JSON list, each as JSON text; null for what is no list."""
    parsed = F.try_parse_json(x)
    return F.transform(F.from_json(F.when(F.startswith(F.schema_of_variant(parsed), F.lit("ARRAY")), x), "array<variant>"), lambda v: F.to_json(v))


def tool_call_rows(rows: DataFrame, ctx: Context) -> DataFrame:
    """A JSON list of function objects in `tools`; a row whose list is broken is dropped, an empty one has none."""
    blank = T.is_blank(F.col("tools"))
    entries = json_entries(F.col("tools"))
    sound = F.forall(entries, lambda t: F.coalesce(F.get_json_object(t, "$.function.name"), F.lit("")) != "")
    rows = rows.filter(blank | F.coalesce(sound, F.lit(False)))
    tools = F.when(~F.col("__blank") & (F.size("__entries") > 0), F.col("__entries"))
    rows = rows.withColumns({"__blank": blank, "__entries": entries})
    return canonical(rows, ctx, _numbered("hermesfc"), _sharegpt(system=_column(rows, "system")), tools=tools, meta=F.struct("category", "task"))


def image_rows(rows: DataFrame, ctx: Context, holdout: bool = False) -> DataFrame:
    """Images with a pair of texts; images are kept as content addresses. Rows of other configurations, or with an image without bytes, are dropped."""
    if ctx.config not in (VQA_CONFIGS if holdout else GENERATION_CONFIGS):
        rows = rows.limit(0)
    first = F.try_element_at(F.col("texts"), F.lit(1))
    images = F.coalesce(F.col("images"), F.array())
    fits = ~T.is_blank(first["user"]) & ~T.is_blank(first["assistant"]) & F.forall(images, lambda i: F.coalesce(F.octet_length(i["bytes"]), F.lit(0)) > 0)
    shas = F.transform(images, lambda i: F.sha2(i["bytes"], 256))
    parts = F.concat(F.array(M.text_part(T.strip(first["user"]))), F.transform(shas, M.image_part))
    refs = F.transform(F.array_distinct(shas), lambda s: F.struct(s.alias("sha256"), F.concat(F.substring(s, 1, 2), F.lit("/"), s).alias("path"), F.lit(None).cast("int").alias("w"), F.lit(None).cast("int").alias("h"), F.lit(None).cast("string").alias("origin_url")))
    made = F.array(M.message("user", parts), M.text_message("assistant", T.strip(first["assistant"])))
    return canonical(rows, ctx, _numbered(f"{'visionholdout' if holdout else 'cauldron'}-{ctx.config}"), F.when(fits, made), images=refs, meta=F.struct(F.size(shas).alias("n_images")), domain="reasoning" if holdout else None)


def unit_test_rows(rows: DataFrame, ctx: Context) -> DataFrame:
    """Prompts with assert tests; the signature of the reference solution is stated in the prompt."""
    rows = rows.filter(_has("prompt") & (F.size("test_list") > 0)).withColumn("__sig", T.signature("code"))
    ask = F.concat(F.col("prompt"), F.lit("\n\nName the function `"), F.col("__sig.name"), F.lit("` and use exactly this signature: `def "), F.col("__sig.rendered"), F.lit(":`"))
    spec = verify("python_tests", F.array_join(F.coalesce("test_imports", F.array().cast("array<string>")), "\n"), F.col("test_list"), F.col("__sig.name"))
    return canonical(rows, ctx, F.concat(F.lit("mbpp-"), F.col("task_id").cast("string")), F.array(M.text_message("user", F.coalesce(ask, F.col("prompt")))), verify_spec=spec)


def stdin_rows(rows: DataFrame, ctx: Context, most_pairs: int = 20) -> DataFrame:
    """Prompts with pairs of input and output texts."""
    io = F.from_json("input_output", "struct<inputs: array<variant>, outputs: array<variant>>")
    text = lambda v: F.when(F.schema_of_variant(v) == "STRING", v.cast("string"))
    n = F.least(F.size(io["inputs"]), F.size(io["outputs"]))
    zipped = F.arrays_zip(F.slice(F.transform(io["inputs"], text), 1, n).alias("i"), F.slice(F.transform(io["outputs"], text), 1, n).alias("o"))
    pairs = F.transform(F.slice(F.filter(zipped, lambda p: p["i"].isNotNull() & p["o"].isNotNull()), 1, most_pairs), lambda p: F.array(p["i"], p["o"]))
    rows = rows.filter(_has("question") & _has("input_output")).withColumn("__pairs", pairs).filter(F.size("__pairs") > 0)
    return canonical(rows, ctx, F.concat(F.lit("apps-"), F.col("problem_id").cast("string")), F.array(M.text_message("user", F.col("question"))), verify_spec=verify("python_io", pairs=F.col("__pairs")))


def seed_rows(rows: DataFrame, domain: str = "uncensored") -> DataFrame:
    """Text seeds (id, source, config, text) as prompts."""
    out = canonical(rows, Context("", None, domain), F.col("id"), F.array(M.text_message("user", F.col("text"))))
    named = rows.select(F.col("id"), F.struct(F.col("source").alias("name"), F.col("config").cast("string").alias("config"), F.lit(None).cast("long").alias("row"), F.lit(None).cast("string").alias("license")).alias("named"))
    return out.join(named, "id").withColumn("source", F.col("named")).drop("named").select(out.columns)


# Dialogs whose assistant turns are to be written anew: they are kept as scaffolds.


def _answered(messages: Column) -> Column:
    """messages with the ids of pending calls given to tool turns, first in first out; null if a tool turn has none pending.

    messages: canonical, with the calls of each scaffold in place.
    """
    start = F.struct(F.slice(messages, 1, 0).alias("out"), F.array().cast("array<string>").alias("pending"), F.lit(True).alias("ok"))

    def step(s: Column, m: Column) -> Column:
        calls = F.coalesce(m["tool_calls"], F.array())
        asks, is_tool = (m["role"] == "assistant") & (F.size(calls) > 0), m["role"] == "tool"
        pending = F.when(asks, F.transform(calls, lambda c: c["id"])).when(is_tool, F.slice(s["pending"], 2, F.greatest(F.size(s["pending"]), F.lit(1)))).otherwise(s["pending"])
        new = F.when(is_tool, m.withField("tool_call_id", F.try_element_at(s["pending"], F.lit(1)))).otherwise(m)
        return F.struct(F.concat(s["out"], F.array(new)).alias("out"), pending.alias("pending"), (s["ok"] & ~(is_tool & (F.size(s["pending"]) == 0))).alias("ok"))

    done = F.aggregate(messages, start, step)
    return F.when(done["ok"], done["out"])


def _scaffold(text: Column, calls: Column) -> Column:
    has = F.size(calls) > 0
    return F.struct(F.lit("assistant").alias("role"), F.array(M.text_part(text)).alias("parts"), F.when(has, calls).alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"), has.alias("scaffold"))


def tagged_dialogs(rows: DataFrame, ctx: Context) -> DataFrame:
    """Dialogs with <tool_call> blocks of JSON and <tool_response> turns; calls of undeclared names drop the row.

    Turns are parsed one by one (explode, and back by row), so the UDF sees batches of blocks, not of dialogs.
    """
    turns = rows.select("_seq", F.posexplode("conversations").alias("i", "t")).select("_seq", "i", F.col("t.from").alias("who"), F.col("t.value").alias("said"))
    turns = turns.withColumn("blocks", F.when(F.col("who") == "gpt", T.blocks_of("said", "tool_call")).otherwise(F.array().cast("array<string>"))).withColumn("parsed", P.tagged_calls("blocks"))
    prose = F.aggregate("blocks", F.col("said"), lambda s, b: F.replace(F.replace(s, F.concat(F.lit("<tool_call>\n"), b, F.lit("\n</tool_call>")), F.lit("")), F.concat(F.lit("<tool_call>"), b, F.lit("</tool_call>")), F.lit("")))
    shown = F.when(F.col("who") == "system", F.when(F.contains("said", F.lit("<tools>")), T.strip(F.element_at(F.split("said", "<tools>"), 1))).otherwise(F.col("said"))).when(
        F.col("who") == "tool", F.coalesce(F.try_element_at(T.blocks_of("said", "tool_response"), F.lit(1)), F.col("said"))
    ).when((F.col("who") == "gpt") & (F.size("blocks") > 0), T.strip(prose)).otherwise(F.col("said"))
    role = F.create_map(*[F.lit(x) for kv in {"system": "system", "human": "user", "gpt": "assistant", "tool": "tool"}.items() for x in kv])[F.col("who")]
    turns = turns.select("_seq", "i", role.alias("role"), shown.alias("text"), (role_known(role) & F.col("said").isNotNull() & F.col("parsed.ok")).alias("ok"), "parsed.names", "parsed.arguments")
    each = F.struct("i", "role", "text", "names", "arguments")
    by = turns.groupBy("_seq").agg(F.array_sort(F.collect_list(each)).alias("turns"), F.min("ok").alias("ok"))
    sizes = F.transform("turns", lambda t: F.size(t["names"]))
    first = lambda i: F.aggregate(F.slice(sizes, 1, i), F.lit(0), lambda a, b: a + b)  # noqa: E731  calls in the turns before
    calls = lambda t, i: F.transform(t["names"], lambda n, k: F.struct(F.concat(F.lit("call_"), (first(i) + k).cast("string")).alias("id"), F.lit("function").alias("type"), n.alias("name"), F.element_at(t["arguments"], k + 1).alias("arguments")))
    made = F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", _scaffold(t["text"], calls(t, i))).otherwise(M.text_message(t["role"], t["text"])))
    full = rows.join(by, "_seq").withColumn("__tools", json_entries(F.col("tools"))).withColumn("__made", F.when(F.col("ok"), _answered(made)))
    declared = F.when(F.size("__tools") > 0, M.declared_tools(F.col("__tools")))
    fits = ends_on_assistant(F.col("__made")) & F.coalesce(F.forall(M.tool_calls_in(F.col("__made")), lambda c: F.array_contains(declared, c["name"])), F.lit(True))
    return canonical(full, ctx, _numbered("hermesfc"), F.when(fits, F.col("__made")), tools=F.when(F.size("__tools") > 0, F.col("__tools")), meta=F.struct("category", "task", F.lit(False).alias("simulated")))


def role_known(role: Column) -> Column:
    return role.isNotNull()


def notation_dialogs(rows: DataFrame, ctx: Context) -> DataFrame:
    """Dialogs whose assistant turns may be calls in the bracket notation, and whose system text lists the functions."""
    turns = rows.select("_seq", F.posexplode("conversations").alias("i", "t")).select("_seq", "i", F.col("t.from").alias("who"), F.col("t.value").alias("said"))
    turns = turns.withColumn("calls", P.calls_in_notation(F.when(F.col("who") == "assistant", F.col("said"))))
    turns = turns.select("_seq", "i", "who", "said", (F.col("who").isin("user", "assistant", "tool") & F.col("said").isNotNull()).alias("ok"), "calls")
    by = turns.groupBy("_seq").agg(F.array_sort(F.collect_list(F.struct("i", "who", "said", "calls"))).alias("turns"), F.min("ok").alias("ok"))
    made = F.transform("turns", lambda t: F.when(t["who"] == "assistant", _scaffold(F.when(F.size(t["calls"]) > 0, F.lit("")).otherwise(t["said"]), F.coalesce(t["calls"], F.array()))).otherwise(M.text_message(t["who"], t["said"])))
    full = rows.join(by, "_seq").withColumn("__tools", P.tools_in_prose("system"))
    intro = F.when(F.contains("system", F.lit("[")), T.strip(F.substring_index("system", "[", 1)))
    lead = F.when(F.coalesce(intro, F.lit("")) != "", F.array(M.text_message("system", intro)))
    answered = _answered(made)
    whole = F.concat(F.coalesce(lead, F.slice(made, 1, 0)), answered)
    return canonical(full, ctx, _numbered("toolace"), F.when(F.coalesce("ok", F.lit(False)) & ends_on_assistant(whole), whole), tools=F.col("__tools"), meta=F.struct(F.lit(False).alias("simulated")))


def chat_dialogs(rows: DataFrame, ctx: Context) -> DataFrame:
    """Dialogs of two user turns or more, their assistant turns blanked."""
    turns = F.coalesce(F.col("messages"), F.array())
    fits = F.forall(turns, lambda m: F.coalesce(m["role"].isin("system", "user", "human", "gpt", "assistant"), F.lit(False)) & m["content"].isNotNull())
    made = F.transform(turns, lambda m: F.when(m["role"].isin("gpt", "assistant"), M.message("assistant", F.array(M.text_part(F.lit(""))), scaffold=True)).when(m["role"] == "system", M.text_message("system", m["content"])).otherwise(M.text_message("user", m["content"])))
    ok = fits & ends_on_assistant(made) & (F.size(M.by_role(made, "user")) >= 2)
    name = f"chat-{ctx.name.split('/')[-1]}-{ctx.config or 'default'}"
    return canonical(rows, ctx, _numbered(name), F.when(ok, made), meta=F.struct(F.lit(False).alias("simulated")))


ADAPTERS: dict[str, Callable[[DataFrame, Context], DataFrame]] = {
    "smoltalk": chat_rows, "sharegpt_openhermes": roleplay_rows, "sharegpt_toolace": tool_prose_rows, "numina": competition_rows, "gsm8k": school_rows, "codefeedback": code_rows, "toolcalls": tool_call_rows, "cauldron": image_rows,
}
DIALOGS: dict[str, Callable[[DataFrame, Context], DataFrame]] = {"hermes": tagged_dialogs, "toolace": notation_dialogs, "chat": chat_dialogs}


def adapter(key: str) -> Callable[[DataFrame, Context], DataFrame]:
    if key not in ADAPTERS:
        raise KeyError(f"no adapter {key}; there are {', '.join(ADAPTERS)}")
    return ADAPTERS[key]
