"""Queries of single operators that the plans combine, each over its whole tables, with equivalent SQL.

What the tables lack (tool calls, think tags, fenced code, images, recorded completions) is made from the columns of
each document, by its number, so that every case occurs at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodeweave import schema as S
from lodeweave.functions import messages as M
from lodeweave.functions import quant as Q
from lodeweave.functions import text as T
from lodeweave.operators import aggregates as A
from lodeweave.operators import contamination as C
from lodeweave.operators import generation as G
from lodeweave.operators import invention as V
from lodeweave.operators import sampling as P
from lodeweave.operators import windows as N
from lodeweave.plans import corpus
from lodeweave.plans.registry import _JOINED, _NORM, _TOKENS, _catalog, _dialogs, _docs, _labelled, _pairs_sql, _rollouts, _t, _VERDICT, query
from lodeweave.sources import adapters, readers, sinks
from lodeweave.sources.storage import dealt

_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


def _n() -> Column:
    return F.col("doc_id")


def _text(x: str) -> Column:
    return F.coalesce(F.col(x).cast("string"), F.lit(""))


# Texts.


@query("SELECT doc_id, substr(sha256(text), 1, 12) AS content_id FROM documents")
def content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", T.content_id("text").alias("content_id"))


@query(f"SELECT doc_id, ('0x' || substr(sha256({_NORM}), 1, 8))::BIGINT AS seed FROM documents")
def request_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", T.seed_number(T.text_key("text")).alias("seed"))


@query(f"SELECT doc_id, regexp_extract_all(replace(text, ',', ''), '-?\\d+(?:\\.\\d+)?')[-1] AS number, {_STRIP.format('split_part(text, chr(10), 1)')} AS line FROM documents")
def final_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last number of each text, and its first line."""
    return _t(spark, sf_dir, "documents").select("doc_id", T.final_number("text").alias("number"), T.first_line("text").alias("line"))


@query("SELECT doc_id, replace(replace(replace(replace(x, '<|im_end|>', ''), '<|im_start|>', ''), '<|endoftext|>', ''), '<|eot_id|>', '') AS cleaned FROM (SELECT doc_id, '<|im_start|>' || source || '<|eot_id|> ' || lang || '<|im_end|>' AS x FROM documents)")
def markup_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.concat(F.lit("<|im_start|>"), F.col("source"), F.lit("<|eot_id|> "), F.col("lang"), F.lit("<|im_end|>"))
    return _t(spark, sf_dir, "documents").select("doc_id", T.clean_markup(marked).alias("cleaned"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN '<think>x</think>' || text ELSE '<think>\n' || source || '\n</think>\n\n' || text END AS folded FROM documents".replace("\\n", "' || chr(10) || '"))
def reasoning_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third text has no side field, every third has think tags already."""
    content = F.when(_n() % 3 == 1, F.concat(F.lit("<think>x</think>"), F.col("text"))).otherwise(F.col("text"))
    return _t(spark, sf_dir, "documents").select("doc_id", T.fold_reasoning(content, F.when(_n() % 3 != 0, F.concat(F.lit(" "), F.col("source"), F.lit("\n")))).alias("folded"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'unbalanced_think_tags' WHEN greatest(1, length(x) // 4) < 16 THEN 'too_short' WHEN greatest(1, length(x) // 4) > 16384 THEN 'too_long' END AS reason
FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '<think>' || text WHEN 1 THEN '<think>a</think>' || text ELSE text || '!' END AS x FROM documents)""")
def think_filter_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers whose think tags are open, closed and none."""
    x = F.when(_n() % 3 == 0, F.concat(F.lit("<think>"), F.col("text"))).when(_n() % 3 == 1, F.concat(F.lit("<think>a</think>"), F.col("text"))).otherwise(F.concat(F.col("text"), F.lit("!")))
    return _t(spark, sf_dir, "documents").select("doc_id", x.alias("x")).select("doc_id", T.response_reject_reason("x", T.count_tokens("x")).alias("reason"))


_FORMS = "['\\boxed{v}', '#### v', 'The answer is v.', '$v.']"


@query(f"""WITH d AS (SELECT doc_id, CAST(coalesce(n_chars, 0) AS VARCHAR) AS v FROM documents)
SELECT doc_id, CASE WHEN doc_id % 4 IN (0, 1) THEN v ELSE replace({_FORMS}[doc_id % 4 + 1], 'v', v) END AS extracted, doc_id % 3 <> 1 AS accepted FROM d""")
def answers_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number answered in four forms behind a thought of another one; every third is compared with a wrong number."""
    v = F.coalesce("n_chars", F.lit(0)).cast("long")
    form = F.when(_n() % 4 == 0, F.concat(F.lit("\\boxed{"), v.cast("string"), F.lit("}"))).when(_n() % 4 == 1, F.concat(F.lit("#### "), v.cast("string")))
    form = form.when(_n() % 4 == 2, F.concat(F.lit("The answer is "), v.cast("string"), F.lit("."))).otherwise(F.concat(F.lit("$"), v.cast("string"), F.lit(".")))
    said = F.concat(F.lit("<think>\\boxed{"), (v + 1).cast("string"), F.lit("}</think>So\n"), form)
    rows = _t(spark, sf_dir, "documents").select("doc_id", said.alias("said"), F.when(_n() % 3 == 1, v + 1).otherwise(v).cast("string").alias("gold"))
    return rows.select("doc_id", T.extract_answer("said").alias("extracted"), T.check_answer("said", F.col("gold")).alias("accepted"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'f' || doc_id || '(a, b=1)' ELSE 'other(x)' END AS signature FROM documents")
def code_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two fenced blocks the one that defines the name asked for, else the first; its signature."""
    name = F.concat(F.lit("f"), _n().cast("string"))
    said = F.concat(F.lit("First\n```python\ndef other(x):\n    return x\n```\nthen\n```\ndef "), name, F.lit("(a,\n   b=1,):\n    return a\n```\n"))
    wanted = F.when(_n() % 2 == 0, name).otherwise(F.lit("missing"))
    return _t(spark, sf_dir, "documents").select("doc_id", T.signature(T.extract_code(said, wanted))["rendered"].alias("signature"))


@query("""SELECT doc_id, repeat('grass ', 3) || 'key ' || doc_id || repeat('grass ', 7) AS hay, CAST(length(text) + 6 * greatest(0, ceil((4 * 2000 - length(text)) / 6.0)) AS BIGINT) AS padded FROM documents""")
def needles_hidden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A needle at 0.3 of its haystack; the length of each text padded to 2,000 tokens."""
    hay = T.haystack(F.concat(F.lit("key "), _n().cast("string")), "grass ", 10, 0.3)
    return _t(spark, sf_dir, "documents").select("doc_id", hay.alias("hay"), F.char_length(T.pad_to("text", "grass ", 2000)).cast("long").alias("padded"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 3 = 1 THEN source ELSE '' END AS field FROM documents")
def field_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of pairs: with a user text, with an assistant's only, and without pairs."""
    pair = lambda u: F.array(F.struct(u.alias("user"), F.col("source").alias("assistant")))
    field = F.when(_n() % 3 == 0, pair(F.col("lang"))).when(_n() % 3 == 1, pair(F.lit(""))).otherwise(F.slice(pair(F.lit("")), 1, 0))
    return _t(spark, sf_dir, "documents").select("doc_id", C.field_text(field).alias("field"))


# Scans, quotas and caches.


@query(f"""WITH d AS (SELECT doc_id, {_STRIP.format('text')} AS text FROM documents)
SELECT 'docs-default-train-' || (row_number() OVER (ORDER BY doc_id) - 1) AS id, text FROM d WHERE text <> '' QUALIFY row_number() OVER (ORDER BY doc_id) <= 300""")
def seeds_harvested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 300 texts that are not blank, numbered."""
    return readers.harvest_seeds(_docs(spark, sf_dir).select("_seq", "text"), "public/docs", None, "train", "text", 300).select("id", "text")


@query(f"""WITH d AS (SELECT doc_id, {_STRIP.format('text')} AS text FROM documents), h AS (SELECT 'docs-default-train-' || (row_number() OVER (ORDER BY doc_id) - 1) AS id, text FROM d WHERE text <> '' QUALIFY row_number() OVER (ORDER BY doc_id) <= 300)
SELECT id, 'public/docs' AS name, text AS prompt, '' AS problems FROM h""")
def seed_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harvested seeds as canonical prompts, validated."""
    seeds = readers.harvest_seeds(_docs(spark, sf_dir).select("_seq", "text"), "public/docs", None, "train", "text", 300)
    return adapters.seed_rows(seeds).select("id", "source.name", M.prompt_text(F.col("messages")).alias("prompt"), F.array_join(M.validate_prompt(), "; ").alias("problems"))


@query(f"SELECT {_STRIP.format('text')} AS text FROM (SELECT text FROM benchmark ORDER BY item_id LIMIT 2000) WHERE {_STRIP.format('text')} <> ''")
def eval_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.eval_set(_t(spark, sf_dir, "benchmark").withColumn("_seq", F.col("item_id")), F.col("text"))


@query("SELECT text FROM (SELECT string_agg(CASE WHEN role = 'user' THEN text ELSE '' END, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id) WHERE text <> ''")
def local_prompt_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.local_prompts(_dialogs(spark, sf_dir))


_CATALOG = "SELECT source AS dataset, lang AS domain, count(*) AS cap FROM documents GROUP BY source, lang"


@query(f"SELECT dataset, domain, cap, CASE WHEN domain IN ('en', 'de') THEN NULL ELSE 'license of ' || dataset END AS license FROM ({_CATALOG}) WHERE domain NOT IN ('en', 'de') UNION ALL SELECT dataset, domain, cap, NULL FROM ({_CATALOG}) WHERE domain IN ('en', 'de')")
def source_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog with what is known of its datasets, here of those of two languages."""
    sources = _catalog(_docs(spark, sf_dir)).withColumn("dataset", F.concat_ws("/", "domain", "dataset"))
    known = sources.filter("domain NOT IN ('en', 'de')").select("dataset", F.concat(F.lit("license of "), F.substring_index("dataset", "/", -1)).alias("license"))
    out = readers.source_metadata(sources, known)
    return out.select(F.substring_index("dataset", "/", -1).alias("dataset"), "domain", "cap", "license")


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= count(*) OVER (PARTITION BY source) // 3")
def quota_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first third of each source."""
    rows = _docs(spark, sf_dir).select("doc_id", "_seq", "source")
    return P.take_quota(rows, rows.groupBy("source").agg(F.floor(F.count("*") / 3).alias("quota"))).select("doc_id", "source")


@query("SELECT doc_id, source FROM documents QUALIFY coalesce(sum(CASE WHEN length(text) >= 400 THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 12")
def capped_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source up to its twelfth text of 400 characters."""
    rows = _docs(spark, sf_dir).select("doc_id", "_seq", "source", (F.char_length("text") >= 400).alias("valid"))
    return P.take_capped(rows, F.col("valid"), 12, ["source"]).select("doc_id", "source")


@query("SELECT doc_id, doc_id >= (SELECT min(doc_id) FROM (SELECT doc_id FROM documents ORDER BY doc_id DESC LIMIT 64)) AS held_out FROM documents")
def windows_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.last_windows(_t(spark, sf_dir, "documents").select(F.col("doc_id").alias("_seq"))).select(F.col("_seq").alias("doc_id"), "held_out")


@query("""SELECT user_id || '|' || event_type AS key, event_id, CASE WHEN event_id % 4 <> 0 THEN CAST(event_id AS VARCHAR) END AS content FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 4 = 0, event_id) = 1""")
def cache_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line for each key of a cache: the first that holds a completion, else the first."""
    content = F.when(F.col("event_id") % 4 != 0, F.struct(F.col("event_id").cast("string").alias("content")))
    lines = _t(spark, sf_dir, "events").select(F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("key"), "event_id", content.alias("completion"))
    return readers.first_entries(lines, "event_id").select("key", "event_id", "completion.content")


# Adapters.


@query("""SELECT 'gsm8k-' || doc_id AS id, 'How long is ' || doc_id || '?' AS question, CASE WHEN doc_id % 5 <> 0 THEN CAST(n_chars AS VARCHAR) END AS gold, 2::INT AS n FROM documents WHERE doc_id % 7 <> 0""")
def school_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with a final answer behind hashes; every fifth has none, and every seventh row has no question."""
    answer = F.concat(F.lit("It is\n"), F.when(_n() % 5 != 0, F.lit("#### ")).otherwise(F.lit("")), _text("n_chars"))
    rows = _t(spark, sf_dir, "documents").select(_n().alias("_seq"), F.when(_n() % 7 != 0, F.concat(F.lit(" How long is "), _n().cast("string"), F.lit("? "))).alias("question"), answer.alias("answer"))
    out = adapters.school_rows(rows, adapters.Context("public/school", "main", "reasoning"))
    return out.select("id", M.prompt_text(F.col("messages")).alias("question"), F.col("verify.gold").alias("gold"), F.size("messages").alias("n"))


@query("""SELECT 'numina-' || doc_id AS id, CAST(n_chars AS VARCHAR) AS gold, lang AS kind FROM documents WHERE doc_id % 3 <> 0""")
def competition_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problems with a boxed solution; every third is marked as not valid."""
    solution = F.concat(F.lit("\\boxed{0} and then \\boxed{ "), _text("n_chars"), F.lit("}"))
    rows = _t(spark, sf_dir, "documents").select(_n().alias("_seq"), F.concat(F.lit("Problem "), _n().cast("string")).alias("problem"), solution.alias("solution"), F.lit("Yes").alias("problem_is_valid"), F.when(_n() % 3 == 0, "No").otherwise("Yes").alias("solution_is_valid"), F.col("lang").alias("problem_type"), F.lit(False).alias("synthetic"))
    out = adapters.competition_rows(rows, adapters.Context("public/olympiad", None, "reasoning"))
    return out.select("id", F.col("verify.gold").alias("gold"), F.get_json_object("meta", "$.problem_type").alias("kind"))


@query("""WITH c AS (SELECT conv_id, list(role ORDER BY turn) AS r FROM conversations GROUP BY conv_id)
SELECT 'smoltalk-default-' || conv_id AS id, CAST(len(r) AS INT) AS n FROM c WHERE r[-1] = 'assistant' AND len(list_filter(r, lambda x: x NOT IN ('system', 'user', 'assistant'))) = 0""")
def chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("_seq")).agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("messages"))
    return adapters.chat_rows(turns, adapters.Context("public/chat", None, "roleplay")).select("id", F.size("messages").alias("n"))


@query("""WITH c AS (SELECT conv_id, list(role ORDER BY turn) AS r, string_agg(CASE WHEN role = 'user' THEN regexp_replace(text, '^\\s+|\\s+$', '', 'g') ELSE '' END, '' ORDER BY turn) AS asked FROM conversations GROUP BY conv_id)
SELECT 'openhermes-roleplay-' || conv_id AS id, CAST(len(r) AS INT) + 1 AS n, asked FROM c WHERE r[-1] = 'assistant' AND len(list_filter(r, lambda x: x NOT IN ('system', 'user', 'assistant'))) = 0 AND conv_id % 2 = 0""")
def roleplay_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of from and value, with a system text beside them; every second is of another category."""
    named = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    turn = F.struct("turn", named.alias("from"), F.concat(F.col("text"), F.lit("<|im_end|>")).alias("value"))
    turns = _t(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("_seq")).agg(F.array_sort(F.collect_list(turn)).alias("conversations"))
    rows = turns.withColumns({"category": F.when(F.col("_seq") % 2 == 0, "roleplay").otherwise("other"), "system_prompt": F.lit("Play a part.")})
    out = adapters.roleplay_rows(rows, adapters.Context("public/roles", None, "roleplay"))
    return out.select("id", F.size("messages").alias("n"), M.user_text(F.col("messages")).alias("asked"))


@query("""SELECT 'mbpp-' || doc_id AS id, 'Task ' || doc_id || chr(10) || chr(10) || 'Name the function `g' || doc_id || '` and use exactly this signature: `def g' || doc_id || '(x, y):`' AS prompt, 'g' || doc_id AS name, 1::INT AS tests FROM documents WHERE doc_id % 4 <> 0""")
def unit_test_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two splits of tasks in one; every fourth has no tests."""
    name = F.concat(F.lit("g"), _n().cast("string"))
    tests = F.when(_n() % 4 != 0, F.array(F.concat(F.lit("assert "), name, F.lit("(1, 2)")))).otherwise(F.array().cast("array<string>"))
    rows = _t(spark, sf_dir, "documents").select(_n().alias("_seq"), _n().alias("task_id"), F.concat(F.lit("Task "), _n().cast("string")).alias("prompt"), F.concat(F.lit("def "), name, F.lit("(x,\n  y):\n  return x")).alias("code"), tests.alias("test_list"), F.array(F.lit("import math")).alias("test_imports"))
    whole = rows.filter("task_id % 2 = 0").unionByName(rows.filter("task_id % 2 = 1"))
    out = adapters.unit_test_rows(whole, adapters.Context("public/tasks", None, "coding"))
    return out.select("id", M.prompt_text(F.col("messages")).alias("prompt"), F.col("verify.name").alias("name"), F.size("verify.tests").alias("tests"))


@query("""SELECT 'apps-' || doc_id AS id, 2::INT AS pairs, CAST(doc_id AS VARCHAR) AS first_in FROM documents WHERE doc_id % 5 <> 0""")
def stdin_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of input and output; one is no text and goes, every fifth row has none."""
    n = _n().cast("string")
    given = F.when(_n() % 5 == 0, F.lit('{"inputs": [], "outputs": []}')).otherwise(F.concat(F.lit('{"inputs": ["'), n, F.lit('", 5, "b", "c"], "outputs": ["1", "2", "3"]}')))
    rows = _t(spark, sf_dir, "documents").select(_n().alias("_seq"), _n().alias("problem_id"), F.concat(F.lit("Read "), n).alias("question"), given.alias("input_output"))
    return adapters.stdin_rows(rows, adapters.Context("public/judge", None, "coding")).select("id", F.size("verify.pairs").alias("pairs"), F.element_at(F.element_at("verify.pairs", 1), 1).alias("first_in"))


@query("""SELECT string_agg('Q: How long is ' || doc_id || '?' || chr(10) || 'A: It is' || chr(10) || n_chars, chr(10) ORDER BY doc_id) || chr(10) || chr(10) AS prompt FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 8)""")
def few_shot_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight solved examples before a question."""
    rows = _t(spark, sf_dir, "documents").select(_n().alias("_seq"), F.concat(F.lit("How long is "), _n().cast("string"), F.lit("?")).alias("question"), F.concat(F.lit("It is\n#### "), _text("n_chars")).alias("answer"))
    return V.few_shot(rows)


# Dialogs with tools.

_TOOL = '{"type": "function", "function": {"name": "size", "parameters": {"type": "object"}}}'


def _tool_dialogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dialog for each document. Every third result answers a call that was not made; every fifth call's tool is not declared."""
    size = _text("n_chars")
    call = F.struct(F.lit("c1").alias("id"), F.lit("function").alias("type"), F.when(_n() % 5 == 0, "put").otherwise("size").alias("name"), F.to_json(F.struct(_n().alias("doc"), _text("lang").alias("lang"))).alias("arguments"))
    turns = F.array(
        M.text_message("user", F.concat(F.lit("How long is "), _n().cast("string"), F.lit("?"))),
        M.message("assistant", F.array(M.text_part(F.lit(""))), F.array(call)),
        M.message("tool", F.array(M.text_part(size)), call_id=F.when(_n() % 3 == 0, "c9").otherwise("c1")),
        M.text_message("assistant", F.concat(F.lit("It has "), size, F.lit(" characters."))),
    )
    return _t(spark, sf_dir, "documents").select(
        "doc_id", _n().cast("string").alias("id"), F.lit("coding").alias("domain"), F.lit("prebuilt").alias("origin"), F.struct(_text("source").alias("name")).alias("source"), turns.alias("messages"),
        F.array(F.lit(_TOOL)).alias("tools"), F.array().cast(f"array<{S.IMAGE}>").alias("images"), F.lit(0).alias("tokens"),
    )


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'tool result ''c9'' has no preceding call; call ''c1'' at message 1 has no tool result' ELSE '' END AS problems,
concat_ws('; ', CASE WHEN doc_id % 5 = 0 THEN 'undeclared tool ''put'' at 1' END, CASE WHEN doc_id % 3 = 0 THEN 'tool result without a preceding call at 2; call ''c1'' at 1 has no tool result' END) AS turn_problems FROM documents""")
def tool_dialog_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tool_dialogs(spark, sf_dir)
    return rows.select("doc_id", F.array_join(M.validate_trajectory(), "; ").alias("problems"), F.array_join(M.check_turns(F.col("messages"), F.col("tools")), "; ").alias("turn_problems"))


def _shown_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    parts = [
        quoted(f"<|im_start|>system\n# Tools\n\nYou have access to the following functions:\n\n<tools>\n{_TOOL}\n</tools>{M._RULES}<|im_end|>\n<|im_start|>user\nHow long is "), "doc_id",
        quoted("?<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\n<tool_call>\n<function="), "CASE WHEN doc_id % 5 = 0 THEN 'put' ELSE 'size' END", quoted(">\n<parameter=doc>\n"), "doc_id",
        quoted("\n</parameter>\n<parameter=lang>\n"), "coalesce(lang, '')", quoted("\n</parameter>\n</function>\n</tool_call><|im_end|>\n<|im_start|>user\n<tool_response>\n"), "coalesce(CAST(n_chars AS VARCHAR), '')",
        quoted("\n</tool_response><|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\nIt has "), "coalesce(CAST(n_chars AS VARCHAR), '')", quoted(" characters.<|im_end|>\n"),
    ]
    return f"SELECT doc_id, sha256({' || '.join(parts)}) AS shown, '' AS problems FROM documents"


@query(_shown_sql())
def tool_dialogs_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chat format of dialogs with tools (its hash), and what the render gate finds."""
    rows = _tool_dialogs(spark, sf_dir)
    return rows.select("doc_id", F.sha2(M.rendered(F.col("messages"), F.col("tools")), 256).alias("shown"), F.array_join(M.render_problems(F.col("messages"), F.col("tools")), "; ").alias("problems"))


@query("SELECT doc_id, doc_id || '-call-3' AS call_id, 1::INT AS results FROM documents")
def tool_call_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls under ids of the row's own, and the tool turns behind the call."""
    m = F.col("messages")
    return _tool_dialogs(spark, sf_dir).select("doc_id", F.element_at(M.remapped(M.tool_calls_in(m), F.col("id"), F.lit(3)), 1)["id"].alias("call_id"), F.size(M.tool_run(m, F.lit(1))).alias("results"))


@query(f"SELECT CAST(doc_id AS VARCHAR) AS id, '{_TOOL}' AS tool, 'How long is ' || doc_id || '?' AS example FROM documents")
def tool_prompt_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.tool_seeds(_tool_dialogs(spark, sf_dir))


@query("""SELECT 'dict' AS type, count(*) AS n FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT 'int', count(*) FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT 'str', count(*) FROM documents WHERE doc_id % 2 = 0 AND doc_id % 3 = 0 HAVING count(*) > 0""")
def tool_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliased type names in tools' schemas."""
    spec = lambda whole, a, b: F.lit('{"type": "function", "function": {"name": "f", "parameters": {"type": "%s", "properties": {"a": {"type": "%s"}, "b": {"type": "%s"}}}}}' % (whole, a, b))
    tool = F.when(_n() % 2 != 0, spec("object", "integer", "string")).when(_n() % 3 == 0, spec("dict", "int", "str")).otherwise(spec("dict", "int", "string"))
    return sinks.alias_counts(_t(spark, sf_dir, "documents").select(F.array(tool).alias("tools")))


@query("SELECT count(*) AS rows, 0::BIGINT AS failures, 2 * count(*) AS opened, 2 * count(*) AS closed, true AS balanced, true AS probe, true AS opens FROM documents")
def render_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.render_report(_tool_dialogs(spark, sf_dir))


# Images.


def _pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two texts with an image of the row's own and one of its language; every fourth row has an empty image, every ninth no answer."""
    head = F.unhex(F.lit("89504E470D0A1A0A"))
    image = lambda x: F.struct(F.concat(head, x.cast("binary")).alias("bytes"))
    images = F.array(image(_text("lang")), F.struct(F.when(_n() % 4 == 0, F.lit("").cast("binary")).otherwise(F.concat(head, _n().cast("string").cast("binary"))).alias("bytes")))
    texts = F.array(F.struct(F.lit(" What is it? ").alias("user"), F.when(_n() % 9 == 0, "").otherwise(_text("source")).alias("assistant")))
    return _t(spark, sf_dir, "documents").select(_n().alias("_seq"), images.alias("images"), texts.alias("texts"))


_HEAD = "from_hex('89504E470D0A1A0A')"


@query(f"""SELECT 'cauldron-chart2text-' || doc_id AS id, sha256({_HEAD} || encode(lang)) AS first_sha, sha256({_HEAD} || encode(CAST(doc_id AS VARCHAR))) AS second_sha, 2::INT AS refs FROM documents WHERE doc_id % 4 <> 0 AND doc_id % 9 <> 0""")
def image_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = adapters.image_rows(_pictures(spark, sf_dir), adapters.Context("public/pictures", "chart2text", "reasoning"))
    shas = M.image_shas(F.col("messages"))
    return out.select("id", F.element_at(shas, 1).alias("first_sha"), F.element_at(shas, 2).alias("second_sha"), F.size("images").alias("refs"))


@query("SELECT 'visionholdout-' || c || '-' || doc_id AS id, c AS config FROM documents, (VALUES ('ai2d', 0), ('tqa', 1)) v(c, k) WHERE doc_id % 2 = k AND doc_id % 4 <> 0 AND doc_id % 9 <> 0 QUALIFY row_number() OVER (PARTITION BY c ORDER BY doc_id) <= 25")
def vision_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 sound rows of each configuration; a configuration that is not of the list gives none."""
    rows = _pictures(spark, sf_dir)
    return corpus.holdout({"ai2d": rows.filter("_seq % 2 = 0"), "tqa": rows.filter("_seq % 2 = 1"), "other": rows}, "public/pictures", 25)[0].select("id", "source.config")


@query(f"SELECT DISTINCT sha256({_HEAD} || encode(lang)) AS sha256 FROM documents WHERE lang NOT IN ('en', 'de')")
def images_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of rows that a store of two languages' images lacks."""
    rows = _t(spark, sf_dir, "documents").select("lang", F.array(F.sha2(F.concat(F.unhex(F.lit("89504E470D0A1A0A")), _text("lang").cast("binary")), 256)).alias("shas"))
    return sinks.unresolved_images(rows, rows.filter("lang IN ('en', 'de')").select(F.explode("shas").alias("sha256")).distinct(), "shas")


# Counts, rates and measures.


@query("SELECT lang AS domain, count(*) AS cap FROM documents GROUP BY lang")
def domain_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.caps_by_domain(_catalog(_docs(spark, sf_dir)))


@query(f"SELECT source, domain, count(*) AS attempted FROM ({_JOINED}) GROUP BY source, domain HAVING count(*) < 20")
def thin_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.thin_samples(A.pass_rates(_labelled(spark, sf_dir), F.col("quality") == 1, ["source", "domain"]), 20).select("source", "domain", "attempted")


@query(f"SELECT source || '|' || domain AS key, count(*) AS attempted, count(*) FILTER (quality = 1) AS accepted, round_even(count(*) FILTER (quality = 1) / count(*), 4) AS pass_rate FROM ({_JOINED}) GROUP BY source, domain")
def source_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.source_counts(_labelled(spark, sf_dir).select(F.struct(F.col("source").alias("name")).alias("source"), "domain", (F.col("quality") == 1).alias("accepted")))


@query(f"SELECT domain, count(*) AS n, count(*) FILTER (quality = 1) AS hits, round(count(*) FILTER (quality = 1) / count(*), 6) AS accuracy FROM ({_JOINED}) GROUP BY domain")
def accuracy_by_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.accuracy(_labelled(spark, sf_dir).withColumn("hit", F.col("quality") == 1), ["domain"]).withColumn("accuracy", F.round("accuracy", 6))


@query("""WITH p AS (SELECT event_type, event_id % 2 AS run, round(exp(sum(value / 100) / count(*)), 4) AS ppl FROM events GROUP BY ALL)
SELECT event_type, round(abs(max(CASE WHEN run = 0 THEN ppl END) - max(CASE WHEN run = 1 THEN ppl END)), 4) AS spread FROM p GROUP BY event_type""")
def run_spreads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("event_type", (F.col("event_id") % 2).alias("run"), (F.col("value") / 100).alias("nll"), F.lit(1).alias("n"))
    return A.run_spread(A.perplexity(rows, ["event_type", "run"]), ["event_type"]).withColumn("spread", F.round("spread", 4))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 5")
def common_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.most_common(_t(spark, sf_dir, "documents"), "source", 5)


@query(f"SELECT doc_id, CAST(greatest(0, floor(({_TOKENS} - 33) / 128)) AS BIGINT) AS pages, CAST(greatest(0, {_TOKENS} - 160) AS BIGINT) AS vals FROM documents")
def cache_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key pages and value tokens that are quantized once a text's tokens are cached."""
    return _docs(spark, sf_dir).select("doc_id", Q.pages_retired(F.col("tokens")).alias("pages"), Q.values_retired(F.col("tokens")).alias("vals"))


@query("""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS p, list_reverse(CAST(embedding AS DOUBLE[])) AS q FROM embeddings),
z AS (SELECT vec_id, p, q, ln(list_sum(list_transform(p, lambda x: exp(x)))) AS zp, ln(list_sum(list_transform(q, lambda x: exp(x)))) AS zq FROM v)
SELECT vec_id, round(list_sum(list_transform(list_zip(p, q), lambda t: exp(t[1] - zp) * ((t[1] - zp) - (t[2] - zq)))), 6) AS kl FROM z""")
def logit_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as logits, against itself backwards."""
    p = F.col("embedding").cast("array<double>")
    return _t(spark, sf_dir, "embeddings").select("vec_id", F.round(Q.kl(p, F.reverse(p)), 6).alias("kl"))


@query("""WITH t AS (SELECT user_id AS win, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, value AS nll FROM events)
SELECT win, round(sum(nll) FILTER (pos < 8), 4) AS prefill_nll, count(*) FILTER (pos < 8) AS prefill_n, round(sum(nll) FILTER (pos >= 8), 4) AS decode_nll, count(*) FILTER (pos >= 8) AS decode_n FROM t WHERE pos > 0 GROUP BY win""")
def window_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as a window of losses, the first eight of them prefilled."""
    pos = F.row_number().over(W.partitionBy("user_id").orderBy("event_id")) - 1
    rows = _t(spark, sf_dir, "events").select(F.col("user_id").alias("window"), pos.alias("pos"), F.col("value").alias("nll"))
    return Q.window_nll(rows, 8).select(F.col("window").alias("win"), F.round("prefill_nll", 4).alias("prefill_nll"), "prefill_n", F.round("decode_nll", 4).alias("decode_nll"), "decode_n")


# The guard and the merge.


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS id, 'seeded' AS shard FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT CAST(doc_id AS VARCHAR), 'survivor' FROM labels JOIN documents USING (doc_id) WHERE {_VERDICT} = 'keep'""")
def shards_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two shards of documents, the decided rows replaced by the rollouts' survivors."""
    rows = _docs(spark, sf_dir).select("id", "doc_id", "domain")
    seeded = rows.drop("doc_id").withColumn("shard", F.lit("seeded"))
    verdicts = A.rollout_verdicts(_rollouts(spark, sf_dir), 2, "doc_id").withColumn("id", F.col("doc_id").cast("string"))
    survivors = rows.join(verdicts.filter("verdict = 'keep'").select("doc_id"), "doc_id", "left_semi").select("id", "domain", F.lit("survivor").alias("shard"))
    even = F.col("id").cast("long") % 2 == 0
    return G.merged([seeded.filter(even), seeded.filter(~even)], verdicts, survivors, 1 << 62).select("id", "shard")


_HITS = """r(doc_id, text) AS (SELECT doc_id, text FROM documents UNION ALL SELECT 1000000000 + item_id, upper(text) FROM benchmark WHERE item_id % 2 = 0 UNION ALL SELECT 2000000000 + item_id, text || '!' FROM benchmark),
p(doc_id, text) AS (FROM r UNION ALL SELECT -1 - item_id, text FROM benchmark)"""


@query(_pairs_sql("p").replace("WITH ", f"WITH {_HITS}, ", 1) + f""", hit AS (SELECT doc_id FROM r WHERE sha256({_NORM}) IN (SELECT sha256({_NORM}) FROM benchmark))
SELECT doc_id, 'exact' AS kind FROM hit UNION ALL SELECT DISTINCT b, 'near' FROM e WHERE est >= 0.85 AND a < 0 AND b >= 0 AND b NOT IN (SELECT doc_id FROM hit) AND b IN (SELECT doc_id FROM r WHERE text <> '')""")
def contam_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact and near hits of whole texts among documents and copies of the evaluation texts, in other letters or with a mark behind them."""
    evals = _t(spark, sf_dir, "benchmark")
    rows = dealt(_t(spark, sf_dir, "documents")).select("doc_id", "text")
    rows = rows.unionByName(evals.filter("item_id % 2 = 0").select((F.col("item_id") + 1_000_000_000).alias("doc_id"), F.upper("text").alias("text")))
    rows = rows.unionByName(evals.select((F.col("item_id") + 2_000_000_000).alias("doc_id"), F.concat("text", F.lit("!")).alias("text")))
    return C.collisions(rows, evals, row_id="doc_id")
