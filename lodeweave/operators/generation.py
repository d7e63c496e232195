"""Completions for prompts: recorded ones are joined, missing ones are asked of a provider, and verdicts are made anew each run.

A provider is a picklable callable: messages (a list of dicts), tools (a list of JSON texts) and a seed in, a dict of `content`
and `tool_calls` out; an exception is a teacher error. It is called from mapInPandas, one partition per stream of requests,
and must give the same answer to the same request, as a lost task asks again. `Echo` is one without a model, for tests.

Dialogs are made in rounds: a round asks for the next turn of all open dialogs at once, under a key of the turns before it, so
recorded turns are joined as recorded answers are, and an interrupted run goes on at each dialog's first missing turn.
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave import schema as S
from lodeweave.functions import messages as M
from lodeweave.functions import text as T
from lodeweave.operators import verification as V
from lodeweave.operators.sampling import downsample
from lodeweave.sources.storage import stored

ROLLOUTS, ACCEPTED_TARGET = 2, 25_000
COMPLETION = f"struct<content: string, tool_calls: array<{S.CALL}>>"
Provider = Callable[[list[dict], list[str] | None, int], dict]


@dataclass(frozen=True)
class Echo:
    """Answers each prompt with a fixed text, or one by the last user text."""

    replies: dict[str, str] = field(default_factory=dict)
    default: str = "Understood. Here is a plain answer of some length."

    def __call__(self, messages: list[dict], tools: list[str] | None, seed: int) -> dict:
        said = next((m["text"] for m in reversed(messages) if m["role"] == "user"), "")
        return {"content": self.replies.get(said, self.default), "tool_calls": []}


@dataclass(frozen=True)
class HttpProvider:
    """An OpenAI-like chat endpoint. Server errors and broken connections are tried again with a growing wait; client errors and time-outs are not."""

    url: str
    model: str = ""
    timeout: float = 600.0
    tries: int = 4
    wait: float = 5.0
    sampling: tuple[tuple[str, float], ...] = ()

    def __call__(self, messages: list[dict], tools: list[str] | None, seed: int) -> dict:
        body = {"messages": [wire_message(m) for m in messages], "seed": seed, "model": self.model, **dict(self.sampling)}
        if tools:
            body["tools"] = [json.loads(t) for t in tools]
        request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json"})
        for attempt in range(1, self.tries + 1):
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                    return _reply(json.loads(reply.read())["choices"][0]["message"])
            except urllib.error.HTTPError as e:
                if e.code < 500 or attempt == self.tries:
                    raise
            except (urllib.error.URLError, ConnectionError) as e:
                if isinstance(getattr(e, "reason", None), TimeoutError) or attempt == self.tries:
                    raise
            time.sleep(self.wait * attempt)
        raise RuntimeError("no attempt was made")


def wire_message(m: dict) -> dict:
    out = {"role": m["role"], "content": m["text"]}
    if m.get("images"):
        out["content"] = [{"type": "text", "text": m["text"]}, *({"type": "image_url", "image_url": {"url": u}} for u in m["images"])]
    if m.get("tool_calls"):
        out["tool_calls"] = [{"id": c["id"], "type": "function", "function": {"name": c["name"], "arguments": c["arguments"]}} for c in m["tool_calls"]]
    if m.get("tool_call_id"):
        out["tool_call_id"] = m["tool_call_id"]
    return out


def _reply(message: dict) -> dict:
    content, thought = message.get("content") or "", (message.get("reasoning_content") or "").strip()
    if thought and "<think>" not in content:
        content = f"<think>\n{thought}\n</think>\n\n{content}"
    calls = [{"id": c.get("id"), "type": "function", "name": c["function"].get("name"), "arguments": c["function"].get("arguments")} for c in message.get("tool_calls") or []]
    return {"content": content, "tool_calls": calls}


def image_url(content: Column, kind: Column) -> Column:
    """A data address for an image of the store."""
    return F.concat(F.lit("data:image/"), kind, F.lit(";base64,"), F.base64(content))


def request_key(messages: Column, kind: Column) -> Column:
    """The key of a request: its kind and the messages before the turn, in one fixed serialization."""
    return F.sha2(F.to_json(F.struct(kind.alias("kind"), messages.alias("messages"))), 256)


def single_key(messages: Column, row_id: Column, rollout: Column) -> Column:
    """Rollout 0 has the key of a plain run, so its completions are used again."""
    kind = F.concat(F.lit("single:"), row_id, F.when(rollout > 0, F.concat(F.lit(":r"), rollout.cast("string"))).otherwise(F.lit("")))
    return request_key(messages, kind)


_ANSWER = f"key string, completion {COMPLETION}, error string"
_WIRE = "array<struct<sha256: string, url: string>>"


def image_urls(requests: DataFrame, store: DataFrame) -> DataFrame:
    """(key, urls) of requests with images: the data address of each image that the store (sha256, path, content) has."""
    asked = requests.select("key", F.explode(F.array_distinct(M.image_shas(F.col("messages")))).alias("sha256"))
    kind = F.substring_index("path", ".", -1)
    found = asked.join(store.select("sha256", image_url(F.col("content"), kind).alias("url")), "sha256")
    return found.groupBy("key").agg(F.collect_list(F.struct("sha256", "url")).alias("urls"))


def completed(requests: DataFrame, provider: Provider, store: DataFrame | None = None) -> DataFrame:
    """(key, completion, error) of requests (key, messages, tools). An image that is not in the store is an error of its request."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, texts, tools, urls in zip(batch["key"], batch["texts"], batch["tools"], batch["urls"], strict=True):
                try:
                    have = {} if urls is None else {u["sha256"]: u["url"] for u in urls}
                    wire = [dict(t) | {"images": [have[i] for i in (t["images"] if t["images"] is not None else ())]} for t in texts]
                    got = provider(wire, None if tools is None else list(tools), int(key[:8], 16))
                    out.append((key, {"content": got.get("content") or "", "tool_calls": got.get("tool_calls") or []}, None))
                except Exception as e:  # noqa: BLE001  whatever the provider raises is its error
                    out.append((key, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["key", "completion", "error"])

    texts = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), M.message_text(m).alias("text"), M.image_shas(F.array(m)).alias("images"), m["tool_calls"].alias("tool_calls"), m["tool_call_id"].alias("tool_call_id")))
    once = requests.dropDuplicates(["key"])
    asked = once.select("key", texts.alias("texts"), "tools")
    if store is None:
        asked = asked.withColumn("urls", F.lit(None).cast(_WIRE))
    else:
        asked = asked.join(image_urls(once, store), "key", "left")
    return asked.mapInPandas(run, _ANSWER)


def with_completions(requests: DataFrame, cache: DataFrame, provider: Provider | None, store: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(requests with completion and error, new cache entries). Without a provider missing completions are errors; store: the images."""
    have = cache.filter("completion IS NOT NULL").select("key", "completion").dropDuplicates(["key"])
    missing = requests.join(have, "key", "left_anti")
    if provider is None:
        new = missing.select("key", F.lit(None).cast(COMPLETION).alias("completion"), F.lit("not recorded").alias("error")).dropDuplicates(["key"])
    else:
        new = stored(completed(missing, provider, store), "completions")
    every = have.withColumn("error", F.lit(None).cast("string")).unionByName(new)
    return requests.join(every, "key", "left"), new.filter("error IS NULL").select("key", "completion")


def completion_row(prompts: DataFrame) -> DataFrame:
    """Prompts with a completion as examples: the assistant turn appended, tokens counted."""
    content, calls = F.col("completion.content"), F.col("completion.tool_calls")
    tokens = T.count_tokens(content) + F.when(F.size(calls) > 0, T.count_tokens(F.to_json(calls))).otherwise(0)
    turn = M.message("assistant", F.array(M.text_part(content)), F.when(F.size(calls) > 0, calls))
    return prompts.withColumns({"messages": F.concat("messages", F.array(turn)), "tokens": tokens, "origin": F.lit("teacher")})


def judged(answered: DataFrame, run_code: bool = False) -> DataFrame:
    """answered prompts as examples with accepted, reason (teacher_error, verify_failed, or a filter's) and detail."""
    rows = completion_row(answered)
    verdict = V.check_record(F.col("verify"), F.col("completion.content"), run_code)
    rows = rows.withColumn("__verdict", verdict).withColumn("__filter", M.example_reject_reason(F.col("messages"), F.col("tokens")))
    missing = F.col("completion").isNull()
    reason = F.when(missing, "teacher_error").when(~F.col("__verdict.passed"), "verify_failed").otherwise(F.col("__filter"))
    detail = F.when(missing, F.coalesce("error", F.lit("not recorded"))).when(~F.col("__verdict.passed"), F.col("__verdict.why"))
    return rows.withColumn("reason", reason).withColumn("detail", detail).withColumn("accepted", F.col("reason").isNull()).drop("__verdict", "__filter")


def run_pool(prompts: DataFrame, cache: DataFrame, provider: Provider | None, limit: int | None = None, run_code: bool = False, rollout: int = 0, store: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(judged examples, new cache entries) of a pool; limit: None is all, 0 is none."""
    if limit is not None:
        prompts = downsample(prompts, limit, S.DOMAIN_SHARE)
    asked = prompts.withColumn("key", single_key(F.col("messages"), F.col("id"), F.lit(rollout)))
    answered, new = with_completions(asked, cache, provider, store)
    return judged(answered, run_code), new


def rollouts(prompts: DataFrame, k: int = ROLLOUTS) -> DataFrame:
    """Prompts that have an oracle, k times, with the key of each rollout."""
    each = prompts.filter("verify IS NOT NULL").withColumn("rollout", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return each.withColumn("key", single_key(F.col("messages"), F.col("id"), F.col("rollout")))


def rejects(judged_rows: DataFrame, stage: str, pool: str | None = None) -> DataFrame:
    """The ledger's rows."""
    record = F.to_json(F.struct("id", "domain", "source", "messages", "tokens"))
    return judged_rows.filter(~F.col("accepted")).select(F.lit(stage).alias("stage"), "reason", "detail", F.lit(pool).cast("string").alias("pool"), "id", record.alias("record"))


def source_counts(judged_rows: DataFrame) -> DataFrame:
    """key (name|domain), attempted, accepted, pass_rate."""
    key = F.concat_ws("|", F.coalesce("source.name", F.lit("?")), "domain")
    by = judged_rows.groupBy(key.alias("key")).agg(F.count("*").alias("attempted"), F.count_if("accepted").alias("accepted"))
    return by.withColumn("pass_rate", F.bround(F.try_divide("accepted", "attempted"), 4))


# Dialogs, a turn a round.

_OPEN, _DONE, _DROPPED = "open", "done", "dropped"
_BRIEF_USER = "Play the person who talks to an assistant with tools. Write that person's first message, and nothing else: a concrete request that one of the tools can meet."
_BRIEF_TOOL = "Play the service behind a tool. You are shown one call; answer with the small JSON object that such a service would return, and nothing else."


def no_cache(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"key string, completion {COMPLETION}")


class _Rounds:
    """Requests under their prefix keys, answered from the cache first; `new` gathers what has to be recorded."""

    def __init__(self, cache: DataFrame, provider: Provider | None, store: DataFrame | None):
        self.cache, self.provider, self.store = cache, provider, store
        self.new = cache.filter("false").select("key", "completion")

    def ask(self, rows: DataFrame, role: str, messages: Column, tools: Column) -> DataFrame:
        """rows (id, ...) with completion and error; the key is of the role in the run, the dialog, and the messages."""
        kind = F.concat(F.lit(f"{role}:"), F.col("id"))
        asked = rows.withColumns({"__asked": messages, "__tools": tools})
        asked = asked.withColumn("key", request_key(F.col("__asked"), kind))
        answers, new = with_completions(asked.select("key", F.col("__asked").alias("messages"), F.col("__tools").alias("tools")).dropDuplicates(["key"]), self.cache.unionByName(self.new), self.provider, self.store)
        self.new = self.new.unionByName(new)
        return asked.join(answers.select("key", "completion", "error"), "key").drop("key", "__asked", "__tools")


def _numbered_calls(calls: Column, row_id: Column, made: Column) -> Column:
    """calls with ids that go on from `made` within the dialog, and what they lack filled in."""
    return F.transform(calls, lambda c, i: F.struct(
        F.concat(row_id, F.lit("-call-"), (made + i).cast("string")).alias("id"), F.lit("function").alias("type"),
        F.coalesce(c["name"], F.lit("")).alias("name"), F.coalesce(c["arguments"], F.lit("{}")).alias("arguments"),
    ))


def _turn(content: Column, calls: Column) -> Column:
    return M.message("assistant", F.array(M.text_part(F.coalesce(content, F.lit("")))), F.when(F.size(calls) > 0, calls))


def _up_to_gap(state: DataFrame) -> DataFrame:
    """Each open dialog with the source's turns copied up to the next assistant turn at `at` (from 0), or done if there is none."""
    n = F.size("source")
    gap = F.array_min(F.filter(F.transform("source", lambda m, i: F.when((m["role"] == "assistant") & (i >= F.col("at")), i)), lambda i: i.isNotNull()))
    found = state.withColumn("__gap", F.coalesce(gap, n))
    copied = F.transform(F.slice("source", F.col("at") + 1, F.greatest(F.col("__gap") - F.col("at"), F.lit(0))), lambda m: m.withField("tool_calls", F.lit(None).cast(f"array<{S.CALL}>")))
    opened = F.col("status") == _OPEN
    return found.withColumns({
        "turns": F.when(opened, F.concat("turns", copied)).otherwise(F.col("turns")), "at": F.when(opened, F.col("__gap")).otherwise(F.col("at")),
        "status": F.when(opened & (F.col("__gap") >= n), _DONE).otherwise(F.col("status")),
    }).drop("__gap")


def _filled(state: DataFrame) -> DataFrame:
    """state with the answer for the gap at `at` put in, and as many of its calls as the source has results for."""
    calls, run = F.coalesce("completion.tool_calls", F.array().cast(f"array<{S.CALL}>")), M.tool_run(F.col("source"), F.col("at"))
    both = state.withColumns({"__run": run, "__calls": calls}).withColumn("__kept", _numbered_calls(F.slice("__calls", 1, F.greatest(F.size("__run"), F.lit(1))), F.col("id"), F.col("made")))
    asks, last = F.size("__calls") > 0, F.try_element_at("turns", F.lit(-1))
    lost = F.col("completion").isNull() | (asks & (F.size("__run") == 0))
    meets = ~asks & F.coalesce(last["role"] == "assistant", F.lit(False))  # two assistant turns would meet
    told = F.zip_with(F.slice("__kept", 1, F.size("__run")), F.slice("__run", 1, F.greatest(F.size("__kept"), F.lit(1))), lambda c, r: M.message("tool", r["parts"], None, c["id"]))
    new = F.when(asks, F.concat(F.array(_turn(F.col("completion.content"), F.col("__kept"))), told)).otherwise(F.array(_turn(F.col("completion.content"), F.slice("__kept", 1, 0))))
    return both.select(
        "id", "source", "tools", F.when(lost | meets, F.col("turns")).otherwise(F.concat("turns", new)).alias("turns"), (F.col("at") + 1 + F.size("__run")).alias("at"),
        F.when(asks & ~lost, F.col("made") + F.size("__kept")).otherwise(F.col("made")).alias("made"), F.when(lost, _DROPPED).when(meets, _DONE).otherwise(_OPEN).alias("status"),
    )


def _ending(turns: Column) -> Column:
    """turns without tool turns at the end; null if an assistant turn is not last then."""
    other = F.array_max(F.filter(F.transform(turns, lambda m, i: F.when(m["role"] != "tool", i + 1)), lambda i: i.isNotNull()))
    cut = F.slice(turns, 1, F.coalesce(other, F.lit(0)))
    return F.when(F.try_element_at(cut, F.lit(-1))["role"] == "assistant", cut)


def _with_dialogs(rows: DataFrame, ended: DataFrame, simulated: bool) -> DataFrame:
    """rows whose dialog has ended well, with its messages, tokens and origin."""
    said = F.array_join(F.transform(M.by_role(F.col("messages"), "assistant"), lambda m: M.message_text(m)), "\n")
    full = rows.drop("messages").join(ended.filter("turns IS NOT NULL").select("id", F.col("turns").alias("messages")), "id")
    more = {"origin": F.lit("teacher"), "tokens": T.count_tokens(said)}
    if simulated:
        more["meta"] = F.lit('{"simulated":true}')
    return full.withColumns(more)


def regenerated(dialogs: DataFrame, cache: DataFrame, provider: Provider | None, store: DataFrame | None = None, most_user: int = S.MAX_TURNS, most_tool: int = S.MAX_TURNS) -> tuple[DataFrame, DataFrame]:
    """(dialogs with every assistant turn written anew, new cache entries).

    The results of the source follow the calls that they can answer. A call without a result in the source drops the
    dialog, as an error does; calls beyond the results are cut; a dialog ends before two assistant turns would meet.
    """
    asked = dialogs.filter("NOT coalesce(get_json_object(meta, '$.seed_only') = 'true', false)")
    state = asked.select("id", M.truncated(F.col("messages"), most_user, most_tool).alias("source"), "tools", F.array().cast(f"array<{S.MESSAGE}>").alias("turns"), F.lit(0).alias("at"), F.lit(0).alias("made"), F.lit(_OPEN).alias("status"))
    rounds, ended = _Rounds(cache, provider, store), None
    while True:
        state = stored(_up_to_gap(state), "dialogs")
        done = state.filter(F.col("status") != _OPEN).select("id", F.when(F.col("status") == _DONE, _ending(F.col("turns"))).alias("turns"))
        ended = done if ended is None else ended.unionByName(done)
        state = state.filter(F.col("status") == _OPEN)
        if not state.limit(1).count():
            return _with_dialogs(asked.select(dialogs.columns), ended, False).select(dialogs.columns), rounds.new
        state = _filled(rounds.ask(state, "prebuilt", F.col("turns"), F.col("tools")))


def regenerate(dialogs: DataFrame, provider: Provider, most_user: int = S.MAX_TURNS, most_tool: int = S.MAX_TURNS) -> DataFrame:
    """The dialogs of `regenerated`, with nothing recorded before."""
    return regenerated(dialogs, no_cache(dialogs.sparkSession), provider, None, most_user, most_tool)[0]


def simulated(seeds: DataFrame, cache: DataFrame, provider: Provider | None, most_turns: int = S.MAX_TURNS, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(dialogs made up from seeds (id, domain, source, tools, first_user), new cache entries): calls and their results until an answer.

    A null first turn is asked for; a blank one, given or made, drops the seed, as do errors and dialogs without an answer in
    most_turns. limit: so many seeds, in proportion to the domains.
    """
    if limit is not None:
        seeds = downsample(seeds, limit, S.DOMAIN_SHARE)
    rounds, nothing = _Rounds(cache, provider, None), F.lit(None).cast("array<string>")
    slim = stored(seeds.select("id", "tools", "first_user"), "seeds")
    brief = F.array(M.text_message("system", F.lit(_BRIEF_USER)), M.text_message("user", F.lit("Write the first message.")))
    first = rounds.ask(slim.filter("first_user IS NULL").select("id", "tools"), "simuser", brief, nothing).select("id", "tools", T.strip(F.col("completion.content")).alias("first_user"))
    begun = slim.filter("first_user IS NOT NULL").unionByName(first).filter(~F.coalesce(T.is_blank("first_user"), F.lit(True)))
    state, ended = stored(begun.select("id", "tools", F.array(M.text_message("user", F.col("first_user"))).alias("turns")), "dialogs"), None
    for _ in range(most_turns):
        calls = F.coalesce("completion.tool_calls", F.array().cast(f"array<{S.CALL}>"))
        told = rounds.ask(state, "simagent", F.col("turns"), F.col("tools")).filter("completion IS NOT NULL").withColumn("calls", calls)
        told = stored(told.select("id", "tools", F.concat("turns", F.array(_turn(F.col("completion.content"), F.col("calls")))).alias("turns"), "calls"), "dialogs")
        done = told.filter(F.size("calls") == 0).select("id", "turns")
        ended = done if ended is None else ended.unionByName(done)
        waiting = told.filter(F.size("calls") > 0)
        if not waiting.limit(1).count():
            break
        each = waiting.select("id", F.posexplode("calls").alias("i", "call"))
        shown = F.array(M.text_message("system", F.lit(_BRIEF_TOOL)), M.text_message("user", F.to_json(F.struct("call.name", "call.arguments"))))
        answers = rounds.ask(each, "simtool", shown, nothing).select("id", F.struct("i", "call", "completion").alias("x"))
        results = answers.groupBy("id").agg(F.array_sort(F.collect_list("x")).alias("xs")).filter("forall(xs, x -> x.completion IS NOT NULL)")
        tool_turns = F.transform("xs", lambda x: M.message("tool", F.array(M.text_part(T.strip(x["completion"]["content"]))), None, x["call"]["id"]))
        state = stored(waiting.join(results, "id").select("id", "tools", F.concat("turns", tool_turns).alias("turns")), "dialogs")
    return _with_dialogs(seeds.drop("first_user"), ended, True), rounds.new


def simulate(seeds: DataFrame, provider: Provider, most_turns: int = S.MAX_TURNS) -> DataFrame:
    """The dialogs of `simulated`, with nothing recorded before."""
    return simulated(seeds, no_cache(seeds.sparkSession), provider, most_turns)[0]


def tool_seeds(prompts: DataFrame) -> DataFrame:
    """(id, tool, example): each declared tool with the row's first user text."""
    text = T.strip(M.prompt_text(F.col("messages")))
    return prompts.filter(F.size("tools") > 0).select("id", F.explode("tools").alias("tool"), text.alias("example")).filter("example <> ''")


def invented(seeds: DataFrame, template: str, cache: DataFrame, provider: Provider | None, kind: str) -> DataFrame:
    """(seed, text): the first line that the provider makes of each seed; lines equal to the seed go."""
    ask = F.replace(F.lit(template), F.lit("{seed}"), F.col("seed"))
    requests = seeds.select("seed", F.array(M.text_message("user", ask)).alias("messages"), F.lit(None).cast("array<string>").alias("tools"))
    requests = requests.withColumn("key", request_key(F.col("messages"), F.lit(f"invent:{kind}")))
    answered, _ = with_completions(requests, cache, provider)
    out = answered.select("seed", T.first_line(F.col("completion.content")).alias("text")).filter("text <> ''")
    return out.filter(F.lower(F.trim("text")) != F.lower(F.trim("seed")))


def merged(shards: list[DataFrame], verdicts: DataFrame, survivors: DataFrame, target: int = ACCEPTED_TARGET) -> DataFrame:
    """All shards without the rows that the rollouts decided, with the survivors in their place; trimmed to the target.

    A teacher error decides nothing, so its row stands.
    """
    whole = shards[0]
    for more in shards[1:]:
        whole = whole.unionByName(more, allowMissingColumns=True)
    decided = verdicts.filter("verdict <> 'teacher_error'").select("id").distinct()
    out = whole.join(decided, "id", "left_anti").unionByName(survivors, allowMissingColumns=True)
    return downsample(out, target, S.DOMAIN_SHARE) if out.count() > target else out


def guard_fingerprint(judged_prompts: int, pool_prompts: int) -> None:
    if judged_prompts != pool_prompts:
        raise ValueError(f"the verdicts are for {judged_prompts} prompts with an oracle, the pools have {pool_prompts}")
