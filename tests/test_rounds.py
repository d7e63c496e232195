"""Dialogs made in rounds: what is recorded is not asked again, images reach the provider, first turns are made."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from lodeweave.operators import generation as G
from lodeweave.sources import sinks as K
from tests.test_dialogs import GOOD, TOOL, Caller, dialogs, msg


class Refuses:
    def __call__(self, messages, tools, seed):
        raise AssertionError("asked")


class Counts:
    """Answers with the number of turns it was shown; calls while the last turn is no result and there are tools."""

    def __call__(self, messages, tools, seed):
        if messages[-1]["text"] == "fail":
            raise ValueError("no")
        if tools and messages[-1]["role"] == "user":
            return {"content": f"call {len(messages)}", "tool_calls": [{"id": "c", "name": "get", "arguments": "{}"}]}
        return {"content": f"seen {len(messages)}" if tools is not None else "made up ", "tool_calls": []}


def shape(messages):
    return [(m.role, m.parts[0].text) for m in messages]


def test_turns_are_recorded(spark):
    two = [*GOOD, msg("user", "and there?"), msg("assistant", "", [("c2", "get", "{}")]), msg("tool", "rain", call_id="c2"), msg("assistant", "Rain.")]
    rows = dialogs(spark, (GOOD, [TOOL]), (two, [TOOL]), ([msg("user", "fail"), msg("assistant", "a")], None))
    got, new = G.regenerated(rows, G.no_cache(spark), Counts())
    found = {r.id: shape(r.messages) for r in got.collect()}
    first = [("user", "weather?"), ("assistant", "call 1"), ("tool", "sunny"), ("assistant", "seen 3")]
    assert found == {"r0": first, "r1": first + [("user", "and there?"), ("assistant", "call 5"), ("tool", "rain"), ("assistant", "seen 7")]}
    assert [c.id for r in got.filter("id = 'r1'").collect() for m in r.messages for c in m.tool_calls or []] == ["r1-call-0", "r1-call-1"]
    recorded = spark.createDataFrame(new.collect(), new.schema)
    assert recorded.count() == 6
    again, more = G.regenerated(rows, recorded, Refuses())
    assert {r.id: shape(r.messages) for r in again.collect()} == found and more.count() == 0
    part, more = G.regenerated(rows.filter("id = 'r1'"), recorded.limit(0).unionByName(recorded.filter("completion.content like 'call 1'")), Counts())
    assert {r.id: shape(r.messages) for r in part.collect()} == {"r1": found["r1"]} and more.count() == 3  # goes on at the first missing turn
    assert not G.regenerated(rows, G.no_cache(spark), None)[0].count()


def test_assistant_turns_never_meet(spark):
    rows = dialogs(spark, ([msg("user", "q"), msg("assistant", "a"), msg("assistant", "b"), msg("user", "r"), msg("assistant", "c")], []))
    (r,) = G.regenerated(rows, G.no_cache(spark), Counts())[0].collect()
    assert shape(r.messages) == [("user", "q"), ("assistant", "seen 1")]


def test_simulated_dialogs(spark):
    seeds = spark.createDataFrame([("s", "coding", "q", [TOOL]), ("t", "coding", " ", [TOOL]), ("u", "coding", None, [TOOL]), ("v", "coding", "fail", [])], "id string, domain string, first_user string, tools array<string>")
    got, new = G.simulated(seeds, G.no_cache(spark), Counts())
    found = {r.id: r for r in got.collect()}
    assert {k: shape(r.messages) for k, r in found.items()} == {
        "s": [("user", "q"), ("assistant", "call 1"), ("tool", "made up"), ("assistant", "seen 3")], "u": [("user", "made up"), ("assistant", "call 1"), ("tool", "made up"), ("assistant", "seen 3")],
    }
    assert found["s"].messages[2].tool_call_id == "c" and json.loads(found["s"].meta) == {"simulated": True}
    recorded = spark.createDataFrame(new.collect(), new.schema)
    again, more = G.simulated(seeds.filter("id <> 'v'"), recorded, Refuses())
    assert {r.id: shape(r.messages) for r in again.collect()} == {k: shape(r.messages) for k, r in found.items()} and more.count() == 0
    assert [r.id for r in G.simulated(seeds, G.no_cache(spark), Caller(), most_turns=1)[0].collect()] == ["v"]  # it has no tools to call


class Sees:
    def __call__(self, messages, tools, seed):
        return {"content": json.dumps(G.wire_message(messages[-1])["content"]), "tool_calls": []}


def test_images_reach_the_provider(spark):
    png = b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + (32).to_bytes(4, "big") + (16).to_bytes(4, "big")
    store = K.image_store(spark.createDataFrame([(bytearray(png),)], "content binary"))
    sha = store.first().sha256
    rows = dialogs(spark, ([msg("user", parts=[("text", "see", None), ("image", None, sha)])], None), ([msg("user", parts=[("text", "see", None), ("image", None, "gone")])], None), ([msg("user", "plain")], None))
    got = {r.id: r for r in G.run_pool(rows, G.no_cache(spark), Sees(), store=store)[0].select("id", "completion.content", "reason", "detail").collect()}
    parts = json.loads(got["r0"].content)
    assert [p["type"] for p in parts] == ["text", "image_url"] and parts[1]["image_url"]["url"].startswith("data:image/png;base64,iVBOR")
    assert got["r1"].reason == "teacher_error" and "gone" in got["r1"].detail and json.loads(got["r2"].content) == "plain"
    asked = rows.filter("id = 'r0'").withColumn("key", F.col("id"))
    assert [len(r.urls) for r in G.image_urls(asked, store).collect()] == [1]
