"""The canonical row of a corpus, and the fixed values of its columns."""

from __future__ import annotations

# Fixed values that results depend on.
DOMAINS = ("reasoning", "coding", "roleplay", "uncensored")
DOMAIN_SHARE = {"reasoning": 0.30, "coding": 0.30, "roleplay": 0.20, "uncensored": 0.20}
ORIGINS = ("prebuilt", "teacher")
PART_TYPES = ("text", "image")
ROLES = ("system", "user", "assistant", "tool")
GREETINGS = (
    "hi", "hi there", "hello", "hello there", "hey", "hey there", "good morning", "good afternoon",
    "good evening", "how are you", "how are you doing", "how's it going", "greetings", "yo",
)
KEYWORDS = {
    "reasoning": ("solve", "prove", "theorem", "derive", "calculate", "equation", "integral"),
    "coding": ("function", "def ", "class ", "compile", "refactor", "traceback", "import "),
    "roleplay": ("pretend", "roleplay", "character", "story", "persona", "*smiles*"),
    "uncensored": ("jailbreak", "bypass", "unrestricted", "no restrictions", "as an ai without"),
}
TYPE_ALIASES = {
    "dict": "object", "int": "integer", "float": "number", "str": "string", "text": "string",
    "bool": "boolean", "list": "array", "tuple": "array", "set": "array",
}
MARKUP = ("<|im_end|>", "<|im_start|>", "<|endoftext|>", "<|eot_id|>")
NON_LATIN = r"[\u0400-\u04ff\u0600-\u06ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af]"
NON_LATIN_MOST = 0.02
PROMPT_TOKENS = (4, 8192)
ANSWER_TOKENS = (16, 16384)
TURN_TOKENS = 4
MAX_TURNS = 8
SPLIT_SEED = 17
REFUSAL_HOLDOUT = 500

PART = "struct<type: string, text: string, sha256: string>"
CALL = "struct<id: string, type: string, name: string, arguments: string>"
#: parts null: the content was neither a text nor a list.
MESSAGE = f"struct<role: string, parts: array<{PART}>, tool_calls: array<{CALL}>, tool_call_id: string, scaffold: boolean>"
IMAGE = "struct<sha256: string, path: string, w: int, h: int, origin_url: string>"
VERIFY = "struct<type: string, setup: string, tests: array<string>, name: string, pairs: array<array<string>>, gold: string>"
SOURCE = "struct<name: string, config: string, row: bigint, license: string>"
#: tools: one JSON text for each entry. meta: JSON text. _seq: the order that "first wins" goes by.
CANONICAL = (
    f"id string, domain string, origin string, source {SOURCE}, messages array<{MESSAGE}>, tools array<string>, "
    f"images array<{IMAGE}>, tokens bigint, verify {VERIFY}, meta string, _seq bigint"
)
