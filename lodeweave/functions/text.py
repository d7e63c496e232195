"""Column functions on texts: normal forms, keys, counts, rejection predicates, answers and code. All of them run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodeweave import schema as S

ColumnOrName = Column | str
_FENCE = r"(?s)```(?:python)?\s*(.*?)```"
_BOXED = r"\\boxed\{([^{}]*)\}"
_FINAL = r"####\s*([^\n]+)"
_NUMBER = r"-?\d[\d,]*(?:\.\d+)?"


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, use) -> Column:
    """use(value), with the value computed once for a row; within lambdas a column expression would be computed for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(x: ColumnOrName) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def is_blank(x: ColumnOrName) -> Column:
    return F.coalesce(strip(x), F.lit("")) == ""


def normalise(x: ColumnOrName) -> Column:
    return F.trim(F.regexp_replace(F.lower(_c(x)), r"(?U)\s+", " "))


def text_key(x: ColumnOrName) -> Column:
    return F.sha2(normalise(x), 256)


def row_key(x: ColumnOrName, images: Column) -> Column:
    """Identity of a row: its text, and the images it carries if any."""
    return F.when(F.size(images) > 0, F.concat(text_key(x), F.lit("|"), F.array_join(F.array_sort(images), ","))).otherwise(text_key(x))


def content_id(x: ColumnOrName, length: int = 12) -> Column:
    return F.substring(F.sha2(_c(x), 256), 1, length)


def seed_number(key: ColumnOrName) -> Column:
    """The number that the first eight hex digits of a key stand for."""
    return F.conv(F.substring(_c(key), 1, 8), 16, 10).cast("long")


def count_tokens(x: ColumnOrName) -> Column:
    return F.greatest(F.lit(1), F.floor(F.char_length(_c(x)) / 4)).cast("long")


def non_latin_ratio(x: ColumnOrName) -> Column:
    return F.regexp_count(_c(x), F.lit(S.NON_LATIN)) / F.greatest(F.lit(1), F.char_length(_c(x)))


def prompt_reject_reason(x: ColumnOrName, tokens: Column) -> Column:
    low, high = S.PROMPT_TOKENS
    return (
        F.when(is_blank(x), "empty_prompt").when(tokens < low, "prompt_too_short").when(tokens > high, "prompt_too_long")
        .when(non_latin_ratio(x) > S.NON_LATIN_MOST, "non_english")
    )


def response_reject_reason(x: ColumnOrName, tokens: Column, least: int = S.ANSWER_TOKENS[0]) -> Column:
    return (
        F.when(is_blank(x), "empty_assistant")
        .when(F.regexp_count(_c(x), F.lit("<think>")) != F.regexp_count(_c(x), F.lit("</think>")), "unbalanced_think_tags")
        .when(tokens < least, "too_short").when(tokens > S.ANSWER_TOKENS[1], "too_long")
    )


def repeat_ratio(x: ColumnOrName, n: int = 8) -> Column:
    """Repeats over all word n-grams; 0 below 2n words."""
    def of(words: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))
        return let(grams, lambda g: F.when(F.size(words) < 2 * n, F.lit(0.0)).otherwise(1 - F.size(F.array_distinct(g)) / F.size(g)))

    return let(F.split(strip(x), r"(?U)\s+"), of)


def assign_domain(x: ColumnOrName, declared: ColumnOrName) -> Column:
    """A declared domain of the list stands; another is judged by the first table with a keyword in the text."""
    low, out = F.lower(_c(x)), F.when(_c(declared).isin(*S.DOMAINS), _c(declared))
    for domain, words in S.KEYWORDS.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(low, F.lit(word))
        out = out.when(hit, domain)
    return out.otherwise(_c(declared))


def clean_markup(x: ColumnOrName) -> Column:
    out = _c(x)
    for token in S.MARKUP:
        out = F.replace(out, F.lit(token), F.lit(""))
    return strip(out)


def is_greeting(x: ColumnOrName) -> Column:
    return F.regexp_replace(F.lower(strip(x)), r"[!.]+$", "").isin(*S.GREETINGS)


def strip_think(x: ColumnOrName) -> Column:
    return strip(F.regexp_replace(_c(x), r"(?s)<think>.*?</think>", ""))


def _last(found: Column) -> Column:
    return F.try_element_at(found, F.lit(-1))


def gold_boxed(x: ColumnOrName) -> Column:
    return strip(_last(F.regexp_extract_all(_c(x), F.lit(_BOXED), F.lit(1))))


def gold_hashes(x: ColumnOrName) -> Column:
    return strip(_last(F.regexp_extract_all(_c(x), F.lit(_FINAL), F.lit(1))))


def first_line(x: ColumnOrName) -> Column:
    return strip(F.element_at(F.split(_c(x), r"\R", 2), 1))


def extract_answer(x: ColumnOrName) -> Column:
    clean = strip_think(x)
    return F.coalesce(gold_boxed(clean), gold_hashes(clean), strip(_last(F.split(clean, r"\R"))))


def normalise_answer(x: ColumnOrName) -> Column:
    plain = F.replace(F.translate(F.lower(strip(x)), ",$", ""), F.lit("\\%"), F.lit("%"))
    return F.regexp_replace(F.regexp_replace(plain, r"(?U)\s+", " "), r"\.+$", "")


def final_number(x: ColumnOrName) -> Column:
    return _last(F.regexp_extract_all(F.replace(_c(x), F.lit(","), F.lit("")), F.lit(r"-?\d+(?:\.\d+)?"), F.lit(0)))


def check_answer(completion: ColumnOrName, gold: ColumnOrName) -> Column:
    want = normalise_answer(gold)
    last = _last(F.regexp_extract_all(strip_think(completion), F.lit(_NUMBER), F.lit(0)))
    numeric = F.regexp_like(want, F.lit(f"^(?:{_NUMBER})$")) & F.coalesce(normalise_answer(last) == want, F.lit(False))
    return (normalise_answer(extract_answer(completion)) == want) | numeric


def code_blocks(x: ColumnOrName) -> Column:
    return F.transform(F.regexp_extract_all(_c(x), F.lit(_FENCE), F.lit(1)), strip)


def extract_code(completion: ColumnOrName, name: Column | None = None) -> Column:
    """The fenced block that defines `name`, else the first with a definition, else the last; without fences the text."""
    blocks = code_blocks(completion)
    name = F.lit(None).cast("string") if name is None else name
    named = F.filter(blocks, lambda b: F.regexp_like(b, F.concat(F.lit(r"(?m)^\s*def\s+\Q"), name, F.lit(r"\E\s*\("))))
    defines = F.filter(blocks, lambda b: F.regexp_like(b, F.lit(r"(?m)^\s*def\s+\w+\s*\(")))
    return F.coalesce(F.try_element_at(named, F.lit(1)), F.try_element_at(defines, F.lit(1)), _last(blocks), strip_think(completion))


def signature(code: ColumnOrName) -> Column:
    """struct(name, rendered) of the first definition, or null."""
    pattern = r"(?m)^\s*def\s+([A-Za-z_]\w*)\s*\(([^)]*)\)"
    name, params = F.regexp_extract(_c(code), pattern, 1), F.regexp_extract(_c(code), pattern, 2)
    params = F.regexp_replace(strip(F.regexp_replace(params, r"(?U)\s+", " ")), ",+$", "")
    return F.when(F.coalesce(name, F.lit("")) != "", F.struct(name.alias("name"), F.concat(name, F.lit("("), params, F.lit(")")).alias("rendered")))


def contains_text(x: ColumnOrName, part: Column, fold: bool = False) -> Column:
    return F.contains(F.lower(_c(x)), F.lower(part)) if fold else F.contains(_c(x), part)


def pad_to(x: ColumnOrName, filler: str, tokens: int) -> Column:
    """x with fillers behind it until it has the tokens."""
    missing = F.greatest(F.lit(0), F.ceil((4 * tokens - F.char_length(_c(x))) / len(filler))).cast("int")
    return F.concat(_c(x), F.repeat(F.lit(filler), missing))


def haystack(needle: Column, filler: str, times: int, depth: float) -> Column:
    """A needle within repeated filler, at a share of its length."""
    before = int(times * depth)
    return F.concat(F.lit(filler * before), needle, F.lit(filler * (times - before)))


def blocks_of(x: ColumnOrName, tag: str) -> Column:
    """What stands in each <tag>; a tag that does not end takes the rest."""
    parts = F.split(_c(x), f"<{tag}>")
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: strip(F.element_at(F.split(p, f"</{tag}>", 2), 1)))


def fold_reasoning(content: ColumnOrName, reasoning: ColumnOrName) -> Column:
    """The reasoning of a side field before the content, in think tags, unless the content has them."""
    return F.when(is_blank(reasoning) | F.contains(F.coalesce(_c(content), F.lit("")), F.lit("<think>")), F.coalesce(_c(content), F.lit(""))).otherwise(
        F.concat(F.lit("<think>\n"), strip(reasoning), F.lit("\n</think>\n\n"), F.coalesce(_c(content), F.lit("")))
    )
