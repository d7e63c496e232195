"""Personal data by anchors: an Aho-Corasick automaton finds cues, parsers expand and validate around each.

The automaton holds at-signs, plus signs, digits, schemes and identifier cues. From an anchor a deterministic parser
walks left and right over the characters its kind allows and then validates what it found. Four base kinds follow
fixed patterns, leftmost and non-overlapping for each kind; a match that fails its check is dropped and not retried:

  email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
  ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+), each part 255 at most
  card   [0-9]([\\x20-]?[0-9])+, 13 to 19 digits that pass Luhn
  phone  \\+[0-9][\\x20().0-9-]+[0-9], 9 to 15 digits

The method adds spans of further kinds, each only behind an anchor of its own: `user` (the user part of a URL's
authority, or the address of a mailto: or tel: link), `mail2` (an address written with (at) or [at]), `iban` (checked
modulo 97), `ssn` (behind the word ssn or "social security"), `key` (a credential behind a cue such as token, secret or
password, or behind a prefix that issuers give; it must mix letters and digits), `account` (6 to 17 digits behind account,
acct, konto or routing) and `tel` (where a base phone ran on into further numbers and failed, its longest part of whole
words with 9 to 15 digits). Added spans never replace base spans.

Spans are [start, end) in code points. Cases: a null text is empty; an empty list hashes as the empty text; rows
that repeat are handled each; texts are never cut; other columns are ignored by `personal_data` and kept by `redacted`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import read_table, small_batches

Span = tuple[str, int, int]
BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("user", "mail2", "iban", "ssn", "key", "account", "tel")
_ORDER = {kind: i for i, kind in enumerate(BASE_KINDS + MORE_KINDS)}
_SCHEMES = ("://", "mailto:", "tel:")
_CUES = ("(at)", "[at]", "iban", "ssn", "social security")
_PASSWORDS = ("password", "passwd", "pwd", "passphrase")
_SECRETS = ("token", "secret", "api key", "api_key", "api-key", "apikey", "access key", "access_key", "access-key", "accesskey", "private key", "private_key", "bearer", "credential")
#: Prefixes that issuers give to credentials, and how many more characters follow at least.
_ISSUED = {"AKIA": 16, "ASIA": 16, "ghp_": 30, "gho_": 30, "github_pat_": 30, "glpat-": 16, "xoxb-": 20, "xoxp-": 20, "sk-": 20, "sk_live_": 16, "AIza": 30}
_ACCOUNTS = ("account", "acct", "konto", "routing")
_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_LOCAL, _LABEL = _ALNUM | set("._%+-"), _ALNUM | set("-")
_PHONE = _DIGITS | set(" ().-")
_SECRET = _ALNUM | set("_-./+=~")
_USERINFO = _ALNUM | set("._%+-~!$&'*=:;")


def _run(text: str, at: int, allowed: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _run_back(text: str, at: int, least: int, allowed: frozenset) -> int:
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _domain(text: str, at: int) -> int:
    """The end of label(.label)+ at `at`, or `at`."""
    end = _run(text, at, _LABEL)
    if end == at:
        return at
    first = end
    while end < len(text) and text[end] == "." and (more := _run(text, end + 1, _LABEL)) > end + 1:
        end = more
    return end if end > first else at


def _emails(text: str, ats: list[int]) -> Iterator[Span]:
    free = 0
    for at in ats:
        if at < free:
            continue
        start, end = _run_back(text, at, free, _LOCAL), _domain(text, at + 1)
        if start < at and end > at + 1:
            yield "email", start, end
            free = end


def _digit_runs(text: str, hits: list[int]) -> list[tuple[int, int]]:
    runs: list[tuple[int, int]] = []
    for i in hits:
        if runs and runs[-1][1] == i:
            runs[-1] = (runs[-1][0], i + 1)
        else:
            runs.append((i, i + 1))
    return runs


def _ips(text: str, runs: list[tuple[int, int]]) -> Iterator[Span]:
    i = 0
    while i + 3 < len(runs):
        four = runs[i : i + 4]
        if all(b[0] == a[1] + 1 and text[a[1]] == "." for a, b in zip(four, four[1:], strict=False)):
            if all(_at_most_255(text[s:e]) for s, e in four):
                yield "ip", four[0][0], four[3][1]
            i += 4
        else:
            i += 1


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _cards(text: str, runs: list[tuple[int, int]]) -> Iterator[Span]:
    i = 0
    while i < len(runs):
        j = i
        while j + 1 < len(runs) and runs[j + 1][0] == runs[j][1] + 1 and text[runs[j][1]] in " -":
            j += 1
        n = sum(e - s for s, e in runs[i : j + 1])
        if 13 <= n <= 19 and luhn("".join(text[s:e] for s, e in runs[i : j + 1])):
            yield "card", runs[i][0], runs[j][1]
        i = j + 1


def _phones(text: str, pluses: list[int]) -> Iterator[Span]:
    free = 0
    for at in pluses:
        if at < free or text[at + 1 : at + 2] not in _DIGITS or at + 1 >= len(text):
            continue
        last = _run(text, at + 2, _PHONE)
        while last > at + 2 and text[last - 1] not in _DIGITS:
            last -= 1
        if last < at + 4:  # a digit, at least one more character, and a digit
            continue
        free = last
        if 9 <= sum(c in _DIGITS for c in text[at + 1 : last]) <= 15:
            yield "phone", at, last


def _users(text: str, ends: list[tuple[int, str]]) -> Iterator[Span]:
    for at, scheme in ends:
        if scheme == "://":
            end = _run(text, at, _USERINFO)
            if end > at and text[end : end + 1] == "@" and _run(text, end + 1, _LABEL) > end + 1:
                yield "user", at, end
        elif scheme == "tel:":
            end = _run(text, at + (text[at : at + 1] == "+"), _PHONE)
            while end > at and text[end - 1] not in _DIGITS:
                end -= 1
            if 7 <= sum(c in _DIGITS for c in text[at:end]) <= 15:
                yield "user", at, end
        else:
            end = _run(text, at, _LOCAL)
            if end > at and text[end : end + 1] == "@" and (last := _domain(text, end + 1)) > end + 1:
                yield "user", at, last


def _spelled(text: str, hits: list[tuple[int, int]]) -> Iterator[Span]:
    for start, end in hits:
        left = start
        while left > 0 and text[left - 1] == " ":
            left -= 1
        first = _run_back(text, left, 0, _LOCAL)
        right = _run(text, end, frozenset(" "))
        last = _run(text, right, _LABEL)
        dots = 0
        while m := re.compile(r" ?(?:\(dot\)|\[dot\]|\.) ?(?=[A-Za-z0-9])").match(text, last):
            last = _run(text, m.end(), _LABEL)
            dots += 1
        if first < left and last > right and dots:
            yield "mail2", first, last


#: Characters of an IBAN by country.
_IBAN_SIZE = {k: int(n) for n, names in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
    "23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,DZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
    "28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
).split()) for k in names.split(",")}


def _ibans(text: str, ends: list[int]) -> Iterator[Span]:
    """The country's length is tried first, then each length from the longest to the shortest that ends a word."""
    for at in ends:
        if m := re.compile(r"[\s:#]{0,4}(?:number|no\.?|is)?[\s:#]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})").match(text, at):
            code, stops = "", {}
            for i in range(m.start(1), m.end(1)):
                if text[i] != " ":
                    code += text[i]
                    if len(code) >= 15 and text[i + 1 : i + 2] not in _ALNUM:
                        stops[len(code)] = i + 1
            for size in sorted(stops, key=lambda n: (n != _IBAN_SIZE.get(code[:2]), -n)):
                if int("".join(str(int(c, 36)) for c in code[4:size] + code[:4])) % 97 == 1:
                    yield "iban", m.start(1), stops[size]
                    break


def _ssns(text: str, ends: list[int]) -> Iterator[Span]:
    for at in ends:
        if (m := re.compile(r"[\s:#]{0,4}(?:number|no\.?|is)?[\s:#]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])").match(text, at)) and m[1][:3] not in ("000", "666") and m[1][0] != "9":
            yield "ssn", m.start(1), m.end(1)


#: Between a cue and what it tells of: a quote, an equals sign or colon or "is", another quote; or white space alone.
_ASSIGNS = re.compile(r"""s?["'\])]{0,2}\s{0,3}(?::=|={1,3}>?|:|\bis\b)\s{0,3}["'(\[]?""")
_SPACE = re.compile(r"""s?["']?\s{1,3}["']?""")
_QUOTED = re.compile(r"""(?<=["'])[^\s"']{6,128}(?=["'])""")
_ACCOUNT = re.compile(r"""s?(?:\s{0,2}(?:number|nummer|numbers|no\.?|nr\.?|id))?[\s:#=]{0,4}(?:is\s)?(?P<number>[0-9](?:[ -]?[0-9]){5,16})(?![0-9.,]?[0-9])""", re.I)


def _strong(value: str) -> bool:
    """Letters and digits mixed, and not a few characters over and over."""
    return any(c in _DIGITS for c in value) and any(c.isalpha() for c in value) and len(set(value)) >= 6


def _keys(text: str, cues: list[tuple[int, bool]], issued: list[tuple[int, int, int]]) -> Iterator[Span]:
    """Credentials behind cues (place behind the cue, is it a password) and prefixes (start, end, least length of the rest)."""
    for at, password in cues:
        assigned = _ASSIGNS.match(text, at)
        sign = assigned or _SPACE.match(text, at)
        if not sign:
            continue
        start = sign.end()
        if password and assigned and (m := _QUOTED.match(text, start)):
            yield "key", start, m.end()
            continue
        end = _run(text, start, _SECRET)
        while end > start and text[end - 1] in "./":
            end -= 1
        value = text[start:end]
        if len(value) >= (8 if password and assigned else 16) and _strong(value):
            yield "key", start, end
    for start, at, least in issued:
        if start and text[start - 1] in _ALNUM:
            continue
        end = _run(text, at, _ALNUM | set("_-"))
        if end - at >= least and _strong(text[start:end]):
            yield "key", start, end


def _accounts(text: str, ends: list[int]) -> Iterator[Span]:
    for at in ends:
        if m := _ACCOUNT.match(text, at):
            yield "account", m.start("number"), m.end("number")


def _shorter_phones(text: str, pluses: list[int], taken: list[Span]) -> Iterator[Span]:
    """Where a phone number runs on into further numbers: as many whole words of it as have 9 to 15 digits."""
    starts = {s for _, s, _ in taken}
    for at in pluses:
        if at in starts or text[at + 1 : at + 2] not in _DIGITS or at + 1 >= len(text):
            continue
        last, digits, best = _run(text, at + 2, _PHONE), 0, 0
        for i in range(at + 1, last):
            digits += text[i] in _DIGITS
            if digits > 15:
                break
            if digits >= 9 and text[i] in _DIGITS and text[i + 1 : i + 2] in ("", " "):
                best = i + 1
        if best:
            yield "tel", at, best


def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word in ("@", "+", *sorted(_DIGITS)):
        a.add_word(word, (word if word in "@+" else "0", 1))
    for cue in _SCHEMES + _CUES + _PASSWORDS + _SECRETS + _ACCOUNTS:
        for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            a.add_word(form, (cue, len(form)))
    for prefix in _ISSUED:
        a.add_word(prefix, (prefix, len(prefix)))
    a.make_automaton()
    return a


_cached: list = []


def spans_of(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by kind and start."""
    if not text:
        return [], []
    if not _cached:
        _cached.append(_automaton())
    hits: dict[str, list] = {}
    for end, (cue, size) in _cached[0].iter(text):
        hits.setdefault(cue, []).append((end + 1 - size, end + 1))
    if not hits:
        return [], []
    at = lambda cue: [s for s, _ in hits.get(cue, ())]
    runs = _digit_runs(text, at("0"))
    base = [*_emails(text, at("@")), *_ips(text, runs), *_cards(text, runs), *_phones(text, at("+"))]
    more = [
        *_users(text, sorted((e, cue) for cue in _SCHEMES for _, e in hits.get(cue, ()))),
        *_spelled(text, sorted(hits.get("(at)", []) + hits.get("[at]", []))),
        *_ibans(text, [e for _, e in hits.get("iban", ())]),
        *_ssns(text, sorted(e for cue in ("ssn", "social security") for _, e in hits.get(cue, ()))),
        *_keys(text, sorted((e, cue in _PASSWORDS) for cue in _PASSWORDS + _SECRETS for _, e in hits.get(cue, ())), sorted((s, e, n) for cue, n in _ISSUED.items() for s, e in hits.get(cue, ()))),
        *_accounts(text, sorted(e for cue in _ACCOUNTS for _, e in hits.get(cue, ()))),
        *_shorter_phones(text, at("+"), [x for x in base if x[0] == "phone"]),
    ]
    order = lambda span: (_ORDER[span[0]], span[1], span[2])
    base.sort(key=order)
    return base, sorted(dict.fromkeys(base + more), key=order)


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, a digest of the base spans, and all spans, for each row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [spans_of(x) for x in batch.column(1).to_pylist()]
            counts = [pa.array([sum(k == kind for k, _, _ in base) for base, _ in rows], pa.int64()) for kind in BASE_KINDS]
            digests = pa.array([hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in rows], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digests, pa.array([_listed(x) for _, x in rows], pa.string())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(text: str | None) -> str | None:
    """The text with each run of overlapping spans replaced by the kind of its first span, as [EMAIL]."""
    spans = sorted(spans_of(text)[1], key=lambda x: (x[1], -x[2]))
    if not spans:
        return text
    out, at, until, kind = [], 0, -1, ""
    for k, start, end in [*spans, ("", len(text) + 1, 0)]:
        if start >= until:
            if kind:
                out.append(f"[{kind.upper()}]")
                at = until
            out.append(text[at:start])
            until, kind = end, k
        else:
            until = max(until, end)
    return "".join(out)


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked; columns as they were, n_chars (if there) made anew."""
    text_at = docs.columns.index("text")
    chars_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(text_at).to_pylist()
            new = [mask(x) for x in old]
            columns = list(batch.columns)
            columns[text_at] = pa.array(new, columns[text_at].type)
            if chars_at is not None:
                chars = columns[chars_at].to_pylist()
                columns[chars_at] = pa.array([c if a == b else len(b) for a, b, c in zip(old, new, chars, strict=True)], columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents"))
