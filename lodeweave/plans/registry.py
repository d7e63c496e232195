"""The engine's queries by name, each with equivalent SQL where SQL can express it.

Prompts are `documents` with their language as the domain, evaluation texts are `benchmark`, dialogs are `conversations`,
verdicts are `labels`, vectors are `embeddings`. Every query reads its whole tables. Names that start with ext_ are
extensions beyond the curation operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodeweave import schema as S
from lodeweave.functions import messages as M
from lodeweave.functions import minhash as H
from lodeweave.functions import quant as Q
from lodeweave.functions import text as T
from lodeweave.operators import aggregates as A
from lodeweave.operators import contamination as C
from lodeweave.operators import dedup as D
from lodeweave.operators import sampling as P
from lodeweave.operators import windows as N
from lodeweave.plans import corpus
from lodeweave.sources import adapters
from lodeweave.sources.storage import dealt
from lodeweave.streaming import incremental as I

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
#: Shares by language, where a query draws by domain.
SHARES = {"en": 0.30, "de": 0.30, "es": 0.20, "fr": 0.20}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    from lodeweave.plans import parts  # noqa: F401  adds its own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from lodeweave.plans import parts  # noqa: F401  adds its own

    return dict(_SQL)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str, deal: bool = False) -> DataFrame:
    """documents as prompts: id, _seq, domain, tokens; deal: to all cores, where Python is to work on them."""
    d = _t(spark, sf_dir, "documents")
    d = dealt(d) if deal else d
    return d.select("doc_id", F.col("doc_id").alias("_seq"), F.col("doc_id").cast("string").alias("id"), "text", F.col("lang").alias("domain"), "source", T.count_tokens("text").alias("tokens"))


# The parts of SQL that queries share.
_NORM = "trim(regexp_replace(lower(trim(text)), '\\s+', ' ', 'g'))"
_TOKENS = "greatest(1, length(text) // 4)"
_REASON = f"""CASE WHEN trim(text) = '' THEN 'empty_prompt' WHEN {_TOKENS} < 4 THEN 'prompt_too_short' WHEN {_TOKENS} > 8192 THEN 'prompt_too_long'
 WHEN len(regexp_extract_all(text, '[\\x{{0400}}-\\x{{04ff}}\\x{{0600}}-\\x{{06ff}}\\x{{3040}}-\\x{{30ff}}\\x{{3400}}-\\x{{4dbf}}\\x{{4e00}}-\\x{{9fff}}\\x{{ac00}}-\\x{{d7af}}]')) / greatest(1, length(text)) > 0.02 THEN 'non_english' END"""
_SUMMARY = """SELECT domain, n, round_even(n / sum(n) OVER (), 4) AS share, CAST(tokens AS BIGINT) AS tokens, round_even(tokens / sum(tokens) OVER (), 4) AS token_share
FROM (SELECT domain, count(*) AS n, sum(tokens) AS tokens FROM k GROUP BY domain)"""


def _summary(rows: DataFrame) -> DataFrame:
    return A.summarise(rows).select("domain", "n", "share", "tokens", "token_share")


@query(f"""WITH d AS (SELECT doc_id, lang AS domain, {_TOKENS} AS tokens, sha256({_NORM}) AS key, {_REASON} AS reason FROM documents),
f AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS nth FROM d WHERE reason IS NULL), k AS (SELECT * FROM f WHERE nth = 1)
{_SUMMARY}""")
def prompt_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan, normal form, row filters, exact first-wins dedup, report by domain."""
    rows = _docs(spark, sf_dir)
    sound = rows.filter(T.prompt_reject_reason("text", F.col("tokens")).isNull())
    # one row for each key, without moving texts
    firsts = sound.select(T.text_key("text").alias("key"), "doc_id", "domain", "tokens").groupBy("key").agg(F.min_by(F.struct("domain", "tokens"), "doc_id").alias("x"))
    return _summary(firsts.select("x.domain", "x.tokens"))


@query(f"SELECT doc_id, sha256({_NORM}) AS key, length({_NORM}) AS n_normal FROM documents")
def normalise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", T.text_key("text").alias("key"), F.char_length(T.normalise("text")).cast("long").alias("n_normal"))


@query(f"SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY sha256({_NORM})")
def exact_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").groupBy(T.text_key("text").alias("key")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("key")


@query(f"SELECT doc_id, {_TOKENS} AS tokens, {_REASON} AS reason FROM documents")
def prompt_filter_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", "tokens", T.prompt_reject_reason("text", F.col("tokens")).alias("reason"))


@query(f"SELECT reason, count(*) AS n FROM (SELECT {_REASON} AS reason FROM documents) WHERE reason IS NOT NULL GROUP BY reason")
def drop_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.drop_counts(_docs(spark, sf_dir).select(T.prompt_reject_reason("text", F.col("tokens")).alias("reason")))


@query("""SELECT doc_id, CASE WHEN trim(text) = '' THEN 'empty_assistant'
 WHEN (length(text) - length(replace(text, '<think>', ''))) / 7 <> (length(text) - length(replace(text, '</think>', ''))) / 8 THEN 'unbalanced_think_tags'
 WHEN greatest(1, length(text) // 4) < 16 THEN 'too_short' WHEN greatest(1, length(text) // 4) > 16384 THEN 'too_long' END AS reason FROM documents""")
def response_filter_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", T.response_reject_reason("text", F.col("tokens")).alias("reason"))


@query("""WITH w AS (SELECT doc_id, regexp_split_to_array(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+') AS w FROM documents),
g AS (SELECT doc_id, len(w) AS n, CASE WHEN len(w) >= 16 THEN list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')) END AS g FROM w)
SELECT doc_id, round(CASE WHEN n < 16 THEN 0.0 ELSE 1 - len(list_distinct(g)) / len(g) END, 9) AS ratio FROM g""")
def repeat_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", F.round(T.repeat_ratio("text"), 9).alias("ratio"))


def _keyword_case() -> str:
    cases = " ".join(f"WHEN {' OR '.join(f"contains(lower(text), '{w}')" for w in words)} THEN '{d}'" for d, words in S.KEYWORDS.items())
    return f"SELECT doc_id, CASE {cases} ELSE lang END AS domain FROM documents"


@query(_keyword_case())
def keyword_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", T.assign_domain("text", "lang").alias("domain"))


@query(f"WITH k AS (SELECT lang AS domain, {_TOKENS} AS tokens FROM documents) {_SUMMARY}")
def manifest_by_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(_docs(spark, sf_dir))


def _catalog(rows: DataFrame) -> DataFrame:
    """Sources of documents as a catalog: the cap is the row count."""
    return rows.groupBy("source", "domain").agg(F.count("*").alias("cap")).select(F.col("source").alias("dataset"), F.lit(None).cast("string").alias("config"), "domain", "cap")


_SHARE = "CASE domain WHEN 'en' THEN 0.3 WHEN 'de' THEN 0.3 WHEN 'es' THEN 0.2 WHEN 'fr' THEN 0.2 ELSE 0.0 END::DOUBLE"


@query(f"""WITH c AS (SELECT source AS dataset, lang AS domain, count(*) AS cap FROM documents GROUP BY source, lang)
SELECT dataset, domain, cap, CAST(floor(CAST(round_even(39000 * {_SHARE}, 0) AS BIGINT) * cap / sum(cap) OVER (PARTITION BY domain)) AS BIGINT) AS quota FROM c""")
def quota_allocate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.allocate(_catalog(_docs(spark, sf_dir)), 39_000, SHARES).drop("config")


_HASH = "sha256('17|' || CAST(doc_id AS VARCHAR))"
_RANKED = f"SELECT doc_id, lang AS domain, {_HASH} AS h, row_number() OVER (PARTITION BY lang ORDER BY {_HASH}, CAST(doc_id AS VARCHAR)) AS r FROM documents"


@query(f"""WITH d AS ({_RANKED}), n AS (SELECT DISTINCT domain, {_SHARE} AS w FROM d), t AS (SELECT domain, CAST(round_even(500 * w / sum(w) OVER (), 0) AS BIGINT) AS want FROM n)
SELECT doc_id, domain FROM d JOIN t USING (domain) ORDER BY (r > want)::INT, h, CAST(doc_id AS VARCHAR) LIMIT 500""")
def downsample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("id", "doc_id", "domain")
    return P.downsample(rows, 500, SHARES).select("doc_id", "domain")


@query(f"""WITH d AS ({_RANKED}), n AS (SELECT domain, CAST(round_even(100 * count(*) / sum(count(*)) OVER (), 0) AS BIGINT) AS want FROM d GROUP BY domain)
SELECT doc_id, domain, CASE WHEN r <= want THEN 'val' ELSE 'train' END AS part FROM d JOIN n USING (domain)""")
def stratified_split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.stratified_split(_docs(spark, sf_dir).select("id", "doc_id", "domain"), 100).select("doc_id", "domain", "part")


@query(f"""WITH e AS (SELECT doc_id, row_number() OVER (ORDER BY sha256({_NORM}), doc_id) AS r, count(*) OVER () AS n FROM documents WHERE lang = 'en')
SELECT doc_id, coalesce(e.r <= 500 AND e.n > 500, false) AS held_out FROM documents LEFT JOIN e USING (doc_id)""")
def hash_holdout_500(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.hash_holdout(_docs(spark, sf_dir), F.col("domain") == "en").select("doc_id", "held_out")


@query(f"SELECT doc_id, domain FROM ({_RANKED}) WHERE r <= 20")
def audit_sample_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.audit_sample(_docs(spark, sf_dir).select("id", "doc_id", "domain"), 20).select("doc_id", "domain")


@query("""SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS BIGINT) AS row FROM documents""")
def source_row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.row_index(_docs(spark, sf_dir).select("doc_id", "_seq", "source"), ["source"]).select("doc_id", "source", F.col("row").cast("long").alias("row"))


@query(f"""WITH d AS (SELECT doc_id, {_HASH} AS h FROM documents) SELECT doc_id, CAST((row_number() OVER (ORDER BY h, CAST(doc_id AS VARCHAR)) - 1) // 8 AS BIGINT) AS batch FROM d""")
def shuffled_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.batches(_docs(spark, sf_dir).select("id", "doc_id"), 8).select("doc_id", "batch")


@query(f"SELECT doc_id FROM documents WHERE sha256({_NORM}) IN (SELECT sha256({_NORM}) FROM benchmark)")
def contam_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.exact_hits(_docs(spark, sf_dir), _t(spark, sf_dir, "benchmark"), "doc_id")


@query()
def contam_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact and near hits of whole texts, in the published scheme's hashes."""
    return C.collisions(_docs(spark, sf_dir, True), _t(spark, sf_dir, "benchmark"), mode="blake2b", row_id="doc_id")


@query(f"WITH d AS (SELECT doc_id, {_NORM} AS t FROM documents), b AS (SELECT item_id, {_NORM} AS t FROM benchmark) SELECT doc_id, item_id FROM d JOIN b ON contains(d.t, b.t) WHERE b.t <> ''")
def ext_contam_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.contained(_docs(spark, sf_dir), _t(spark, sf_dir, "benchmark"))


def _pairs_sql(table: str = "documents") -> str:
    planes = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(H.planes()))
    return f"""WITH planes(i, a, b) AS (VALUES {planes}), n AS (SELECT doc_id, {_NORM} AS t FROM {table}),
s AS (SELECT DISTINCT doc_id, CASE WHEN length(t) < 5 THEN t ELSE substr(t, g, 5) END AS s FROM (SELECT doc_id, t, unnest(range(1, greatest(length(t) - 3, 2))) AS g FROM n)),
x AS (SELECT doc_id, ('0x' || substr(md5(s), 1, 15))::BIGINT % 2147483647 AS x FROM s),
m AS (SELECT doc_id, i, min((a * x + b) % 2147483647) AS h FROM x, planes GROUP BY doc_id, i),
g AS (SELECT doc_id, list(h ORDER BY i) AS sig FROM m GROUP BY doc_id),
b AS (SELECT doc_id, k, sig[4 * k + 1:4 * k + 4] AS band FROM g, range(16) r(k)),
c AS (SELECT DISTINCT l.doc_id AS a, r.doc_id AS b FROM b l JOIN b r ON l.k = r.k AND l.band = r.band AND l.doc_id < r.doc_id),
e AS (SELECT a, b, len(list_filter(list_zip(l.sig, r.sig), lambda z: z[1] = z[2])) / 64 AS est FROM c JOIN g l ON l.doc_id = a JOIN g r ON r.doc_id = b)"""


@query(_pairs_sql() + " SELECT a, b, est FROM e WHERE est >= 0.85")
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.near_pairs(D.signed(_docs(spark, sf_dir, True)))


@query("WITH RECURSIVE " + _pairs_sql().removeprefix("WITH ") + f""", p AS (SELECT a, b FROM e WHERE est >= 0.85), ids AS (SELECT row_number() OVER (ORDER BY doc_id) AS i, doc_id, sha256({_NORM}) AS key FROM documents),
q AS (SELECT i.i AS i, list(j.i) AS before FROM p JOIN ids i ON i.doc_id = p.b JOIN ids j ON j.doc_id = p.a GROUP BY i.i),
u AS (SELECT i, before, row_number() OVER (ORDER BY i) AS nth FROM q),
walk(nth, gone) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL
 SELECT u.nth, CASE WHEN len(list_filter(u.before, lambda y: NOT list_contains(w.gone, y))) > 0 THEN list_append(w.gone, u.i) ELSE w.gone END FROM walk w JOIN u ON u.nth = w.nth + 1),
out AS (SELECT unnest(gone) AS i FROM (SELECT gone FROM walk ORDER BY nth DESC LIMIT 1)),
kept AS (SELECT key FROM ids WHERE i NOT IN (SELECT i FROM out))
SELECT doc_id, CASE WHEN out.i IS NULL THEN NULL WHEN key IN (SELECT key FROM kept) THEN 'duplicate_prompt' ELSE 'near_duplicate' END AS reason FROM ids LEFT JOIN out ON ids.i = out.i""")
def near_dup_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir, True)
    return D.dedup_reasons(rows).select(F.col("_seq").alias("doc_id"), "reason")


@query()
def near_dup_reasons_blake2b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the published scheme's hashes, which SQL has not."""
    return D.dedup_reasons(_docs(spark, sf_dir, True), mode="blake2b").select(F.col("_seq").alias("doc_id"), "reason")


#: Planted prompts: (id, first number, last number) of a text of numbers. The second is a near copy beyond the token bound of
#: the first; the fourth is a near copy within the bound of the third, which is beyond it.
_PLANTED = ((-4, 1, 6500), (-3, 1, 6800), (-2, 10_001, 15_600), (-1, 10_001, 15_300))


def _planted_sql() -> str:
    return " ".join(f"UNION ALL SELECT {i}, array_to_string(range({a}, {b + 1}), ' ')" for i, a, b in _PLANTED)


@query(f"WITH RECURSIVE p(doc_id, text) AS (SELECT doc_id, text FROM documents {_planted_sql()}), " + _pairs_sql("p").removeprefix("WITH ") + f""",
f AS (SELECT doc_id, sha256({_NORM}) AS key, {_REASON} AS late FROM p), h AS (SELECT key, min(doc_id) AS head FROM f WHERE late IS NULL GROUP BY key),
q AS (SELECT b, list(a) AS before FROM e WHERE est >= 0.85 AND a IN (SELECT head FROM h) AND b IN (SELECT head FROM h) GROUP BY b),
u AS (SELECT b, before, row_number() OVER (ORDER BY b) AS nth FROM q),
walk(nth, gone) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL
 SELECT u.nth, CASE WHEN len(list_filter(u.before, lambda y: NOT list_contains(w.gone, y))) > 0 THEN list_append(w.gone, u.b) ELSE w.gone END FROM walk w JOIN u ON u.nth = w.nth + 1),
out AS (SELECT unnest(gone) AS i FROM (SELECT gone FROM walk ORDER BY nth DESC LIMIT 1)),
kept AS (SELECT head, key FROM h WHERE head NOT IN (SELECT i FROM out)),
near AS (SELECT DISTINCT b FROM e WHERE est >= 0.85 AND a IN (SELECT head FROM kept))
SELECT f.doc_id, CASE WHEN kept.head < f.doc_id THEN 'duplicate_prompt' WHEN near.b IS NOT NULL THEN 'near_duplicate' ELSE late END AS reason
FROM f LEFT JOIN kept ON f.key = kept.key LEFT JOIN near ON near.b = f.doc_id""")
def prompt_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prompt pipeline's reasons for documents and planted near copies across the token bound."""
    numbers = lambda a, b: F.array_join(F.transform(F.sequence(F.lit(a), F.lit(b)), lambda x: x.cast("string")), " ")
    rows = dealt(_t(spark, sf_dir, "documents")).select(F.col("doc_id").alias("_seq"), "text")
    for i, a, b in _PLANTED:
        rows = rows.unionByName(spark.range(1).select(F.lit(i).cast("long").alias("_seq"), numbers(a, b).alias("text")))
    prompts = adapters.canonical(rows, adapters.Context("documents", None, "coding"), F.col("_seq").cast("string"), F.array(M.text_message("user", F.col("text"))))
    return corpus.judged(prompts).select(F.col("_seq").alias("doc_id"), "reason")


def _dialogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as canonical messages, in the order of turns."""
    turns = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return turns.select("conv_id", F.transform("turns", lambda t: M.text_message(t["role"], t["text"])).alias("messages"))


@query("""WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, count(*) FILTER (role = 'user') OVER (PARTITION BY conv_id ORDER BY turn DESC) AS users_left FROM conversations),
g AS (SELECT *, role = 'user' AND rtrim(lower(trim(text)), '!.') IN ('hi', 'hi there', 'hello', 'hello there', 'hey', 'hey there', 'good morning', 'good afternoon', 'good evening', 'how are you', 'how are you doing', 'how''s it going', 'greetings', 'yo') AND users_left > 1 AS greets FROM t),
s AS (SELECT conv_id, max(CASE WHEN n = 1 AND role = 'system' THEN text END) AS system, min(CASE WHEN role = 'user' AND NOT greets THEN n END) AS at FROM g GROUP BY conv_id),
f AS (SELECT g.conv_id, g.text AS prompt, s.system IS NOT NULL AS has_system FROM s JOIN g ON g.conv_id = s.conv_id AND g.n = s.at
 WHERE NOT EXISTS (SELECT 1 FROM g x WHERE x.conv_id = s.conv_id AND x.n < s.at AND NOT (x.n = 1 AND x.role = 'system') AND NOT x.greets AND NOT EXISTS (SELECT 1 FROM g y WHERE y.conv_id = x.conv_id AND y.n = x.n - 1 AND y.greets AND x.role = 'assistant')))
SELECT conv_id, prompt, has_system FROM f""")
def conv_strip_to_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = M.strip_to_prompt(F.col("messages"))
    rows = _dialogs(spark, sf_dir).select("conv_id", prompt.alias("p")).filter("p IS NOT NULL")
    return rows.select("conv_id", M.prompt_text(F.col("p")).alias("prompt"), (F.element_at("p", 1)["role"] == "system").alias("has_system"))


@query("""WITH c AS (SELECT conv_id, list(role ORDER BY turn) AS r FROM conversations GROUP BY conv_id)
SELECT conv_id, concat_ws('; ', CASE WHEN r[-1] <> 'assistant' THEN 'last message is not assistant' END, CASE WHEN list_contains(r, 'system') AND r[1] <> 'system' THEN 'system message is not first' END) AS problems FROM c""")
def conv_valid_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dialogs(spark, sf_dir).select(
        "conv_id", F.col("conv_id").cast("string").alias("id"), F.lit("roleplay").alias("domain"), F.lit("prebuilt").alias("origin"), F.struct(F.lit("conversations").alias("name")).alias("source"),
        "messages", F.array().cast(f"array<{S.IMAGE}>").alias("images"), F.lit(0).alias("tokens"),
    )
    return rows.select("conv_id", F.array_join(M.validate_trajectory(), "; ").alias("problems"))


@query("""WITH t AS (SELECT *, row_number() OVER w AS n, count(*) FILTER (role = 'user') OVER w AS u FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, CAST(coalesce(max(CASE WHEN u <= 2 AND role = 'assistant' THEN n END), 0) AS INT) AS n_kept FROM t GROUP BY conv_id""")
def conv_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogs cut at two user turns, back to an assistant turn."""
    return _dialogs(spark, sf_dir).select("conv_id", F.size(M.truncated(F.col("messages"), users=2)).alias("n_kept"))


@query("""WITH t AS (SELECT conv_id, turn, role, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id) AS q FROM conversations),
ok AS (SELECT conv_id FROM t GROUP BY conv_id HAVING bool_or(role = 'user') AND NOT bool_or(role = 'system' AND n > 1))
SELECT conv_id, string_agg(CASE WHEN role = 'assistant' AND turn > q THEN '<|im_start|>assistant\n<think>\n\n</think>\n\n' || x || '<|im_end|>\n' ELSE '<|im_start|>' || role || '\n' || x || '<|im_end|>\n' END, '' ORDER BY turn) AS rendered
FROM t WHERE conv_id IN (SELECT conv_id FROM ok) GROUP BY conv_id""".replace("\\n", "' || chr(10) || '"))
def conv_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dialogs(spark, sf_dir).select("conv_id", M.rendered(F.col("messages")).alias("rendered")).filter("rendered IS NOT NULL")


@query("""WITH t AS (SELECT conv_id, turn, role, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id) AS q FROM conversations)
SELECT conv_id, CAST(count(*) FILTER (role = 'assistant' AND turn > coalesce(q, -1)) AS INT) AS expected FROM t GROUP BY conv_id""")
def conv_expected_think(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dialogs(spark, sf_dir).select("conv_id", M.expected_think_blocks(F.col("messages")).alias("expected"))


@query("""WITH t AS (SELECT *, CASE WHEN role = lag(role) OVER w THEN 0 ELSE 1 END AS c FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
r AS (SELECT conv_id, role, sum(c) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM t) SELECT conv_id, CAST(run AS BIGINT) AS run, any_value(role) AS role, count(*) AS n FROM r GROUP BY conv_id, run""")
def conv_role_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = N.runs(_t(spark, sf_dir, "conversations"), ["conv_id"], "turn", F.col("role"))
    return r.groupBy("conv_id", F.col("run").cast("long").alias("run")).agg(F.first("role").alias("role"), F.count("*").alias("n"))


_CODES = "list_transform(regexp_extract_all(lower(text), '[a-z]+'), lambda w: length(w))"


@query(f"""WITH d AS (SELECT doc_id, {_CODES} AS k FROM documents), e AS (SELECT doc_id, unnest(k) AS v, generate_subscripts(k, 1) AS i FROM d), o AS (SELECT v, row_number() OVER (ORDER BY doc_id, i) - 1 AS p FROM e)
SELECT CAST(p // 512 AS BIGINT) AS win, CAST(sum(v) AS BIGINT) AS total, md5(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p)) AS digest FROM o GROUP BY p // 512 HAVING count(*) = 512""")
def token_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts' token lists (here the lengths of words) in windows of 512."""
    rows = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("_seq"), F.transform(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)), F.char_length).alias("tokens"))
    w = N.token_windows(rows, "tokens", 512)
    return w.select(F.col("window").alias("win"), F.aggregate("tokens", F.lit(0).cast("long"), lambda s, v: s + v).alias("total"), F.md5(F.array_join(F.col("tokens").cast("array<string>"), ",")).alias("digest"))


_PACK = """WITH RECURSIVE d AS (SELECT row_number() OVER (ORDER BY doc_id) AS n, length(text) AS size, text FROM documents WHERE text <> ''),
walk(n, chunk, size, done) AS (SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, false UNION ALL
 SELECT d.n, CASE WHEN w.done THEN w.chunk + 1 ELSE w.chunk END, CASE WHEN w.done THEN d.size ELSE w.size + d.size END, CASE WHEN w.done THEN d.size ELSE w.size + d.size END >= 8000 FROM walk w JOIN d ON d.n = w.n + 1)
SELECT w.chunk AS chunk, substr(string_agg(d.text, ' ' ORDER BY d.n), 1, 16000) AS text FROM walk w JOIN d USING (n) GROUP BY w.chunk HAVING bool_or(w.done)"""


@query(_PACK)
def calibration_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.pack_chunks(_docs(spark, sf_dir).select("_seq", "text")).select("chunk", "text")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", "id", "domain", "source").join(_t(spark, sf_dir, "labels"), "doc_id")


_JOINED = "SELECT doc_id, lang AS domain, source, quality, toxic FROM documents JOIN labels USING (doc_id)"


@query(f"SELECT source, domain, count(*) AS attempted, count(*) FILTER (quality = 1) AS accepted, round_even(count(*) FILTER (quality = 1) / count(*), 4) AS pass_rate FROM ({_JOINED}) GROUP BY source, domain")
def pass_rate_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.pass_rates(_labelled(spark, sf_dir), F.col("quality") == 1, ["source", "domain"])


@query(f"SELECT domain, count(*) AS attempted, count(*) FILTER (quality = 1) / count(*) AS rate FROM ({_JOINED}) GROUP BY domain")
def attempt_weighted_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = A.pass_rates(_labelled(spark, sf_dir), F.col("quality") == 1, ["source", "domain"])
    return A.attempt_weighted(rates.withColumn("key", F.concat_ws("|", "source", "domain")))


@query(f"SELECT count(*) AS attempted, count(*) FILTER (quality = 1) AS accepted, round_even(count(*) FILTER (quality = 1) / count(*), 4) AS blended FROM ({_JOINED})")
def blended_pass_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.blended_rate(A.pass_rates(_labelled(spark, sf_dir), F.col("quality") == 1, ["source"]))


def _rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = F.array(F.struct(F.lit(0).alias("rollout"), (F.col("quality") == 1).alias("accepted")), F.struct(F.lit(1).alias("rollout"), (F.col("toxic") == 0).alias("accepted")))
    return _t(spark, sf_dir, "labels").select("doc_id", F.explode(both).alias("x")).select("doc_id", "x.*", F.lit(False).alias("error"))


_VERDICT = "CASE WHEN quality + 1 - toxic = 2 THEN 'all_pass' WHEN quality + 1 - toxic = 0 THEN 'all_fail' ELSE 'keep' END"


@query(f"SELECT doc_id, {_VERDICT} AS verdict, CAST(quality + 1 - toxic AS BIGINT) AS passes FROM labels")
def rollout_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rollouts for each label: quality, and not toxic."""
    return A.rollout_verdicts(_rollouts(spark, sf_dir), 2, "doc_id")


@query(f"""SELECT doc_id, 'seeded' AS shard FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'survivor' FROM labels JOIN documents USING (doc_id) WHERE {_VERDICT} = 'keep'""")
def merge_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, verdicts = _t(spark, sf_dir, "documents").select("doc_id"), A.rollout_verdicts(_rollouts(spark, sf_dir), 2, "doc_id")
    seeded = rows.join(verdicts.filter("verdict <> 'teacher_error'").select("doc_id"), "doc_id", "left_anti").select("doc_id", F.lit("seeded").alias("shard"))
    return seeded.unionByName(rows.join(verdicts.filter("verdict = 'keep'").select("doc_id"), "doc_id", "left_semi").select("doc_id", F.lit("survivor").alias("shard")))


_NEEDS = f"SELECT domain, CAST(ceil(5000 / (count(*) FILTER (quality = 1) / count(*))) AS BIGINT) AS need FROM ({_JOINED}) GROUP BY domain"
_ANCHORED = f"""WITH c AS (SELECT source AS dataset, lang AS domain, count(*) AS cap FROM documents GROUP BY source, lang), n AS ({_NEEDS}),
a AS (SELECT dataset, domain, cap, greatest(cap, (need * cap + sum(cap) OVER (PARTITION BY domain) - 1) // sum(cap) OVER (PARTITION BY domain))::BIGINT AS anchored_cap FROM c JOIN n USING (domain))"""


def _anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = A.pass_rates(_labelled(spark, sf_dir), F.col("quality") == 1, ["domain"])
    needs = rates.select("domain", F.ceil(5000 / (F.col("accepted") / F.col("attempted"))).cast("long").alias("need"))
    return P.anchored_caps(_catalog(_docs(spark, sf_dir)), needs)


@query(f"{_ANCHORED} SELECT * FROM a")
def anchored_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _anchored(spark, sf_dir).select("dataset", "domain", "cap", "anchored_cap")


@query(f"{_ANCHORED}, s AS (SELECT domain, sum(anchored_cap) AS need, {_SHARE} AS share FROM a GROUP BY domain) SELECT CAST(max(ceil(need / share)) AS BIGINT) AS target FROM s WHERE share > 0")
def driver_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.driver_target(_anchored(spark, sf_dir), SHARES)


@query("""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), g AS (SELECT vec_id, k, e[16 * k + 1:16 * k + 16] AS x FROM v, range(4) r(k)),
s AS (SELECT vec_id, k, x, list_min(x) AS mn, greatest(list_max(x) - list_min(x), 1e-6) / 3.0 AS sc FROM g)
SELECT vec_id, CAST(k AS INT) AS grp, round(list_sum(list_transform(x, lambda v: least(greatest(round_even((v - mn) / sc, 0), 0.0), 3.0) * sc + mn)), 4) AS total FROM s""")
def quantize_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bits, groups of 16: the sum of each group's values after quantization."""
    v = _t(spark, sf_dir, "embeddings").select("vec_id", Q.fake_quant(F.col("embedding"), 64, 16, 2).alias("q"))
    groups = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.struct(k.alias("grp"), F.round(F.aggregate(F.slice("q", k * 16 + 1, 16), F.lit(0.0), lambda s, x: s + x), 4).alias("total")))
    return v.select("vec_id", F.explode(groups).alias("x")).select("vec_id", "x.grp", "x.total")


@query("""WITH e AS (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS channel FROM embeddings), s AS (SELECT channel, avg(abs(x)) AS score FROM e GROUP BY channel)
SELECT CAST(channel AS INT) AS channel, row_number() OVER (ORDER BY score DESC, channel) <= 16 AS promoted FROM s""")
def promoted_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.promoted_channels(_t(spark, sf_dir, "embeddings").select(F.col("embedding").cast("array<double>").alias("embedding")), "embedding", 0.25)


@query("SELECT event_type, user_id, min(event_id) AS event_id FROM events GROUP BY event_type, user_id")
def first_seen_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First write wins: the first event of each key."""
    return _t(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.min("event_id").alias("event_id"))


@query("SELECT event_type, round(exp(sum(value / 100) / count(*)), 4) AS ppl FROM events GROUP BY event_type")
def perplexity_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("event_type", (F.col("value") / 100).alias("nll"), F.lit(1).alias("n"))
    return A.perplexity(rows, ["event_type"])


# Extensions: joins, grouping sets, windows and event time on the star schema.


@query("SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def ext_join_orders_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (_t(spark, sf_dir, x) for x in ("orders", "customer", "nation"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.groupBy("n_name").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def ext_agg_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("SELECT c_mktsegment, o_orderstatus, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY CUBE (c_mktsegment, o_orderstatus)")
def ext_cube_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).cube("c_mktsegment", "o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def ext_top3_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return _t(spark, sf_dir, "orders").withColumn("r", F.row_number().over(w)).filter("r <= 3").select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def ext_tumbling_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.tumbling(_t(spark, sf_dir, "events")).select("window_start", "event_type", "n", F.round("total", 2).alias("total"))


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, k""")
def ext_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.sessions(_t(spark, sf_dir, "events"))


@query("SELECT e.event_id, o.event_id AS last_error FROM (SELECT * FROM events WHERE event_type = 'view') e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') o ON e.user_id = o.user_id AND o.ts <= e.ts")
def ext_asof_last_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each view with the last error of its user before it, by one window over the union instead of a join."""
    e = _t(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "error"))
    w = W.partitionBy("user_id").orderBy("ts", (F.col("event_type") == "view")).rowsBetween(W.unboundedPreceding, 0)
    last = F.last(F.when(F.col("event_type") == "error", F.col("event_id")), ignorenulls=True).over(w)
    return e.withColumn("last_error", last).filter("event_type = 'view'").select("event_id", "last_error")

