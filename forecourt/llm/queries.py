"""The registered queries of the training-data operators."""

from pyspark.sql import functions as F

from forecourt.llm import chat, decontaminate, dedup, mixing, periods, pieces, pii, quality, secrets, sharding, toxicity, turnrepair, urlrules
from workload.registry import query


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    "op2_chat_format",
    r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(32 + length(regexp_replace(role || text, '([<\[\\])', '\1\\', 'g'))) OVER w AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars,
  count(*) FILTER (role = 'assistant' OR k = n) AS n_examples
FROM placed GROUP BY conv_id
""",
)
def op2_chat_format(spark, folder):
    """All conversations and one of control strings, formatted and read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], turns.schema)
    return chat.digest(chat.expand(turns.unionByName(extra)))


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(
    "op3_url_filter",
    r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (
  SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts)
  JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, parts.host, parts.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best ON parts.host = best.host AND parts.path = best.path
""",
)
def op3_url_filter(spark, folder):
    """The verdict on every page's url."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query("op6_quality_rules")
def op6_quality_rules(spark, folder):
    """Counts and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.judge(docs, table(spark, folder, "labels").select("doc_id", "quality"))


@query("op7_toxicity")
def op7_toxicity(spark, folder):
    """Toxicity score of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.score(docs, table(spark, folder, "labels").select("doc_id", "toxic"))


@query("op5_secret_scan")
def op5_secret_scan(spark, folder):
    """Secrets of every document."""
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.drop("kinds", "starts", "ends")


@query("op8_near_duplicates")
def op8_near_duplicates(spark, folder):
    """Component of every document, from links of 85 per cent and more."""
    return dedup.groups(table(spark, folder, "documents").select("doc_id", "text"), percent=85)


def shard_digest(docs, shards=24):
    """Documents in shards of equal counts, with the fewest bytes moved from a layout by id."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        sharding.size_of().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = sharding.reshard(rows, shards, size=F.col("size"), order=("doc_id", "text_crc32"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard"
    )


@query("op9_reshard")
def op9_reshard(spark, folder):
    """All documents resharded into 24 shards."""
    return shard_digest(table(spark, folder, "documents"))


@query("op4_mix_sources")
def op4_mix_sources(spark, folder):
    """The place of every document in a mixture of the sources."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixing.mix(docs, order=("doc_id",))


@query("op1_decontaminate")
def op1_decontaminate(spark, folder):
    """Benchmark items found in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, table(spark, folder, "benchmark").select("item_id", "text"))


@query("op10_personal_data")
def op10_personal_data(spark, folder):
    """Personal data of every document."""
    return pii.scan(table(spark, folder, "documents").select("doc_id", "text")).drop("found")


@query("op11_periodic_runs")
def op11_periodic_runs(spark, folder):
    """Runs of words in every document, one of ten made periodic, and the text without their repetitions."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return periods.digest(periods.collapse(periods.with_planted_runs(docs)))


@query("op12_sentence_pieces")
def op12_sentence_pieces(spark, folder):
    """Every document encoded and decoded; ``agrees`` and ``decodes`` compare with the library."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"), path, back=True, keep=["doc_id"])
    hashes = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("ids", "decoded")]
    return rows.select("doc_id", "n_tokens", *hashes, "agrees", "decodes")


def _plus(state, cost, letters):
    return f"CASE WHEN {state} IS NOT NULL THEN struct_pack(c := {state}.c + {cost}, t := {state}.t || '{letters}') END"


def _least(*states):
    return f"list_sort(list_filter([{', '.join(states)}], lambda z: z IS NOT NULL))[1]"


def _keep(initial, state):
    return f"CASE WHEN NOT goes AND initial = '{initial}' THEN {_plus(state, 'cut', 'K')} END"


def _rerole(state):
    return f"CASE WHEN NOT goes THEN {_plus(state, '2 + cut', 'R')} END"


#: s, y, u, a: the cheapest edits so far that give no turn, a system turn, an open user turn, complete pairs.
REPAIR_SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT list(t ORDER BY i) AS steps FROM (
    SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS t
    FROM range(256) r(i))),
kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([4294967295::UBIGINT],
        list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: unicode(x)::UBIGINT)),
      lambda c, b: xor(c // 256, steps[1 + xor(c % 256, b)::BIGINT])), 4294967295::UBIGINT) % 20 AS kind
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(2) r(i) WHERE kind <> 0 AND (i = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS k,
    rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS shown FROM damaged),
faults AS (
  SELECT conv_id, turn, role, text, k, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS earlier,
    CASE WHEN shown = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
step AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS k, struct_pack(c := 0, t := '') AS s, NULL::STRUCT(c INTEGER, t VARCHAR) AS y,
    NULL::STRUCT(c INTEGER, t VARCHAR) AS u, NULL::STRUCT(c INTEGER, t VARCHAR) AS a FROM conversations
  UNION ALL
  SELECT conv_id, k,
    {_plus("s", 3, "D")},
    {_least(_plus("y", 3, "D"), _keep("s", "s"))},
    {_least(_plus("u", 3, "D"), *[f(x) for x in ("s", "y", "a") for f in (lambda x: _keep("u", x), _rerole)])},
    {_least(_plus("a", 3, "D"), _keep("a", "u"), _rerole("u"))}
  FROM (
    SELECT step.conv_id, faults.k, s, y, {_least("u", _plus("s", 2, "I"), _plus("y", 2, "I"), _plus("a", 2, "I"))} AS u,
      {_least("a", _plus("u", 2, "I"), _plus("s", 4, "II"), _plus("y", 4, "II"))} AS a,
      initial, fault IN ('blank', 'duplicate') AS goes, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cut
    FROM step JOIN faults ON faults.conv_id = step.conv_id AND faults.k = step.k + 1)),
ends AS (
  SELECT conv_id, {_least("s", "a", _plus("u", 2, "I"), _plus("y", 4, "II"))} AS best
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) AS back FROM step) WHERE back = 1),
letters AS (
  SELECT conv_id, unnest(string_split(best.t, '')) AS e, generate_subscripts(string_split(best.t, ''), 1) AS pos FROM ends WHERE best.t <> ''),
walked AS (
  SELECT *, count(*) FILTER (e <> 'I') OVER w AS k, count(*) FILTER (e <> 'D') OVER w AS m
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
turns AS (
  SELECT walked.conv_id, pos, e, m, CASE WHEN e <> 'I' THEN faults.role END AS role, CASE WHEN e = 'I' THEN '' ELSE faults.text END AS text,
    max(CASE WHEN m = 1 AND e = 'K' AND faults.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY walked.conv_id) AS led
  FROM walked LEFT JOIN faults ON faults.conv_id = walked.conv_id AND faults.k = walked.k),
repaired AS (
  SELECT conv_id, count(*) AS n_repaired,
    string_agg(CASE WHEN e = 'K' THEN role WHEN (m - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos) AS whole
  FROM turns WHERE e <> 'D' GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n_turns,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost, best.t AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256, coalesce(n_turns, 0) AS n_turns, coalesce(n_repaired, 0) AS n_repaired
FROM ends LEFT JOIN counts USING (conv_id) LEFT JOIN repaired USING (conv_id)
"""


@query("op13_turn_repair", REPAIR_SQL)
def op13_turn_repair(spark, folder):
    """All conversations, damaged and repaired."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return turnrepair.digest(turnrepair.repair(turnrepair.damaged(turns)), turns)
