"""Registered queries, each beside SQL that says the same to DuckDB, so that they can't drift apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dialoom.config import ASSISTANT_VOICE, CATEGORIES, VOICE_POOLS, GenerationConfig
from dialoom.functions import hashing, signal, text as tx
from dialoom.functions.stats import percentiles, word_confidence
from dialoom.operators import assignment as asg, generation as gen, incremental as inc, qa, sampling, validation as val
from dialoom.sources.dialogues import load

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# ---- shared SQL ----------------------------------------------------------------

_SPLIT = "CASE conv_id % 20 WHEN 18 THEN 'validation' WHEN 19 THEN 'test' ELSE 'train' END"
_TURNS = f"""t AS (SELECT conv_id, printf('conv_%06d', conv_id) AS id, {_SPLIT} AS split, {sql_list(CATEGORIES)}[conv_id % 6 + 1] AS category,
  row_number() OVER w - 1 AS i, role AS speaker, text, lag(role) OVER w AS before, count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))"""
_RECORDS = f"{_TURNS}, d AS (SELECT conv_id, any_value(id) AS id, any_value(split) AS split, any_value(category) AS category, any_value(n) AS n, sum(length(text)) AS chars FROM t GROUP BY conv_id)"
_POOL = "CASE split " + " ".join(f"WHEN '{s}' THEN {sql_list(v)}" for s, v in VOICE_POOLS.items()) + " END"


def _seed(*parts: str) -> str:
    return "('0x' || substr(sha256(" + " || '|' || ".join(parts) + "), 1, 16))::UBIGINT"


def _voice(seed: str = "'0'") -> str:
    return f"({_POOL})[({_seed(seed, chr(39) + 'user_voice' + chr(39), 'split', 'id')} % len({_POOL}))::BIGINT + 1]"


_POOL_ROWS = "pool AS (SELECT * FROM (VALUES " + ", ".join(f"('{s}', {k}, '{v}')" for s, vs in VOICE_POOLS.items() for k, v in enumerate(vs)) + ") AS p(split, ord, voice))"
_BLANK = r"regexp_full_match(text, '[\s\p{Z}\x1c-\x1f\x85]*')"
_CONTROL = r"regexp_matches(text, '\p{C}')"
_UNSUPPORTED = r"regexp_matches(text, '[^\x20-\x7E‘’“”—–…À-ÖØ-öø-ÿ]')"
_URL = r"regexp_matches({0}, '(?i)(https?://|www\.)\S+')"
_MARKDOWN = r"(regexp_matches(text, '\*\*[^*]+\*\*') OR regexp_matches(text, '(^|[^\p{L}\p{N}_])_[^_]+_($|[^\p{L}\p{N}_])') OR regexp_matches(text, '`[^`]+`') OR regexp_matches(text, '^\s*#{1,6}\s') OR regexp_matches(text, '^\s*[-*]\s') OR regexp_matches(text, '\[[^\]]+\]\([^)]+\)'))"
_TOKENS = r"list_filter(regexp_extract_all({0}, '[A-Za-zÀ-ÖØ-öø-ÿ'']+'), lambda w: trim(w, '''') <> '')"
_PER_TURN = f"""SELECT id, split, conv_id, 'turn[' || i || '] has invalid speaker ''' || speaker || '''' AS reason FROM t WHERE speaker NOT IN ('user', 'assistant')
  UNION ALL SELECT id, split, conv_id, 'turn[' || i || '] text must be nonempty' FROM t WHERE text IS NULL OR {_BLANK}
  UNION ALL SELECT id, split, conv_id, 'turn[' || i || '] contains control characters' FROM t WHERE NOT {_BLANK} AND {_CONTROL}
  UNION ALL SELECT id, split, conv_id, 'turn[' || i || '] contains unsupported unicode characters' FROM t WHERE NOT {_BLANK} AND {_UNSUPPORTED}
  UNION ALL SELECT id, split, conv_id, 'turn[' || i || '] contains a URL' FROM t WHERE NOT {_BLANK} AND {_URL.format('text')}
  UNION ALL SELECT id, split, conv_id, 'turn[' || i || '] contains markdown syntax' FROM t WHERE NOT {_BLANK} AND {_MARKDOWN}
  UNION ALL SELECT id, split, conv_id, 'turn[' || i || '] exceeds max utterance length (400 chars)' FROM t WHERE NOT {_BLANK} AND length(text) > 400
  UNION ALL SELECT id, split, conv_id, 'turn[' || i || '] normalizes to an empty forced-alignment transcript' FROM t WHERE NOT {_BLANK} AND speaker = 'assistant' AND len({_TOKENS.format('text')}) = 0"""
_COUNT = "SELECT id, split, conv_id, 'turns must have an even count between 2 and 8, got ' || n AS reason FROM d WHERE n < 2 OR n > 8 OR n % 2 <> 0"
_ORDER = """SELECT id, split, conv_id, 'first speaker must be ''user''' AS reason FROM t WHERE i = 0 AND speaker <> 'user'
  UNION ALL SELECT id, split, conv_id, 'final speaker must be ''assistant''' FROM t WHERE i = n - 1 AND speaker <> 'assistant'
  UNION ALL SELECT id, split, conv_id, 'turn[' || min(i) || '] does not alternate speaker with turn[' || (min(i) - 1) || ']' FROM t WHERE speaker = before GROUP BY id, split, conv_id"""
_ALL = f"{_RECORDS}, a AS ({_PER_TURN} UNION ALL {_COUNT}), b AS ({_ORDER}), v AS (SELECT * FROM a UNION ALL SELECT * FROM b WHERE conv_id NOT IN (SELECT conv_id FROM a))"
_STRUCT = f"""{_RECORDS}, bad AS (SELECT conv_id FROM d WHERE n < 2 OR n > 8 OR n % 2 <> 0 UNION SELECT conv_id FROM t WHERE speaker NOT IN ('user', 'assistant') OR (i = 0 AND speaker <> 'user') OR (i = n - 1 AND speaker <> 'assistant') OR speaker = before),
  good AS (SELECT * FROM d WHERE conv_id NOT IN (SELECT conv_id FROM bad))"""


def structural(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogues that are right in count, speakers and order (texts aside)."""
    return load(spark, sf_dir).where(F.size(val.structure_reasons(F.col("turns"))) == 0)


# ---- validation ----------------------------------------------------------------


@query(f"WITH {_ALL} SELECT split, id, reason FROM v")
def source_violations(spark, sf_dir):
    return val.violations(load(spark, sf_dir))


@query(f"""WITH {_RECORDS}, a AS (SELECT * FROM ({_PER_TURN}) UNION ALL {_COUNT}), b AS ({_ORDER}), m AS (SELECT conv_id, split, conv_id % 12 AS k FROM d),
  f AS (SELECT conv_id, reason FROM a WHERE conv_id % 12 > 7 UNION ALL SELECT conv_id, reason FROM a WHERE conv_id % 12 = 7 AND reason NOT LIKE 'turn[0]%'
    UNION ALL SELECT conv_id, 'turn[0] must have exactly keys ''speaker'' and ''text''' FROM m WHERE k = 7 UNION ALL SELECT conv_id, 'category ''other'' is not in the allowed category set' FROM m WHERE k = 8),
  r AS (SELECT conv_id, CASE k WHEN 0 THEN 'unexpected keys (extra=[''extra''], missing=[])' WHEN 1 THEN 'unexpected keys (extra=[], missing=[''turns''])' WHEN 2 THEN 'id must be a nonempty string' WHEN 5 THEN 'invalid JSON'
      WHEN 6 THEN 'record must be a JSON object' ELSE 'turns must be a nonempty list' END AS reason FROM m WHERE k < 7
    UNION ALL SELECT * FROM f UNION ALL SELECT conv_id, reason FROM b WHERE conv_id % 12 > 8 AND conv_id NOT IN (SELECT conv_id FROM f))
  SELECT split, conv_id AS line_no, reason FROM r JOIN m USING (conv_id)""")
def raw_record_violations(spark, sf_dir):
    """Records as lines of JSON, most of them broken in one of nine ways, through the tolerant reader."""
    d = load(spark, sf_dir).withColumn("k", F.col("line_no") % 12)
    said = F.transform("turns", lambda t: F.struct(t["speaker"].alias("speaker"), t["text"].alias("text")))
    moody = F.transform("turns", lambda t, i: F.struct(t["speaker"].alias("speaker"), t["text"].alias("text"), F.when(i == 0, "x").alias("mood")))
    json = lambda *cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    whole = json("category", "id", said.alias("turns"))
    line = (
        F.when(F.col("k") == 0, json("category", F.lit("x").alias("extra"), "id", said.alias("turns")))
        .when(F.col("k") == 1, json("category", "id"))
        .when(F.col("k") == 2, json("category", F.lit(" ").alias("id"), said.alias("turns")))
        .when(F.col("k") == 3, json("category", "id", F.lit("x").alias("turns")))
        .when(F.col("k") == 4, json("category", "id", F.slice(said, 1, 0).alias("turns")))
        .when(F.col("k") == 5, F.substring(whole, 1, 20))
        .when(F.col("k") == 6, F.lit("[1, 2]"))
        .when(F.col("k") == 7, F.to_json(F.struct("category", "id", moody.alias("turns"))))
        .when(F.col("k") == 8, json(F.lit("other").alias("category"), "id", said.alias("turns")))
        .otherwise(whole)
    )
    raw = d.select("split", "id", "line_no", line.alias("line")).select("split", F.col("id").alias("ref"), "line_no", F.try_parse_json("line").alias("v"))
    return val.parse(raw).select("split", "line_no", F.explode("reasons").alias("reason"))


@query(f"WITH {_ALL} SELECT split, regexp_replace(reason, '[0-9]+', 'N', 'g') AS reason, count(*) AS n FROM v GROUP BY 1, 2")
def source_violation_counts(spark, sf_dir):
    kind = F.regexp_replace("reason", "[0-9]+", "N").alias("reason")
    return val.violations(load(spark, sf_dir)).groupBy("split", kind).agg(F.count("*").alias("n"))


@query(f"WITH {_STRUCT} SELECT split, id, category, n AS n_turns FROM good")
def structurally_valid_dialogues(spark, sf_dir):
    return structural(spark, sf_dir).select("split", "id", "category", F.size("turns").cast("long").alias("n_turns"))


@query(f"""WITH {_STRUCT}, e AS (SELECT * FROM (VALUES ('train', 2700), ('validation', 150), ('test', 150)) AS x(split, expected)),
  h AS (SELECT split, count(*) AS found FROM good GROUP BY split)
  SELECT split, expected::BIGINT AS expected, coalesce(found, 0)::BIGINT AS found, 'expected ' || expected || ' records, found ' || coalesce(found, 0) AS reason FROM e LEFT JOIN h USING (split) WHERE coalesce(found, 0) <> expected""")
def split_count_check(spark, sf_dir):
    from dialoom.config import EXPECTED_COUNTS

    return val.count_problems(structural(spark, sf_dir), EXPECTED_COUNTS)




@query("""WITH e AS (SELECT user_id::VARCHAR AS id, event_type AS split, event_id, dense_rank() OVER (ORDER BY event_type) AS r FROM events),
  w AS (SELECT *, row_number() OVER (PARTITION BY split, id ORDER BY event_id) AS nth, min(r) OVER (PARTITION BY id) AS fr, first_value(split) OVER (PARTITION BY id ORDER BY r, event_id) AS fs FROM e)
  SELECT split, id, reason, count(*) AS n FROM (SELECT split, id, 'duplicate id within ' || split AS reason FROM w WHERE nth > 1
  UNION ALL SELECT split, id, 'id appears in both ''' || fs || ''' and ''' || split || ''' (split overlap)' FROM w WHERE fr < r) GROUP BY ALL""")
def duplicate_and_overlap_ids(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("split"), "event_id")
    kinds = tuple(sorted(r.split for r in e.select("split").distinct().collect()))  # event types: a handful
    return val.id_problems(e, F.col("event_id"), kinds).groupBy("split", "id", "reason").agg(F.count("*").alias("n"))


@query("""SELECT event_id, CASE WHEN n > 1 THEN user_id || '__dup' || n ELSE user_id::VARCHAR END AS new_id
  FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)""")
def duplicate_id_repair(spark, sf_dir):
    return inc.repair_ids(read(spark, sf_dir, "events").select("event_id", "user_id"), "user_id", "event_id").select("event_id", "new_id")


# ---- text ----------------------------------------------------------------------


@query(f"SELECT doc_id, {_CONTROL} AS control, {_UNSUPPORTED} AS unsupported, {_URL.format('text')} AS url, {_MARKDOWN} AS markdown, length(text) > 400 AS long FROM documents")
def text_gate_flags(spark, sf_dir):
    t = F.col("text")
    return read(spark, sf_dir, "documents").select("doc_id", tx.has_control(t).alias("control"), tx.has_unsupported(t).alias("unsupported"), tx.has_url(t).alias("url"), tx.has_markdown(t).alias("markdown"), tx.too_long(t).alias("long"))


@query(f"SELECT page_id, url FROM pages WHERE {_URL.format('html')}")
def url_pages(spark, sf_dir):
    return read(spark, sf_dir, "pages").where(tx.has_url(F.col("html"))).select("page_id", "url")


@query(f"SELECT doc_id FROM documents WHERE {_MARKDOWN}")
def markdown_docs(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(tx.has_markdown(F.col("text"))).select("doc_id")


@query(f"WITH w AS (SELECT doc_id, {_TOKENS.format('text')} AS w FROM documents) SELECT doc_id, len(w)::BIGINT AS n_tokens, w[1] AS first_token, w[-1] AS last_token FROM w")
def tokenize_words(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", tx.tokens(F.col("text")).alias("w"))
    return d.select("doc_id", F.size("w").cast("long").alias("n_tokens"), F.get("w", F.lit(0)).alias("first_token"), F.try_element_at("w", F.lit(-1)).alias("last_token"))


@query(f"""WITH w AS (SELECT unnest({_TOKENS.format('text')}) AS w FROM conversations), s AS (SELECT regexp_replace(translate(lower(w), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[^a-z'']', '', 'g') AS word FROM w)
  SELECT word, count(*) AS n FROM s WHERE word <> '' GROUP BY word""")
def normalized_vocab(spark, sf_dir):
    w = read(spark, sf_dir, "conversations").select(F.explode(tx.tokens(F.col("text"))).alias("w"))
    return w.select(tx.spoken(F.col("w")).alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


_SAY = {"the": "ðə", "that": "ðæt", "sich": "zɪç"}


#: Signs that are no part of a word are doubled, so that two words next to each other each have their own; marked words (between
#: two private characters) are spelled out once the doubles are halved.
_NO_WORD = r"[^\p{L}\p{N}_\x{E000}\x{E001}]"
_MARKED = "d"
for _w in _SAY:
    _MARKED = f"regexp_replace({_MARKED}, '(^|{_NO_WORD})({_w}|{_w.upper()}|{_w.capitalize()})($|{_NO_WORD})', '\\1\ue000\\2\ue001\\3', 'g')"
_SPOKEN = f"regexp_replace({_MARKED}, '({_NO_WORD}){_NO_WORD}', '\\1', 'g')"
for _w, _p in _SAY.items():
    _SPOKEN = f"regexp_replace({_SPOKEN}, '\ue000((?i:{_w}))\ue001', '[\\1](/{_p}/)', 'g')"


@query(f"SELECT doc_id, sha256(out) AS rewritten, length(out) - length(text) AS added FROM (SELECT doc_id, text, {_SPOKEN} AS out FROM (SELECT doc_id, text, regexp_replace(text, '({_NO_WORD})', '\\1\\1', 'g') AS d FROM documents))")
def pronunciation_rewrite(spark, sf_dir):
    out = tx.pronounce(F.col("text"), _SAY)
    return read(spark, sf_dir, "documents").select("doc_id", hashing.sha256(out).alias("rewritten"), (F.length(out) - F.length("text")).cast("long").alias("added"))


@query(r"""WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20-\x7E‘’“”—–…]')) AS c FROM documents)
  SELECT doc_id, c AS char, 'U+' || lpad(upper(to_hex(unicode(c))), 4, '0') AS code, count(*) AS n FROM c GROUP BY doc_id, c""")
def offending_characters(spark, sf_dir):
    c = read(spark, sf_dir, "documents").select("doc_id", F.explode(tx.offending(F.col("text"))).alias("char"))
    return c.groupBy("doc_id", "char").agg(F.count("*").alias("n")).select("doc_id", "char", tx.code_point(F.col("char")).alias("code"), "n")


@query("SELECT event_id, CASE WHEN value IS NULL THEN NULL ELSE printf('%02d:%02d:%02d', greatest(floor(value * 100), 0)::BIGINT // 3600, (greatest(floor(value * 100), 0)::BIGINT % 3600) // 60, greatest(floor(value * 100), 0)::BIGINT % 60) END AS hms FROM events")
def format_hms(spark, sf_dir):
    v = F.col("value") * 100
    return read(spark, sf_dir, "events").select("event_id", F.when(F.col("value").isNotNull(), tx.format_hms(v)).alias("hms"))


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_props_extract(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "long").alias("k"))


# ---- assignment ----------------------------------------------------------------


@query(f"WITH {_RECORDS} SELECT id, ({_seed(chr(39) + '0' + chr(39), 'id', chr(39) + 'user_voice' + chr(39))})::VARCHAR AS seed FROM d")
def seed_ints(spark, sf_dir):
    return load(spark, sf_dir).select("id", hashing.seed_int(0, F.col("id"), "user_voice").cast("string").alias("seed"))


@query(f"WITH {_RECORDS} SELECT split, id, {_voice()} AS voice FROM d")
def native_voice_assignment(spark, sf_dir):
    return load(spark, sf_dir).select("split", "id", asg.user_voice(F.col("id"), F.col("split")).alias("voice"))


def _uniform(purpose: str, low: float, high: float) -> str:
    return f"{low} + floor(({_seed(chr(39) + '0' + chr(39), chr(39) + purpose + chr(39), 'split', 'id', 'i::VARCHAR')})::HUGEINT // 2048)::DOUBLE / 9007199254740992.0::DOUBLE * ({high} - {low})"


@query(f"WITH {_TURNS} SELECT id, i::BIGINT AS turn, round(CASE WHEN speaker = 'assistant' THEN 1.0 ELSE {_uniform('user_speed', 0.92, 1.08)} END, 4)::DOUBLE AS speed, round(CASE WHEN i = 0 THEN 0.0 ELSE {_uniform('pause', 0.25, 0.75)} END, 4)::DOUBLE AS pause, CASE WHEN speaker = 'assistant' THEN 'af_heart' ELSE {_voice()} END AS voice FROM t")
def native_turn_speed_pause(spark, sf_dir):
    t = gen.plan_turns(load(spark, sf_dir), GenerationConfig())
    return t.select("id", F.col("index").cast("long").alias("turn"), F.round("speed", 4).alias("speed"), F.round("pause", 4).alias("pause"), "voice")


@query()
def compat_voice_assignment(spark, sf_dir):
    """By numpy's generator, which SQL doesn't have."""
    draw = asg.numpy_voice()
    return load(spark, sf_dir).select("split", "id", draw("id", "split").alias("voice"))


@query(f"WITH {_RECORDS}, {_POOL_ROWS}, a AS (SELECT split, {_voice()} AS voice, count(*) AS n FROM d GROUP BY ALL) SELECT split, voice AS user_voice, n FROM pool JOIN a USING (split, voice)")
def voice_distribution(spark, sf_dir):
    a = load(spark, sf_dir).select("split", F.lit(True).alias("ok"), asg.user_voice(F.col("id"), F.col("split")).alias("user_voice"))
    pool = F.broadcast(val.pool_table(spark)).select("split", F.col("voice").alias("user_voice"))
    return qa.voice_distribution(a).join(pool, ["split", "user_voice"])


@query(f"""WITH {_RECORDS}, {_POOL_ROWS}, u AS (SELECT DISTINCT split, CASE WHEN conv_id % 7 = 0 THEN 'af_alloy' ELSE {_voice()} END AS voice FROM d)
  SELECT split, voice, 'leaked' AS problem FROM u ANTI JOIN pool USING (split, voice) UNION ALL SELECT split, voice, 'missing' FROM pool ANTI JOIN u USING (split, voice)""")
def voice_pool_leak(spark, sf_dir):
    voice = F.when(F.col("line_no") % 7 == 0, "af_alloy").otherwise(asg.user_voice(F.col("id"), F.col("split")))
    return qa.voice_leaks(load(spark, sf_dir).select("split", voice.alias("user_voice")), val.pool_table(spark))


@query(f"WITH {_POOL_ROWS}, p AS (SELECT * FROM pool UNION ALL SELECT 'extra', 0, 'af_sky'), av AS (SELECT voice FROM p WHERE voice NOT IN ('bm_lewis', 'am_liam')) SELECT 'voice ' || a.voice || ' is in ' || a.split || ' and ' || b.split AS reason FROM p a JOIN p b ON a.voice = b.voice AND a.split < b.split UNION ALL SELECT DISTINCT 'voice ' || voice || ' is not available' FROM p WHERE voice NOT IN (SELECT voice FROM av)")
def voice_pool_disjointness(spark, sf_dir):
    pool = val.pool_table(spark, VOICE_POOLS | {"extra": ("af_sky",)})
    return val.pool_problems(pool, pool.select("voice").distinct().where(~F.col("voice").isin("bm_lewis", "am_liam")))


_JSON_TEXT = r"""replace(replace(replace(replace(replace({0}, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(9), '\t'), chr(13), '\r')"""


@query(f"""WITH {_TURNS}, j AS (SELECT id, any_value(category) AS category, string_agg('{{"speaker":"' || speaker || '","text":"' || {_JSON_TEXT.format('text')} || '"}}', ',' ORDER BY i) AS said FROM t GROUP BY id),
  k AS (SELECT id, '{{"category":"' || category || '","id":"' || id || '","turns":[' || said || ']}}' AS s FROM j)
  SELECT id, sha256(array_to_string(list_transform(regexp_extract_all(s, '(?s).'), lambda c: CASE WHEN unicode(c) < 127 AND unicode(c) > 31 THEN c
    WHEN unicode(c) <= 65535 THEN '\\u' || lpad(lower(to_hex(unicode(c))), 4, '0') ELSE '\\u' || lower(to_hex(55296 + ((unicode(c) - 65536) >> 10))) || '\\u' || lower(to_hex(56320 + ((unicode(c) - 65536) & 1023))) END), '')) AS checksum FROM k""")
def dialogue_checksum(spark, sf_dir):
    return load(spark, sf_dir).select("id", hashing.dialogue_checksum(F.col("category"), F.col("id"), F.col("turns")).alias("checksum"))


@query("SELECT doc_id, sha256(text) AS checksum FROM documents")
def row_hash_documents(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", hashing.sha256(F.col("text")).alias("checksum"))


# ---- sampling ------------------------------------------------------------------


@query("""WITH w AS (SELECT n_name AS name, count(c_custkey) AS weight FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name),
  s AS (SELECT *, weight * 1000.0::DOUBLE / sum(weight) OVER () AS share FROM w), q AS (SELECT *, floor(share)::BIGINT AS q FROM s),
  r AS (SELECT *, row_number() OVER (ORDER BY share - q DESC, name) AS r, 1000 - sum(q) OVER () AS more FROM q)
  SELECT name, weight, q + CASE WHEN r <= more THEN 1 ELSE 0 END AS quota FROM r""")
def largest_remainder_quota(spark, sf_dir):
    n, c = read(spark, sf_dir, "nation"), read(spark, sf_dir, "customer")
    w = F.broadcast(n).join(c.groupBy("c_nationkey").agg(F.count("*").alias("w")), n.n_nationkey == F.col("c_nationkey"), "left").select(F.col("n_name").alias("name"), F.coalesce("w", F.lit(0)).alias("weight"))
    return sampling.largest_remainder(w, 1000, "name")


@query()
def stratified_smoke_selection(spark, sf_dir):
    return sampling.stratified(structural(spark, sf_dir), 20).selected


@query()
def smoke_coverage(spark, sf_dir):
    s = sampling.stratified(structural(spark, sf_dir), 20)
    return s.voices.select("split", F.col("voice").alias("name"), "covered").unionByName(s.categories.select(F.lit("all").alias("split"), F.col("category").alias("name"), "covered"))


@query(f"WITH {_RECORDS} SELECT split, id, ((row_number() OVER (ORDER BY split, id) - 1) % 4)::INT AS shard FROM d")
def work_shards(spark, sf_dir):
    return sampling.shards(load(spark, sf_dir).select("split", "id"), 4, ["split", "id"])


@query(f"""WITH {_RECORDS}, g AS (SELECT count(*) AS dialogues, sum(chars)::BIGINT AS chars, sum(n - 1) * 0.5::DOUBLE AS pause FROM d)
  SELECT dialogues, chars, pause AS pause_seconds, round(chars / 15.0::DOUBLE + pause, 4) AS seconds, round((chars / 15.0::DOUBLE + pause) / 3600, 6) AS hours, floor((chars / 15.0::DOUBLE + pause) * 96000)::BIGINT AS bytes FROM g""")
def dry_run_estimate(spark, sf_dir):
    return gen.dry_run(load(spark, sf_dir))


# ---- placements and alignments -------------------------------------------------


@query(f"""WITH {_TURNS}, s AS (SELECT id, i, length(text) * 1600 AS n, CASE WHEN i = 0 THEN 0 ELSE 12000 END AS p FROM t)
  SELECT id, i::BIGINT AS turn, (sum(n + p) OVER (PARTITION BY id ORDER BY i) - n)::BIGINT AS start_sample, (sum(n + p) OVER (PARTITION BY id ORDER BY i))::BIGINT AS end_sample FROM s""")
def turn_placements(spark, sf_dir):
    t = load(spark, sf_dir).select("id", F.posexplode("turns").alias("index", "t")).withColumn("n", F.length("t.text") * 1600)
    out = gen.placements(t, ("id",), F.col("n"), F.when(F.col("index") == 0, 0).otherwise(12000))
    return out.select("id", F.col("index").cast("long").alias("turn"), "start_sample", "end_sample")


@query(f"""WITH {_TURNS}, w AS (SELECT id, i, {_TOKENS.format('text')} AS w, length(text) / 15.0::DOUBLE AS s FROM t WHERE speaker = 'assistant'),
  e AS (SELECT id, i, s / len(w) AS step, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS k FROM w)
  SELECT id, i::BIGINT AS turn, k::BIGINT AS pos, word, round(k * step, 8) AS start, round((k + 1) * step - 1e-4, 8) AS "end" FROM e""")
def stub_word_alignment(spark, sf_dir):
    t = load(spark, sf_dir).select("id", F.posexplode("turns").alias("turn", "t")).where("t.speaker = 'assistant'")
    w = t.select("id", F.col("turn").cast("long").alias("turn"), F.posexplode(gen.even_words(F.col("t.text"), F.length("t.text") / 15.0, 8)).alias("pos", "w"))
    return w.select("id", "turn", F.col("pos").cast("long").alias("pos"), "w.word", "w.start", "w.end")


@query("""WITH e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, event_type AS word, (epoch_us(ts) // 1000000 % 600)::DOUBLE AS s, value, event_id FROM events),
  i AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN 'NaN'::DOUBLE ELSE s + value - 20 END AS z, CASE WHEN event_id % 13 = 0 THEN 'OTHER' ELSE 'SPEAKER_MAIN' END AS who FROM e),
  p AS (SELECT *, z IS NOT NULL AND NOT isnan(z) AS ok, last_value(CASE WHEN z IS NOT NULL AND NOT isnan(z) THEN z END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM i)
  SELECT user_id, pos::BIGINT AS pos, 'alignments[' || pos || m AS reason FROM (SELECT user_id, pos, '].speaker must be ''SPEAKER_MAIN''' AS m FROM p WHERE who <> 'SPEAKER_MAIN'
  UNION ALL SELECT user_id, pos, '] timestamps must be finite' FROM p WHERE NOT ok UNION ALL SELECT user_id, pos, '] start must be nonnegative' FROM p WHERE ok AND s < 0
  UNION ALL SELECT user_id, pos, '] end must be greater than start' FROM p WHERE ok AND z <= s UNION ALL SELECT user_id, pos, '] end exceeds duration' FROM p WHERE ok AND z > 500 + 0.05
  UNION ALL SELECT user_id, pos, '] start is before the previous end' FROM p WHERE ok AND s < before)""")
def alignment_violations(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    start = (F.unix_timestamp("ts") % 600).cast("double")
    end = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(start + F.col("value") - 20)
    pos = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    items = e.select("user_id", pos.cast("long").alias("pos"), F.col("event_type").alias("word"), start.alias("start"), end.alias("end"), F.when(F.col("event_id") % 13 == 0, "OTHER").otherwise("SPEAKER_MAIN").alias("speaker"))
    return val.alignment_violations(items, ("user_id",), F.lit(500.0))


@query("""SELECT user_id, round(exp(avg(ln(least(greatest(value / 100, 1e-6), 1.0)))), 6) AS geometric, round(coalesce(avg(value / 100), 0.0), 6) AS mean, round(coalesce(min(value / 100), 0.0), 6) AS low, coalesce(avg(value / 100), 0.0) < 0.55 AS flagged FROM events GROUP BY user_id""")
def confidence_summary(spark, sf_dir):
    v = F.col("value") / 100
    g = read(spark, sf_dir, "events").groupBy("user_id").agg(F.round(word_confidence(v), 6).alias("geometric"), F.coalesce(F.avg(v), F.lit(0.0)).alias("m"), F.round(F.coalesce(F.min(v), F.lit(0.0)), 6).alias("low"))
    return g.select("user_id", "geometric", F.round("m", 6).alias("mean"), "low", (F.col("m") < GenerationConfig().alignment_min_confidence).alias("flagged"))


# ---- signals -------------------------------------------------------------------

_PEAK = "coalesce(list_max(list_transform({0}, lambda x: abs(x::DOUBLE))), 0.0)"
_TRIPLE = "list_transform(embedding, lambda x: x::DOUBLE * 3)"


def tripled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double") * 3).alias("s"))


@query(f"SELECT vec_id, round({_PEAK.format('embedding')}, 6) AS peak, round(coalesce(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / nullif(len(embedding), 0)), 0.0), 6) AS rms FROM embeddings")
def signal_peak_rms(spark, sf_dir):
    s = F.col("embedding")
    return read(spark, sf_dir, "embeddings").select("vec_id", F.round(signal.peak(s), 6).alias("peak"), F.round(signal.rms(s), 6).alias("rms"))


@query(f"SELECT vec_id, {_PEAK.format(_TRIPLE)} > 0.0001 AS speech, {_PEAK.format(_TRIPLE)} >= 1.000001 AS clips, true AS finite FROM embeddings")
def signal_flags(spark, sf_dir):
    s = F.col("s")
    return tripled(spark, sf_dir).select("vec_id", signal.has_speech(s).alias("speech"), signal.clips(s, 1.0 + 1e-6).alias("clips"), signal.all_finite(s).alias("finite"))


@query(f"SELECT vec_id, k::BIGINT AS k, round(x, 5) AS x FROM (SELECT vec_id, generate_subscripts(s, 1) - 1 AS k, unnest(s) * CASE WHEN p > 1 THEN 0.98::DOUBLE / p ELSE 1.0 END AS x FROM (SELECT vec_id, {_TRIPLE} AS s, {_PEAK.format(_TRIPLE)} AS p FROM embeddings))")
def signal_limiter(spark, sf_dir):
    d = tripled(spark, sf_dir).select("vec_id", F.posexplode(signal.limit(F.col("s"))).alias("k", "x"))
    return d.select("vec_id", F.col("k").cast("long").alias("k"), F.round("x", 5).alias("x"))


@query("""SELECT vec_id, k::BIGINT AS k, round(x * least(1.0, k / 11.0::DOUBLE, (63 - k) / 11.0::DOUBLE), 6) AS x FROM (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS k, unnest(embedding)::DOUBLE AS x FROM embeddings)""")
def signal_fade(spark, sf_dir):
    d = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(signal.fade(F.col("embedding"), 1000, 0.012)).alias("k", "x"))
    return d.select("vec_id", F.col("k").cast("long").alias("k"), F.round("x", 6).alias("x"))


@query(f"SELECT vec_id, k::BIGINT AS k, trunc(greatest(least(x, 1.0), -1.0) * 32767)::INT AS x FROM (SELECT vec_id, generate_subscripts(s, 1) - 1 AS k, unnest(s) AS x FROM (SELECT vec_id, {_TRIPLE} AS s FROM embeddings))")
def signal_pcm16(spark, sf_dir):
    d = tripled(spark, sf_dir).select("vec_id", F.posexplode(signal.pcm16(F.col("s"))).alias("k", "x"))
    return d.select("vec_id", F.col("k").cast("long").alias("k"), "x")


@query("""WITH g AS (SELECT label, vec_id // 16 AS part, list(embedding ORDER BY vec_id) AS c FROM embeddings GROUP BY ALL)
  SELECT label, part::BIGINT AS part, (len(c) * 64 + (len(c) - 1) * 12)::BIGINT AS n, round(list_sum(list_transform(flatten(c), lambda x: x::DOUBLE)), 4) AS total FROM g""")
def chunk_concat(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    g = e.groupBy("label", F.floor(F.col("vec_id") / 16).alias("part")).agg(F.transform(F.sort_array(F.collect_list(F.struct("vec_id", "embedding"))), lambda x: x["embedding"]).alias("c"))
    s = g.select("label", "part", signal.join_chunks(F.col("c"), 100, 0.12).alias("s"))
    return s.select("label", "part", F.size("s").cast("long").alias("n"), F.round(F.aggregate("s", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"))


@query("""WITH t AS (SELECT vec_id // 2 AS pair, vec_id % 2 AS side, embedding AS s FROM embeddings), p AS (SELECT pair, max(CASE WHEN side = 1 THEN s END) AS l, max(CASE WHEN side = 0 THEN s END) AS r FROM t GROUP BY pair)
  SELECT pair::BIGINT AS pair, (64 + 64 + 8)::BIGINT AS n, round(list_sum(list_transform(l, lambda x: x::DOUBLE)), 4) AS left_sum, round(list_sum(list_transform(r, lambda x: x::DOUBLE)), 4) AS right_sum, round(l[1]::DOUBLE, 5) AS left_first FROM p WHERE l IS NOT NULL AND r IS NOT NULL""")
def stereo_assembly(spark, sf_dir):
    """Pairs of vectors as a user's turn, a pause of 8 samples and an assistant's turn."""
    e = read(spark, sf_dir, "embeddings")
    pair, user = F.floor(F.col("vec_id") / 2), F.col("vec_id") % 2 == 0
    p = e.groupBy(pair.alias("pair")).agg(F.max(F.when(user, F.col("embedding"))).alias("u"), F.max(F.when(~user, F.col("embedding"))).alias("a")).where("u IS NOT NULL AND a IS NOT NULL")
    quiet = lambda n: F.array_repeat(F.lit(0.0).cast("float"), n)
    p = p.withColumn("left", F.concat(quiet(F.size("u") + 8), "a")).withColumn("right", F.concat("u", quiet(F.size("a") + 8)))
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda s, x: s + x.cast("double")), 4)
    return p.select("pair", F.size("left").cast("long").alias("n"), total("left").alias("left_sum"), total("right").alias("right_sum"), F.round(F.get("left", F.size("u") + 8).cast("double"), 5).alias("left_first"))


# ---- increments ----------------------------------------------------------------


@query("SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def receipt_compaction(spark, sf_dir):
    log = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return inc.latest(log, "user_id", "event_id").select("user_id", "event_id", "event_type", "value")


def synthetic_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of structurally valid dialogues: one in five is missing, one in seven stale by text, one in eleven by settings."""
    d = inc.with_checksums(structural(spark, sf_dir), GenerationConfig()).where("line_no % 5 <> 0")
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + F.length(t["text"]))
    return d.select(
        "id", "split", F.when(F.col("line_no") % 7 == 0, "stale").otherwise(F.col("source_checksum")).alias("source_checksum"),
        F.when(F.col("line_no") % 11 == 0, "stale").otherwise(F.col("config_checksum")).alias("config_checksum"), (chars / 15.0).alias("duration_seconds"), "user_voice",
    )


def receipt_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    want = inc.with_checksums(structural(spark, sf_dir), GenerationConfig()).select("split", "id", "source_checksum", "config_checksum")
    r = synthetic_receipts(spark, sf_dir).select("id", F.col("source_checksum").alias("rs"), F.col("config_checksum").alias("rc"), F.lit(True).alias("has"))
    j = want.join(r, "id", "left")
    return j.select("split", "id", inc.receipt_reasons(F.col("source_checksum"), F.col("config_checksum"), F.col("has"), F.col("rs"), F.col("rc")).alias("reasons"))


@query(f"WITH {_STRUCT} SELECT split, id FROM good WHERE conv_id % 5 = 0 OR conv_id % 7 = 0 OR conv_id % 11 = 0")
def resume_worklist(spark, sf_dir):
    state = receipt_state(spark, sf_dir).withColumn("ok", F.size("reasons") == 0)
    return inc.worklist(structural(spark, sf_dir), state).select("split", "id")


@query(f"""WITH {_STRUCT} SELECT split, id, 'no completed receipt found' AS reason FROM good WHERE conv_id % 5 = 0
  UNION ALL SELECT split, id, 'receipt source_checksum does not match current source record' FROM good WHERE conv_id % 5 <> 0 AND conv_id % 7 = 0
  UNION ALL SELECT split, id, 'receipt config_checksum does not match current generation config' FROM good WHERE conv_id % 5 <> 0 AND conv_id % 11 = 0""")
def verify_reasons(spark, sf_dir):
    return receipt_state(spark, sf_dir).select("split", "id", F.explode("reasons").alias("reason"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_orderstatus IS DISTINCT FROM CASE o_orderpriority WHEN '1-URGENT' THEN 'F' WHEN '2-HIGH' THEN 'O' ELSE o_orderstatus END) AS n_changed FROM orders")
def checksum_migration(spark, sf_dir):
    new = spark.createDataFrame([("1-URGENT", "F"), ("2-HIGH", "O")], "o_orderpriority string, o_orderstatus string")
    return inc.migrate(read(spark, sf_dir, "orders"), new, ["o_orderpriority"], "o_orderstatus")[1]


@query(f"WITH {_STRUCT} SELECT split, conv_id AS line_no, 'audio/' || id || '.wav' AS path, round(chars / 15.0::DOUBLE, 3) AS duration FROM good WHERE conv_id % 5 <> 0")
def manifest_build(spark, sf_dir):
    return inc.manifest(structural(spark, sf_dir), synthetic_receipts(spark, sf_dir))


@query("""WITH l AS (SELECT l_orderkey, sum(l_extendedprice * (1 + l_tax) * (1 - l_discount)) AS s FROM lineitem GROUP BY l_orderkey)
  SELECT o_orderkey, round(o_totalprice, 2) AS listed, round(coalesce(s, 0), 2) AS found FROM orders LEFT JOIN l ON l_orderkey = o_orderkey WHERE abs(coalesce(o_totalprice, -1) - coalesce(s, 0)) > 0.01""")
def manifest_duration_mismatch(spark, sf_dir):
    """The tolerance check of manifests at volume: listed totals against the sums of their lines."""
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 + F.col("l_tax")) * (1 - F.col("l_discount"))).alias("s"))
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left").withColumn("s", F.coalesce("s", F.lit(0.0)))
    return j.where(F.abs(F.coalesce("o_totalprice", F.lit(-1.0)) - F.col("s")) > 0.01).select("o_orderkey", F.round("o_totalprice", 2).alias("listed"), F.round("s", 2).alias("found"))


def checked_inputs(spark: SparkSession, sf_dir: str, kinds: int) -> DataFrame:
    """Structurally valid dialogues with their checksums, as finished work with one fault each by ``k``; the others in a tag of columns.

    Sound has 1,600 frames for each character; one word is aligned.
    """
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + F.length(t["text"]))
    d = inc.with_checksums(structural(spark, sf_dir), GenerationConfig())
    return d.withColumn("k", F.col("line_no") % kinds).withColumn("frames", chars * 1600).withColumn("assistant_voice", F.lit(ASSISTANT_VOICE)).withColumn("seed", F.lit(0))


def sound_of(d: DataFrame, k: dict[str, int]) -> DataFrame:
    """Figures of sound files; ``k`` names which rows have which fault."""
    at = lambda name: F.col("k") == k[name]
    return d.select(
        "split", "id", F.when(at("rate"), 16_000).otherwise(24_000).alias("sample_rate"), F.when(at("channels"), 1).otherwise(2).alias("channels"), F.when(at("empty"), 0).otherwise(F.col("frames")).alias("n_frames"),
        (~at("finite")).alias("finite"), (~at("left")).alias("speech_left"), (~at("right")).alias("speech_right"), at("clips").alias("clips"), *[F.lit(0.1).alias(f"{x}_{y}") for x in ("rms", "peak") for y in ("left", "right")],
        F.when(at("error"), "bad header").alias("error"),
    )


def words_of(d: DataFrame, none: int, late: int) -> Column:
    end = F.when(F.col("k") == late, F.col("frames") / 24_000 + 1).otherwise(F.lit(0.2))
    one = F.array(F.struct(F.lit("a").alias("word"), F.lit(0.1).alias("start"), end.alias("end"), F.lit("SPEAKER_MAIN").alias("speaker")))
    return F.when(F.col("k") == none, F.slice(one, 1, 0)).otherwise(one)


_SOUND_SQL = """WHEN {rate} THEN '{w}sample_rate 16000 != 24000' WHEN {channels} THEN '{w}channels 1 != 2' WHEN {left} THEN 'left (assistant) channel has no detectable speech' WHEN {right} THEN 'right (user) channel has no detectable speech'"""


@query(f"""WITH {_STRUCT}, w AS (SELECT split, id, CASE conv_id % 17 WHEN 0 THEN 'wav missing' WHEN 1 THEN 'companion json missing' WHEN 2 THEN 'wav failed to open: bad header' WHEN 3 THEN 'companion json failed to parse'
  {_SOUND_SQL.format(w='wav ', rate=4, channels=5, left=8, right=9)} WHEN 6 THEN 'wav has zero samples; alignments[0] end exceeds duration' WHEN 7 THEN 'wav contains non-finite samples' WHEN 10 THEN 'wav peak at/above clipping threshold'
  WHEN 11 THEN 'alignments missing or empty' WHEN 12 THEN 'alignments[0] end exceeds duration' WHEN 13 THEN 'no completed receipt found' WHEN 14 THEN 'receipt source_checksum does not match current source record'
  WHEN 15 THEN 'receipt config_checksum does not match current generation config' ELSE '' END AS reasons FROM good) SELECT split, id, reasons = '' AS ok, reasons FROM w""")
def resume_verification(spark, sf_dir):
    """The check of finished work before it is resumed: every reason it knows, on one dialogue in seventeen each."""
    d = checked_inputs(spark, sf_dir, 17)
    wavs = sound_of(d.where("k <> 0"), {"error": 2, "rate": 4, "channels": 5, "empty": 6, "finite": 7, "left": 8, "right": 9, "clips": 10})
    made = d.where("k <> 1").select("split", "id", (F.col("k") != 3).alias("parsed"), words_of(d, 11, 12).alias("alignments"))
    stale = lambda c, k: F.when(F.col("k") == k, "stale").otherwise(F.col(c)).alias(c)
    receipts = d.where("k <> 13").select("id", stale("source_checksum", 14), stale("config_checksum", 15))
    v = inc.verify(structural(spark, sf_dir), wavs, made, receipts, GenerationConfig())
    return v.select("split", "id", "ok", F.array_join("reasons", "; ").alias("reasons"))


@query(f"""WITH {_STRUCT}, w AS (SELECT split, id, conv_id % 21 AS k, chars, CASE conv_id % 21 WHEN 0 THEN 'companion json missing' WHEN 1 THEN 'wav failed to open: bad header' WHEN 2 THEN 'companion json failed to parse'
  {_SOUND_SQL.format(w='', rate=3, channels=4, left=7, right=8)} WHEN 5 THEN 'wav has zero frames; implausibly short duration 0.000s; alignments[0] end exceeds duration' WHEN 6 THEN 'non-finite audio samples' WHEN 9 THEN 'clipping detected'
  WHEN 10 THEN 'alignments missing or empty' WHEN 11 THEN 'alignments[0] end exceeds duration' WHEN 12 THEN 'assistant_voice ''bm_x'' != required ''af_heart''' WHEN 13 THEN 'user_voice ''xx_no'' is not in the ''' || split || ''' pool'
  WHEN 14 THEN 'dialogue id not found in source split files' WHEN 15 THEN 'source split ''elsewhere'' != output split ''' || split || ''' (split overlap/mismatch)' WHEN 16 THEN 'category mismatch between source and companion json'
  WHEN 17 THEN 'source_dialogue checksum mismatch between source data and companion json' WHEN 18 THEN 'no corresponding entry in split manifest' WHEN 19 THEN 'manifest duration 9999.0 does not match wav duration ' || printf('%.3f', chars / 15.0::DOUBLE) ELSE '' END AS problems FROM good)
  SELECT split, id, problems = '' AS ok, problems, CASE WHEN k IN (0, 1) THEN NULL WHEN k = 5 THEN 0.0 WHEN k = 3 THEN round(chars / 10.0::DOUBLE, 6) ELSE round(chars / 15.0::DOUBLE, 6) END AS duration_seconds FROM w""")
def qa_record_checks(spark, sf_dir):
    """The judgement of a generated data set, file by file: every kind of problem, on one dialogue in twenty-one each."""
    d = checked_inputs(spark, sf_dir, 21)
    wavs = sound_of(d, {"error": 1, "rate": 3, "channels": 4, "empty": 5, "finite": 6, "left": 7, "right": 8, "clips": 9})
    other = lambda c, k, x: F.when(F.col("k") == k, x).otherwise(F.col(c)).alias(c)
    made = d.where("k <> 0").select(
        "split", "id", (F.col("k") != 2).alias("parsed"), words_of(d, 10, 11).alias("alignments"), F.lit(0.9).alias("confidence_mean"), F.lit(False).alias("flagged"), other("assistant_voice", 12, "bm_x"), other("user_voice", 13, "xx_no"), "seed",
        other("category", 16, "other"), other("source_checksum", 17, "stale"),
    )
    index = qa.source_index(d.where("k <> 14").select(other("split", 15, "elsewhere"), "id", "category", "turns", "line_no", "source_checksum"))
    listed = F.when(F.col("k") == 19, 9999.0).when(F.col("k") == 5, 0.0).when(F.col("k") == 3, F.col("frames") / 16_000).otherwise(F.col("frames") / 24_000)
    c = qa.check(wavs, made, index, d.where("k <> 18").select("split", "id", listed.alias("duration")), GenerationConfig())
    return c.select("split", "id", "ok", F.array_join("problems", "; ").alias("problems"), F.round("duration_seconds", 6).alias("duration_seconds"))


# ---- reports -------------------------------------------------------------------


def synthetic_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structurally valid dialogues as checked records; one in nine failed."""
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + F.length(t["text"]))
    return structural(spark, sf_dir).select("split", "id", (F.col("line_no") % 9 != 0).alias("ok"), (chars / 15.0).alias("duration_seconds"), F.when(F.col("line_no") % 8 == 0, "").otherwise(F.col("category")).alias("category"))


_PCT = ", ".join(f"round(coalesce(quantile_cont({{0}}, {p / 100}), 'NaN'::DOUBLE), 4) AS p{p}" for p in (0, 25, 50, 75, 90, 95, 99, 100))
_CHECKS = f"{_STRUCT}, c AS (SELECT split, id, conv_id % 9 <> 0 AS ok, chars / 15.0::DOUBLE AS s, CASE WHEN conv_id % 8 = 0 THEN '' ELSE category END AS category FROM good)"


@query(f"WITH {_CHECKS} SELECT split, count(*) AS found, count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS invalid, round(coalesce(sum(s) FILTER (WHERE ok), 0.0) / 3600, 6) AS hours, {_PCT.format('CASE WHEN ok THEN s END')} FROM c GROUP BY split")
def qa_split_summary(spark, sf_dir):
    return qa.split_summary(synthetic_checks(spark, sf_dir))


@query(f"WITH {_CHECKS} SELECT coalesce(nullif(category, ''), 'unknown') AS category, round(sum(s) / 3600, 6) AS hours FROM c WHERE ok GROUP BY 1")
def qa_category_hours(spark, sf_dir):
    return qa.category_hours(synthetic_checks(spark, sf_dir))


@query(f"SELECT l_returnflag, {_PCT.format('l_extendedprice')} FROM lineitem GROUP BY l_returnflag")
def qa_percentiles(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(*[c.alias(k) for k, c in percentiles(F.col("l_extendedprice")).items()])


@query("""SELECT count(*) AS n_valid, (SELECT count(*) FROM documents) AS n_index, round(count(*) * 100.0::DOUBLE / nullif((SELECT count(*) FROM documents), 0), 4) AS completion_percent FROM documents SEMI JOIN (SELECT * FROM labels WHERE quality = 1) USING (doc_id)""")
def qa_completion_percent(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id")
    return qa.completion(d.join(read(spark, sf_dir, "labels").where("quality = 1"), "doc_id", "left_semi"), d)


@query(f"WITH {_STRUCT} SELECT split, count(*) AS total, count(*) FILTER (WHERE conv_id % 5 <> 0) AS completed, count(*) FILTER (WHERE conv_id % 5 = 0) AS failed, round(coalesce(sum(chars / 15.0::DOUBLE) FILTER (WHERE conv_id % 5 <> 0), 0.0) / 3600, 6) AS hours FROM good GROUP BY split")
def generation_summary(spark, sf_dir):
    return inc.generation_summary(structural(spark, sf_dir), synthetic_receipts(spark, sf_dir))


@query(f"""WITH {_CHECKS}, e AS (SELECT * FROM (VALUES ('train', 20), ('validation', 5), ('test', 1)) AS x(split, expected)), h AS (SELECT split, count(*) AS found, count(*) FILTER (WHERE ok) AS valid FROM c GROUP BY split)
  SELECT split, coalesce(found, 0) AS found, coalesce(valid, 0) AS valid, expected::BIGINT AS expected, CASE WHEN coalesce(found, 0) < expected THEN 'incomplete' WHEN valid < found THEN 'invalid' ELSE 'complete' END AS verdict FROM e LEFT JOIN h USING (split)""")
def dataset_verdict(spark, sf_dir):
    return qa.verdict(synthetic_checks(spark, sf_dir), spark, {"train": 20, "validation": 5, "test": 1})


