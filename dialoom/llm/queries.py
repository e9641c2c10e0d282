"""Registered queries of the corpus operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dialoom.llm.common import table

#: A public SentencePiece model, where the box has one.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.quality import quality

    return quality(table(spark, sf_dir, "documents")).drop("clean_text")


def op2_sentencepiece(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    from dialoom.llm.pieces import encode

    return encode(table(spark, sf_dir, "documents"), model)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.lm import score

    return score(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.digests import fingerprint

    return fingerprint(table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.suffixes import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.urls import judge_urls

    return judge_urls(table(spark, sf_dir, "pages")).withColumn("template_purity", F.round("template_purity", 6))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.chat import format_chats, read_back, text_parts, under_mask

    own = spark.sql(r"""SELECT -7L AS conv_id, turn, role, r'\### Assistant: </turn> ok' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(turn, role)""")
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(own)
    d = format_chats(text_parts(turns)).withColumn("turns", read_back(F.col("formatted"))).withColumn("loss", under_mask(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return d.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.html import extract

    return extract(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_sentencepiece, op3_lm_scoring, op4_simhash_near_dedup, op5_document_fingerprints, op6_suffix_array_dedup, op7_url_filters, op8_chat_formatting, op9_html_extraction, op10_mixing)}


_SPACE = r"[\x20\x09-\x0D]+"
_ENDS = """'.', '!', '?', '…', ':', ';', '。', '！', '？', '"', '''', '”', '’', '»', ')', ']'"""


def _op1_sql() -> str:
    """The same counts and line rules in DuckDB; three-word windows are compared as texts."""
    from dialoom.llm.quality import BOILERPLATE, NAVIGATION, SEPARATORS

    any_of = lambda tests: "(" + " OR ".join(tests) + ")"
    count = lambda m: f"length(x) - length(replace(x, '{m}', ''))"
    spaces = count(" ")
    short = f"({spaces} < 8 AND (regexp_matches(lower(x), '{NAVIGATION.replace(chr(39), chr(39) * 2)}') OR {any_of(f'contains(x, {chr(39)}{m}{chr(39)})' for m in SEPARATORS)}))"
    long_ = any_of(f"{count(m)} >= 2" for m in SEPARATORS)
    phrases = any_of(f"contains(lower(x), '{p}')" for p in BOILERPLATE)
    passes = rf"(x = '' OR (right(x, 1) IN ({_ENDS}) AND len(regexp_extract_all(x, '[#*$%&|<>{{}}\\]')) * 10 <= {spaces} + 1 AND NOT {short} AND NOT {long_} AND NOT (x = upper(x) AND x <> lower(x)) AND NOT {phrases}))"
    return rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda w: w <> '') AS w FROM documents),
      g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
      r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
      l AS (SELECT doc_id, y, trim(y, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS y FROM d)),
      k AS (SELECT doc_id, sum(length(y))::BIGINT AS all_chars, coalesce(sum(length(y)) FILTER (WHERE {passes}), 0)::BIGINT AS kept_chars, count(*) FILTER (WHERE x <> '') - count(DISTINCT CASE WHEN x <> '' THEN y END) AS dup FROM l GROUP BY doc_id),
      a AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda z: length(z))), 0)::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, dup::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, all_chars, kept_chars
        FROM d JOIN k USING (doc_id) LEFT JOIN r USING (doc_id)),
      b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
      SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 100 * (all_chars - kept_chars) <= 30 * all_chars AS kept, kept_chars, all_chars - kept_chars AS lost_chars FROM b"""


_ESC = r"replace(replace(replace({0}, '\', '\\'), '<|', '<\|'), '|>', '|\>')"
_OP8_SQL = rf"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
  SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length({_ESC.format('role')}) + length({_ESC.format('text')}) + 16)::BIGINT AS formatted_chars FROM c GROUP BY conv_id"""


def _op7_sql() -> str:
    """Host, path and rules as the contract has them; the template tree by the same statistics."""
    wild = r"(regexp_full_match(q, '[0-9]+') OR regexp_full_match(q, '[0-9a-fA-F-]{8,}') OR (regexp_matches(q, '[0-9]') AND length(q) >= 12) OR regexp_full_match(q, '[0-9]{2,4}[-_.][0-9]{1,2}([-_.][0-9]{1,4})?'))"
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    from dialoom.llm.urls import DEPTH, LOWER, MERGED, RULES, TAIL, UPPER

    ranked = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h + p}'" for h, p, _ in ranked) + " END"
    said = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in ranked) + " END"
    share = lambda b, n: f"{b} / nullif({n}, 0)::DOUBLE"
    pooled = share("ab", "an")
    apart = f"coalesce(abs({share('kb', 'kn')} - {share('(ab - kb)', '(an - kn)')}) > 1.96 * sqrt({pooled} * (1 - {pooled}) * (1 / nullif(kn, 0)::DOUBLE + 1 / nullif(an - kn, 0)::DOUBLE)), false)"
    levels = "".join(
        f"""k{k} AS MATERIALIZED (SELECT host, node, segs[{k + 1}] AS seg, sum(n) AS kn, sum(b) AS kb FROM t{k} WHERE len(segs) > {k} GROUP BY ALL),
      a{k} AS MATERIALIZED (SELECT host, node, seg, kn, kb, CASE WHEN kids = 1 OR (kn >= 5 AND (an - kn < 5 OR {apart})) THEN seg ELSE '{MERGED}' END AS name
        FROM k{k} JOIN (SELECT host, node, count(*) AS kids, sum(kn) AS an, sum(kb) AS ab FROM k{k} GROUP BY ALL) USING (host, node)),
      m{k} AS MATERIALIZED (SELECT a.host, a.node, a.seg, name, nn, nb FROM a{k} a JOIN (SELECT host, node, name, sum(kn) AS nn, sum(kb) AS nb FROM a{k} GROUP BY ALL) USING (host, node, name)),
      t{k + 1} AS MATERIALIZED (SELECT t.host, segs, n, b, concat_ws('/', nullif(t.node, ''), name) AS node, CASE WHEN nn >= 5 THEN nn ELSE near END AS near, CASE WHEN nn >= 5 THEN nb ELSE bnear END AS bnear
        FROM t{k} t LEFT JOIN m{k} m ON t.host = m.host AND t.node = m.node AND t.segs[{k + 1}] = m.seg),
      """
        for k in range(DEPTH)
    )
    return rf"""WITH u AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
      h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
      r AS (SELECT *, {rule} AS rule, {said} AS said, list_filter(string_split(path, '/'), lambda x: x <> '') AS every FROM h),
      e AS (SELECT page_id, i, s, regexp_replace(s, '\.[A-Za-z]{{1,5}}$', '') AS q, regexp_extract(s, '\.[A-Za-z]{{1,5}}$') AS suffix FROM (SELECT page_id, unnest(every) AS s, generate_subscripts(every, 1) AS i FROM r)),
      g AS (SELECT page_id, list(CASE WHEN {wild} THEN '*' || suffix ELSE s END ORDER BY i) AS w FROM e GROUP BY page_id),
      d AS MATERIALIZED (SELECT r.*, CASE WHEN len(w) > {DEPTH} THEN list_concat(w[:{DEPTH - 1}], ['{TAIL}']) ELSE coalesce(w, []) END AS segs FROM r LEFT JOIN g USING (page_id)),
      l AS (SELECT host, segs, count(said) AS n, count(*) FILTER (WHERE said = 'block') AS b FROM d GROUP BY ALL),
      o AS (SELECT coalesce(sum(b) / nullif(sum(n), 0)::DOUBLE, 0.0) AS prior FROM l),
      t0 AS MATERIALIZED (SELECT host, segs, n, b, '' AS node, CASE WHEN hn >= 5 THEN hn END AS near, CASE WHEN hn >= 5 THEN hb END AS bnear FROM l JOIN (SELECT host, sum(n) AS hn, sum(b) AS hb FROM l GROUP BY host) USING (host)),
      {levels}j AS (SELECT host, segs, node, near, coalesce((bnear + 4.0::DOUBLE * prior) / (near + 4.0::DOUBLE), prior) AS purity FROM t{DEPTH}, o)
      SELECT d.page_id, d.host, d.path, d.rule, coalesce(d.said, CASE WHEN purity >= 0.8 AND near >= 5 THEN 'block' ELSE 'allow' END) AS verdict, node AS template, round(purity, 6) AS template_purity
      FROM d JOIN j ON d.host = j.host AND d.segs = j.segs"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": _op1_sql(), "op7_url_filters": _op7_sql(), "op8_chat_formatting": _OP8_SQL}
