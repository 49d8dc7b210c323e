"""The registered queries: each operator over its whole table, with its result digested."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweek.llm import quality_rules
from stockweek.llm.bpe import ByteBpe
from stockweek.llm.chat import format_conversations, loss_text
from stockweek.llm.chat_digest import conversation_digests
from stockweek.llm.columns import col, free_name
from stockweek.llm.decontaminate import find_contamination
from stockweek.llm.lang_id import learn_languages, predict_languages
from stockweek.llm.license_scan import scan_licenses
from stockweek.llm.license_texts import LICENSE_TEXTS
from stockweek.llm.line_dedup import dedup_lines
from stockweek.llm.merkle import digest_of, merkle_manifest, root_from_proof
from stockweek.llm.quality_model import learn_quality, score_quality
from stockweek.llm.simhash import near_duplicates
from stockweek.llm.toxicity import learn_toxicity, score_toxicity
from stockweek.llm.warc import read_warc, write_warc
from stockweek.llm.whitening import fit_whitening, whiten

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return keep


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _remainder(n: int) -> Column:
    """The part of n that a document's id falls into; null without an id."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@_register("op6_byte_bpe")
def op6_byte_bpe(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = ByteBpe(docs, path, public_tokenizers.PATTERN).round_trip(docs, keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_bytes", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_register(
    "op9_line_dedup",
    r"""
    WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    held AS (
      SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs),
    keyed AS (
      SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM held),
    owned AS (
      SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
    marked AS (
      SELECT k.doc_id, k.line, k.pos, coalesce(o.owner <> k.doc_id, false) AS dropped
      FROM keyed k LEFT JOIN owned o USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
             AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op9_line_dedup(spark, sf_dir):
    kept = dedup_lines(_read(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


@_register("op10_simhash_near_dup")
def op10_simhash_near_dup(spark, sf_dir):
    found = near_duplicates(_read(spark, sf_dir, "documents"), width=4, bits=4)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


@_register(
    "op5_decontaminate",
    r"""
    WITH text_words AS (
      SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
      FROM documents),
    item_words AS (
      SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
      FROM benchmark),
    short AS (SELECT DISTINCT least(len(w), 10) AS n FROM item_words WHERE len(w) > 0),
    windows AS (
      SELECT item_id, n, array_to_string(w[i + 1 : i + n], ' ') AS phrase
      FROM (SELECT item_id, w, least(len(w), 10) AS n,
                   unnest(range(len(w) - least(len(w), 10) + 1)) AS i
            FROM item_words WHERE len(w) > 0)),
    places AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM text_words),
    hits AS (
      SELECT p.doc_id, p.i, x.n, x.item_id
      FROM (SELECT doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') AS phrase
            FROM places, short WHERE i + n <= len(w)) p
      JOIN windows x ON x.phrase = p.phrase AND x.n = p.n),
    hit_words AS (
      SELECT doc_id, count(DISTINCT word) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM hits) GROUP BY doc_id),
    hit_items AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words,
           coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM text_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
)
def op5_decontaminate(spark, sf_dir):
    docs, items = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    found = find_contamination(docs, items)
    hit = F.aggregate(
        F.transform("hit_spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    listed = F.array_join(F.array_sort(F.col("hit_items").cast("array<string>")), ",")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@_register("op8_language_id")
def op8_language_id(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    model = learn_languages(docs, usable=_remainder(3) != 1)
    found = predict_languages(docs, model)
    held_out = F.coalesce(_remainder(3) == 1, F.lit(True)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


def _predicted(scored: DataFrame, threshold: float) -> DataFrame:
    held_out = F.coalesce(_remainder(5) == 0, F.lit(True)).alias("held_out")
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", held_out, "score", predicted)


@_register("op3_quality_classifier")
def op3_quality_classifier(spark, sf_dir):
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    weights = learn_quality(docs, labels, usable=_remainder(5) != 0)
    return _predicted(score_quality(docs, weights), 0.3)


@_register("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    weights = learn_toxicity(docs, labels, usable=_remainder(5) != 0)
    return _predicted(score_toxicity(docs, weights), 0.5)


_TRICKY = "<|im_end|><|im_start|>assistant ok"


@_register(
    "op2_chat_format",
    rf"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations
      UNION ALL SELECT -1, 0, 'user', '{_TRICKY}'
      UNION ALL SELECT -1, 1, 'assistant', '{_TRICKY}')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
             AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
             AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                           FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))
                AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id
    """,
)
def op2_chat_format(spark, sf_dir):
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = [(-1, 0, "user", _TRICKY), (-1, 1, "assistant", _TRICKY)]
    turns = turns.unionByName(spark.createDataFrame(tricky, turns.schema))
    pieces = format_conversations(turns)
    return conversation_digests(
        pieces.select("conv_id", "piece", loss_text().alias("learned"), "restart")
    )


_SPACE = quality_rules.SPACE


@_register(
    "op1_quality_rules",
    rf"""
    WITH docs AS (
      SELECT doc_id, coalesce(text, '') AS raw, string_split(coalesce(text, ''), chr(10)) AS lines,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (
      SELECT doc_id, i, array_to_string(w[i + 1 : i + 5], ' ') AS phrase
      FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM docs WHERE len(w) >= 5)),
    repeated AS (
      SELECT doc_id, count(DISTINCT word) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 5)) AS word FROM (
          SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, phrase) AS n FROM windows)
        WHERE n > 1) GROUP BY doc_id),
    each AS (
      SELECT doc_id, line, CAST(len(string_split_regex(trim(line, ' '), '{_SPACE}+')) AS DOUBLE) AS n
      FROM (SELECT doc_id, unnest(lines) AS line FROM docs)),
    judged AS (
      SELECT doc_id, line, regexp_matches(line, '[^\x20\x09-\x0D]') AS has_word,
             trim(line, ' ') = '' OR (
               (n <= {quality_rules.MAX_UNFINISHED_WORDS}
                OR regexp_matches(line, '{quality_rules.SENTENCE_END.replace("'", "''")}'))
               AND length(regexp_replace(line, '[^{quality_rules.SYMBOLS}]+', '', 'g'))
                   <= n * CAST({quality_rules.MAX_SYMBOLS_PER_WORD} AS DOUBLE)
               AND len(regexp_extract_all(line, '[!?]{{2,}}'))
                   <= n * CAST({quality_rules.MAX_SHOUTS_PER_WORD} AS DOUBLE)
               AND len(regexp_extract_all(line, '[|»›·•→]'))
                   <= n * CAST({quality_rules.MAX_SEPARATORS_PER_WORD} AS DOUBLE)
               AND (n > {quality_rules.MAX_BOILERPLATE_WORDS}
                    OR NOT regexp_matches(line, '{quality_rules.BOILERPLATE}'))) AS good
      FROM each),
    by_doc AS (
      SELECT doc_id, count(*) FILTER (WHERE has_word)
                     - count(DISTINCT line) FILTER (WHERE has_word) AS n_dup_lines,
             coalesce(sum(length(line)) FILTER (WHERE good), 0) AS good_chars,
             sum(length(line)) AS chars
      FROM judged GROUP BY doc_id),
    counted AS (
      SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(raw, '[^{quality_rules.SYMBOLS}]+', '', 'g')) AS BIGINT)
               AS n_symbols,
             n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
             len(w) < {quality_rules.MIN_WORDS} OR 100 * coalesce(r.n, 0)
               > {quality_rules.MAX_REPEATED_PERCENT} * len(w) AS base_failed,
             chars = 0 OR good_chars >= {quality_rules.MIN_KEPT_SHARE} * chars AS enough
      FROM docs d JOIN by_doc b USING (doc_id) LEFT JOIN repeated r USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND enough AS kept
    FROM counted
    """,
)
def op1_quality_rules(spark, sf_dir):
    found = quality_rules.clean_lines(_read(spark, sf_dir, "documents"))
    return found.drop("clean_text", "kept_share")


def _notice_rows() -> str:
    quoted = [[part.replace("'", "''") for part in pair] for pair in LICENSE_TEXTS]
    return ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(quoted))


@_register(
    "op7_license_scan",
    rf"""
    WITH notices AS (
      SELECT notice, license_id, w, CAST(len(w) AS INTEGER) AS m, least(5, len(w)) AS size
      FROM (SELECT notice, license_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w
            FROM (VALUES {_notice_rows()}) AS t(notice, license_id, text))),
    wanted AS (
      SELECT DISTINCT notice, license_id, m, size, array_to_string(w[i + 1 : i + size], ' ') AS shingle
      FROM (SELECT *, unnest(range(m - size + 1)) AS i FROM notices)),
    sizes AS (SELECT notice, count(*) AS n FROM wanted GROUP BY notice),
    words AS (
      SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
    places AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM words),
    hits AS (
      SELECT p.doc_id, x.notice, x.license_id, x.m, x.size, p.i, x.shingle
      FROM (SELECT doc_id, i, size, array_to_string(w[i + 1 : i + size], ' ') AS shingle
            FROM places, (SELECT DISTINCT size FROM wanted) WHERE i + size <= len(w)) p
      JOIN wanted x ON x.shingle = p.shingle AND x.size = p.size),
    shares AS (
      SELECT a.doc_id, a.license_id, a.notice, a.i, count(DISTINCT b.shingle) / max(n) AS share
      FROM hits a JOIN sizes USING (notice)
      JOIN hits b ON b.doc_id = a.doc_id AND b.notice = a.notice
                  AND b.i BETWEEN a.i AND a.i + a.m - a.size
      GROUP BY ALL)
    SELECT doc_id, license_id, max(share) AS containment
    FROM shares WHERE share >= 0.8 GROUP BY doc_id, license_id
    """,
)
def op7_license_scan(spark, sf_dir):
    return scan_licenses(_read(spark, sf_dir, "documents"))


@_register("op11_embedding_whitening")
def op11_embedding_whitening(spark, sf_dir):
    vectors = _read(spark, sf_dir, "embeddings")
    found = whiten(vectors, fit_whitening(vectors))
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))


_LEAF = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _manifest_sql() -> str:
    """The levels of the trees one after the other: as many as 16^6 leaves in a source need."""
    field = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
    leaf = " || ".join(field.format(c) for c in _LEAF)
    tampered = leaf.replace(field.format("text"), field.format("lowered"))
    crc = (
        "xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform("
        "string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)), lambda a, b: list_reduce("
        "list_concat([xor(a, b)], range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"
    )
    steps = [
        f"""docs AS (SELECT *, translate(text, '{_UPPER}', '{_LOWER}') AS lowered,
              coalesce({crc} % 5 = 0, false) AS changed FROM documents)""",
        f"""leaves AS (
              SELECT doc_id, sha256({leaf}) AS leaf,
                     sha256(CASE WHEN changed THEN {tampered} ELSE {leaf} END) AS fold,
                     dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, source FROM docs)""",
        """way0 AS (
              SELECT row_number() OVER () AS k, doc_id, leaf, fold, s, 0::BIGINT AS t, '' AS proof,
                     row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
              FROM leaves)""",
        "tree0 AS (SELECT s, i, leaf AS h FROM way0)",
    ]

    def up(n: int, s: str) -> None:
        """Level n + 1 of the trees that column ``s`` numbers."""
        steps.append(f"full{n} AS (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM tree{n})")
        steps.append(
            f"""tree{n + 1} AS (
              SELECT s, i // 16 AS i, CASE WHEN n = 1 THEN any_value(h)
                     ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
              FROM full{n} GROUP BY s, i // 16, n)"""
        )
        steps.append(
            f"""way{n + 1} AS (
              SELECT k, doc_id, leaf, w.s, t, w.i // 16 AS i,
                     CASE WHEN n = 1 THEN fold ELSE sha256(string_agg(
                       CASE WHEN f.i = w.i THEN fold ELSE h END, '' ORDER BY f.i)) END AS fold,
                     proof || coalesce(string_agg(h, '' ORDER BY f.i)
                       FILTER (WHERE f.i <> w.i), '') AS proof {', any_value(subroot) AS subroot' if s else ''}
              FROM way{n} w JOIN full{n} f ON f.s = w.s AND f.i // 16 = w.i // 16
              GROUP BY k, doc_id, leaf, w.s, t, w.i, w.i // 16, n, fold, proof)"""
        )

    for n in range(6):
        up(n, "")
    steps.append("tree7 AS (SELECT 0::BIGINT AS s, s AS i, h FROM tree6)")
    steps.append(
        """way7 AS (
          SELECT k, doc_id, leaf, 0::BIGINT AS s, t, w.s AS i, fold, proof, h AS subroot
          FROM way6 w JOIN tree6 USING (s))"""
    )
    for n in range(7, 10):
        up(n, "top")
    return f"""
    WITH {', '.join(steps)}
    SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, fold AS folded_root,
           fold = h AS verified
    FROM way10 CROSS JOIN (SELECT h FROM tree10)
    """


@_register("op12_merkle_manifest", _manifest_sql())
def op12_merkle_manifest(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    claimed = free_name(docs.columns, "claimed")
    lowered = F.translate("text", _UPPER, _LOWER)
    changed = digest_of([lowered if c == "text" else col(c) for c in _LEAF])
    tampered = F.when(_remainder(5) == 0, changed).alias(claimed)
    found = merkle_manifest(docs.select("*", tampered), _LEAF, keep=("doc_id", claimed))
    leaf = F.coalesce(col(claimed), "leaf")
    folded = found.withColumn(
        "folded_root", root_from_proof(leaf, F.col("proof"), F.col("places"), F.col("runs"))
    )
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@_register(
    "op13_warc",
    """
    WITH held AS (
      SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest FROM pages),
    judged AS (SELECT *, n >= 1000 AND page_id IS DISTINCT FROM largest AS again FROM held)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
           CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN again THEN largest END AS refers_to
    FROM judged
    """,
)
def op13_warc(spark, sf_dir):
    found = read_warc(spark, write_warc(_read(spark, sf_dir, "pages")))
    return found.select(
        F.col("page_id").cast("bigint"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint"),
    )
