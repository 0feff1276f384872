"""One query per operator over its whole table, with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeworks.llm import ann, bpe, chat, exact_dedup, hmm, langid, line_dedup, merkle, mixing, periodic, simhash, toxicity, warc
from ridgeworks.llm.common import remainder, written
from ridgeworks.session import shared_path

RANKS = "byte_bpe_multi_50k.tiktoken"
# fixed value: the contract's extra conversation
EXTRA = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = langid.LanguageModel(docs.filter(~held_out))
    found = model.identify(docs, F.struct("doc_id", held_out.alias("held_out")), F.col("text"))
    return found.select("row.doc_id", "row.held_out", "found.lang_pred", "found.score")


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    encoded = bpe.encode_texts(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return bpe.digests(encoded)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    held_out = remainder(F.col("doc_id"), 3) == 1
    allowed = docs.filter(remainder(F.col("doc_id"), 3) != 1)
    model = toxicity.ToxicityModel(docs, labels.filter(~held_out), learn=allowed)
    predicted = F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0)
    return model.scores().select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", EXTRA), (-7, 1, "assistant", EXTRA)], rows.schema)
    return chat.digests(chat.format_conversations(rows.unionByName(extra)))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.Mix(table(spark, folder, "documents"))
    return mix.taken().select("doc_id", "size", "source_size", "target", "taken")


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark)
    decisions, _ = exact_dedup.deduplicate(table(spark, folder, "documents"), index)
    index.close()
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return decisions.select("doc_id", "keep_id", "group_size", "kept", digest)


def op9_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 7) == 2
    return hmm.HiddenMarkov(docs, held_out).scores()


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(table(spark, folder, "pages"))
    return cleaned.select("row.page_id", "host", "n_lines", "n_dropped", "clean_text")


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    values = {x: F.replace(x, F.lit("\n"), F.lit("")) if x == "text" else F.col(x) for x in merkle.FIELDS}
    touched = (remainder(F.col("doc_id"), 2) == 0) & F.contains("text", F.lit("\n"))
    tampered = F.when(touched, merkle.leaf_digest(list(values.values())))
    found = merkle.Manifest(docs, carry={"tampered": tampered}).proofs()
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.withColumn("folded_root", folded).select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.archive_pages(table(spark, folder, "pages"), path)
    records = written(warc.read_archives(spark, path, payloads=False), "warc-heads")
    found = warc.with_originals(records)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = periodic.periodic_runs(docs, text=periodic.looped(F.col("doc_id"), F.col("text")))
    return periodic.digests(found)


QUERIES = {
    f.__name__: f
    for f in (
        op1_nearest_neighbours,
        op2_language_id,
        op3_byte_bpe,
        op4_toxicity,
        op5_simhash,
        op6_chat_format,
        op7_mixing,
        op8_exact_dedup,
        op9_language_model,
        op10_line_dedup,
        op11_merkle_manifest,
        op12_warc_revisits,
        op13_periodic_runs,
    )
}


def _part(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_part(text if x == 'text' else x) for x in merkle.FIELDS)})"


def _sides(place: str, level: str) -> str:
    """Sibling digests before and after a node's ancestor in the list of a level's nodes."""
    at = f"({place} // CAST(power(3, {level}.level) AS BIGINT))"
    before = f"list_slice({level}.nodes, {at} // 3 * 3 + 1, {at})"
    after = f"list_slice({level}.nodes, {at} + 2, {at} // 3 * 3 + 3)"
    return f"{{'b': array_to_string({before}, ''), 'a': array_to_string({after}, '')}}"


_UNSEEN = line_dedup.UNSEEN.replace("(?s)", "")

ORACLES = {
    "op6_chat_format": f"""
WITH said AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role,
         coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (CAST(-7 AS BIGINT), CAST(0 AS BIGINT), 'user', '{EXTRA}'), (-7, 1, 'assistant', '{EXTRA}')),
escaped AS (
  SELECT *, regexp_replace(text, '\\\\|###|</turn>', '\\\\\\0', 'g') AS safe_text,
         regexp_replace(role, '[\\\\#:<\\n]', '\\\\\\0', 'g') AS safe_role FROM said),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length('### ' || safe_role || ': ' || safe_text || '</turn>' || chr(10))) AS chars
  FROM escaped GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM joined
""",
    "op8_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op10_line_dedup": f"""
WITH lined AS (
  SELECT page_id,
         lower(regexp_extract(coalesce(url, ''),
               '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         list_filter(list_transform(string_split(
           regexp_replace(regexp_replace(coalesce(html, ''), '{_UNSEEN}', chr(10), 'gs'),
                          '{line_dedup.TAG}', chr(10), 'g'), chr(10)),
           lambda x: regexp_replace(x, '{line_dedup.EDGE}', '', 'g')), lambda x: x <> '') AS lines
  FROM pages),
totals AS (SELECT host, count(*) AS pages FROM lined GROUP BY host),
held AS (SELECT host, line, count(*) AS held
         FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM lined) GROUP BY host, line),
often AS (SELECT host, list(line) AS often FROM held JOIN totals USING (host)
          WHERE held >= {line_dedup.MIN_PAGES} AND held > pages * CAST({line_dedup.RATIO} AS DOUBLE) GROUP BY host),
cut AS (SELECT page_id, host, lines,
               list_filter(lines, lambda x: NOT coalesce(list_contains(often, x), false)) AS stay
        FROM lined LEFT JOIN often USING (host))
SELECT page_id, host, CAST(len(lines) AS INTEGER) AS n_lines, CAST(len(lines) - len(stay) AS INTEGER) AS n_dropped,
       array_to_string(stay, chr(10)) AS clean_text
FROM cut
""",
    "op12_warc_revisits": """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                       sha256(coalesce(html, '')) AS payload_digest FROM pages),
ranked AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least,
                  row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS place FROM hashed)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN least END AS refers_to
FROM ranked
""",
    # crc32 bit by bit over the decimal digits; levels as lists, a path as (before, after) texts of siblings
    "op11_merkle_manifest": f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         {_leaf("replace(text, chr(10), '')")} AS cut,
         xor(list_reduce(list_concat([4294967295], flatten(list_transform(
             string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
           lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384)), 4294967295) & 1 AS crc_low
  FROM documents),
ordered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
trees AS (SELECT source, list(leaf ORDER BY idx) AS nodes FROM ordered GROUP BY source),
levels AS (
  SELECT source, 0 AS level, nodes FROM trees
  UNION ALL
  SELECT source, level + 1, list_transform(range(0, len(nodes), 3),
         lambda i: sha256(array_to_string(list_slice(nodes, i + 1, i + 3), ''))) FROM levels WHERE len(nodes) > 1),
subroots AS (SELECT source, nodes[1] AS subroot FROM levels WHERE len(nodes) = 1),
seated AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS seat FROM subroots),
tops AS (
  SELECT 0 AS level, (SELECT list(subroot ORDER BY seat) FROM seated) AS nodes
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 3),
         lambda i: sha256(array_to_string(list_slice(nodes, i + 1, i + 3), ''))) FROM tops WHERE len(nodes) > 1),
placed AS (
  SELECT o.doc_id, o.source, o.leaf, o.cut, o.crc_low, o.idx, s.subroot, s.seat
  FROM ordered o JOIN seated s ON o.source IS NOT DISTINCT FROM s.source),
own AS (
  SELECT p.source, p.idx, list({_sides('p.idx', 'l')} ORDER BY l.level) AS path
  FROM placed p JOIN levels l ON p.source IS NOT DISTINCT FROM l.source WHERE len(l.nodes) > 1 GROUP BY p.source, p.idx),
over AS (
  SELECT s.seat, list({_sides('s.seat', 't')} ORDER BY t.level) AS path
  FROM seated s, tops t WHERE len(t.nodes) > 1 GROUP BY s.seat),
paths AS (
  SELECT p.doc_id, p.leaf, p.subroot, CASE WHEN p.crc_low = 0 THEN p.cut ELSE p.leaf END AS start,
         list_concat(coalesce(o.path, []), coalesce(v.path, [])) AS path
  FROM placed p LEFT JOIN own o ON p.source IS NOT DISTINCT FROM o.source AND p.idx = o.idx
  LEFT JOIN over v ON p.seat = v.seat),
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root,
         sha256(array_to_string(list_transform(path, lambda x: x.b || x.a), '')) AS proof_sha256,
         list_reduce(list_concat([{{'b': start, 'a': ''}}], path),
           lambda t, x: {{'b': sha256(x.b || t.b || x.a), 'a': ''}}).b AS folded_root
  FROM paths)
SELECT *, folded_root = root AS verified FROM folded
""",
}
