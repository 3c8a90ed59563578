"""The registered queries of the operators of this subpackage, over whole tables, and their SQL where there is one."""

from __future__ import annotations

import os
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtide.llm import (
    bpe,
    conversation,
    decontaminate,
    embedding_dedup,
    html_text,
    license_scan,
    line_dedup,
    merkle,
    minhash,
    packing,
    quality,
    url_filter,
    warc,
)
from labtide.llm.staging import table

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@cache
def tokenizer() -> str:
    """The vocabulary file of the packing query; its place can be set by LABTIDE_TOKENIZER."""
    import public_tokenizers

    return os.environ.get("LABTIDE_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")


@cache
def ranks() -> str:
    """The rank file of the byte-level query; its place can be set by LABTIDE_RANKS."""
    import public_tokenizers

    return os.environ.get("LABTIDE_RANKS") or public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select(
        "page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict", "judged.score"
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = line_dedup.LineIndex(spark)
    index.insert(docs)
    return index.digests(docs)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).drop("url")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "evidence", "host_rate", "path_rate", "posterior", "kept")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item; clean documents have no row."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_item").distinct()


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer())


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks(), public_tokenizers.PATTERN)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.digests(conversation.repair(conversation.damaged(table(spark, sf_dir, "conversations"))))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_near_duplicates,
        op3_line_dedup,
        op4_license_scan,
        op5_warc,
        op6_quality,
        op7_embedding_dedup,
        op8_decontamination,
        op9_packing,
        op10_html_text,
        op11_merkle_manifest,
        op12_byte_bpe,
        op13_conversation_repair,
    )
}

LINES_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT doc_id, place, line, coalesce(doc_id < keeper, false) AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

WARC_SQL = """
WITH pages_of AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM pages_of WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM pages_of LEFT JOIN firsts USING (payload_digest)
"""

VECTORS_SQL = """
WITH RECURSIVE fine AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
linked AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION
  SELECT r.node, l.b FROM reach r JOIN linked l ON l.a = r.seen),
least AS (SELECT node AS vec_id, min(seen) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a AS vec_id, count(*) AS n FROM linked GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN degree USING (vec_id)
"""

def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _crc(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    return f"""xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT), lambda c, x:
    list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(c, x)),
    4294967295::BIGINT), 4294967295)"""

MERKLE_SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, CASE WHEN {_crc("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS changed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
low AS (
  SELECT lang, 0 AS level, i, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1
  GROUP BY lang, level, i // 2, n),
trees AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, i, n, subroot AS h FROM trees
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY level, i // 2, n),
places AS (
  SELECT l.rid, l.level, l.level AS seq, l.i >> l.level AS own, s.h
  FROM (SELECT rid, lang, i, unnest(range(CAST(ceil(log2(n)) AS BIGINT))) AS level FROM leaves) l
  LEFT JOIN low s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = l.level AND s.i = xor(l.i >> l.level, 1)
  UNION ALL
  SELECT l.rid, t.level, 1000 + t.level, t.i >> t.level, s.h
  FROM leaves l JOIN (SELECT lang, i, unnest(range(CAST(ceil(log2(n)) AS BIGINT))) AS level FROM trees) t
    ON t.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN high s ON s.level = t.level AND s.i = xor(t.i >> t.level, 1)),
path AS (SELECT rid, own, h, row_number() OVER (PARTITION BY rid ORDER BY seq) AS step FROM places),
fold AS (
  SELECT rid, 0 AS step, coalesce(changed, leaf) AS node FROM leaves
  UNION ALL
  SELECT f.rid, f.step + 1, sha256(CASE WHEN p.h IS NULL THEN node WHEN p.own % 2 = 1 THEN p.h || node ELSE node || p.h END)
  FROM fold f JOIN path p ON p.rid = f.rid AND p.step = f.step + 1),
top AS (SELECT rid, max_by(node, step) AS folded_root FROM fold GROUP BY rid),
proofs AS (SELECT rid, string_agg(h, '' ORDER BY step) AS proof FROM path WHERE h IS NOT NULL GROUP BY rid),
root AS (SELECT h AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN trees t ON t.lang IS NOT DISTINCT FROM l.lang CROSS JOIN root JOIN top USING (rid) LEFT JOIN proofs USING (rid)
"""

# Documents whose sets of word pairs overlap by 80 %, and the smallest id reachable; words are cut at white space.
NEAR_SQL = """
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ \\x09-\\x0D]+') AS w FROM documents),
grams AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)),
                                           lambda i: w[i] || ' ' || w[i + 1]) END)) AS g FROM cut),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION
  SELECT r.node, l.b FROM reach r JOIN ways l ON l.a = r.seen),
least AS (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

# Documents that hold 80 % of an item's runs of five words, or all words of a shorter item in a row.
LEAKS_SQL = """
WITH texts AS (
  SELECT 'doc' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'item', item_id, text FROM benchmark),
cut AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
items AS (
  SELECT DISTINCT id, least(5, len(w)) AS width,
         unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda i: array_to_string(w[i : i + least(5, len(w)) - 1], ' '))) AS g
  FROM cut WHERE kind = 'item' AND len(w) > 0),
grams AS (
  SELECT DISTINCT id, width, unnest(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i : i + width - 1], ' '))) AS g
  FROM cut, (SELECT DISTINCT width FROM items) WHERE kind = 'doc' AND len(w) >= width),
sizes AS (SELECT id, count(*) AS n_item FROM items GROUP BY id),
shared AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM items i JOIN grams d USING (width, g) GROUP BY 1, 2)
SELECT doc_id, item_id, n_shared, n_item FROM shared JOIN sizes ON sizes.id = item_id WHERE 100 * n_shared >= 80 * n_item
"""

SPACES_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# Costs from each place in the grammar to the end (c0 start, c1 after s, c2 after u, c3 after a), turn by turn from the
# back; then the cheapest way is walked from the front, least edit first.
REPAIR_SQL = f"""
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations),
held AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM coded, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) copies),
placed AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS initial, lag(left(role, 1)) OVER w AS last, rtrim(text, {SPACES_SQL}) AS bare
  FROM held WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault FROM placed),
turns AS (
  SELECT *, fault IN ('blank', 'duplicate') AS bad, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cut FROM faults),
known AS (
  SELECT c.conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE last IS NOT NULL AND last || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
  GROUP BY c.conv_id),
back AS (
  SELECT conv_id, n + 1 AS i, 0 AS c0, 4 AS c1, 2 AS c2, 0 AS c3 FROM known
  UNION ALL
  SELECT conv_id, i, least(k0, 2 + k2, 4 + k3), least(k1, 2 + k2, 4 + k3), least(k2, 2 + k3), least(k3, 2 + k2) FROM (
    SELECT b.conv_id, t.i, least(3 + c1, u + c2) AS k1, least(3 + c2, a + c3) AS k2, least(3 + c3, u + c2) AS k3,
           least(3 + c0, u + c2, CASE WHEN initial = 's' AND NOT bad THEN cut + c1 ELSE 1000000 END) AS k0
    FROM back b JOIN (
      SELECT *, cut + CASE WHEN bad THEN 1000000 WHEN initial = 'u' THEN 0 ELSE 2 END AS u,
             cut + CASE WHEN bad THEN 1000000 WHEN initial = 'a' THEN 0 ELSE 2 END AS a FROM turns) t
      ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.i = b.i - 1)),
costs AS (SELECT conv_id, i, [c0, c1, c2, c3] AS c FROM back),
walk AS (
  SELECT conv_id, 1 AS i, 0 AS phase, '' AS audit, []::VARCHAR[] AS lines FROM known
  UNION ALL
  SELECT conv_id, CASE WHEN edit = 'I' THEN i ELSE i + 1 END,
         CASE WHEN edit = 'D' THEN phase WHEN edit = 'S' THEN 1 WHEN phase = 2 THEN 3 ELSE 2 END,
         audit || CASE WHEN edit = 'S' THEN 'K' ELSE edit END,
         CASE edit WHEN 'D' THEN lines WHEN 'I' THEN list_append(lines, want || ':')
                   WHEN 'R' THEN list_append(lines, want || ':' || text) ELSE list_append(lines, role || ':' || text) END
  FROM (
    SELECT w.*, t.role, t.text, CASE WHEN phase = 2 THEN 'assistant' ELSE 'user' END AS want,
           CASE WHEN t.i IS NULL THEN 'I'
                WHEN 3 + after.c[phase + 1] = here.c[phase + 1] THEN 'D'
                WHEN 2 + here.c[CASE WHEN phase = 2 THEN 4 ELSE 3 END] = here.c[phase + 1] THEN 'I'
                WHEN phase = 0 AND initial = 's' AND NOT bad AND cut + after.c[2] = here.c[1] THEN 'S'
                WHEN initial = CASE WHEN phase = 2 THEN 'a' ELSE 'u' END THEN 'K' ELSE 'R' END AS edit
    FROM walk w JOIN costs here ON here.conv_id IS NOT DISTINCT FROM w.conv_id AND here.i = w.i
    LEFT JOIN costs after ON after.conv_id IS NOT DISTINCT FROM w.conv_id AND after.i = w.i + 1
    LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i
    WHERE t.i IS NOT NULL OR phase IN (1, 2))),
ends AS (SELECT conv_id, max_by(audit, length(audit)) AS audit, max_by(lines, length(audit)) AS lines FROM walk GROUP BY conv_id)
SELECT k.conv_id, gaps, blank, duplicate, truncated, illegal, c.c[1]::BIGINT AS cost, audit,
       sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM known k JOIN ends e ON e.conv_id IS NOT DISTINCT FROM k.conv_id JOIN costs c ON c.conv_id IS NOT DISTINCT FROM k.conv_id AND c.i = 1
"""

# The other operators rest on trained models, tokenizers, packing orders or parsing, which SQL cannot state.
ORACLES: dict[str, str] = {
    "op2_near_duplicates": NEAR_SQL,
    "op8_decontamination": LEAKS_SQL,
    "op3_line_dedup": LINES_SQL,
    "op5_warc": WARC_SQL,
    "op7_embedding_dedup": VECTORS_SQL,
    "op11_merkle_manifest": MERKLE_SQL,
    "op13_conversation_repair": REPAIR_SQL,
}
