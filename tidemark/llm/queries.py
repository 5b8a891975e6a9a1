"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import chat, codebooks, htmltext, jaccard, merkle, neighbours, ordinal, packing, personal, pieces, quality, secretscan, suffixes
from tidemark.llm.vocabularies import BYTE_BPE, BYTE_BPE_ADDED, PIECES
from tidemark.llm.registry import QUERIES, SQL, query  # noqa: F401 - read by the entry module
from tidemark.sources.tables import Inputs

# The rules hold as plain conditions; their order in the cascade does not matter.
QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
m AS (
  SELECT doc_id, t, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines
  FROM d),
r AS (
  SELECT doc_id, i, list_aggregate(list_slice(w, i, i + 7), 'string_agg', ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
q AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM r) WHERE n > 1),
c AS (
  SELECT doc_id, sum(least(8, i - coalesce(before, i - 8)))::BIGINT AS n
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM q) GROUP BY doc_id),
f AS (
  SELECT m.*, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    n_words < 20 OR 100 * coalesce(c.n, 0) > 30 * n_words AS base_failed,
    length(t) - length(replace(t, chr(10), '')) + 1 AS all_lines,
    length(t) - length(regexp_replace(t, '[\p{L}\p{M}]', '', 'g')) AS letters,
    length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS capitals,
    len(regexp_extract_all(t, '(?m)^[ \t]*[-*•●·]')) AS bullets,
    len(regexp_extract_all(t, '(?m)(?:…|\.\.\.)[ \t]*$')) AS ellipses,
    len(regexp_extract_all(t, '(?m)^.*\S')) AS filled,
    length(t) - length(regexp_replace(t, '[{};]', '', 'g')) AS code
  FROM m LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * all_lines
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 100 * letters < 60 * word_chars
    OR 100 * capitals > 40 * word_chars OR 100 * bullets > 90 * filled OR 100 * ellipses > 30 * filled
    OR 100 * code > 5 * word_chars) AS kept
FROM f
"""

# Trees level by level: a node of 16 has the concatenated hashes in order. The crc32 goes byte by byte over a table by its rule.
MERKLE_SQL = r"""
WITH RECURSIVE
step(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS tab FROM step WHERE k = 8),
f AS (
  SELECT doc_id, source, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1])), 4294967295) % 5 = 0 AS hit
  FROM documents, crc),
l AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN hit THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS other
  FROM f),
d AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY source) AS n
  FROM l),
nodes(source, level, i, n, h) AS (
  SELECT source, 0, rank, n, leaf FROM d
  UNION ALL
  SELECT source, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY source, level, i // 16, n),
subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, i, n, h) AS (
  SELECT 0, rank, n, subroot FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 16, n),
upper AS (
  SELECT s.source, s.subroot, s.rank, t.level, string_agg(t.h, '' ORDER BY t.i) FILTER (t.i < s.rank >> (4 * t.level)) AS a,
    string_agg(t.h, '' ORDER BY t.i) FILTER (t.i > s.rank >> (4 * t.level)) AS b
  FROM subroots s JOIN tops t ON t.n > 1 AND t.i // 16 = s.rank >> (4 * t.level + 4) GROUP BY ALL),
above AS (SELECT source, list(coalesce(a, '') || '|' || coalesce(b, '') ORDER BY level) AS up FROM upper GROUP BY source),
lower AS (
  SELECT d.source, d.rank, s.level, string_agg(s.h, '' ORDER BY s.i) FILTER (s.i < d.rank >> (4 * s.level)) AS a,
    string_agg(s.h, '' ORDER BY s.i) FILTER (s.i > d.rank >> (4 * s.level)) AS b
  FROM d JOIN nodes s ON s.source IS NOT DISTINCT FROM d.source AND s.n > 1 AND s.i // 16 = d.rank >> (4 * s.level + 4) GROUP BY ALL),
beside AS (SELECT source, rank, list(coalesce(a, '') || '|' || coalesce(b, '') ORDER BY level) AS side FROM lower GROUP BY source, rank),
p AS (
  SELECT d.doc_id, d.leaf, s.subroot, (SELECT h FROM tops WHERE n = 1) AS root, d.other,
    list_concat(coalesce(b.side, []), coalesce(u.up, [])) AS path
  FROM d JOIN subroots s ON s.source IS NOT DISTINCT FROM d.source
  LEFT JOIN beside b ON b.source IS NOT DISTINCT FROM d.source AND b.rank = d.rank
  LEFT JOIN above u ON u.source IS NOT DISTINCT FROM d.source),
r AS (
  SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(other, leaf), path), lambda x, y: sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2))) AS folded_root
  FROM p)
SELECT *, folded_root = root AS verified FROM r
"""


def codebook_sql(rounds: int = 6) -> str:
    """Lloyd's rounds written out: the distances to all entries, the least of them, the floors of the means."""
    ctes = [
        """v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS u
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
        """p AS MATERIALIZED (
  SELECT vec_id, part, i, u[1 + part * (len(u) // 8) + i] AS x
  FROM v, range(8) a(part), LATERAL (SELECT unnest(range(len(v.u) // 8)) AS i))""",
        """c0 AS MATERIALIZED (
  SELECT part, e, i, x FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v ORDER BY vec_id LIMIT 16) USING (vec_id))""",
    ]
    for r in range(rounds + 1):
        ctes.append(
            f"""n{r} AS MATERIALIZED (
  SELECT vec_id, part, min(d * 16 + e) % 16 AS e, min(d * 16 + e) // 16 AS d
  FROM (SELECT vec_id, part, e, sum((p.x - c.x) * (p.x - c.x))::BIGINT AS d FROM p JOIN c{r} c USING (part, i) GROUP BY ALL)
  GROUP BY ALL)"""
        )
        if r < rounds:
            ctes.append(
                f"""c{r + 1} AS MATERIALIZED (
  SELECT c.part, c.e, c.i, coalesce((m.s - ((m.s % m.k) + m.k) % m.k) // m.k, c.x) AS x
  FROM c{r} c LEFT JOIN (
    SELECT part, e, i, sum(x)::BIGINT AS s, count(*) AS k FROM p JOIN n{r} USING (vec_id, part) GROUP BY ALL) m USING (part, e, i))"""
            )
    last = rounds
    ctes.append(
        f"""r AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM n{last} GROUP BY vec_id)"""
    )
    return f"""WITH {", ".join(ctes)}
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, e, i)) FROM c{last}) AS codebooks_sha256
FROM r JOIN v USING (vec_id)
"""


@query("op1_suffix_array_dedup")
def op1_suffix_array_dedup(t: Inputs):
    """What is left of every document without byte strings of 200 that occur twice."""
    return suffixes.digests(t("documents"))


@query("op2_quality_rules", QUALITY_SQL)
def op2_quality_rules(t: Inputs):
    """Measures and the verdict of the cascade for every document."""
    return quality.judged(t("documents").select("doc_id", "text")).drop("text")


@query("op3_html_extraction")
def op3_html_extraction(t: Inputs):
    """The main text of every page."""
    return htmltext.extract(t("pages"))


@query("op4_ngram_jaccard_join")
def op4_ngram_jaccard_join(t: Inputs):
    """Documents linked at 85 % of their four-word shingles, as components."""
    return jaccard.near_duplicates(t("documents"), k=4, percent=85)


@query("op5_chat_formatting")
def op5_chat_formatting(t: Inputs):
    """Roles recovered from the texts of every conversation, and their canonical turns."""
    turns = t("conversations")
    return chat.formatted(turns.drop("role"), chat.train(turns))


@query("op6_secret_scans")
def op6_secret_scans(t: Inputs):
    """Secrets in every document: base patterns, and structures confirmed by parsing."""
    return secretscan.scan(t("documents"))


@query("op7_nearest_neighbours")
def op7_nearest_neighbours(t: Inputs):
    """The ten nearest found of every hundredth vector, among all others."""
    return neighbours.nearest(t("embeddings"), F.col("id") % 100 == 0)


@query("op8_sentencepiece_nbest")
def op8_sentencepiece_nbest(t: Inputs):
    """The three best segmentations of every document."""
    return pieces.encoded(t("documents"), PIECES, n=3)


@query("op9_quality_classifier")
def op9_quality_classifier(t: Inputs):
    """Expected grade, probability of the top grade and verdict for every document."""
    model = ordinal.train(t("documents"), ordinal.grades_of(t("labels")), 3)
    return ordinal.score(t("documents"), model)


@query("op10_lexical_packing")
def op10_lexical_packing(t: Inputs):
    """All documents in windows of 1024 tokens, together with documents that share their words."""
    return packing.packed(t("documents"), *BYTE_BPE, added=BYTE_BPE_ADDED)


@query("op11_vector_codes", codebook_sql())
def op11_vector_codes(t: Inputs):
    """Every vector in codes of eight codebooks, after six rounds."""
    return codebooks.digests(t("embeddings"))


@query("op12_personal_data")
def op12_personal_data(t: Inputs):
    """Personal data in every document: base patterns, and spans that a model of all labelers' votes confirms."""
    return personal.found(t("documents"))


@query("op13_merkle_manifest", MERKLE_SQL)
def op13_merkle_manifest(t: Inputs):
    """Leaf, subroot, root and proof of every document, and the root that a tampered text leads to."""
    return merkle.checked(t("documents"))
