"""The operators bound to the standard tables with production parameters, and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import context_mixing, decontaminate, fill_middle, html_text, jaccard_join, language, lexical_search, mixing, quality_pairs, quality_rules, repeated_bytes, shared_windows, toxicity
from stratum.llm._spark import table


def op1_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_pairs.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality_rules(docs, table(spark, sf_dir, "labels")).drop("text")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.digest(repeated_bytes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), passage=repeated_bytes.PASSAGE))


def op7_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.token_scores(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_classes(table(spark, sf_dir, "documents"), k=3, percent=90).select("doc_id", "n_shingles", "component_id", "n_links")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_shared_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_windows.digest(shared_windows.remove_shared(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_bradley_terry_quality, op2_sainte_lague_mix, op3_quality_rules, op4_html_text, op5_toxicity, op6_repeated_bytes, op7_context_mixing, op8_jaccard_join, op9_language, op10_decontaminate,
    op11_lexical_search, op12_shared_windows, op13_fill_in_middle,
)}

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLE_SQL: dict[str, str] = {
    "op10_decontaminate": f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
cut AS (SELECT item_id, w, least(len(w), 5) AS k, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS p FROM iw WHERE len(w) > 0),
items AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS s FROM cut),
sized AS (SELECT item_id, k, count(*) AS q FROM items GROUP BY item_id, k),
lengths AS (SELECT DISTINCT k FROM items),
runs AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM dw, lengths WHERE len(w) >= k),
docs AS (SELECT DISTINCT doc_id, k, array_to_string(w[p:p + k - 1], ' ') AS s FROM runs)
SELECT doc_id, item_id, q AS n_item, count(*) AS n_shared, count(*) / q AS containment
FROM docs JOIN items USING (k, s) JOIN sized USING (item_id, k)
GROUP BY doc_id, item_id, q HAVING 10 * count(*) >= 8 * q
""",
    "op8_jaccard_join": f"""
WITH RECURSIVE dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
runs AS (SELECT doc_id, w, least(len(w), 3) AS k, unnest(range(1, len(w) - least(len(w), 3) + 2)) AS p FROM dw WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + k - 1], ' ') AS s FROM runs),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.m, d.doc_id)) AS component_id, coalesce(c.c, 0) AS n_links
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) r USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS c FROM link GROUP BY a) c USING (doc_id)
""",
    "op11_lexical_search": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
i AS (SELECT item_id, row_number() OVER () AS q, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS (SELECT r, term, count(*) AS tf FROM d GROUP BY r, term),
z AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM d GROUP BY r),
c AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS l FROM z),
w AS (SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term),
m AS (SELECT r, doc_id, 75 + (25 * n * big_n) // l AS m FROM z, c),
s AS (SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM i JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY q, item_id, r, doc_id),
o AS (SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20
""",
    "op12_shared_windows": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT r, doc_id, unnest(range(1, len(w) - 48)) AS p, unnest(list_transform(range(1, len(w) - 48), lambda p: array_to_string(w[p:p + 49], ' '))) AS s FROM d WHERE len(w) >= 50),
m AS (SELECT s, min(doc_id) AS m FROM s GROUP BY s),
hit AS (SELECT r, p FROM s JOIN m USING (s) WHERE m < doc_id),
gone AS (SELECT DISTINCT r, p + unnest(range(50)) AS x FROM hit),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS x, unnest(w) AS word FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY x) AS k FROM words ANTI JOIN gone USING (r, x) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
""",
    "op13_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT doc_id, t, n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT doc_id, t, n, a, b, form, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1, n - b) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
""",
}
