"""Registered queries of the training-data operators: ``opN_<name>`` applies
operator N to its whole table and returns the checked columns. SQL is given
where SQL can express the whole result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from donorlake.llm import (bpe, bwt, classlm, decontaminate, divergence, fptree, langid, pii, quality_rules, resample,
                           rlz, superminhash, tokencount)
from donorlake.llm.util import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


OP1_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT rid, w[p] || ' ' || w[p + 1] AS x
  FROM (SELECT rid, w, unnest(range(1, len(w))) AS p FROM d WHERE len(w) >= 2)
  UNION ALL SELECT rid, w[1] FROM d WHERE len(w) = 1),
size AS (SELECT rid, count(*) AS n FROM sets GROUP BY rid),
shared AS (SELECT a.rid AS a, b.rid AS b, count(*) AS inter FROM sets a JOIN sets b ON a.x = b.x AND a.rid < b.rid
         GROUP BY a.rid, b.rid),
link AS (SELECT a, b FROM shared JOIN size s ON s.rid = a JOIN size t ON t.rid = b
         WHERE 100 * inter >= 80 * (s.n + t.n - inter)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a AS node, a AS other FROM edge UNION SELECT node, b FROM reach JOIN edge ON other = a),
named AS (SELECT node, min(d.doc_id) AS least FROM reach JOIN d ON d.rid = other GROUP BY node)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least, doc_id)::BIGINT AS component_id,
       doc_id IS NOT DISTINCT FROM coalesce(least, doc_id) AS kept
FROM d LEFT JOIN size USING (rid) LEFT JOIN named ON node = rid
"""


@query("op1_superminhash", OP1_SQL)
def op1_superminhash(spark, sf_dir):
    return superminhash.digest(superminhash.near_duplicates(table(spark, sf_dir, "documents"), k=2))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_QUALITY_RULES = quality_rules.RULES

OP3_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  coalesce(text, '') AS text, {_WORDS} AS w, row_number() OVER () AS rid FROM documents),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
line_n AS (SELECT rid, line, count(*) AS n FROM lines
           WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
per_line AS (SELECT rid, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines FROM line_n GROUP BY rid),
pos AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3),
win AS (SELECT rid, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS x FROM pos),
dup AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, x) AS n FROM win) WHERE n >= 2),
rep AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM dup) GROUP BY rid),
m AS (SELECT d.rid, doc_id, lang, source, len(w)::BIGINT AS n_words,
             length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN per_line USING (rid) LEFT JOIN rep USING (rid)),
v AS ({" UNION ALL ".join(
    f"SELECT rid, lang, source, '{name}' AS rule, {a} / greatest({b}, 1)::DOUBLE AS value, "
    f"{floor}::DOUBLE AS floor_, {str(both).lower()} AS both_ FROM m WHERE n_words > 0"
    for name, (a, b, floor, both) in _QUALITY_RULES.items())}),
b AS (SELECT *, CASE WHEN value > 0 THEN ceil(ln(value) / ln({quality_rules.GAMMA}::DOUBLE)) END AS bin FROM v),
c AS (SELECT lang, source, rule, any_value(floor_) AS floor_, any_value(both_) AS both_, bin, count(*) AS n FROM b
      GROUP BY lang, source, rule, bin),
cl AS (SELECT lang, rule, bin, sum(n) AS n FROM c GROUP BY lang, rule, bin),
qo AS (SELECT lang, source, rule, max(total) AS total, any_value(floor_) AS floor_, any_value(both_) AS both_,
              min(CASE WHEN upto > floor(0.25 * (total - 1)) THEN value END) AS q1,
              min(CASE WHEN upto > floor(0.75 * (total - 1)) THEN value END) AS q3
       FROM (SELECT *, coalesce(2 / ({quality_rules.GAMMA} + 1) * pow({quality_rules.GAMMA}::DOUBLE, bin), 0.0) AS value,
                    sum(n) OVER (PARTITION BY lang, source, rule ORDER BY bin NULLS FIRST) AS upto,
                    sum(n) OVER (PARTITION BY lang, source, rule) AS total FROM c)
       GROUP BY lang, source, rule),
ql AS (SELECT lang, rule,
              min(CASE WHEN upto > floor(0.25 * (total - 1)) THEN value END) AS l1,
              min(CASE WHEN upto > floor(0.75 * (total - 1)) THEN value END) AS l3
       FROM (SELECT *, coalesce(2 / ({quality_rules.GAMMA} + 1) * pow({quality_rules.GAMMA}::DOUBLE, bin), 0.0) AS value,
                    sum(n) OVER (PARTITION BY lang, rule ORDER BY bin NULLS FIRST) AS upto,
                    sum(n) OVER (PARTITION BY lang, rule) AS total FROM cl)
       GROUP BY lang, rule),
q AS (SELECT lang, source, rule, floor_, both_,
             CASE WHEN total >= {quality_rules.MIN_GROUP} THEN q1 ELSE l1 END AS q1,
             CASE WHEN total >= {quality_rules.MIN_GROUP} THEN q3 ELSE l3 END AS q3
      FROM qo JOIN ql USING (lang, rule)),
f AS (SELECT rid, bool_or(value > q3 + {quality_rules.REACH} * greatest(q3 - q1, q.floor_)
                          OR (q.both_ AND value < q1 - {quality_rules.REACH} * greatest(q3 - q1, q.floor_))) AS bad
      FROM v JOIN q USING (lang, source, rule) GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PCT} * n_words) AS base_failed,
       NOT (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PCT} * n_words)
         AND NOT coalesce(bad, false) AS kept
FROM m LEFT JOIN f USING (rid)
"""


@query("op3_quality_rules", OP3_SQL)
def op3_quality_rules(spark, sf_dir):
    return quality_rules.digest(quality_rules.quality_rules(table(spark, sf_dir, "documents")))


@query("op2_weak_pii")
def op2_weak_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.detect(docs, pii.fit(docs)))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark, sf_dir):
    return bwt.digest(bwt.suffix_dedup(table(spark, sf_dir, "documents")))


@query("op5_class_lm")
def op5_class_lm(spark, sf_dir):
    return classlm.digest(classlm.class_lm(table(spark, sf_dir, "documents")))


@query("op6_byte_bpe")
def op6_byte_bpe(spark, sf_dir):
    return bpe.digest(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"))))


@query("op7_importance_resampling")
def op7_importance_resampling(spark, sf_dir):
    return resample.digest(resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@query("op8_language_id")
def op8_language_id(spark, sf_dir):
    return langid.digest(langid.language_id(table(spark, sf_dir, "documents")))


OP9_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(doc_id, 9223372036854775807) AS k, {_WORDS} AS w FROM documents),
win AS (SELECT rid, k, p, array_to_string(w[p : p + 12], ' ') AS x
        FROM (SELECT rid, k, w, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13)),
dup AS (SELECT rid, p FROM win JOIN (SELECT x, min(k) AS least FROM win GROUP BY x) USING (x) WHERE least < k),
gone AS (SELECT DISTINCT rid, unnest(range(p, p + 13)) AS q FROM dup),
word AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (SELECT word.rid, string_agg(word, ' ' ORDER BY word.q) FILTER (gone.q IS NULL) AS text, count(gone.q) AS n
         FROM word LEFT JOIN gone ON word.rid = gone.rid AND word.q = gone.q GROUP BY word.rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


@query("op9_rlz_dedup", OP9_SQL)
def op9_rlz_dedup(spark, sf_dir):
    return rlz.digest(rlz.substring_dedup(table(spark, sf_dir, "documents")))


OP10_SQL = rf"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
  WHERE text IS NOT NULL AND item_id IS NOT NULL),
sized AS (SELECT item_id, w, least(len(w), {decontaminate.WINDOW}) AS n FROM items WHERE len(w) > 0),
item_win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k : k + n - 1], ' ') AS x
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM sized)),
doc_win AS (
  SELECT rid, p, n, array_to_string(w[p : p + n - 1], ' ') AS x
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM words, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n)),
found AS (SELECT rid, p, n, item_id FROM doc_win JOIN item_win USING (n, x)),
hit AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM found) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM found) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid)
"""


@query("op10_decontaminate", OP10_SQL)
def op10_decontaminate(spark, sf_dir):
    return decontaminate.digest(
        decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


_LOWER_TEXT = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_LOWER_TEXT}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
vocab AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= {divergence.MIN_DOCS}),
cnt AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN vocab USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM d),
tot AS (SELECT lang, source, sum(n) AS total FROM cnt GROUP BY lang, source),
lng AS (SELECT lang, count(*) AS v, sum(n) AS total FROM vocab GROUP BY lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + ({divergence.SCALE}::HUGEINT * (coalesce(c.n, 0) + {divergence.SMOOTH}))
               // (coalesce(tot.total, 0) + {divergence.SMOOTH} * lng.v)::HUGEINT AS p,
             1 + ({divergence.SCALE}::HUGEINT * (k.n + {divergence.SMOOTH}))
               // (lng.total + {divergence.SMOOTH} * lng.v)::HUGEINT AS q
      FROM grp g JOIN vocab k USING (lang) JOIN lng USING (lang) LEFT JOIN tot USING (lang, source)
      LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}
"""


@query("op11_source_divergence", OP11_SQL)
def op11_source_divergence(spark, sf_dir):
    return divergence.digest(divergence.audit(table(spark, sf_dir, "documents")))


@query("op12_token_counts")
def op12_token_counts(spark, sf_dir):
    return tokencount.digest(tokencount.count_tokens(table(spark, sf_dir, "documents")))


OP13_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid,
                  regexp_extract_all({_LOWER_TEXT}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, row_number() OVER () AS iid,
             regexp_extract_all({_LOWER_TEXT}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
asked AS (SELECT iid, unnest(w) AS term FROM i),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM asked) GROUP BY rid, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
total AS (SELECT count(*) AS n, sum(len(w)) AS l FROM d WHERE len(w) > 0),
m AS (SELECT rid, doc_id, 75 + (25 * len(w)::HUGEINT * total.n) // total.l AS m FROM d, total WHERE len(w) > 0),
weight AS (SELECT term, floor(1000 * ln((2 * total.n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, total),
score AS (SELECT iid, rid, doc_id, sum(w * ((1000000000 * tf)::BIGINT // (1000 * tf + 12 * m)))::BIGINT AS score
          FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN m USING (rid) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN i USING (iid) WHERE rank <= {fptree.TOP}
"""


@query("op13_fp_tree_search", OP13_SQL)
def op13_fp_tree_search(spark, sf_dir):
    return fptree.digest(fptree.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
