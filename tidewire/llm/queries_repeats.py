"""Registered queries of whitening, repeated passages and spelling variants, with oracle SQL where SQL can express them."""

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import passages, spelling, whitening
from tidewire.llm.common import table


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(table(spark, sf_dir, "documents"))


QUERIES = {"op11_whitening": op11_whitening, "op12_passages": op12_passages, "op13_spelling": op13_spelling}
ORACLES = {
    # Near words by their deletions: one word is the other without a letter, or both lack the same place's letter.
    "op13_spelling": f"""
WITH RECURSIVE steps AS (
  SELECT i, 0 AS k, i AS c FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
hashed AS (SELECT run, times, xor(4294967295, list_reduce(
    list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295)) AS h FROM counted, crc),
slipped AS (SELECT CASE WHEN h % {spelling.SLIP} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, times FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM slipped WHERE length(word) >= {spelling.MIN_LETTERS} GROUP BY word HAVING sum(times) >= {spelling.MIN_COUNT}),
cuts AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS cut FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM words)),
pairs AS (
  SELECT a.word AS word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
ranked AS (SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS place FROM pairs),
judged AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= {spelling.FORM_FACTOR} * w.n THEN r.other END AS form,
    CASE WHEN r.other_n >= {spelling.FORM_FACTOR} * w.n THEN r.other_n END AS form_n FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
walk AS (SELECT word, word AS root, form AS onward FROM judged UNION ALL SELECT k.word, j.word, j.form FROM walk k JOIN judged j ON j.word = k.onward)
SELECT j.word, j.form, k.root, j.n, j.n_near, j.form_n FROM judged j JOIN walk k ON k.word = j.word WHERE k.onward IS NULL""",
}
