"""Name queries over customer-derived raw names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire import fixed_values as fixed
from tidewire.functions import names as fn
from tidewire.functions.similarity import token_sort, token_sort_ratio
from tidewire.functions.text import fallback, strip_ws
from tidewire.operators import ranking, resolve, signals
from tidewire.plans import fixtures as fx, records
from tidewire.plans.catalog import sqltext as sql

c = F.col


def _raw(spark, sf):
    return fx.derive(spark, sf, fx.RAW_NAMES)


def _names(spark, sf):
    return resolve.distinct_names(_raw(spark, sf).select("raw_name"))


def _mapping(spark, sf, **options):
    return resolve.resolve_entities(_names(spark, sf), resolve.dictionary_frame(spark), **options)


def _exact_tier(found: str):
    """Names that one of the two exact tiers finds; the fuzzy tier has no part in it."""

    def query(spark, sf):
        table = resolve.Dictionary(resolve.dictionary_frame(spark))
        tiers = resolve.add_exact(_names(spark, sf), table)
        if found == "cleaned_name":
            tiers = resolve.add_cleaned_exact(tiers, table)
        return tiers.where(c(found).isNotNull()).select("raw_name", c(found).alias("canonical_name"), F.lit(100.0).alias("score"))

    return query


def _of_type(kind, *columns):
    return lambda spark, sf: _mapping(spark, sf).where(c("match_type") == kind).select(*columns)


def src_dictionary(spark, sf):
    exact = resolve.add_exact(_raw(spark, sf), resolve.Dictionary(resolve.dictionary_frame(spark)))
    counts = exact.groupBy(c("exact_name").alias("canonical")).agg(F.count("*").alias("n"))
    joined = resolve.dictionary_frame(spark).join(counts, "canonical", "left")
    return joined.select("pos", "canonical", F.coalesce("n", F.lit(0)).alias("names"))


def token_sort_scores(spark, sf):
    pairs = _raw(spark, sf).withColumn("pos", (c("rec_id") % 50).cast("int"))
    joined = pairs.join(F.broadcast(resolve.dictionary_frame(spark)), "pos")
    return joined.select("rec_id", "canonical", F.round(token_sort_ratio(c("raw_name"), c("canonical")), 6).alias("score"))


def score_round(spark, sf):
    pairs = _raw(spark, sf).withColumn("pos", (c("rec_id") * 7 % 50).cast("int"))
    joined = pairs.join(F.broadcast(resolve.dictionary_frame(spark)), "pos")
    return joined.select("rec_id", F.bround(token_sort_ratio(c("raw_name"), c("canonical")), 2).alias("score"))


def argmax_match(spark, sf):
    cleaned = _names(spark, sf).withColumn("cleaned", fn.clean_name(strip_ws(c("raw_name"))))
    targets = cleaned.select(token_sort(fallback(c("cleaned"), strip_ws(c("raw_name")))).alias("target"))
    best = resolve.best_matches(targets, resolve.Dictionary(resolve.dictionary_frame(spark)), 0.0)
    return best.select("target", c("best.canonical").alias("canonical_name"), F.round("best.score", 6).alias("score"))


def union_distinct_names(spark, sf):
    items = fx.derive(spark, sf, fx.HUB_ITEMS)
    orgs = items.select(fn.product_org(c("id")))
    variants = spark.createDataFrame([(v,) for v in fixed.NAME_VARIANTS], "raw_name string")
    return resolve.distinct_names(_raw(spark, sf).select("raw_name"), orgs, variants)


def api_resolver(spark, sf):
    """Another dictionary and threshold: supplier names against customer names."""
    suppliers = fx.table(spark, sf, "supplier").select(c("s_name").alias("raw_name"))
    dictionary = resolve.dictionary_frame(spark, ["Supplier 1", "Supplier#000000007", "supplier 000000011", "Customer"])
    return resolve.resolve_entities(resolve.distinct_names(suppliers), dictionary, threshold=90.0)


def api_resolver_wide(spark, sf):
    """A dictionary past the inline limit: every part name with its size, resolved through the segment join."""
    entries = fx.table(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_brand").alias("canonical"), "p_partkey")
    dictionary = entries.groupBy("canonical").agg(F.min("p_partkey").alias("pos"))
    wanted = fx.table(spark, sf, "part").select(F.concat_ws("  ", F.lower("p_brand"), F.initcap("p_name")).alias("raw_name"))
    return resolve.resolve_entities(resolve.distinct_names(wanted), dictionary, threshold=85.0, inline_limit=100)


def plan_entity_mapping(spark, sf):
    sources = [_raw(spark, sf).select("raw_name"), fx.derive(spark, sf, fx.HUB_ITEMS).select(fn.product_org(c("id")))]
    return records.entity_mapping(sources, resolve.dictionary_frame(spark))


QUERIES = {
    "src_dictionary": src_dictionary,
    "clean_name": lambda s, d: _raw(s, d).select("rec_id", fn.clean_name(c("raw_name")).alias("cleaned")),
    "drop_blank": lambda s, d: signals.drop_blank(_raw(s, d), "raw_name"),
    "token_sort_ratio": token_sort_scores,
    "score_round": score_round,
    "argmax_match": argmax_match,
    "distinct_names": _names,
    "union_distinct_names": union_distinct_names,
    "er_exact": _exact_tier("exact_name"),
    "er_cleaned_exact": _exact_tier("cleaned_name"),
    "er_fuzzy": _of_type("FUZZY", "raw_name", "canonical_name", "score"),
    "er_fallback": _of_type("FALLBACK", "raw_name", "canonical_name"),
    "er_resolve": _mapping,
    "er_resolve_lower": lambda s, d: _mapping(s, d, processor="lower"),
    "match_type_filter": lambda s, d: resolve.matched(_mapping(s, d)),
    "match_type_summary": lambda s, d: resolve.match_type_summary(_mapping(s, d)),
    "sort_names": lambda s, d: ranking.sort_names(_names(s, d)),
    "sample_head": lambda s, d: ranking.sample_head(resolve.matched(_mapping(s, d))),
    "api_resolver": api_resolver,
    "api_resolver_wide": api_resolver_wide,
    "plan_entity_mapping": plan_entity_mapping,
}

_RAW = fx.oracle(fx.RAW_NAMES)
_HUB = fx.oracle(fx.HUB_ITEMS)


def _resolution(names: str, dictionary: str = fx.DICTIONARY, threshold: float = 80.0, lower: bool = False) -> str:
    """CTEs dict, names, tiers, mapping over a query of raw names."""
    compared = "lower({})" if lower else "{}"
    return f"""WITH dict AS (
  SELECT pos, canonical, key, sorted, length(sorted) AS n, {sql.masks('sorted')} AS masks
  FROM (SELECT pos, canonical, lower(canonical) AS key, {sql.token_sort(compared.format('canonical'))} AS sorted FROM ({dictionary}) AS given)
), names AS (
  SELECT DISTINCT raw_name FROM ({names}) AS given WHERE {sql.strip('raw_name')} <> ''
), equi AS (
  SELECT raw_name, stripped, cleaned, e.canonical AS exact_name, CASE WHEN e.canonical IS NULL THEN k.canonical END AS cleaned_name
  FROM (SELECT raw_name, stripped, {sql.clean_name('stripped')} AS cleaned FROM (SELECT raw_name, {sql.strip('raw_name')} AS stripped FROM names)) AS t
  LEFT JOIN dict AS e ON lower(stripped) = e.key LEFT JOIN dict AS k ON lower(cleaned) = k.key AND cleaned <> ''
), targets AS (
  SELECT DISTINCT {sql.token_sort(compared.format("coalesce(nullif(cleaned, ''), stripped)"))} AS target FROM equi
), scored AS (
  SELECT target, canonical, 200.0::DOUBLE * ({sql.lcs('target', 'masks', 'n')}) / (length(target) + n) AS score,
    row_number() OVER (PARTITION BY target ORDER BY 200.0::DOUBLE * ({sql.lcs('target', 'masks', 'n')}) / (length(target) + n) DESC, pos) AS place
  FROM targets, dict
), mapping AS (
  SELECT raw_name,
    coalesce(exact_name, cleaned_name, CASE WHEN score >= {threshold} THEN scored.canonical END, nullif(cleaned, ''), stripped) AS canonical_name,
    CASE WHEN exact_name IS NOT NULL THEN 'EXACT' WHEN cleaned_name IS NOT NULL THEN 'CLEANED_EXACT'
      WHEN score >= {threshold} THEN 'FUZZY' ELSE 'FALLBACK' END AS match_type,
    CASE WHEN exact_name IS NOT NULL OR cleaned_name IS NOT NULL THEN 100.0::DOUBLE
      WHEN score >= {threshold} THEN round_even(score, 2) END AS score
  FROM equi JOIN scored ON target = {sql.token_sort(compared.format("coalesce(nullif(cleaned, ''), stripped)"))} AND place = 1
)
"""


_RAW_ONLY = f"SELECT raw_name FROM ({_RAW}) AS r"
_ORGS = f"SELECT {sql.product_org()} AS raw_name FROM ({_HUB}) AS h"
_ER = _resolution(_RAW_ONLY)

def _pair(pos: str) -> str:
    """Raw names with one dictionary name each: lengths m, n and common subsequence l of the sorted forms."""
    return f"""SELECT rec_id, canonical, length(a) AS m, length(b) AS n, {sql.lcs('a', 'masks', 'length(b)')} AS l FROM (
  SELECT rec_id, canonical, a, b, {sql.masks('b')} AS masks FROM (
    SELECT rec_id, canonical, {sql.token_sort('raw_name')} AS a, {sql.token_sort('canonical')} AS b
    FROM ({_RAW}) AS r JOIN ({fx.DICTIONARY}) AS d ON pos = {pos}))"""


_PARTS = "SELECT concat_ws(' ', p_name, p_brand) AS canonical, min(p_partkey) AS pos FROM part GROUP BY 1"
_WANTED = """SELECT concat_ws('  ', lower(p_brand), array_to_string(list_transform(string_split(p_name, ' '),
  lambda w: concat(upper(substring(w, 1, 1)), lower(substring(w, 2)))), ' ')) AS raw_name FROM part"""
_OTHER = "SELECT * FROM (VALUES (0, 'Supplier 1'), (1, 'Supplier#000000007'), (2, 'supplier 000000011'), (3, 'Customer')) AS o(pos, canonical)"

ORACLES = {
    "src_dictionary": f"""SELECT pos, canonical, count(rec_id) AS names FROM ({fx.DICTIONARY}) AS d
      LEFT JOIN ({_RAW}) AS r ON lower({sql.strip('raw_name')}) = lower(canonical) GROUP BY pos, canonical""",
    "clean_name": f"SELECT rec_id, {sql.clean_name('raw_name')} AS cleaned FROM ({_RAW}) AS r",
    "drop_blank": f"SELECT rec_id, raw_name FROM ({_RAW}) AS r WHERE {sql.strip('raw_name')} <> ''",
    "token_sort_ratio": f"""SELECT rec_id, canonical, round(CASE WHEN m + n = 0 THEN 100.0 ELSE 200.0::DOUBLE * l / (m + n) END, 6) AS score
      FROM ({_pair('rec_id % 50')})""",
    "score_round": f"""SELECT rec_id, round_even(CASE WHEN m + n = 0 THEN 100.0 ELSE 200.0::DOUBLE * l / (m + n) END, 2) AS score
      FROM ({_pair('rec_id * 7 % 50')})""",
    "argmax_match": _ER + "SELECT target, canonical AS canonical_name, round(score, 6) AS score FROM scored WHERE place = 1",
    "distinct_names": _ER + "SELECT raw_name FROM names",
    "union_distinct_names": f"""SELECT raw_name FROM ({_RAW_ONLY} UNION {_ORGS} UNION {fx.VARIANTS}) AS u
      WHERE {sql.strip('raw_name')} <> ''""",
    "er_exact": _ER + "SELECT raw_name, canonical_name, score FROM mapping WHERE match_type = 'EXACT'",
    "er_cleaned_exact": _ER + "SELECT raw_name, canonical_name, score FROM mapping WHERE match_type = 'CLEANED_EXACT'",
    "er_fuzzy": _ER + "SELECT raw_name, canonical_name, score FROM mapping WHERE match_type = 'FUZZY'",
    "er_fallback": _ER + "SELECT raw_name, canonical_name FROM mapping WHERE match_type = 'FALLBACK'",
    "er_resolve": _ER + "SELECT * FROM mapping",
    "er_resolve_lower": _resolution(_RAW_ONLY, lower=True) + "SELECT * FROM mapping",
    "match_type_filter": _ER + "SELECT * FROM mapping WHERE match_type <> 'FALLBACK'",
    "match_type_summary": _ER + """SELECT match_type, count(*) AS names, round(avg(score), 2) AS avg_score, min(score) AS min_score
      FROM mapping GROUP BY match_type""",
    "sort_names": _ER + "SELECT raw_name FROM names ORDER BY raw_name",
    "sample_head": _ER + "SELECT * FROM mapping WHERE match_type <> 'FALLBACK' ORDER BY raw_name LIMIT 10",
    "api_resolver": _resolution("SELECT s_name AS raw_name FROM supplier", _OTHER, 90.0) + "SELECT * FROM mapping",
    "api_resolver_wide": _resolution(_WANTED, _PARTS, 85.0) + "SELECT * FROM mapping",
    "plan_entity_mapping": _resolution(f"{_RAW_ONLY} UNION ALL {_ORGS} UNION ALL {fx.VARIANTS}") + "SELECT * FROM mapping",
}
