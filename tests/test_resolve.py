import random

import pytest
from pyspark.sql import functions as F

from tidewire import fixed_values as fixed
from tidewire.functions import similarity
from tidewire.operators import resolve

GOLDEN = {
    "OpenAI, Inc.": ("OpenAI", "CLEANED_EXACT", 100.0),
    "Open AI": ("OpenAI", "FUZZY", 80.0),
    "Anthropic PBC": ("Anthropic", "CLEANED_EXACT", 100.0),
    "Anthropic Labs": ("Anthropic", "CLEANED_EXACT", 100.0),
    "Mistral AI Technologies": ("Mistral AI", "FUZZY", 82.35),
    "Cohere Inc.": ("Cohere", "CLEANED_EXACT", 100.0),
    "Hugging Face, Inc.": ("Hugging Face", "CLEANED_EXACT", 100.0),
    "Stability.AI": ("Stability AI", "FUZZY", 85.71),
    "DeepSeek-AI": ("DeepSeek", "FUZZY", 94.12),
    "Scale AI Corp": ("Scale", "FALLBACK", None),
    "Groq, Inc.": ("Groq", "CLEANED_EXACT", 100.0),
    "openai": ("OpenAI", "EXACT", 100.0),
    " Copy.ai ": ("Copy.ai", "EXACT", 100.0),
    "AI Labs Inc.": ("AI Labs Inc.", "FALLBACK", None),
    "xAI": ("xAI", "FALLBACK", None),
}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def ratio(a, b):
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def names_frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "raw_name string")


def as_dict(mapping):
    return {r.raw_name: (r.canonical_name, r.match_type, r.score) for r in mapping.collect()}


def random_names(seed, count, alphabet="abAB ioé𝒳"):
    rng = random.Random(seed)
    made = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 14))) for _ in range(count)}
    return sorted(n for n in made if n.strip())


def test_golden_names(spark):
    mapping = resolve.resolve_entities(names_frame(spark, GOLDEN), resolve.dictionary_frame(spark))
    assert as_dict(mapping) == GOLDEN


def test_ratio_equals_dynamic_programming(spark):
    rng = random.Random(5)
    lengths = [0, 1, 7, 60, 61, 62, 122, 123, 190]
    word = lambda n: "".join(rng.choice("abcA é𝒳 ") for _ in range(n))
    pairs = [(word(rng.choice(lengths)), word(rng.choice(lengths))) for _ in range(120)]
    frame = spark.createDataFrame(pairs, "a string, b string")
    got = frame.select("a", "b", similarity.token_sort_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert all(r.r == pytest.approx(ratio(r.a, r.b), abs=1e-9) for r in got)


@pytest.mark.parametrize("threshold", [0.0, 20.0, 50.0, 66.6, 67.5, 80.0, 100.0])
def test_fuzzy_tier_equals_brute_force(spark, threshold):
    """Neither the edit-distance filter nor the segment join may lose a pair, and ties go to the first entry."""
    names = random_names(1, 150)
    dictionary = random_names(2, 60) + ["long " * 20, "abab" * 20]
    canon = resolve.dictionary_frame(spark, dictionary)
    table = resolve.Dictionary(canon)
    frame = names_frame(spark, names)
    tiers = resolve.add_cleaned_exact(resolve.add_exact(frame, table), table)
    targets = tiers.where("exact_name IS NULL AND cleaned_name IS NULL").select(
        F.coalesce(F.nullif(F.col("cleaned"), F.lit("")), F.col("stripped")).alias("text")
    )
    targets = targets.select(similarity.token_sort(F.col("text")).alias("target")).distinct()
    expected = {}
    for (target,) in targets.collect():
        best = max(((ratio(target, d), -i) for i, d in enumerate(dictionary)))
        if best[0] >= threshold:
            expected[target] = (round(best[0], 9), dictionary[-best[1]])
    for limit in (2000, 1):
        best = resolve.best_matches(targets, resolve.Dictionary(canon, limit), threshold).collect()
        assert {r.target: (round(r.best.score, 9), r.best.canonical) for r in best} == expected


def test_rare_grams_leave_few_of_all_pairs(spark):
    """Word-like names at the usual threshold: no pair lost, under one in twenty compared."""
    rng = random.Random(9)
    syllables = ["ana", "bor", "cel", "dyn", "eth", "flo", "gra", "hyp", "ion", "jet", "kin", "lum", "mor", "neo", "orb", "pix", "qua", "rix", "sol", "tek"]
    made = lambda: " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(2, 4))).title() for _ in range(rng.randrange(1, 3)))
    names, dictionary = sorted({made() for _ in range(400)}), sorted({made() for _ in range(400)})
    entries = resolve.Dictionary(resolve.dictionary_frame(spark, dictionary), 1).entries
    targets = names_frame(spark, names).select(similarity.token_sort(F.col("raw_name")).alias("target")).distinct().withColumn("m", F.length("target"))
    found = {(r.target, r.sorted) for r in resolve.candidate_pairs(targets, entries, 80.0).collect()}
    sorted_form = lambda x: " ".join(sorted(x.split()))
    near = {(sorted_form(a), sorted_form(b)) for a in names for b in dictionary if ratio(a, b) >= 80.0}
    assert near <= found and len(found) < 0.05 * len(names) * len(dictionary)


@pytest.mark.parametrize("threshold", [-1.0, 100.5])
def test_thresholds_out_of_range_are_refused(spark, threshold):
    with pytest.raises(ValueError):
        resolve.resolve_entities(names_frame(spark, ["a"]), resolve.dictionary_frame(spark), threshold)


@pytest.mark.parametrize("processor", [None, "lower"])
def test_large_dictionary_path_gives_the_same_rows(spark, processor):
    names = names_frame(spark, list(GOLDEN) + random_names(3, 80) + fixed.CANONICAL_NAMES + ["STABILITY-AI", "deepseek-ai"])
    canon = resolve.dictionary_frame(spark)
    inline = resolve.resolve_entities(names, canon, processor=processor)
    joined = resolve.resolve_entities(names, canon, inline_limit=1, processor=processor)
    assert as_dict(inline) == as_dict(joined)
    assert (as_dict(inline)["deepseek-ai"][1] == "FUZZY") == (processor == "lower")


def test_later_duplicate_wins_exact_lookup(spark):
    canon = resolve.dictionary_frame(spark, ["Acme", "ACME"])
    names = names_frame(spark, ["acme"])
    for limit in (2000, 1):
        assert as_dict(resolve.resolve_entities(names, canon, inline_limit=limit)) == {"acme": ("ACME", "EXACT", 100.0)}


def test_empty_dictionary_leaves_fallbacks(spark):
    canon = resolve.dictionary_frame(spark).limit(0)
    got = as_dict(resolve.resolve_entities(names_frame(spark, ["Acme Inc.", "Inc."]), canon))
    assert got == {"Acme Inc.": ("Acme", "FALLBACK", None), "Inc.": ("Inc.", "FALLBACK", None)}


def test_resolve_plan_has_one_shuffle_and_no_cross_join(spark):
    names = resolve.distinct_names(names_frame(spark, list(GOLDEN)))
    plan = resolve.resolve_entities(names, resolve.dictionary_frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_distinct_names_drop_blank_and_null(spark):
    got = resolve.distinct_names(names_frame(spark, ["a", " ", None]), names_frame(spark, ["a", "b", " "]))
    assert sorted(r.raw_name for r in got.collect()) == ["a", "b"]


def test_match_type_summary(spark):
    mapping = resolve.resolve_entities(names_frame(spark, GOLDEN), resolve.dictionary_frame(spark))
    rows = {r.match_type: (r.names, r.avg_score, r.min_score) for r in resolve.match_type_summary(mapping).collect()}
    assert rows["FUZZY"] == (4, pytest.approx(85.545, abs=0.006), 80.0) and rows["FALLBACK"] == (3, None, None)
    assert resolve.matched(mapping).count() == 12
