import itertools
import math
import random
import sys
import tempfile
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.helpers import awkward, docs, frame, with_clashes
from tidewire.llm import arrow_slices, language, mixing, near_dedup, pii_tagger, sampled_pieces
from tidewire.llm.arrow_slices import slices
from tidewire.session import TEXT_ROWS

FRENCH = "le chat dort sur la chaise et les enfants jouent dans le jardin avec leurs amis "
ENGLISH = "the cat sleeps on the chair and the children play in the garden with their friends "
CLASH = ("likelihood", "name", "host", "node", "bands", "bucket", "root", "seed", "at", "domain", "suffix", "logs", "kept")


def test_slices_cover_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 7, 30, 1, 1)] + [None]})
    parts = [p.column(0).to_pylist() for p in slices([batch], limit=10)]
    assert [x for p in parts for x in p] == batch.column(0).to_pylist() and len(parts) > 2


# Language.

def labelled(spark):
    rows = [(i, (FRENCH if i % 2 else ENGLISH)[i % 7 :], "fr" if i % 2 else "en", f"www.{'a' if i % 2 else 'b'}.example", 1) for i in range(40)]
    return frame(spark, rows)


def test_texts_agree_with_a_plain_count_of_n_grams():
    texts = ["", None, "a", "ab", "Abc é", "x" * 9]
    slots, counts = language.gram_slots(texts)
    want = []
    for t in texts:
        data = f" {t.lower()} ".encode() if t else b""
        own = [int.from_bytes(data[i : i + 4], "big") * 2654435769 % (1 << 32) >> (32 - language.GRAM_BITS) for i in range(len(data) - 3)]
        want += own
        assert counts[texts.index(t)] == len(own)
    assert slots.tolist() == want


def test_held_out_languages_and_evidence(spark):
    model = language.train(labelled(spark))
    assert model[0] == ["en", "fr"]
    rows = frame(spark, [
        (100, "les amis dorment dans le jardin", None, None, 1), (101, "children sleep on a chair", None, None, 1), (102, "世界你好世界你好", None, None, 1),
        (103, "on", "fr-FR", "www.a.example", 1), (104, "on", "en", "www.b.example", 1), (105, None, "fr", "www.a.example", 1)])
    found = {r.doc_id: r for r in language.identify(with_clashes(labelled(spark).unionByName(rows), *CLASH), model).collect()}
    assert (found[100].language, found[101].language, found[102].language) == ("fr", "en", "und")
    assert (found[103].language, found[104].language) == ("fr", "en")  # too short to tell: the declaration and the host do
    assert found[105].language == "und" and not found[105].kept and not found[102].kept
    assert all(found[i].language == ("fr" if i % 2 else "en") and found[i].kept for i in range(40))


def test_a_rare_language_of_a_large_table_is_known(spark):
    many = labelled(spark).crossJoin(spark.range(500).withColumnRenamed("id", "n")).selectExpr("doc_id * 500 + n as doc_id", "text", "lang", "source", "n_chars")
    greek = "η γάτα κοιμάται στην καρέκλα και τα παιδιά παίζουν στον κήπο "
    rare = frame(spark, [(100000 + i, greek[i:] + "με τους φίλους τους", "el", "www.c.example", 1) for i in range(3)])
    # A key that comes in two languages and rows without a key train each language with its own texts only.
    more = frame(spark, [(100000, ENGLISH, "en", "www.b.example", 1), (None, FRENCH, "fr", "www.a.example", 1), (None, ENGLISH, "en", "www.b.example", 1)])
    # More languages than a table usually has, some without text.
    tags = frame(spark, [(200000 + i, f"tag{i} " * 9, "x" + chr(97 + i // 26) + chr(97 + i % 26), "s", 1) for i in range(220)] + [(300000, None, "zz", "s", 1)])
    rows = many.unionByName(rare).unionByName(more).unionByName(tags)
    known, table = language.train(rows)
    assert len(known) == 223 and {"el", "en", "fr"} <= set(known) and "zz" not in known and table.shape[1] == 223
    assert language.train(many.unionByName(rare))[0] == ["el", "en", "fr"]
    few = rare.unionByName(labelled(spark))
    found = {r.doc_id: r for r in language.identify(few, language.train(many.unionByName(rare).unionByName(more))).collect()}
    assert all(found[100000 + i].language == "el" and found[100000 + i].kept for i in range(3))


def test_languages_beyond_the_bound_share_a_class(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    greek = "η γάτα κοιμάται στην καρέκλα και τα παιδιά παίζουν στον κήπο "
    russian = "кошка спит на стуле и дети играют в саду со своими друзьями "
    rare = frame(spark, [(100 + i, (greek if i % 2 else russian)[i:], "el" if i % 2 else "ru", "www.c.example", 1) for i in range(8)])
    rows = labelled(spark).unionByName(rare).unionByName(frame(spark, [(200, greek[3:], None, None, 1), (201, "on", "q" * 8, "www.b.example", 1)]))
    model = language.train(rows)
    assert model[0] == ["en", "fr", language.OTHER] and model[1].shape[1] == 3
    found = {r.doc_id: r for r in language.identify(rows, model).collect()}
    assert all(found[100 + i].language == ("el" if i % 2 else "ru") and found[100 + i].kept for i in range(8))
    assert (found[200].language, found[200].kept) == (language.OTHER, True)
    assert all(found[i].language == ("fr" if i % 2 else "en") and found[i].kept for i in range(40))


def test_any_number_of_tags_leaves_a_bounded_model(spark):
    tag = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3))
    tags = frame(spark, [(1000 + i, f"words of {i}", f"z{tag(i)}", "s", 1) for i in range(3000)])
    known, table = language.train(labelled(spark).unionByName(tags))
    assert len(known) == language.MAX_LANGUAGES + 1 == table.shape[1] and {"en", "fr", language.OTHER} <= set(known)


def test_draws_pass_their_share():
    assert language._draws(2.0) == language._draws(1.0) == 2**63 - 1
    assert language._draws(0.5) == 0 and language._draws(0.0) == -(2**63) and language._draws(0.25) == -(2**62)


def brute_posteriors(rows, langs):
    """{doc_id: (language, posterior)} of rows (doc_id, text, lang, source), evidence by evidence in plain Python."""
    def grams(text):
        data = f" {text.lower()} ".encode() if text and not text.isspace() else b""
        return [int.from_bytes(data[i : i + 4], "big") * 2654435769 % (1 << 32) >> (32 - language.GRAM_BITS) for i in range(len(data) - 3)]

    def normal(logs):
        raised = [math.exp(x - max(logs)) for x in logs]
        return [x / sum(raised) for x in raised]

    model = []
    for lang in langs:
        counts = Counter(g for _, text, own, _ in rows if own == lang for g in grams(text))
        whole = sum(counts.values()) + language.UNSEEN * (1 << language.GRAM_BITS)
        model.append(lambda g, counts=counts, whole=whole: math.log((counts[g] + language.UNSEEN) / whole))
    model.append(lambda g: -math.log(1 << language.GRAM_BITS))
    classes, n, smooth = [*langs, language.UNKNOWN], len(langs) + 1, language.SMOOTHING
    text_logs = {d: [language.TEXT_WEIGHT * sum(map(own, grams(text))) for own in model] for d, text, _, _ in rows}
    told = [(normal(text_logs[d]), lang if lang in langs else lang and language.UNKNOWN, host) for d, text, lang, host in rows if grams(text)]
    sums = lambda pick: [sum(p[i] for p, lang, host in told if pick(lang, host)) for i in range(n)]
    total = sums(lambda lang, host: True)
    prior = [(x + smooth / n) / (sum(total) + smooth) for x in total]
    domain_of = lambda host: ".".join(host.split(".")[-2:])
    under = lambda s, parent: [(x + smooth * q) / (sum(s) + smooth) for x, q in zip(s, parent)]
    given_that = lambda s: [math.log((x + smooth / n) / (t + smooth)) for x, t in zip(s, total)]
    seen_hosts = {host for _, _, host in told}
    found = {}
    for d, text, lang, host in rows:
        logs = text_logs[d]
        lang = lang if lang in langs else lang and language.UNKNOWN
        if lang is not None and any(own == lang for _, own, _ in told):
            logs = [a + b for a, b in zip(logs, given_that(sums(lambda own, _: own == lang)))]
        if host is not None and "." in host and any(h and "." in h and h.split(".")[-1] == host.split(".")[-1] for _, _, h in told):
            logs = [a + b for a, b in zip(logs, given_that(sums(lambda _, h: h is not None and "." in h and h.split(".")[-1] == host.split(".")[-1])))]
        place = prior
        if host is not None and host in seen_hosts:
            by_domain = under(sums(lambda _, h: h is not None and domain_of(h) == domain_of(host)), prior)
            place = under(sums(lambda _, h: h == host), by_domain)
        p = normal([a + math.log(q) for a, q in zip(logs, place)])
        found[d] = (classes[p.index(max(p))] if grams(text) else language.UNKNOWN, max(p))
    return found


def test_posteriors_match_a_plain_version(spark):
    extra = [
        (100, "les amis", None, "www.a.example"), (101, "on", "fr", "x.a.example"), (102, "世界你好", "zz", "lone"), (103, "cat", "en", None), (104, None, "fr", "www.b.example"),
        (105, "le the", None, "new.b.other"), (106, "chat on", "en", "www.a.example")]
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in labelled(spark).collect()] + extra
    docs_ = frame(spark, [(*row, 1) for row in rows])
    model = language.train(docs_)
    want = brute_posteriors(rows, model[0])
    for r in language.identify(docs_, model).collect():
        lang, posterior = want[r.doc_id]
        assert r.language == lang and abs(r.posterior - posterior) < 2e-5, (r.doc_id, r, want[r.doc_id])


def test_evidence_from_addresses(spark):
    rows = [(i, FRENCH if i % 2 else ENGLISH, None, None, 1) for i in range(20)]
    pages = frame(spark, rows).selectExpr("*", "if(doc_id % 2 = 1, 'https://m.site.fr/a', 'http://user@site.co.uk:80/b') as url")
    found = language.identify(pages, language.train(labelled(spark)), language.Columns(declared=None, host=None, address="url")).collect()
    assert all(r.language == ("fr" if r.doc_id % 2 else "en") for r in found)


def test_language_on_awkward_rows(spark):
    model = language.train(labelled(spark))
    found = language.identify(awkward(spark), model).collect()
    assert len(found) == 9 and all(not r.kept for r in found if r.doc_id in (2, 3, 6))
    kept = language.keep_identified(with_clashes(labelled(spark).unionByName(awkward(spark)), *CLASH))
    assert all((r.text or "").strip() for r in kept.collect()) and kept.count() >= 40
    empty = awkward(spark).limit(0)
    assert language.identify(empty, model).count() == 0 and language.keep_identified(empty).count() == 0


# Near copies.

def brute_classes(texts, idf):
    """Classes by comparing all pairs with the exact similarity."""
    weigh = lambda t: (lambda h, c: (h, near_dedup.weights_of(near_dedup.levels_of(h, c, idf))))(*next(near_dedup.shingles(pa.array([t]))))
    own, root = [weigh(t or "") for t in texts], list(range(len(texts)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    links = set()
    for i, j in itertools.combinations(range(len(texts)), 2):
        same = (texts[i] or "") == (texts[j] or "")
        if same or near_dedup.weighted_jaccard(own[i], own[j]) >= near_dedup.THRESHOLD:
            root[find(i)] = find(j)
            if not same:
                links.add((texts[i], texts[j]))
    return [find(i) for i in range(len(texts))], links


def near_texts():
    draw, words = random.Random(3), [f"w{i}" for i in range(400)]
    texts = []
    for size in (60, 90, 12, 200):
        base = draw.choices(words, k=size)
        for changes in (0, 0, 1, 1, 2, size // 4):
            own = list(base)
            for _ in range(changes):
                own[draw.randrange(size)] = draw.choice(words)
            texts.append(" ".join(own))
    crowd = draw.choices(words, k=150)
    for i in range(60):  # one bucket for many: larger than those that compare all pairs
        own = list(crowd)
        own[draw.randrange(150)] = f"x{i}"
        texts.append(" ".join(own))
    return texts + ["short one", "short one", "short two", "", None, "a b c d e", "a b c d e f"]


def test_near_groups_match_all_pairs(spark):
    texts = near_texts()
    rows = with_clashes(docs(spark, texts), *CLASH)
    found = {r.doc_id: r for r in near_dedup.near_groups(rows).collect()}
    want, links = brute_classes(texts, near_dedup.idf_table(rows))
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert (found[i].class_id == found[j].class_id) == (want[i] == want[j]), (i, j)
    for i, r in found.items():
        assert r.class_id == max(j for j in found if want[j] == want[i]) and r.kept == (r.class_id == i)
        assert r.class_size == sum(want[j] == want[i] for j in found)
    assert found[2].n_links > 0 and found[texts.index("short one")].n_links == 0


def class_of(spark, texts):
    found = near_dedup.near_groups(docs(spark, texts)).collect()
    return [r.class_id for r in sorted(found, key=lambda r: r.doc_id)]


def same_classes(found, want):
    return len(set(zip(found, want))) == len(set(found)) == len(set(want))


def sparse_pairs():
    """Texts that share a template and are not near, and few pairs that just are, by half of their own words."""
    template = [f"t{i}" for i in range(150)]
    texts = [" ".join(template + [f"o{i}_{k}" for k in range(22)]) for i in range(500)]
    return texts + [" ".join(template + [f"o{i}_{k}" if k < 12 else f"c{i}_{k}" for k in range(22)]) for i in range(0, 500, 25)]


def test_sparse_pairs_of_a_large_bucket_are_all_found(spark):
    texts = sparse_pairs()
    want, links = brute_classes(texts, near_dedup.idf_table(docs(spark, texts)))
    assert len(links) == 20
    assert same_classes(class_of(spark, texts), want)


def test_texts_near_the_members_of_a_star_but_not_its_pivot_are_found(spark):
    """A star of texts around one, fringe texts that are near one member only, and others of the same passage that are near none."""
    words = [f"w{i}" for i in range(120)]
    star = [words[:i] + [f"m{i}_{k}" for k in range(7)] + words[i + 7 :] for i in range(0, 110, 2)]
    fringe = [own[:60] + [f"f{i}_{k}" for k in range(8)] + own[68:] for i, own in enumerate(star)]
    others = [words[:70] + [f"o{i}_{k}" for k in range(50)] for i in range(40)]
    texts = [" ".join(t) for t in [words, *star, *fringe, *others]]
    want, links = brute_classes(texts, near_dedup.idf_table(docs(spark, texts)))
    assert any(texts[0] not in x for x in links)
    assert same_classes(class_of(spark, texts), want)


def test_stars_go_to_the_neighbour_with_most_links(spark):
    links = frame(spark, [("a", "b", 0.9), ("c", "a", 0.85), ("a", "d", 0.8), ("d", "e", 0.95)], "a string, b string, similarity double")
    found = {r.node: (r.pivot, round(r.far, 6)) for r in near_dedup.pivots(links).collect()}
    assert found == {"a": ("a", 0.0), "b": ("a", 0.1), "c": ("a", 0.15), "d": ("a", 0.2), "e": ("d", 0.05)}


def test_open_pairs_are_those_that_the_triangle_leaves(spark):
    """Two stars at a distance of 0.5 and 0.3: only members far enough from their pivots go on, and only with a shared shingle."""
    row = lambda node, pivot, far: (1, node, 10.0, 10.0, pivot, 2, pivot, far)
    placed = frame(spark, [row("p", "p", 0.0), row("x", "p", 0.15), row("y", "p", 0.05), row("q", "q", 0.0), row("z", "q", 0.16), row("s", "s", 0.0)],
                   "shingle long, node string, rest double, total double, root string, members int, pivot string, far double")
    told = frame(spark, [("p", "q", 0.5), ("p", "s", 0.7), ("q", "s", 0.2)], "a string, b string, similarity double")
    assert {(r.a, r.b) for r in near_dedup.open_pairs(placed, told).collect()} == {("x", "z"), ("s", "x")}


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 1 << 30))
def test_prefixes_hold_the_first_shared_shingle_of_every_near_pair(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    base = draw.choices(words, k=draw.randrange(5, 80))
    other = base[draw.randrange(3) :] + draw.choices(words, k=draw.randrange(4))
    idf, rarity = (np.random.default_rng(seed + k).uniform(1, 1.5, 1 << near_dedup.DF_BITS).astype(np.float32) for k in range(2))
    own = [(h, near_dedup.weights_of(near_dedup.levels_of(h, c, idf))) for h, c in near_dedup.shingles(pa.array([" ".join(base), " ".join(other)]))]
    similar = near_dedup.weighted_jaccard(*own)
    first, second = (dict(zip(*near_dedup.prefixes(x, rarity))) for x in own)
    bound = near_dedup.THRESHOLD / (1 + near_dedup.THRESHOLD) * sum(w.sum() for _, w in own)
    reached = any(min(first[h], second[h]) >= bound - near_dedup.SLACK for h in first.keys() & second.keys())
    assert reached or similar < near_dedup.THRESHOLD


def test_the_size_of_a_bucket_changes_no_pair(spark, monkeypatch):
    draw, texts = random.Random(6), []
    for i in range(900):  # pairs just above the threshold, of which some share no two bands at a refined distance
        base = [f"p{i}_{k}" for k in range(draw.randrange(60, 100))]
        texts += [" ".join(base), " ".join(base[: int(len(base) * 0.815) + 1])]
    small = class_of(spark, texts)
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 1)
    large = class_of(spark, texts)
    missed = sum(small[i] == small[i + 1] and large[i] != large[i + 1] for i in range(0, len(texts), 2))
    assert missed == 0 and len(set(small)) < 950


def test_near_groups_on_awkward_rows(spark):
    found = near_dedup.near_groups(awkward(spark)).collect()
    assert len(found) == 9
    assert {r.class_id for r in found if r.doc_id in (2, 3)} == {3}
    assert sum(r.kept for r in found) == len({(r.class_id, r.class_size) for r in found})
    left = near_dedup.drop_near_copies(with_clashes(awkward(spark), *CLASH))
    assert sorted((r.doc_id, r.text) for r in left.select("doc_id", "text").collect())[0] == (1, "a b") and left.count() == 5
    assert near_dedup.near_groups(awkward(spark).limit(0)).count() == 0 and near_dedup.drop_near_copies(awkward(spark).limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = frame(spark, [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)] + [("z1", "z2"), ("z2", "z1")], "a string, b string")
    found = {r.node: r.root for r in near_dedup.components(links).collect()}
    assert set(found.values()) == {"n000", "z1"} and len(found) == 63


def test_components_of_shares_of_edges_are_those_of_all(spark):
    draw = random.Random(9)
    pairs = [(f"n{draw.randrange(400):03}", f"n{draw.randrange(400):03}") for _ in range(260)]
    links = frame(spark, pairs, "a string, b string")
    whole, shares = ({r.node: r.root for r in near_dedup.components(links, size).collect()} for size in (1000, 20))
    above = {}
    for a, b in pairs:
        if a != b:
            group = above.get(a, {a}) | above.get(b, {b})
            above.update((x, group) for x in group)
    assert whole == shares == {x: min(group) for x, group in above.items()}


def test_links_of_one_share_need_no_rounds(spark, monkeypatch):
    written, keep = [], near_dedup.stored
    monkeypatch.setattr(near_dedup, "stored", lambda df, label: written.append(label) or keep(df, label))
    links = frame(spark, [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)], "a string, b string")
    assert near_dedup.components(links).count() == 61 and len(written) == 2
    assert near_dedup.components(links.limit(0)).count() == 0


def test_few_whole_texts_go_to_a_worker_at_a_time(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = spark.range(3000).selectExpr("id AS doc_id", "cast(id AS string) AS text", "'s' AS source", "'en' AS lang").coalesce(1)
    sizes = lambda: [r.n for r in rows.mapInArrow(lambda xs: (pa.RecordBatch.from_pydict({"n": [x.num_rows]}) for x in xs), "n long").collect()]
    for operator in (sampled_pieces.sample_segmentations, near_dedup.near_groups, lambda x: language.identify(x, language.train(x))):
        spark.conf.unset(name)
        assert max(sizes()) == 3000
        operator(rows.limit(3))
        assert sum(sizes()) == 3000 and max(sizes()) <= TEXT_ROWS
    spark.conf.set(name, "100")
    sampled_pieces.sample_segmentations(rows)
    assert max(sizes()) == 100
    spark.conf.unset(name)


def test_samples_collide_as_often_as_texts_are_similar():
    draw, sampler = np.random.default_rng(1), near_dedup.Sampler()
    shared, one, two = (np.sort(draw.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (300, 60, 60))
    sides = [np.sort(np.concatenate((shared, x))) for x in (one, two)]
    levels = [np.where(np.isin(s, shared), 10, 20) for s in sides]
    weights = [near_dedup.weights_of(x) for x in levels]
    similarity = near_dedup.weighted_jaccard((sides[0], weights[0]), (sides[1], weights[1]))
    bands = sampler.bands(sides, levels)
    expected = similarity**near_dedup.BAND
    assert abs((bands[0] == bands[1]).mean() - expected) < 4 * math.sqrt(expected * (1 - expected) / bands.shape[1])


# Pieces.

@pytest.fixture(scope="module")
def toy():
    """A vocabulary in which all segmentations can be listed."""
    pieces = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca"]
    codes = [ord(c) for p in pieces for c in p] + [sampled_pieces.BYTE_CODE + i for i in range(256)]
    ends = np.cumsum([len(p) for p in pieces] + [1] * 256)
    weights = np.log(np.array([3, 1, 2, 1, 2, 1, 3, 1, 2, 1] + [0.1] * 256, float))
    return sampled_pieces.Vocabulary(np.array(codes, np.uint32), ends, weights, np.arange(266, dtype=np.int32)), pieces


def listed(pieces, weights, text):
    """Chance of each segmentation of a text."""
    found = {}
    def walk(at, ids, weight):
        if at == len(text):
            found[tuple(ids)] = weight
        for i, p in enumerate(pieces):
            if text.startswith(p, at):
                walk(at + len(p), [*ids, i], weight * math.exp(weights[i]))
    walk(0, [], 1.0)
    total = sum(found.values())
    return {k: v / total for k, v in found.items()}


def test_samples_follow_sampling_without_replacement(toy):
    vocabulary, pieces = toy
    chances = listed(pieces, vocabulary.log_weights, "▁abca")
    n, sampler = 6000, sampled_pieces.Sampler(vocabulary, 3)
    paths = sampler.draw(["abca"] * n, np.arange(n))
    ids = [np.split(p["ids"], np.cumsum(p["counts"])[:-1]) for p in paths]
    firsts, seconds = {}, {}
    for one, two, three in zip(*ids):
        a, b, c = tuple(one), tuple(two), tuple(three)
        assert len({a, b, c}) == 3
        firsts[a] = firsts.get(a, 0) + 1
        seconds[a, b] = seconds.get((a, b), 0) + 1
    for a, p in chances.items():
        assert abs(firsts.get(a, 0) / n - p) < 5 * math.sqrt(p / n) + 1e-3
        for b, q in chances.items():
            if a != b:
                want = p * q / (1 - p)
                assert abs(seconds.get((a, b), 0) / n - want) < 5 * math.sqrt(want / n) + 1e-3
    for path, own in zip(paths, ids):
        for i in range(50):
            assert abs(path["log_prob"][i] - math.log(chances[tuple(own[i])])) < 1e-9
    # Inclusion scores weigh the samples so that any sum over all segmentations is estimated without bias: here their number 1.
    total = sum((np.exp(p["log_prob"] - p["log_inclusion"])).mean() for p in paths)
    assert abs(total - 1) < 0.05


def test_texts_are_sampled_together_as_alone(toy):
    vocabulary, _ = toy
    draw = random.Random(4)
    texts = ["".join(draw.choice("ab \u00e9\u4e2d") for _ in range(draw.randrange(12))) for _ in range(60)]
    sampler, decoder = sampled_pieces.Sampler(vocabulary, 5), sampled_pieces.Decoder(vocabulary)

    def found(texts, seeds):
        paths = sampler.draw(texts, np.array(seeds))
        rows = [[] for _ in texts]
        for path in paths:
            ends = np.cumsum(path["counts"])
            for row, end, n, exists, score, back in zip(rows, ends, path["counts"], path["exists"], path["log_prob"], decoder.texts(path["ids"], path["counts"])):
                if exists:
                    row.append((path["ids"][end - n : end].tolist(), round(float(score), 9), back))
        return rows

    together = found(texts, range(60))
    assert together == [found([t], [i])[0] for i, t in enumerate(texts)]
    for text, rows in zip(texts, together):
        assert len({tuple(ids) for ids, _, _ in rows}) == len(rows) and {back for _, _, back in rows} == {text}


def test_all_segmentations_come_when_few(toy):
    vocabulary, pieces = toy
    paths = sampled_pieces.Sampler(vocabulary, 8).draw(["ab", "", "zz"], np.arange(3))
    chances = listed(pieces, vocabulary.log_weights, "▁ab")
    assert sum(p["exists"][0] for p in paths) == len(chances) and [p["exists"][1] for p in paths].count(True) == 1
    assert abs(sum(np.exp(p["log_prob"][0]) for p in paths if p["exists"][0]) - 1) < 1e-9
    assert all(p["log_inclusion"][0] == 0 for p in paths if p["exists"][0])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=5))
def test_decoding_restores_any_text(texts):
    vocabulary = sampled_pieces.load_vocabulary()
    sampler, decoder = _public(vocabulary)
    for path in sampler.draw(texts, np.arange(len(texts))):
        back = decoder.texts(path["ids"], path["counts"])
        assert all(a == b for a, b, own in zip(texts, back, path["exists"]) if own)


_cached = {}


def _public(vocabulary):
    if "made" not in _cached:
        _cached["made"] = sampled_pieces.Sampler(vocabulary, 2), sampled_pieces.Decoder(vocabulary)
    return _cached["made"]


def test_segmentations_of_awkward_rows(spark):
    found = sampled_pieces.sample_segmentations(with_clashes(awkward(spark), *CLASH))
    rows = found.collect()
    assert all(r.round_trip for r in rows)
    assert sorted(r.sample for r in rows if r.doc_id == 2) == [0] and sorted(r.sample for r in rows if r.doc_id == 4) == [0, 1]
    twice = [tuple(r.ids) for r in rows if r.doc_id == 1 and r.sample == 0]
    assert len(twice) == 2 and len(set(twice)) == 1
    assert {r.decoded for r in sampled_pieces.decode(found).collect() if r.doc_id == 5} == {"é\U0001f642 x\ty\n\nz"}
    assert sampled_pieces.sample_segmentations(awkward(spark).limit(0)).count() == 0


# Personal data.

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_personal(text):
    import re

    def good(kind, m):
        digits = [c for c in m if c in "0123456789"]
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            odd = [int(d) for d in digits[::-1][::2]] + [sum(map(int, str(2 * int(d)))) for d in digits[::-1][1::2]]
            return 16 <= len(digits) <= 19 and sum(odd) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text) if good(k, m.group())]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "@", ".", "-", " ", "+", "1", "23", "456", "255", "4111111111111111", "1.2.3.4", "(", ")", "é", "\n", "0000"]), max_size=30).map("".join))
def test_patterns_match_a_plain_search(text):
    assert pii_tagger.base_spans(text) == brute_personal(text)


def test_patterns_are_linear_in_hostile_texts():
    for text in ("a" * 200_000, "1" * 200_000, "a." * 100_000 + "@", "+1" + "(" * 200_000):
        pii_tagger.base_spans(text)


def windows(n, seed):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        kind = ("email", "phone", "none")[i % 3]
        word = lambda: "".join(draw.choices("abcdefghij", k=draw.randint(2, 8)))
        lead = " ".join(word() for _ in range(draw.randint(1, 6))) + " "
        own = {"email": f"{word()}@{word()}.com", "phone": f"({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}", "none": str(draw.randint(1, 99))}[kind]
        text = f"{lead}{own} {word()} {word()} {word()}"[: pii_tagger.TRAIN_CHARS]
        end = min(len(text), len(lead) + len(own))
        rows.append((kind, i, text, len(lead), end) if kind != "none" else (kind, i, text, 0, 0))
    return rows


@pytest.fixture(scope="module")
def tagger():
    return pii_tagger.train(windows(300, 1), steps=80)


def test_held_out_spans_are_found(tagger):
    held = windows(150, 2)
    runs = pii_tagger.tag_texts(tagger, [w[2] for w in held])
    right = sum(own == ([(w[0], w[3], w[4])] if w[0] != "none" else []) for w, own in zip(held, runs))
    assert right >= 0.85 * len(held)


def test_gradients_match_differences():
    draw, net = np.random.default_rng(0), pii_tagger.Tagger(cells=3)
    x, tags = draw.integers(0, 99, (7, 4)), draw.integers(0, 5, (7, 4))
    _, grads = net.step_gradients(x, tags)
    for params, own in zip(net._groups(), grads):
        for name, value in params.items():
            at = np.unravel_index(np.abs(own[name]).argmax(), value.shape)
            value[at] += 1e-5
            up, _ = net.step_gradients(x, tags)
            value[at] -= 2e-5
            down, _ = net.step_gradients(x, tags)
            value[at] += 1e-5
            assert abs((up - down) / 2e-5 - own[name][at]) < 1e-6


def test_scores_and_shortcut_agree_with_the_plain_network(tagger):
    x = np.random.default_rng(4).integers(0, 99, (40, 60))
    h1, h2 = tagger.ahead.forward(x), tagger.back.forward(x[::-1])[::-1]
    plain = h1 @ tagger.head["ahead"] + h2 @ tagger.head["back"] + tagger.head["bias"]
    assert np.abs(tagger.scores(x) - plain).max() < 1e-3
    assert (tagger.tag(x) == tagger.decode(tagger.scores(x))).all()


def test_windows_of_a_long_text_are_reconciled(tagger):
    filler = "abc def ghij " * 40
    texts = [filler[:cut] + "call (234) 555-1234 now " + filler for cut in range(150, 330, 9)]
    for text, (base, added) in zip(texts, pii_tagger.all_spans(tagger, texts)):
        start = text.index("(234")
        assert not base and ("phone", start, start + 14) in added


def test_personal_data_on_awkward_rows(spark, tagger):
    rows = with_clashes(awkward(spark), *CLASH, "spans")
    found = pii_tagger.find_personal_data(rows, tagger).collect()
    assert len(found) == 9 and all(r.spans == [] for r in found if r.doc_id in (2, 3, 6))
    assert pii_tagger.find_personal_data(rows.limit(0), pii_tagger.train(pii_tagger.training_windows(rows.limit(0)))).count() == 0
    assert len(pii_tagger.training_windows(docs(spark, ["mail me@x.org please", None, ""]))) >= 1


def _anonymous_mb():
    with open("/proc/self/status") as status:
        return int(next(x.split()[1] for x in status if x.startswith("RssAnon"))) / 1024


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_a_worker_gives_back_what_a_task_held():
    last = []

    def work(batches):
        for batch in batches:
            held = [np.ones(4000) for _ in range(3000)]  # 96 MB
            last.append(np.ones(4000))  # lies behind them, so that the heap can't just end earlier
            yield batch
            del held

    batch = pa.RecordBatch.from_pydict({"text": ["a"]})
    before = _anonymous_mb()
    assert list(arrow_slices.leaving_nothing(work)([batch])) == [batch]
    assert _anonymous_mb() < before + 30


def test_the_pipelines_python_tasks_give_memory_back(spark, tmp_path, monkeypatch):
    rows = docs(spark, ["some words of a text that is long enough " * 3, "other words of another text, long enough"])
    model = language.train(rows)
    for operator in (sampled_pieces.sample_segmentations, near_dedup.near_groups, lambda x: language.identify(x, model), mixing.mix):
        folder = tmp_path / str(len(list(tmp_path.iterdir())))
        folder.mkdir()
        monkeypatch.setattr(arrow_slices, "give_back", lambda folder=str(folder): tempfile.mkstemp(dir=folder))
        operator(rows).collect()
        assert list(folder.iterdir())


def test_edges_in_parts_are_those_of_a_whole_slice(monkeypatch):
    vocabulary = sampled_pieces.load_vocabulary()
    draw = random.Random(5)
    texts = [" ".join("".join(draw.choices("abcdefé\U0001f642", k=draw.randint(1, 40))) for _ in range(60)) for _ in range(8)]

    def drawn():
        sampler = sampled_pieces.Sampler(vocabulary, 3)
        return [[path[x].tolist() for x in ("ids", "log_prob", "top", "log_inclusion")] for own in (texts[:4], texts[4:], texts) for path in sampler.draw(own, np.arange(len(own)))]

    whole, sizes = drawn(), []
    edges = sampled_pieces.Lattice.edges
    monkeypatch.setattr(sampled_pieces.Lattice, "edges", lambda self, codes, starts, own: sizes.append(len(codes)) or edges(self, codes, starts, own))
    monkeypatch.setattr(sampled_pieces, "EDGE_PLACES", 64)
    assert drawn() == whole
    assert max(sizes) < 64 + 4 * 40 + 2
