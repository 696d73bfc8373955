import re
import zlib
from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from tests.llm.helpers import awkward, docs, frame, with_clashes
from tidewire.llm import spelling

CLASH = ("word", "n", "key", "run", "form", "root", "way", "best", "other")


def near(a, b):
    """Exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1:] or (len(a) == len(b) and a[i + 1:] == b[i + 1:])


def brute(rows):
    """The contract, word by word over (doc_id, text)."""
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    links = {w: [x for x in words if near(w, x)] for w in words}
    forms = {}
    for w, n in words.items():
        if links[w]:
            best = min(links[w], key=lambda x: (-words[x], x))
            if words[best] >= 10 * n:
                forms[w] = best
    found = set()
    for w in words:
        root = w
        while root in forms:
            root = forms[root]
        found.add((w, forms.get(w), root, words[w], len(links[w]), words.get(forms.get(w))))
    return found


def rows_of(result):
    found = [tuple(r) for r in result.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_chains_ties_and_letters_beyond_ascii(spark):
    texts = ["colours " * 300, "colourz " * 30, "colourzz " * 3, "colourzy coloursy " * 2, "Économie économie " * 5, "ÉCONOMIE " * 4, "naïveté " * 60,
             "naivete naivete naïvete naïvete", "abcdefg bcdefgh " * 2, "abcdef abcdef shorter", "xabcdefg" * 3, "a×b÷cdefg " * 2, "abcdefghh abcdefgh " * 2]
    frame_ = with_clashes(docs(spark, texts), *CLASH)
    expected = brute(list(enumerate(texts)))
    assert rows_of(spelling.variant_groups(frame_)) == expected
    assert any(root not in (w, form) for w, form, root, *_ in expected)


def test_every_pair_of_random_words_one_edit_apart(spark):
    seen = []

    @settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.text("abÿ", min_size=7, max_size=10), min_size=60, max_size=120, unique=True))
    def hold(words):
        found = [tuple(r) for r in spelling.near_pairs(frame(spark, [(w, 2) for w in words], "word string, n long")).select("s", "t").collect()]
        assert sorted(tuple(sorted(p)) for p in found) == sorted((a, b) for a in words for b in words if a < b and near(a, b))
        seen.extend(found)

    hold()
    assert seen


def test_one_hot_stem_with_all_its_variants(spark):
    stem = "internationals"
    words = sorted({stem[:i] + c + stem[i + d:] for i in range(len(stem)) for c in ["", *"abcdefgh"] for d in (0, 1)} - {""})
    found = spelling.near_pairs(frame(spark, [(w, 2) for w in words], "word string, n long"))
    assert sorted(tuple(sorted((r.s, r.t))) for r in found.collect()) == sorted((a, b) for a in words for b in words if a < b and near(a, b))


def test_awkward_and_empty_tables(spark):
    rows = with_clashes(awkward(spark), *CLASH)
    assert rows_of(spelling.variant_groups(rows)) == brute([(r.doc_id, r.text) for r in rows.collect()]) == set()
    assert spelling.variant_groups(rows.limit(0)).collect() == []
    keyless = frame(spark, [(None, "keyless keyless keylesss"), (None, None), (7, "KEYLESS " * 40)], "doc_id long, text string")
    assert rows_of(spelling.variant_groups(keyless)) == brute([(r.doc_id, r.text) for r in keyless.collect()])
