import hashlib
import random
import time

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.helpers import awkward, docs, frame, with_clashes
from tidewire.llm import bwt, passages, registry, window_scan

CLASH = ("pos", "sha", "later", "anchor", "start", "windows", "spans", "content", "first", "maybe")


def brute(rows):
    """The contract, window by window, over (doc_id, text) in order: results by (doc_id, text)."""
    seen, result = set(), {}
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            window = data[i : i + 100]
            if window in seen:
                gone[i : i + 100] = True
            seen.add(window)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        result[key, text or ""] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return result


def results(found):
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found]


def hold(spark, texts):
    found = sorted(passages.remove_repeats(with_clashes(docs(spark, texts), *CLASH)).collect(), key=lambda r: r.doc_id)
    expected = brute(list(enumerate(texts)))
    assert results(found) == [expected[i, t or ""] for i, t in enumerate(texts)]
    return found


def prose(draw, n, words=500):
    return " ".join(f"{draw.randrange(words):x}{chr(97 + draw.randrange(26))}" * 2 for _ in range(n))


def passages_in_noise(draw, number):
    """Texts that share passages of many lengths, at seams of any kind, copies and periodic texts among them."""
    shared = [prose(draw, n) for n in (10, 14, 17, 18, 20, 30, 90)]
    texts = []
    for _ in range(number):
        parts = []
        for _ in range(draw.randrange(1, 5)):
            parts += [prose(draw, draw.randrange(0, 40)), draw.choice(shared)]
        text = draw.choice(["", " ", "\n"]).join(parts)
        if draw.random() < 0.2:
            at = draw.randrange(len(text))
            text = text[:at] + "é" + text[at + 1 :]
        texts.append(text)
    texts += [texts[0], texts[3], texts[0] + "x", texts[1][5:], "a" * 700, "b" * 99, "a" * 150, "ab" * 300, "abc" * 60 + "abd" * 60, ("x" * 66 + "y") * 9,
              shared[-1] * 3, "", None, "é" * 50, "é" * 49]
    draw.shuffle(texts)
    return texts


def test_passages_of_all_lengths_against_brute_force(spark):
    found = hold(spark, passages_in_noise(random.Random(1), 60))
    assert any(r.n_spans > 1 for r in found) and any(0 < r.n_removed < r.n_bytes for r in found)


def test_the_bounds_of_one_window(spark):
    base = prose(random.Random(2), 40)
    hold(spark, [base, "_" + base[:99] + "!", "_" + base[:100] + "!", "_" + base[7:108] + "!" + base[108:207], base[100:], base[:200] + base[300:]])


def test_hot_anchors_are_spread_over_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(passages, "HOT_BYTES", 300)
    monkeypatch.setattr(passages, "BUCKET_BYTES", 2000)
    draw = random.Random(3)
    line = prose(draw, 25)
    hold(spark, [prose(draw, 6) + line + prose(draw, 6) for _ in range(60)] + passages_in_noise(draw, 20))


def test_texts_longer_than_a_piece(spark, monkeypatch):
    draw = random.Random(4)
    long = prose(draw, 60_000, 5000)
    assert len(long) > 2 * window_scan.PIECE
    texts = [long, "x" + long[5000:9000] + "y", prose(draw, 30) + long[-300:], long[window_scan.PIECE - 150 : window_scan.PIECE + 150]]
    hold(spark, texts)


def test_awkward_rows_and_keys(spark):
    rows = with_clashes(awkward(spark), *CLASH)
    found = passages.remove_repeats(rows).collect()
    given = [(r.doc_id, r.text) for r in rows.collect()]
    ordered = sorted(set(given), key=lambda x: (x[0] is None, x[0] or 0, hashlib.sha256((x[1] or "").encode()).hexdigest()))
    seen = {k: v for k, v in brute(ordered).items()}
    assert sorted(map(str, [(r.doc_id, *x) for r, x in zip(found, results(found))])) == sorted(str((k, *seen[k, t or ""])) for k, t in given)
    text = prose(random.Random(5), 60)
    named = frame(spark, [("b", text), ("a", text + "!"), (None, text), ("b", text)], "doc_id string, text string")
    assert sorted((str(r.doc_id), r.n_removed) for r in passages.remove_repeats(named).collect()) == [
        ("None", len(text)), ("a", 0), ("b", len(text)), ("b", len(text))]
    assert passages.remove_repeats(rows.limit(0)).collect() == []


def test_query_on_the_smallest_tables(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    found = sorted(registry.QUERIES["op12_passages"](spark, SMALL).collect(), key=lambda r: r.doc_id)
    expected = brute(rows)
    assert results(found) == [expected[k, t or ""] for k, t in rows] and any(r.n_removed for r in found)


@pytest.mark.parametrize("seed", range(20))
def test_merged_transforms_give_all_repeated_strings(seed):
    draw = np.random.default_rng(seed)
    strings = [bytes(draw.integers(0, draw.integers(1, 4), draw.integers(0, 40)).astype(np.uint8)) for _ in range(draw.integers(1, 9))]
    suffixes = sorted(((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1)), key=lambda x: ([y + 1 for y in x[0]] + [0], x[1]))
    made = lambda own: bwt.transform(np.frombuffer(b"".join(own), np.uint8), np.array([len(s) for s in own]))
    assert made(strings).tolist() == [strings[k][i - 1] if i else bwt.END for _, k, i in suffixes]
    cuts = sorted(draw.integers(0, len(strings) + 1, 2).tolist())
    shards = [p for p in (strings[: cuts[0]], strings[cuts[0] : cuts[1]], strings[cuts[1] :]) if p]
    for length in (1, 2, 5, 11):
        intervals = {}
        for block, k, i in zip(*bwt.merged([(made(p), np.array([len(s) for s in p])) for p in shards], length)):
            intervals.setdefault(block, set()).add((k, i))
        places = {}
        for k, s in enumerate(strings):
            for i in range(len(s) - length + 1):
                places.setdefault(s[i : i + length], set()).add((k, i))
        assert sorted(map(sorted, intervals.values())) == sorted(sorted(v) for v in places.values() if len(v) > 1)


def test_the_shuffle_files_of_stored_steps_are_gone_with_them(spark):
    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {x for x in blocks.split("\n") if "shuffle_" in x}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    table = docs(spark, passages_in_noise(random.Random(6), 20))
    before, setting = files(), spark.conf.get(name, None)
    found = passages.remove_repeats(table)
    for _ in range(50):  # they go in the background
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and found.count() == table.count() and spark.conf.get(name, None) == setting
