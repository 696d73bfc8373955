import hashlib
import heapq
from collections import Counter
from fractions import Fraction
from itertools import groupby
from math import ceil, floor

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.helpers import awkward, frame, with_clashes
from tidewire.llm import mixing, warc_chunks
from tidewire.llm.common import stored

PAGES = "page_id long, url string, html string"


def round_trip(spark, pages, folder, compression="gzip"):
    warc_chunks.write_archives(warc_chunks.chunk_table(warc_chunks.plan_records(pages)), folder, compression)
    return warc_chunks.read_records(spark, folder)


def test_archives_hold_any_payload(spark, tmp_path):
    size = warc_chunks.CHUNK_BYTES
    bodies = [
        "", None, "x", "é" * size, "\r\n\r\nWARC/1.1\r\n" * 3, "WARC/1.1\r\nWARC-Type: fake\r\n\r\n", "\r\nWARC/1.1\r\n", "a" * (size - 5) + "\r\n\r\nWARC/1.1\r\nb",
        "y" * (3 * size + 7), "\r\n" * 50, "same" * 300, "same" * 300, "same" * 300, "small", "small"]
    pages = with_clashes(frame(spark, [(i, f"http://h/{i}", b) for i, b in enumerate(bodies)], PAGES), "size", "content", "keep", "record_id", "data", "chunk")
    for compression in ("gzip", "none"):
        found = {r.page_id: r for r in round_trip(spark, pages, str(tmp_path / compression), compression).collect()}
        assert len(found) == len(bodies) and all(r.complete for r in found.values())
        for i, body in enumerate(bodies):
            payload = (body or "").encode()
            keep = max(j for j, b in enumerate(bodies) if (b or "") == (body or ""))
            shared = len(payload) >= warc_chunks.MIN_SHARED and keep > i
            assert (found[i].payload_bytes, found[i].payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
            assert (found[i].record_type, found[i].refers_to) == (("revisit", keep) if shared else ("response", None))


def test_archives_are_warc(spark, tmp_path):
    folder = str(tmp_path / "warc")
    round_trip(spark, frame(spark, [(1, "http://h/1", "body"), (2, "http://h/2", "z" * (warc_chunks.CHUNK_BYTES + 1))], PAGES).coalesce(1), folder, "none")
    text = spark.read.text(folder, wholetext=True).collect()
    records = "".join(r.value for r in text).split("\r\n\r\nWARC/1.1\r\n")
    assert all(r.value.startswith("WARC/1.1\r\n") and r.value.endswith("\r\n\r\n") for r in text if r.value)
    assert sum("WARC-Type: continuation" in r for r in records) == 1


def test_running_digests_and_lost_chunks(spark, tmp_path):
    payload = "q" * (2 * warc_chunks.CHUNK_BYTES + 1)
    chunks = stored(warc_chunks.chunk_table(warc_chunks.plan_records(frame(spark, [(1, "u", payload)], PAGES))), "test-chunks")
    rows = chunks.orderBy("chunk").collect()
    assert [r.running_sha1 for r in rows] == [hashlib.sha1(payload[: (i + 1) * warc_chunks.CHUNK_BYTES].encode()).hexdigest() for i in range(3)]
    warc_chunks.write_archives(chunks.where("chunk <> 1"), str(tmp_path / "broken"))
    assert [r.complete for r in warc_chunks.read_records(spark, str(tmp_path / "broken")).collect()] == [False]


def test_awkward_pages(spark, tmp_path):
    big = "b" * 2000
    pages = frame(spark, [(1, None, big), (1, None, big), (None, "u", big), (None, None, None), (2, "u\r\nWARC-Type: x", "")], PAGES)
    found = round_trip(spark, pages, str(tmp_path / "a")).collect()
    assert Counter((r.page_id, r.record_type) for r in found) == {(1, "response"): 2, (None, "response"): 2, (2, "response"): 1}
    assert all(r.complete for r in found)
    assert round_trip(spark, pages.limit(0), str(tmp_path / "none")).count() == 0


def brute_mix(blocks, weights):
    """{(source, block): (release, due, slot)} by a simulation of the whole mix, the fluid in exact fractions."""
    ends = {s: Fraction(blocks[s]) / weights[s] for s in blocks}

    def slots(virtual):
        return sum(Fraction(blocks[s]) if ends[s] <= virtual else virtual * weights[s] for s in blocks)

    jobs = sorted((floor(slots(i / weights[s])), ceil(slots((i + 1) / weights[s])), s, i) for s in blocks for i in range(blocks[s]))
    ready, known, found = [], 0, {}
    for slot in range(len(jobs)):
        while known < len(jobs) and jobs[known][0] <= slot:
            release, due, s, i = jobs[known]
            heapq.heappush(ready, (due, s, i, release))
            known += 1
        due, s, i, release = heapq.heappop(ready)
        assert slot < due
        found[s, i] = release, due, slot
    return found


def framed(fluid, size):
    frames = range(-(-fluid.length // size))
    least = np.array([mixing.waiting(fluid, k * size, min((k + 1) * size, fluid.length)).min() for k in frames], np.int64)
    return [(s, b) for k in frames for s, b in zip(*(x.tolist() for x in mixing.schedule_frame(fluid, k, least, size)))]


@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 40)), min_size=1, max_size=12), st.sampled_from([1, 2, 7, 64, 1000]))
@settings(max_examples=150, deadline=None)
def test_frames_of_any_size_make_the_schedule_of_a_full_simulation(sources, size):
    blocks, weights = {i: n for i, (n, _) in enumerate(sources)}, {i: Fraction(w) for i, (_, w) in enumerate(sources)}
    fluid = mixing.Fluid(blocks.values(), map(float, weights.values()))
    want = {slot: job for job, (_, _, slot) in brute_mix(blocks, weights).items()}
    assert framed(fluid, size) == [want[slot] for slot in range(fluid.length)]


def test_five_thousand_sources_stay_within_a_block_of_their_weights():
    rng = np.random.default_rng(3)
    weights = rng.pareto(1.0, 5000) + 0.01
    blocks = (weights * rng.uniform(0.5, 2, 5000) * 60_000 / weights.sum()).astype(int) + 1
    fluid = mixing.Fluid(blocks, weights)
    order = framed(fluid, 4096)
    assert len(set(order)) == len(order) == blocks.sum()
    # Before any source runs out, the fluid is slots times weight.
    had, share = np.zeros(5000), weights / weights.sum()
    for slot, (s, _) in enumerate(order, 1):
        if slot > fluid.turns[0]:
            break
        had[s] += 1
        assert abs(had - slot * share).max() < 1 + mixing.NEAR
    # Later on, each block lies in the window of its part of the fluid.
    source, block = (np.array(x) for x in zip(*order))
    slots = np.arange(len(order))
    assert (fluid.release(source, block) <= slots).all() and (slots < fluid.due(source, block)).all()


def test_a_long_mix_keeps_to_weights_that_no_round_number_gives():
    weights = np.array([1 / np.pi, 1 / 7000.3, 0.5])
    weights = np.append(weights, 1 - weights.sum())
    fluid = mixing.Fluid((weights * 400_000).astype(int) + 1, weights)
    source = np.array([s for s, _ in framed(fluid, mixing.FRAME)])[: int(fluid.turns[0])]
    had = np.cumsum(source[:, None] == np.arange(4), axis=0)
    assert abs(had - np.arange(1, len(source) + 1)[:, None] * weights).max() < 1 + mixing.NEAR


def test_mix_matches_a_full_simulation(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FRAME", 16)
    sizes = {"a": 40 * 32, "b": 25 * 32 - 3, "c": 7 * 32, "d": 1}
    rows = frame(spark, [(i, f"t{i}", "en", s, 1) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))])
    weights = {"a": 31, "b": 42, "c": 20, "d": 7}
    found = mixing.mix(rows, weights).collect()
    want = brute_mix({s: -(-n // 32) for s, n in sizes.items()}, {s: Fraction(w) for s, w in weights.items()})
    assert {(r.source, r.block): (r.release, r.due, r.slot) for r in found} == want
    assert len({(r.slot, r.place) for r in found}) == len(found) == sum(sizes.values())
    assert [p for p, _ in groupby(sorted(r.phase for r in found))] == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        mixing.mix(rows, {"a": 0.0})


def test_sources_beyond_the_bound_flow_together(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    rows = frame(spark, [(i, f"t{i}", "en", None if i % 41 == 0 else f"s{i % 41 if i % 2 else 1}", 1) for i in range(6000)])
    found = mixing.mix(rows).collect()
    assert sorted(r.doc_id for r in found) == list(range(6000))
    assert len({(r.slot, r.place) for r in found}) == 6000
    assert all(r.release <= r.slot < r.due for r in found)


def test_more_sources_than_rows_of_a_block(spark):
    rows = frame(spark, [(i, f"t{i}", "en", f"s{i % 500}", 1) for i in range(1500)])
    found = mixing.mix(rows).collect()
    assert sorted(r.doc_id for r in found) == list(range(1500)) and len({r.slot for r in found}) == 500


def test_mixed_order_keeps_every_row(spark, tmp_path):
    rows = with_clashes(awkward(spark), "slot", "place", "name", "content", "block", "rank", "phase", "bucket")
    mixed = mixing.in_mixed_order(rows)
    assert mixed.columns == rows.columns
    order = lambda df: sorted(map(str, df.collect()))
    assert order(mixed) == order(rows)
    assert mixing.in_mixed_order(rows.limit(0)).count() == 0 and mixing.mix(rows.limit(0)).count() == 0
