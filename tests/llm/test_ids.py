import hashlib
import math
import zlib
from collections import defaultdict

import pytest

from tests.llm.helpers import awkward, docs, frame, with_clashes
from tidewire.llm import exact_dedup, sharding

CLASH = ("text_sha256", "candidate", "content", "row", "keep", "size", "bucket", "shard", "slot", "packed_input_row", "within")


def test_copy_groups_on_awkward_rows(spark):
    found = exact_dedup.copy_groups(with_clashes(awkward(spark), *CLASH), digest_all=True).collect()
    by_text = defaultdict(list)
    for r in found:
        by_text[r.text_sha256].append(r)
    assert len(found) == 9
    same = by_text[hashlib.sha256(b"a b").hexdigest()]
    assert {(r.keep_id, r.group_size) for r in same} == {(1, 3)} and sum(r.kept for r in same) == 1
    assert next(r for r in same if r.kept).doc_id == 1
    empty = by_text[hashlib.sha256(b"").hexdigest()]
    assert {(r.keep_id, r.group_size) for r in empty} == {(3, 3)} and sum(r.kept for r in empty) == 1
    assert all(r.kept and r.group_size == 1 for r in found if r not in same and r not in empty)


def test_levels_refine_texts_that_agree_in_length_and_prefix(spark):
    head = "x" * exact_dedup.PREFIX_CHARS
    found = exact_dedup.copy_groups(docs(spark, [head + "a", head + "b", head + "a", "other", "short"])).collect()
    assert {r.doc_id: (r.keep_id, r.kept, r.text_sha256 is None) for r in found} == {
        0: (2, False, False), 1: (1, True, False), 2: (2, True, False), 3: (3, True, True), 4: (4, True, True)}


def test_drop_copies_keeps_columns_and_one_row(spark):
    rows = with_clashes(awkward(spark), *CLASH)
    left = exact_dedup.drop_copies(rows)
    assert left.columns == rows.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in left.collect())[:2] == [(1, "a b"), (3, "")]
    assert left.count() == 5
    assert exact_dedup.drop_copies(rows.limit(0)).count() == 0 and exact_dedup.copy_groups(rows.limit(0)).count() == 0


def brute_shard(name, weights):
    def score(i):
        u = (int(hashlib.md5(f"{name}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        return -weights[i] / math.log(u)
    return max(range(len(weights)), key=lambda i: (score(i), -i))


def test_shards_match_brute_force_and_move_only_into_the_new_one(spark):
    weights = [1.0, 2.0, 1.0]
    rows = frame(spark, [(i, f"t{i}", "en", "s", 2) for i in range(400)])
    found = sharding.assign_shards(rows, weights, [*weights, 1.5]).collect()
    assert all(r.shard == brute_shard(str(r.doc_id), weights) and r.grown_shard == brute_shard(str(r.doc_id), [*weights, 1.5]) for r in found)
    assert all(r.grown_shard in (r.shard, 3) for r in found)
    counts = [sum(r.shard == i for r in found) for i in range(3)]
    assert counts[1] > 1.5 * max(counts[0], counts[2])


def test_slots_have_no_gaps_on_awkward_rows(spark):
    found = sharding.assign_shards(with_clashes(awkward(spark), *CLASH), [1.0] * 4).collect()
    assert len(found) == 9
    for shard in range(4):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert {(r.size, r.text_crc32) for r in found if r.doc_id == 3} == {(1, 0)}
    assert {r.text_crc32 for r in found if r.doc_id == 5} == {zlib.crc32("é\U0001f642 x\ty\n\nz".encode())}
    assert sharding.assign_shards(awkward(spark).limit(0), [1.0] * 4).count() == 0


def test_weights_are_checked(spark):
    with pytest.raises(ValueError):
        sharding.shard_of(None, [1.0, 0.0])
