import zlib
from collections import Counter, defaultdict

import pytest
from awkward import AWKWARD

from stridelake.llm.kd_shards import _placed, kd_shards, write_shards


def check(rows, out, shards):
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=str) == want
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))


def test_balanced_with_a_hot_text(spark, docs_of):
    rows = [(i, f"text {i} " + "w " * (i * 7 % 90)) for i in range(3000)] + [(5000 + i, "the hot text " * 5) for i in range(1500)]
    out = kd_shards(docs_of(rows, clashing=False), shards=7).collect()
    check(rows, out, 7)
    size = Counter()
    for r in out:
        size[r["shard"]] += r["size"]
    mean = sum(size.values()) / 7
    assert max(size.values()) < 1.06 * mean and min(size.values()) > 0.94 * mean
    together = defaultdict(set)
    for r in kd_shards(docs_of(rows[:100] * 2, clashing=False), shards=3).collect():
        together[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in together.values())


def test_groups_stay_whole(spark, docs_of):
    """Groups of up to a shard, one larger than that; shards stay near equal."""
    rows = [(i, f"text {i} " + "w " * (i * 7 % 90)) for i in range(2000)]
    for k in range(30):
        rows += [(10_000 + 1000 * k + i, f"group {k} " * 10) for i in range(20 + 9 * k)]
    rows += [(90_000 + i, "larger than a shard " * 4) for i in range(900)]
    out = kd_shards(docs_of(rows, clashing=False), shards=12).collect()
    check(rows, out, 12)
    size, of_text, bytes_of = Counter(), defaultdict(set), Counter()
    for r in out:
        size[r["shard"]] += r["size"]
        of_text[r["text_crc32"]].add(r["shard"])
        bytes_of[r["text_crc32"]] += r["size"]
    share = sum(size.values()) / 12
    assert [bytes_of[t] > share for t, s in of_text.items() if len(s) > 1] == [True]
    assert max(size.values()) < 1.06 * share and min(size.values()) > 0.94 * share


def test_placing_is_balanced():
    groups = [(k, 10 + k % 50) for k in range(400)]
    placed, room = _placed(groups, 20, sum(b for _, b in groups) / 20)
    assert sorted(h for h, _ in placed) == list(range(400)) and max(room) < 15 and len(room) == 20
    assert _placed([], 3, 5.0) == ([], [5.0] * 3)


@pytest.mark.parametrize("shards", [1, 5])
def test_awkward_rows(spark, docs_of, shards):
    rows = AWKWARD + [(3, "same"), (3, "same")]
    check(rows, kd_shards(docs_of(rows), shards=shards, keep=("doc_id", "score", "size")).collect(), shards)


def test_empty_target_and_files(spark, docs_of, tmp_path):
    docs = docs_of([(i, f"t{i}" * 20) for i in range(50)], clashing=False)
    assert kd_shards(docs.limit(0), shards=4).count() == 0
    assert len({r["shard"] for r in kd_shards(docs, target_bytes=1000).collect()}) == 4
    assert kd_shards(docs.select("doc_id", "text"), shards=2).count() == 50
    with pytest.raises(ValueError):
        kd_shards(docs)
    write_shards(docs, str(tmp_path / "out"), shards=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).isEmpty() and back.count() == 50
