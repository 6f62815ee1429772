import pytest
from pyspark.sql import functions as F

from rostra.llm.mixing import exact, mix, mixed, one_period, rounded, schedule, slots


@pytest.mark.parametrize("weights", [{0: 1.0}, {0: 0.5, 1: 0.5}, {0: 0.7, 1: 0.2, 2: 0.07, 3: 0.03}, {i: 1.0 for i in range(30)}, {0: 0.9, **{i: 0.005 for i in range(1, 21)}}])
def test_every_prefix_is_less_than_a_block_away(weights):
    parts = rounded(weights, 1000)
    assert sum(parts.values()) == 1000
    taken = one_period(parts, 1000, 1000)
    for s, part in parts.items():
        assert len(taken[s]) == part
        for k, slot in enumerate(taken[s]):
            assert k * 1000 // part <= slot < -(-(k + 1) * 1000 // part)
    count = dict.fromkeys(parts, 0)
    order = sorted((slot, s) for s, slots in taken.items() for slot in slots)
    assert [slot for slot, _ in order] == list(range(1000))
    for slot, s in order:
        count[s] += 1
        for other, part in parts.items():
            assert abs(count[other] - (slot + 1) * part / 1000) < 1


def brute(blocks, weights, period):
    """Slot by slot: earliest deadline of released blocks, a new segment when a source ends."""
    left, done, begin, slot, order = dict(blocks), dict.fromkeys(blocks, 0), 0, 0, []
    while left:
        width = max(period, 8 * len(left))
        parts, used, begin, ended = rounded({s: weights[s] for s in left}, width), dict.fromkeys(left, 0), slot, False
        while not ended:
            t = slot - begin
            ready = [
                (t // width * width + -(-(used[s] % parts[s] + 1) * width // parts[s]), s)
                for s in left
                if used[s] * width // parts[s] <= t
            ]
            s = min(ready)[1]
            order.append((slot, s, done[s]))
            used[s] += 1
            done[s] += 1
            left[s] -= 1
            slot += 1
            if not left[s]:
                del left[s]
                ended = True
    return order


@pytest.mark.parametrize("blocks,period", [({0: 5, 1: 9, 2: 1}, 10), ({0: 300, 1: 40, 2: 25, 3: 1}, 50), ({0: 7}, 10)])
def test_against_slot_by_slot(spark, blocks, period):
    names = {s: f"s{s}" for s in blocks}
    rows = [(i, names[s]) for s, n in blocks.items() for i in range(s * 100_000, s * 100_000 + n * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    weights = {s: 1.0 / (1 + s) for s in blocks}
    found = mix(docs, {names[s]: w for s, w in weights.items()}, block_rows=4, period=period)
    got = {(r.slot, r.source, r.block) for r in found.select("slot", "source", "block").collect()}
    expected = {(slot, names[s], k) for slot, s, k in brute(blocks, weights, period)}
    assert got <= expected  # a block may be empty
    assert found.count() == len(rows)


def test_segments_cover_all_blocks():
    segments = schedule({0: 10, 1: 1000}, {0: 0.5, 1: 0.5}, 100)
    assert [s.first_slot for s in segments] in ([0, 19], [0, 20])
    assert segments[1].first_block == {1: segments[1].first_slot - 10}


def test_defined_cases(spark):
    rows = [(1, "a", "t", 0), (1, "a", "t", 0), (2, None, None, 1), (None, "b", "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, _k int")
    out = mixed(docs)
    assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert mixed(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mix(docs, {"a": 0.0})
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    slots = mix(hot, block_rows=16).groupBy("slot").agg(F.countDistinct("source").alias("n")).agg(F.max("n")).first()[0]
    assert slots == 1


@pytest.mark.parametrize("weights", [{0: 0.70037, 1: 0.29962, 2: 1e-5}, {i: (i + 1) ** 0.7 for i in range(40)}])
def test_prefixes_against_the_targets_themselves(weights):
    parts = exact(weights)
    total, count = sum(parts.values()), dict.fromkeys(weights, 0)
    blocks = dict.fromkeys(weights, 20_000)
    for slot, (segment, s, block) in zip(range(10_000), slots(blocks, weights)):
        assert block == count[s] and segment.first_slot == 0
        count[s] += 1
        for other, part in parts.items():
            assert abs(count[other] * total - (slot + 1) * part) < total


def test_blocks_are_full_whatever_the_ids(spark):
    n = 1000
    docs = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).alias("doc_id"), F.when(F.col("id") < 700, "a").otherwise("b").alias("source"))
    sizes = mix(docs, block_rows=16).groupBy("source", "block").count().collect()
    found = {s: sorted((r["block"], r["count"]) for r in sizes if r["source"] == s) for s in "ab"}
    for s, rows in (("a", 700), ("b", 300)):
        assert found[s] == [(k, min(16, rows - 16 * k)) for k in range(-(-rows // 16))]
    assert len(set(r.slot for r in mix(docs, block_rows=16).collect())) == 44 + 19
