import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpus_health.llm import mixing, queries, sharding

from .conftest import SMALL, rows_of

NAMES = [f"s{i}" for i in range(7)]


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def brute_table(names, slots):
    orders = []
    for n in names:
        offset, skip = number(f"offset:{n}") % slots, number(f"skip:{n}") % (slots - 1) + 1
        orders.append([(offset + j * skip) % slots for j in range(slots)])
    table = {}
    while len(table) < slots:
        for i, order in enumerate(orders):
            if len(table) < slots:
                table[next(s for s in order if s not in table)] = i
    return [table[i] for i in range(slots)]


def test_table_is_filled_in_turns():
    assert sharding.fill(NAMES, 211) == brute_table(NAMES, 211)
    counts = Counter(sharding.fill(NAMES))
    assert max(counts.values()) - min(counts.values()) <= 1


def test_few_keys_move_when_a_shard_leaves():
    full, less = sharding.fill(NAMES, 10007), sharding.fill(NAMES[:-1], 10007)
    moved = sum(a != b for a, b in zip(full, less, strict=True) if a != 6)
    assert moved < 0.1 * 10007


@pytest.mark.parametrize(("names", "slots"), [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_wrong_tables(names, slots):
    with pytest.raises(ValueError):
        sharding.fill(names, slots)


def test_query_places_every_document(spark, texts):
    table = sharding.fill(queries.SHARDS)
    want = sorted((i, s := number(f"key:{i}") % sharding.SLOTS, queries.SHARDS[table[s]]) for i in texts)
    got = sorted((r.doc_id, r.slot, r.shard) for r in queries.op1_sharding(spark, SMALL).collect())
    assert got == want


def test_sharding_odd_rows(clashing, empty):
    out = sharding.assign(clashing, NAMES)
    assert out.columns == [c for c in clashing.columns if c != "shard"] + ["shard"]
    assert out.count() == clashing.count()
    assert out.where("doc_id is null").select("shard").distinct().count() == 1
    assert out.where("doc_id = 5").select("shard").distinct().count() == 1
    assert sharding.assign(empty, NAMES).count() == 0


def test_shards_are_written(docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), NAMES)
    back = docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count()
    assert {r.shard for r in back.select("shard").distinct().collect()} <= set(NAMES)


def brute_copies(key, rate, seed=mixing.SEED):
    total, i = 0, 0
    while rate - i * mixing.RATE_STEP > 0:
        part = min(mixing.RATE_STEP, rate - i * mixing.RATE_STEP)
        text = f"{seed}|{'\x00' if key is None else key}|{i}"
        u = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52
        p = cdf = math.exp(-part)
        k = 0
        while u >= cdf and k < mixing.STEPS:
            k += 1
            p *= part / k
            cdf += p
        total += k
        i += 1
    return total


def test_mix_is_what_sql_says(spark, sql):
    assert rows_of(queries.op6_mix(spark, SMALL)) == sql(queries.ORACLE_SQL["op6_mix"])


def test_rates_and_high_rates(docs):
    weights = {"src1": 3.0, "src2": 1.0}
    out = mixing.mix(docs, weights, size=8000)
    got = Counter((r.source, r.doc_id) for r in out.select("source", "doc_id").collect())
    counts = {r.source: r["count"] for r in docs.groupBy("source").count().collect()}
    rate = {"src1": 6000 / counts["src1"], "src2": 2000 / counts["src2"]}
    for r in docs.where(F.col("source").isin(*weights)).collect():
        assert got.pop((r.source, r.doc_id), 0) == brute_copies(r.doc_id, rate[r.source])
    assert not got
    share = out.where("source = 'src1'").count() / out.count()
    assert abs(share - 0.75) < 0.03


def test_order_is_global_and_repeats(docs):
    one, two = (mixing.mix(docs).select("place", "doc_id", "copy").collect() for _ in range(2))
    assert one == two
    assert len({r.place for r in one}) == len(one)


def test_mixing_odd_rows(clashing, empty, docs):
    out = mixing.mix(clashing, size=200)
    assert set(out.columns) == set(clashing.columns)
    assert {r.source for r in out.select("source").distinct().collect()} == {None, "a", "b", "c"}
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(docs, {"none": 1.0}).count() == 0
    assert mixing.mix(docs, copy=None, place=None).columns == docs.columns
