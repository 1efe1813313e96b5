"""Exact duplicates against plain Python, also where keys and digests collide and buckets split, and the cases of the docstring."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spanforge.llm import catalogue, exact_dedup
from tests.compare import connection, differences

SF = "/root/testdata/sf0.001"


def test_same_as_sql(spark):
    assert differences(spark, connection(SF), catalogue.queries()["op13_exact_dedup"], exact_dedup.ORACLE_SQL, SF) is None


def plain(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def check(rows, docs):
    sets = defaultdict(list)
    for d, t in docs:
        sets[plain(t)].append(d)
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in sets}
    kept = defaultdict(list)
    for r in rows:
        own = sets[sha[r.text_sha256]]
        largest = max((d for d in own if d is not None), default=None)
        assert (r.group_size, r.keep_id) == (len(own), largest)
        if r.kept:
            kept[r.text_sha256].append(r.doc_id)
    assert all(len(x) == 1 for x in kept.values()) and len(kept) == len(sets)
    assert all(d[0] == max((x for x in sets[sha[s]] if x is not None), default=None) for s, d in kept.items())
    assert sorted((r.text_sha256, r.doc_id is None, r.doc_id or 0) for r in rows) == sorted(
        (hashlib.sha256(plain(t).encode()).hexdigest(), d is None, d or 0) for d, t in docs
    )


def table(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(5)


def documents(seed, n=300):
    rng = random.Random(seed)
    made = [(i, rng.choice("abcABCÄä İ\n") * rng.choice([1, 1, 2, 30]) + str(rng.randrange(n // 3))) for i in range(n)]
    return made + [(None, None), (n + 1, ""), (n + 2, None), (None, "x"), (None, "X"), (5, made[5][1]), (n + 3, "Long " * 100_000), (n + 4, "long " * 100_000)]


@pytest.mark.parametrize("options", [{}, {"capacity": 8}, {"key_bits": 4, "capacity": 8}, {"key_bits": 3, "digest_chars": 1}, {"bits": 7}, {"digest_chars": 0, "key_bits": 1}])
def test_same_as_plain_python(spark, options):
    docs = documents(len(str(options)))
    check(exact_dedup.groups(table(spark, docs), keep_text=False, **options).collect(), docs)


def test_a_third_of_all_rows_is_one_text(spark):
    docs = documents(3) + [(10_000 + i, "One text" if i % 2 else "ONE TEXT") for i in range(200)]
    check(exact_dedup.groups(table(spark, docs)).collect(), docs)


def test_buckets_split_and_the_directory_doubles(spark):
    # Six keys begin alike, so one side of the directory is deeper than the other.
    keys = [i << 40 for i in range(6)] + [-(1 << 62) + i for i in (1, 2)]
    records = spark.createDataFrame([(k,) for k in keys], "_key long")
    depth, buckets = exact_dedup.directory(records, 3)
    assert depth == exact_dedup.MOST_DEPTH and (2, 0) not in buckets and {(2, 1), (2, 2), (2, 3)} < set(buckets)
    assert sum(2.0**-d for d, _ in buckets) == 1
    even = spark.range(4000).select(F.xxhash64("id").alias("_key"))
    depth, buckets = exact_dedup.directory(even, 100)
    counts = [0] * len(buckets)
    for r in even.collect():
        at = [i for i, (d, p) in enumerate(buckets) if (r._key % (1 << 64)) >> (64 - d) == p]
        assert len(at) == 1
        counts[at[0]] += 1
    assert max(counts) <= 100 and 5 < depth < 10


def test_index_is_stored_in_order_with_chains(spark):
    rows = [(i % 4 << 62, str(i % 8), i, i) for i in range(64)]
    entries = spark.createDataFrame([(k - (1 << 64) if k >= 1 << 63 else k, d, i, r) for k, d, i, r in rows], "_key long, _digest string, _id long, _row long")
    index = exact_dedup.build_index(entries, capacity=2).collect()
    assert len(index) == 8 and sorted(r._place for r in index) == [1] * 4 + [2] * 4
    assert {r.n for r in index} == {8} and len({r._bucket for r in index}) == 4


def test_empty_table_and_clashing_columns(spark):
    assert exact_dedup.groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    odd = spark.createDataFrame([(1, "a", 3, 4, 5, 6), (2, "A", 3, 4, 5, 6)], "doc_id long, text string, Kept int, `odd.name` int, _own int, _key int")
    rows = exact_dedup.groups(odd).orderBy("doc_id").collect()
    assert [(r["odd.name"], r["_own"], r["_key"], r["kept"], r["keep_id"], r["text"]) for r in rows] == [(4, 5, 6, False, 2, "a"), (4, 5, 6, True, 2, "A")]
    assert exact_dedup.groups(odd.select("text"), doc_id="text", keep_text=False).count() == 2
