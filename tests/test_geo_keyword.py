"""Circles by grid cells and keywords by the trigram index give the plain search's rows, and read less."""

import glob
import math
import random

import pytest
from pyspark.sql import functions as F

from test_plans import plan
from vigil.functions import geo
from vigil.operators.keyword_index import FEW_FILES, KeywordIndex, keyword_trigrams, trigram_number, trigrams
from vigil.operators.search import PostFilter, search_posts

CIRCLES = [(10, 20, 500), (0, 179.9, 300), (5, -179.5, 1500), (89.5, 10, 400), (-90, 0, 50), (0, 0, 0.0), (60, 0, 25000), (45.5, 7.25, 3), (-30, 180, 120), (70, -100, 2500)]


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


def around(rng, circle):
    """Places everywhere, near the centre and near the circle's edge."""
    lat, lon, r = circle
    out = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]
    for _ in range(60):
        way, far = rng.uniform(0, 2 * math.pi), r / 6371.0 * rng.choice([0.5, 0.99, 0.9999, 1.0001, 1.01])
        p = math.asin(max(-1, min(1, math.sin(math.radians(lat)) * math.cos(far) + math.cos(math.radians(lat)) * math.sin(far) * math.cos(way))))
        q = math.radians(lon) + math.atan2(math.sin(way) * math.sin(far) * math.cos(math.radians(lat)), math.cos(far) - math.sin(math.radians(lat)) * math.sin(p))
        out.append((math.degrees(p), (math.degrees(q) + 180) % 360 - 180))
    return out


@pytest.fixture(scope="module")
def places(spark):
    rng = random.Random(2)
    rows = [p for c in CIRCLES for p in around(rng, c)] + [(90.0, 0.0), (-90.0, 12.0), (0.0, 180.0), (0.0, -180.0), (10.0, 380.0), (None, 1.0), (1.0, None), (91.0, 0.0)]
    return rows, spark.createDataFrame([(i, *map(lambda x: None if x is None else float(x), r)) for i, r in enumerate(rows)], "post_id long, lat double, lon double")


@pytest.mark.parametrize("circle", CIRCLES)
@pytest.mark.parametrize("cells", [True, False])
def test_circle(spark, places, circle, cells):
    rows, df = places
    df = geo.with_cell(df) if cells else df
    got = {r.post_id for r in search_posts(df, PostFilter(geo=circle)).collect()}
    near = [(i, km(*r, circle[0], circle[1])) for i, r in enumerate(rows) if None not in r and abs(r[0]) <= 90]
    assert {i for i, d in near if d < circle[2] - 1e-6} <= got <= {i for i, d in near if d <= circle[2] + 1e-6}


def test_cover_is_short_and_holds_the_circle():
    for c in CIRCLES:
        ranges = geo.cover(*c)
        assert 1 <= len(ranges) <= geo.MAX_RANGES and all(a <= b for a, b in ranges) and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))
    assert sum(b - a + 1 for a, b in geo.cover(45.5, 7.25, 3)) == 1


def test_ranges_reach_the_scan(spark, tmp_dir):
    rng = random.Random(3)
    df = spark.createDataFrame([(i, rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(4000)], "post_id long, lat double, lon double")
    geo.with_cell(df).write.parquet(f"{tmp_dir}/p")
    q = search_posts(spark.read.parquet(f"{tmp_dir}/p"), PostFilter(geo=(10, 20, 200)))
    pushed = plan(q).split("PushedFilters", 1)[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(geo_cell" in pushed and "GreaterThanOrEqual(lat" in pushed
    want = [r.post_id for r in df.filter(geo.within_km(F.col("lat"), F.col("lon"), 10, 20, 200)).collect()]
    assert sorted(r.post_id for r in q.collect()) == sorted(want)


def posts(spark, n=400):
    rng = random.Random(5)
    words = "Alpha beta GAMMA delta worthless phone ünïcode 漢字テスト x yz".split()
    rows = [(i, f"2024-01-{1 + i % 9:02d}", " ".join(rng.choice(words) for _ in range(rng.randrange(5))) if i % 50 else None) for i in range(n)]
    rows[7] = (7, "2024-01-08", "the only needle-in-a-haystack")
    return spark.createDataFrame(rows, "post_id long, date string, tweet string").withColumn("date", F.to_date("date"))


@pytest.mark.parametrize("keyword", ["worthless", "WORTHLESS phone", "needle", "ünÏc", "漢字テ", "x", "yz x", "amma bet", "nothing of it", "%_\\", ""])
def test_index_gives_the_plain_rows(spark, tmp_dir, keyword):
    df = posts(spark)
    index = KeywordIndex(spark, tmp_dir)
    index.write(df, rows_a_block=40)
    want = search_posts(df, PostFilter(keyword=keyword))
    assert sorted(map(str, index.search(PostFilter(keyword=keyword)).collect())) == sorted(map(str, want.collect()))
    files = index.files(keyword) if keyword else None
    n = len(glob.glob(f"{tmp_dir}/posts/part-*"))
    if keyword == "needle":
        assert n >= 8 and len(files) == 1
        assert len(index.search(PostFilter(keyword=keyword)).inputFiles()) == 1
    if keyword in ("x", "yz x", ""):
        assert files is None
    if keyword == "nothing of it":
        assert files == []


def test_trigrams(spark):
    df = spark.createDataFrame([("Abab",), ("ab",), ("",), (None,)], "t string")
    assert [sorted(r.g) for r in df.select(trigrams(F.col("t")).alias("g")).collect()] == [["aba", "bab"], [], [], []]
    assert keyword_trigrams("Abab x yz") == ["aba", "bab"]


def test_index_of_no_posts(spark, tmp_dir):
    index = KeywordIndex(spark, tmp_dir)
    index.write(posts(spark).limit(0))
    assert index.search(PostFilter(keyword="alpha")).count() == 0


def test_many_blocks_share_files(spark, tmp_dir):
    """Files don't grow in number with the blocks, and a block has the trigrams of its texts."""
    df = posts(spark)
    index = KeywordIndex(spark, tmp_dir)
    index.write(df, rows_a_block=2)
    assert len(glob.glob(f"{tmp_dir}/posts/part-*")) <= FEW_FILES
    stored = spark.read.parquet(f"{tmp_dir}/posts")
    assert stored.groupBy("block__").count().agg(F.max("count"), F.count("*")).first()[0] == 2
    want = {(r.block__, g) for r in stored.select("block__", trigrams(F.col("tweet")).alias("g")).collect() for g in r.g if " " not in g}
    got = [(r.block, r.trigram) for r in spark.read.parquet(f"{tmp_dir}/trigrams").collect()]
    assert set(got) == {(b, trigram_number(g)) for b, g in want}
    for keyword in ("worthless phone", "needle", "漢字テスト"):
        hits = search_posts(df, PostFilter(keyword=keyword)).collect()
        assert sorted(map(str, index.search(PostFilter(keyword=keyword)).collect())) == sorted(map(str, hits))
    assert index.posts().columns == df.columns
