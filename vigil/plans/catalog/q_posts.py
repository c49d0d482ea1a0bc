"""Post search predicates, the stored-posts scan and the posts mart (L-4, PF-1..PF-28, S-6, F-10)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.dates import date_text, epoch_seconds
from vigil.functions.geo import with_cell
from vigil.operators.keyword_index import KeywordIndex
from vigil.operators.search import PostFilter, search_posts
from vigil.plans.catalog.base import oracle, register
from vigil.plans.catalog.q_text import RULES_CTES, clean_sql, lexicon_df
from vigil.plans.posts import PostsRun, build_posts
from vigil.session import scratch_path
from vigil.sinks.tables import write_daily
from vigil.sources.posts import scan_posts
from vigil.sources.tables import Inputs

OUT = ["post_id", "date", "username", "likes"]
OUT_SQL = "post_id, date, username, CAST(likes AS BIGINT) AS likes"
PERIOD = PostsRun(since=date(2024, 1, 1), until=date(2024, 1, 31))
HAVERSINE_SQL = ("2 * 6371.0 * asin(sqrt(pow(sin(radians(10.0 - lat) / 2), 2) + cos(radians(lat)) * "
                 "cos(radians(10.0)) * pow(sin(radians(20.0 - lon) / 2), 2))) <= 3000.0")

# name -> (filter, DuckDB predicate)
PREDICATES: dict[str, tuple[PostFilter, str]] = {
    "post_keyword": (PostFilter(keyword="Worthless"), "contains(lower(tweet), 'worthless')"),
    "post_from": (PostFilter(username="src3"), "username = 'src3'"),
    "post_since": (PostFilter(since="2024-01-02"), "ts >= TIMESTAMP '2024-01-02 00:00:00'"),
    "post_until": (PostFilter(until="2024-1-2 12:00:00"), "ts < TIMESTAMP '2024-01-02 12:00:00'"),
    "post_year": (PostFilter(year=2024), "ts < TIMESTAMP '2024-01-01 00:00:00'"),
    "post_geo": (PostFilter(geo="10, 20, 3000km"), HAVERSINE_SQL),
    "post_near": (PostFilter(near="NATION_7"), "place = 'NATION_7'"),
    "post_email": (PostFilter(email=True), "(contains(lower(tweet), 'mail') OR contains(lower(tweet), 'email') "
                                           "OR contains(lower(tweet), 'gmail') OR contains(lower(tweet), 'e-mail'))"),
    "post_phone": (PostFilter(phone=True), "(contains(lower(tweet), 'phone') OR contains(lower(tweet), 'call me') "
                                           "OR contains(lower(tweet), 'text me'))"),
    "post_verified": (PostFilter(verified=True), "verified"),
    "post_to": (PostFilter(to="src6"), "to_user = 'src6'"),
    "post_all": (PostFilter(all="src3"), "(to_user = 'src3' OR username = 'src3' "
                                         "OR COALESCE(list_contains(mentions, 'src3'), false))"),
    "post_images": (PostFilter(images=True), "n_images > 0"),
    "post_videos": (PostFilter(videos=True), "n_videos > 0"),
    "post_media": (PostFilter(media=True), "(n_images > 0 OR n_videos > 0)"),
    "post_replies": (PostFilter(replies=True), "is_reply"),
    "post_retweets": (PostFilter(native_retweets=True), "is_retweet"),
    "post_min_likes": (PostFilter(min_likes=50), "likes >= 50"),
    "post_min_retweets": (PostFilter(min_retweets=30), "retweets >= 30"),
    "post_min_replies": (PostFilter(min_replies=8), "replies >= 8"),
    "post_links_include": (PostFilter(links="include"), "n_urls > 0"),
    "post_links_exclude": (PostFilter(links="exclude"), "n_urls = 0"),
    "post_source": (PostFilter(source="click"), "source = 'click'"),
    "post_no_retweets": (PostFilter(filter_retweets=True), "NOT is_retweet"),
    "post_custom": (PostFilter(custom_query="likes > 50 AND language = 'en'", username="ignored"),
                    "likes > 50 AND language = 'en'"),
    "post_lang": (PostFilter(lang="de"), "language = 'de'"),
    "post_combined": (PostFilter(keyword="the", lang="en", min_likes=20, links="exclude", since="2024-01-02"),
                      "contains(lower(tweet), 'the') AND language = 'en' AND likes >= 20 AND n_urls = 0 "
                      "AND ts >= TIMESTAMP '2024-01-02 00:00:00'"),
}


def _predicate_query(name: str, f: PostFilter, where: str):
    @register(name, oracle(f"SELECT {OUT_SQL} FROM v_posts WHERE {where}", ["v_posts"]))
    def q(inp: Inputs) -> DataFrame:
        return search_posts(inp.view("v_posts"), f).select(*OUT)
    return q


for _name, (_f, _where) in PREDICATES.items():
    _predicate_query(_name, _f, _where)


@register("filter_language", oracle(f"SELECT {OUT_SQL} FROM v_posts WHERE language = 'en'", ["v_posts"]))
def filter_language(inp: Inputs) -> DataFrame:
    return inp.view("v_posts").where(F.col("language") == "en").select(*OUT)


@register("post_list", oracle(f"SELECT {OUT_SQL} FROM v_posts WHERE username IN "
                              "(SELECT username FROM v_list WHERE list_id = 'list_a')", ["v_posts", "v_list"]))
def post_list(inp: Inputs) -> DataFrame:
    return search_posts(inp.view("v_posts"), PostFilter(members_list="list_a"), lists=inp.view("v_list")).select(*OUT)


@register("post_popular_limit", oracle(f"SELECT {OUT_SQL} FROM v_posts ORDER BY likes DESC, post_id LIMIT 100",
                                       ["v_posts"]))
def post_popular_limit(inp: Inputs) -> DataFrame:
    return search_posts(inp.view("v_posts"), PostFilter(popular=True, limit=100)).select(*OUT)


@register("post_latest_limit", oracle(f"SELECT {OUT_SQL} FROM v_posts ORDER BY ts DESC, post_id LIMIT 100",
                                      ["v_posts"]))
def post_latest_limit(inp: Inputs) -> DataFrame:
    return search_posts(inp.view("v_posts"), PostFilter(limit=100)).select(*OUT)


@register("post_parse_date", oracle("""
SELECT post_id, date_text,
       CAST(epoch(COALESCE(try_strptime(date_text, '%Y-%m-%d %H:%M:%S'), try_strptime(date_text, '%Y-%m-%d')))
            AS BIGINT) AS epoch_seconds
FROM (SELECT post_id, CASE WHEN post_id % 2 = 0 THEN strftime(ts, '%Y-%-m-%-d %-H:%-M:%-S')
                           ELSE strftime(ts, '%Y-%-m-%-d') END AS date_text FROM v_posts) t""", ["v_posts"]))
def post_parse_date(inp: Inputs) -> DataFrame:
    p = inp.view("v_posts")
    txt = F.when(F.col("post_id") % 2 == 0, date_text("ts", "y-M-d H:m:s")).otherwise(date_text("ts", "y-M-d"))
    p = p.select("post_id", txt.alias("date_text"))
    return p.withColumn("epoch_seconds", epoch_seconds("date_text"))


STORED_COLS = ["post_id", "ts", "date", "tweet", "language", "username", "likes"]


@register("src_posts_window", oracle(f"SELECT {OUT_SQL} FROM v_posts WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' "
                                     "AND ts < TIMESTAMP '2024-01-31 00:00:00' AND language = 'en'", ["v_posts"]))
def src_posts_window(inp: Inputs) -> DataFrame:
    """Land the posts as a date-partitioned table, then scan one period of it."""
    path = scratch_path(inp.spark, "posts")
    write_daily(inp.view("v_posts").select(*STORED_COLS), path, "date")
    f = PostFilter(since=PERIOD.since.isoformat(), until=PERIOD.until.isoformat(), lang="en")
    return scan_posts(inp.spark, path, f).select(*OUT)


@register("post_geo_cells", oracle(f"SELECT {OUT_SQL} FROM v_posts WHERE {HAVERSINE_SQL}", ["v_posts"]))
def post_geo_cells(inp: Inputs) -> DataFrame:
    """The circle over posts stored with their grid cells: ranges of cells reach the scan."""
    path = scratch_path(inp.spark, "posts-cells")
    with_cell(inp.view("v_posts").select(*OUT, "lat", "lon")).write.parquet(path)
    return search_posts(inp.spark.read.parquet(path), PostFilter(geo="10, 20, 3000km")).select(*OUT)


@register("post_keyword_index", oracle(f"SELECT {OUT_SQL} FROM v_posts WHERE contains(lower(tweet), 'worthless') AND contains(lower(tweet), 'phone')", ["v_posts"]))
def post_keyword_index(inp: Inputs) -> DataFrame:
    """Both terms, by the trigram index of stored posts: only files that hold all trigrams are read."""
    index = KeywordIndex(inp.spark, scratch_path(inp.spark, "posts-index"))
    index.write(inp.view("v_posts").select(*OUT, "tweet", "ts"), rows_a_block=50)
    return index.search(PostFilter(keyword="Worthless PHONE")).select(*OUT)


WINDOW_POSTS = ("posts_in", f"SELECT post_id, date, tweet, {clean_sql('tweet')} AS text FROM v_posts "
                            "WHERE language = 'en' AND ts >= TIMESTAMP '2024-01-01 00:00:00' "
                            "AND ts < TIMESTAMP '2024-01-31 00:00:00'")
MART_SQL = oracle("SELECT p.post_id, p.date, p.tweet, p.text, r.sentiment FROM posts_in p "
                  "JOIN rlabelled r ON p.post_id = r.post_id", ["v_posts"], [WINDOW_POSTS, *RULES_CTES])


def posts_outputs(inp: Inputs, ngrams: bool = True):
    return build_posts(inp.view("v_posts"), PERIOD, lexicon_df(inp), ngrams=ngrams)


@register("posts_mart", MART_SQL)
def posts_mart(inp: Inputs) -> DataFrame:
    return posts_outputs(inp, ngrams=False)[0]
